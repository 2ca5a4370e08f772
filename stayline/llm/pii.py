"""Personal data: pattern matches, and spans that a character model adds.

The model is a bidirectional LSTM over characters with CRF transitions between tags. It is
trained in numpy from labelled spans: written forms of the four kinds, those the patterns
miss included, set into passages of the corpus beside dates, prices, versions and other
look-alikes. Texts are decoded in overlapping windows; the spans of all windows are
reconciled over the whole text.
"""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

#: Runs of the characters that addresses of numbers, cards and phones are written in.
_NUMBERS = re.compile(r"[0-9+][0-9+().\x20-]*")


def digits_of(text):
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def is_ip(digits_and_dots):
    return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in digits_and_dots.split("."))


def is_card(digits):
    return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits)


def is_phone(digits):
    return PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1]


def emails(text):
    """Addresses, leftmost first. An address begins where the run of local characters before
    its at sign does, or where the one before ended; so each run is read once."""
    out, last, seen, at = [], 0, 0, text.find("@")
    while at >= 0:
        before = text[max(last, seen):at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            out.append((start, last))
        seen = at + 1
        at = text.find("@", seen)
    return out


def base_spans(text):
    """(start, kind, end) of all pattern matches, kinds as numbers; matches that fail are dropped."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for run in _NUMBERS.finditer(text):
        own, at = run[0], run.start()
        if len(own) < 7:
            continue
        if own.count(".") > 2:
            out += [(at + m.start(), 1, at + m.end()) for m in IP.finditer(own) if is_ip(m[0])]
        out += [(at + m.start(), 2, at + m.end()) for m in CARD.finditer(own) if is_card(digits_of(m[0]))]
        if "+" in own:
            out += [(at + m.start(), 3, at + m.end()) for m in PHONE.finditer(own) if is_phone(digits_of(m[0]))]
    return sorted(out)


# --- labelled spans -----------------------------------------------------------------------

_TOP = ("com", "org", "net", "de", "fr", "es", "io", "info")


def _name(draw, low=2, high=9):
    return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(low, high)))


def _number(draw, n):
    return "".join(draw.choice("0123456789") for _ in range(n))


def _luhn_number(draw):
    n = draw.choice((13, 15, 16, 16, 16, 19))
    head = _number(draw, n - 1)
    return next(head + c for c in "0123456789" if passes_luhn(head + c))


def written(draw, kind):
    """One written form of a kind: what the patterns find, or what they miss."""
    if kind == 0:
        local = draw.choice((_name(draw), f"{_name(draw)}.{_number(draw, 2)}", f"{_name(draw)}.{_name(draw)}",
                             f"{_name(draw)}_{_number(draw, draw.randint(1, 4))}"))
        names = [_name(draw) for _ in range(draw.choice((1, 1, 2)))] + [draw.choice(_TOP)]
        at, dot = draw.choice((
            ("@", "."), ("@", "."), (" @ ", "."), (" (at) ", "."), (" [at] ", "."), ("(at)", "."), ("[at]", "."),
            (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("@", " . "), ("@", "[.]"), ("[at]", "[dot]"),
            ("{at}", "."), (" @ ", " dot "), ("@", "(dot)")))
        return local + at + dot.join(names)
    if kind == 1:
        return draw.choice((".", ".", "[.]", "(.)", " . ", "[dot]")).join(str(draw.randrange(256)) for _ in range(4))
    if kind == 2:
        number = _luhn_number(draw)
        gap = draw.choice(("", " ", "-", ".", "/", "  ", "_", " - "))
        return gap.join(number[i:i + 4] for i in range(0, len(number), 4))
    a, b, c = _number(draw, 3), _number(draw, 3), _number(draw, 4)
    return draw.choice((
        f"+1 ({a}) {b}-{c}", f"+49 {a} {b}{c}", f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}",
        f"1-{a}-{b}-{c}", f"0{a}/{b}{c}", f"00{draw.randint(10, 99)} {a} {b} {c}", f"0{a} {b} {c}",
        f"({a}){b}-{c}", f"({a}) {b} {c}", f"+{draw.randint(10, 99)}/{a}/{b}{c}"))


def look_alike(draw):
    """Something with digits or signs that is no personal data."""
    n = draw.randrange(1, 9)
    return draw.choice((
        f"20{_number(draw, 2)}-0{n}-1{draw.randrange(10)}", f"1{draw.randrange(10)}/0{n}/20{_number(draw, 2)}",
        f"{draw.randrange(24)}:{_number(draw, 2)}", f"{n}.{draw.randrange(10)}", f"{n}.{draw.randrange(10)}.{draw.randrange(30)}",
        f"{draw.randrange(1000)},{_number(draw, 3)}.{_number(draw, 2)}", f"${draw.randrange(9999)}.{_number(draw, 2)}",
        f'token = "{hashlib.sha1(_name(draw).encode()).hexdigest()}"', _number(draw, draw.randint(1, 8)),
        f"ISBN 978-{n}-{_number(draw, 2)}-{_number(draw, 6)}-{draw.randrange(10)}", f"#{_number(draw, 5)}",
        f"version {n}.", f"{draw.randrange(100)}%", f"{_name(draw).upper()}-{_number(draw, 4)}-{_number(draw, 2)}",
        f"{_number(draw, 2)} x {_number(draw, 3)} cm", f"@{_name(draw)}", f"{_name(draw)} @ {_number(draw, 1)} pm",
        f"{draw.randrange(90)}.{_number(draw, 4)}, {draw.randrange(90)}.{_number(draw, 4)}", f"{_name(draw)}{n}",
        f"20{_number(draw, 2)}-0{n}-1{draw.randrange(10)} {_number(draw, 2)}:{_number(draw, 2)}:{_number(draw, 2)}",
        "(at)", f"[{_number(draw, 2)}]", f"({_number(draw, 4)})", f"{_number(draw, 16)}{_number(draw, 5)}"))


# --- characters and tags ------------------------------------------------------------------

_SIGNS = " @.-+()[]_:/,#%\"'\n{}=*$&!?;"
#: Classes: other signs, letters beyond ASCII, a digit, a-z, the signs, and beyond the text.
N_CLASSES = 3 + 26 + len(_SIGNS) + 1
PAD = N_CLASSES - 1
_CLASS = np.zeros(128, np.int64)
_CLASS[0x30:0x3A] = 2
_CLASS[0x61:0x7B] = _CLASS[0x41:0x5B] = np.arange(3, 29)
_CLASS[[ord(c) for c in _SIGNS]] = 29 + np.arange(len(_SIGNS))
_CLASS[[9, 11, 12, 13]] = _CLASS[32]
N_TAGS = 1 + 2 * len(KINDS)


def classes(text):
    """Class of every character."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(code < 128, _CLASS[np.minimum(code, 127)], 1)


def tags(n, spans):
    """Tag of each of n characters: 0 outside, 1 + 2 kind where a span begins, 2 + 2 kind inside."""
    out = np.zeros(n, np.int64)
    for start, kind, end in spans:
        out[start:end] = 2 + 2 * kind
        out[start] = 1 + 2 * kind
    return out


def spans_of(path):
    """(start, kind, end) of the spans of a tag sequence that begin with their first tag."""
    out, start, kind = [], -1, -1
    for i, tag in enumerate([*path.tolist(), 0]):
        if start >= 0 and tag != 2 + 2 * kind:
            out.append((start, kind, i))
            start = -1
        if tag % 2:
            start, kind = i, (tag - 1) // 2
    return out


def labelled(contexts, width, examples, seed=5):
    """Windows of classes and tags: forms and look-alikes set into passages of the corpus."""
    draw = random.Random(seed)
    contexts = [c for c in contexts if c] or ["and so on with words of no weight "]
    xs, ys = np.full((examples, width), PAD), np.zeros((examples, width), np.int64)
    for i in range(examples):
        text, spans = "", []
        while len(text) < width:
            passage = draw.choice(contexts)
            at = draw.randrange(len(passage))
            text += passage[at:at + draw.randrange(3, 40)]
            if draw.random() < 0.8:
                text = text.rstrip("0123456789+.-@ ") + draw.choice((" ", " ", ": ", "\n", " (", " <", ", "))
            for a, kind, b in base_spans(text[-60:]):
                at = max(0, len(text) - 60)
                if not any(at + a < e and s < at + b for s, _, e in spans):
                    spans.append((at + a, kind, at + b))
            if draw.random() < 0.55:
                kind = draw.randrange(4)
                form = written(draw, kind)
                spans.append((len(text), kind, len(text) + len(form)))
            else:
                form = look_alike(draw)
            text += form + draw.choice((" ", " ", ". ", ", ", ") ", "\n", "!! ", "### ", "> ", "; "))
        shift = draw.randrange(max(1, len(text) - width + 1))
        window = text[shift:shift + width]
        xs[i, :len(window)] = classes(window)
        # A span cut by the window's edge is no example of a whole one, nor of none.
        ys[i, :len(window)] = tags(len(text), sorted(spans))[shift:shift + width]
    return xs, ys


# --- the model ----------------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start_weights(hidden=20, embed=10, seed=3):
    draw = np.random.default_rng(seed)
    normal = lambda *shape: (draw.standard_normal(shape) * 0.25).astype(np.float32)
    weights = {
        "embed": normal(N_CLASSES, embed), "wx": normal(2, embed, 4 * hidden), "wh": normal(2, hidden, 4 * hidden),
        "b": np.zeros((2, 1, 4 * hidden), np.float32), "wo": normal(2, hidden, N_TAGS), "bo": np.zeros(N_TAGS, np.float32),
        "trans": np.zeros((N_TAGS, N_TAGS), np.float32)}
    weights["b"][:, :, hidden:2 * hidden] = 1
    return weights


def emissions(weights, x, keep=None):
    """Tag scores (time, batch, tags). Both directions run as one batch; index 1 is reversed in time."""
    n, width = x.shape
    both = np.stack([x.T, x.T[::-1]])
    hidden = weights["wh"].shape[1]
    gates = np.matmul(weights["embed"][both].reshape(2, width * n, -1), weights["wx"]).reshape(2, width, n, -1) + weights["b"][:, None]
    h = np.zeros((2, n, hidden), np.float32)
    c = np.zeros_like(h)
    hs = np.empty((2, width, n, hidden), np.float32)
    for t in range(width):
        z = gates[:, t] + np.matmul(h, weights["wh"])
        s = _sigmoid(z[..., :3 * hidden])
        g = np.tanh(z[..., 3 * hidden:])
        i, f, o = s[..., :hidden], s[..., hidden:2 * hidden], s[..., 2 * hidden:]
        old, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep is not None:
            keep.append((h, old, i, f, o, g, squashed))
        h = o * squashed
        hs[:, t] = h
    out = hs[0] @ weights["wo"][0] + hs[1, ::-1] @ weights["wo"][1] + weights["bo"]
    return (out, both, hs) if keep is not None else out


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores, trans, y):
    """Loss for each window, and gradients of the scores and the transitions, by forward and backward sums."""
    width, n, k = scores.shape
    ahead, back = np.empty((width, n, k)), np.zeros((width, n, k))
    ahead[0] = scores[0]
    for t in range(1, width):
        ahead[t] = _logsum(ahead[t - 1][:, :, None] + trans, 1) + scores[t]
    for t in range(width - 2, -1, -1):
        back[t] = _logsum(trans + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    total = _logsum(ahead[-1], 1)
    marginal = np.exp(ahead + back - total[None, :, None])
    pair = np.exp(ahead[:-1, :, :, None] + trans + (scores[1:] + back[1:])[:, :, None, :] - total[None, :, None, None])
    d_trans = pair.sum(axis=(0, 1))
    own = y.T
    t, b = np.indices(own.shape)
    marginal[t, b, own] -= 1
    np.add.at(d_trans, (own[:-1], own[1:]), -1)
    gold = scores[t, b, own].sum(axis=0) + trans[own[:-1], own[1:]].sum(axis=0)
    return float((total - gold).mean()), (marginal / n).astype(np.float32), (d_trans / n).astype(np.float32)


def gradient(weights, x, y):
    """Loss and gradients of all weights for one batch, backwards through time."""
    keep = []
    scores, both, hs = emissions(weights, x, keep)
    loss, d_scores, d_trans = crf_gradient(scores, weights["trans"], y)
    width, n, _ = scores.shape
    hidden = weights["wh"].shape[1]
    sides = np.stack([d_scores, d_scores[::-1]])
    grads = {
        "trans": d_trans, "bo": d_scores.sum(axis=(0, 1)),
        "wo": np.einsum("stnh,stnk->shk", hs, sides, optimize=True)}
    d_hs = np.matmul(sides, weights["wo"].transpose(0, 2, 1)[:, None])
    d_z = np.empty((2, width, n, 4 * hidden), np.float32)
    d_h = np.zeros((2, n, hidden), np.float32)
    d_c = np.zeros_like(d_h)
    grads["wh"] = np.zeros_like(weights["wh"])
    back = weights["wh"].transpose(0, 2, 1)
    for t in range(width - 1, -1, -1):
        h, old, i, f, o, g, squashed = keep[t]
        d_h = d_h + d_hs[:, t]
        d_c = d_c + d_h * o * (1 - squashed * squashed)
        z = d_z[:, t]
        z[..., :hidden] = d_c * g * i * (1 - i)
        z[..., hidden:2 * hidden] = d_c * old * f * (1 - f)
        z[..., 2 * hidden:3 * hidden] = d_h * squashed * o * (1 - o)
        z[..., 3 * hidden:] = d_c * i * (1 - g * g)
        grads["wh"] += np.matmul(h.transpose(0, 2, 1), z)
        d_h, d_c = np.matmul(z, back), d_c * f
    flat = d_z.reshape(2, width * n, -1)
    inputs = weights["embed"][both].reshape(2, width * n, -1)
    grads["wx"] = np.matmul(inputs.transpose(0, 2, 1), flat)
    grads["b"] = flat.sum(axis=1, keepdims=True)
    grads["embed"] = np.zeros_like(weights["embed"])
    np.add.at(grads["embed"], both.reshape(-1), np.matmul(flat, weights["wx"].transpose(0, 2, 1)).reshape(-1, inputs.shape[-1]))
    return loss, grads


def train(x, y, rounds=8, batch=48, rate=0.02, seed=9, hidden=20):
    """Weights fitted by Adam on all windows, `rounds` times in shuffled order."""
    weights = start_weights(hidden)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    draw, step = np.random.default_rng(seed), 0
    total = rounds * -(-len(x) // batch)
    for _ in range(rounds):
        order = draw.permutation(len(x))
        for start in range(0, len(x), batch):
            own = order[start:start + batch]
            _, grads = gradient(weights, x[own], y[own])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            now = rate * (1 - 0.9 * step / total)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                first, second = moment[k]
                first += 0.1 * (g - first)
                second += 0.01 * (g * g - second)
                weights[k] -= (now * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return weights


def best_paths(scores, trans):
    """The best tag sequence of each window (Viterbi)."""
    width, n, k = scores.shape
    back = np.empty((width, n, k), np.int8)
    best = scores[0]
    for t in range(1, width):
        step = best[:, :, None] + trans
        back[t] = step.argmax(axis=1)
        best = step.max(axis=1) + scores[t]
    path = np.empty((n, width), np.int64)
    path[:, -1] = best.argmax(axis=1)
    for t in range(width - 1, 0, -1):
        path[:, t - 1] = back[t, np.arange(n), path[:, t]]
    return path


# --- decoding -----------------------------------------------------------------------------

#: What every added span holds; windows without it cannot yield one.
ANCHOR = re.compile(r"[0-9@]|[(\[{]at[)\]}]", re.IGNORECASE)
_DOT = re.compile(r"\s*(?:[\[({]\s*(?:\.|dot)\s*[\])}]|\s+dot\s+)\s*|\s+\.\s+|\s*\.\s*", re.IGNORECASE)
_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s*@\s*", re.IGNORECASE)
_PLAIN = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def holds(kind, span):
    """Whether the text of a decoded span can be of its kind, written plainly."""
    if kind == 0:
        return _PLAIN.fullmatch(_DOT.sub(".", _AT.sub("@", span))) is not None
    if kind == 1:
        parts = _DOT.sub(".", span).split(".")
        return len(parts) == 4 and all(x.isascii() and x.isdigit() for x in parts) and is_ip(".".join(parts))
    if not all(c.isascii() and (c.isdigit() or c in " ().-/_+") for c in span):
        return False
    return (is_card if kind == 2 else is_phone)(digits_of(span)) and "." not in span[-1:]


def trimmed(text, start, end):
    """The span without the white space and signs around it."""
    while start < end and text[start] in " \t\n,;:!?":
        start += 1
    while end > start and text[end - 1] in " \t\n,;:!?.":
        end -= 1
    return start, end


def window_starts(text, width, stride, every=False):
    """Starts of the windows (multiples of `stride`) that hold an anchor, or of all."""
    n = len(text)
    if every:
        return list(range(0, max(1, n - width + stride), stride))
    out, last = [], max(0, -(-max(0, n - width) // stride))
    for m in ANCHOR.finditer(text):
        low = max(0, -(-(m.end() - width) // stride))
        for k in range(max(low, out[-1] + 1 if out else 0), min(last, m.start() // stride) + 1):
            out.append(k)
    return [k * stride for k in out]


def reconciled(text, base, votes):
    """Added spans of a whole text from the spans of all its windows.

    `votes` counts the windows that gave a (start, kind, end). Spans that touch a base span or
    fail the check of their kind go; of those that overlap, the one with more windows stays,
    then the longer, then the first.
    """
    taken, out = [(a, b) for a, _, b in base], []
    for (start, kind, end), n in sorted(votes.items(), key=lambda x: (-x[1], x[0][0] - x[0][2], x[0])):
        if not any(a < end and start < b for a, b in taken) and holds(kind, text[start:end]) and ANCHOR.search(text, start, end):
            taken.append((start, end))
            out.append((start, kind, end))
    return out


def decoded(texts, bases, weights, width=96, stride=48, every=False, batch=256):
    """Added spans of each text. Windows of all texts are decoded side by side."""
    places = [(i, s) for i, text in enumerate(texts) for s in window_starts(text, width, stride, every)]
    votes = [{} for _ in texts]
    for first in range(0, len(places), batch):
        own = places[first:first + batch]
        x = np.full((len(own), width), PAD)
        for row, (i, s) in enumerate(own):
            code = classes(texts[i][s:s + width])
            x[row, :len(code)] = code
        for (i, s), path in zip(own, best_paths(emissions(weights, x), weights["trans"])):
            n = len(texts[i])
            for start, kind, end in spans_of(path) if path.any() else ():
                # A span at an inner edge of the window is whole in the next one.
                if (start == 0 and s > 0) or (end == width and s + width < n):
                    continue
                a, b = trimmed(texts[i], s + start, min(n, s + end))
                if b > a:
                    votes[i][a, kind, b] = votes[i].get((a, kind, b), 0) + 1
    return [reconciled(t, base, v) if v else [] for t, base, v in zip(texts, bases, votes)]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
RESULT = pa.schema([
    ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS],
    ("base", pa.list_(SPAN)), ("spans", pa.list_(SPAN))])
COLUMNS = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
           " base array<struct<kind: string, start: long, end: long>>,"
           " spans array<struct<kind: string, start: long, end: long>>")


def contexts_of(docs, sample=400, chars=1500):
    """Passages to set examples into: the starts of at most `sample` different texts, first by hash.

    A share of the hashes that holds about four times as many texts is read, so tasks send
    the driver a few rows however large the corpus is; copies are one text.
    """
    text = F.substring(F.col("text").cast("string"), 1, chars)
    known = docs.where("text is not null")
    share = min(1.0, 4 * sample / max(1, known.count()))
    rows = known.select(text.alias("text"), F.xxhash64(text).alias("h")).where(
        F.col("h") <= min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
    found = rows.groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(sample).collect()
    return [r["text"] for r in found]


def fit(docs, sample=400, examples=2400, width=96, rounds=8):
    """Weights of the model, trained on `examples` windows with passages of `sample` documents."""
    return train(*labelled(contexts_of(docs, sample), width, examples), rounds=rounds)


def joined(column):
    """kind:start:end of a column of spans, joined by commas."""
    return F.array_join(F.transform(F.col(column), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs, weights=None, width=96, stride=48):
    """Personal data in every text: doc_id, n_email, n_ip, n_card, n_phone, base, spans.

    The counts and `base` (kind, start, end in code points, by start, then kind) are of the
    patterns; `spans` has these and what the model adds. A span that the model adds holds a
    digit or an at sign (`@`, or `at` in brackets), fits its kind when written plainly (four
    parts up to 255, the card checksum, 9 to 15 digits), and touches no base span; windows
    of `width` characters every `stride` overlap by more than such a span is long. As a
    window without a digit or an at sign holds none, it is not decoded: the result is that
    of decoding all.

    A null or empty text has no spans; repeated rows give repeated results; an empty table
    gives none; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights or fit(docs))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def work(batches):
        for batch in X.slices(batches, limit=1 << 19):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = decoded(texts, base, shared.value, width, stride)
            named = lambda rows: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(rows)]
            counts = [[sum(k == kind for _, k, _ in own) for own in base] for kind in range(len(KINDS))]
            yield X.batch_of(
                RESULT, doc_id=batch.column("doc_id"), base=[named(b) for b in base],
                spans=[named(b + a) for b, a in zip(base, added)],
                **{f"n_{k}": c for k, c in zip(KINDS, counts)})

    return source.mapInArrow(work, COLUMNS)
