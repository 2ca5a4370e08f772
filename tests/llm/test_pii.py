"""Personal data: patterns against plain regular expressions, gradients, held-out spans, windows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and pii.passes_luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


CONTEXTS = ["the of and leaux der ción with from, that. is\nan ereau die und est " * 6, "Éoi ünd ñas — the 12 of 1999, no. 5 " * 8]


@pytest.fixture(scope="module")
def weights():
    return pii.train(*pii.labelled(CONTEXTS, 96, 1600), rounds=6)


def test_patterns_equal_plain_regular_expressions():
    draw = random.Random(4)
    signs = ["a", "b.c", "@", "@", ".", "-", "_", "+", "%", " ", "1", "25", "255", "256", "4111", "0", "(", ")", "é", "\n", "/", "12345678"]
    for _ in range(6000):
        text = "".join(draw.choice(signs) for _ in range(draw.randrange(40)))
        assert pii.base_spans(text) == plain(text), repr(text)
    for kind in range(4):
        for _ in range(300):
            text = f"x {pii.written(draw, kind)} y+{pii.look_alike(draw)}@{pii.written(draw, kind)}"
            assert pii.base_spans(text) == plain(text), repr(text)


def test_patterns_take_time_in_proportion():
    for text in ("a" * 300_000, "a@" * 150_000, "1." * 150_000, "+1" * 150_000, "1" * 300_000, "a.b@c" * 60_000):
        pii.base_spans(text)


def test_gradients_equal_differences():
    x, y = pii.labelled(CONTEXTS, 24, 5)
    weights = {k: v.astype(np.float64) for k, v in pii.start_weights(6, 4).items()}
    draw, (_, grads) = np.random.default_rng(1), pii.gradient(weights, x, y)
    for name, value in weights.items():
        for _ in range(3):
            at, step = tuple(draw.integers(0, s) for s in value.shape), 1e-2
            sides = []
            for sign in (1, -1):
                moved = weights | {name: value.copy()}
                moved[name][at] += sign * step
                sides.append(pii.gradient(moved, x, y)[0])
            assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / (2 * step), rel=0.02, abs=2e-3)


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(2)
    scores, trans = draw.normal(size=(4, 3, pii.N_TAGS)), draw.normal(size=(pii.N_TAGS, pii.N_TAGS))
    found = pii.best_paths(scores, trans)
    grids = np.stack(np.meshgrid(*[np.arange(pii.N_TAGS)] * 4, indexing="ij")).reshape(4, -1)
    for b in range(3):
        total = sum(scores[t, b, grids[t]] for t in range(4)) + sum(trans[grids[t], grids[t + 1]] for t in range(3))
        assert found[b].tolist() == grids[:, total.argmax()].tolist()


def test_held_out_spans_are_found(weights):
    """Forms in new passages: what the patterns miss is added, look-alikes are left alone."""
    draw, found, n, wrong, clean = random.Random(77), 0, 0, 0, 0
    texts, truth = [], []
    for i in range(400):
        left, right = "and the oreau of ", " was der est. Ereau ción the"
        form = pii.written(draw, draw.randrange(4)) if i % 2 else pii.look_alike(draw)
        texts.append(left + form + right)
        truth.append((len(left), len(left) + len(form)) if i % 2 else None)
    bases = [pii.base_spans(t) for t in texts]
    for base, added, span in zip(bases, pii.decoded(texts, bases, weights), truth):
        spans = {(a, b) for a, _, b in base + added}
        if span:
            n, found = n + 1, found + (span in spans)
        else:
            clean, wrong = clean + 1, wrong + bool(added)
    assert found >= 0.8 * n and wrong <= 0.04 * clean
    missed = [i for i, s in enumerate(truth) if s and not bases[i]]
    added = pii.decoded([texts[i] for i in missed], [[] for _ in missed], weights)
    assert len(missed) > 40 and sum(bool(a) for a in added) >= 0.6 * len(missed)


def test_skipped_windows_hold_nothing(weights):
    """Decoding every window gives the same spans, in long texts and at every offset."""
    draw = random.Random(6)
    texts = []
    for i in range(60):
        text = ""
        while len(text) < 40 + 15 * i:
            text += draw.choice(CONTEXTS)[:draw.randrange(120)] + draw.choice(["", pii.written(draw, draw.randrange(4)), pii.look_alike(draw)]) + " "
        texts.append(text)
    bases = [pii.base_spans(t) for t in texts]
    some, every = (pii.decoded(texts, bases, weights, every=e) for e in (False, True))
    assert some == every and sum(map(len, some)) > 10
    for text, base, added in zip(texts, bases, some):
        spans = sorted((a, b) for a, _, b in added)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        assert not any(a < d and c < b for a, b in spans for c, _, d in base)


def test_table(spark, weights):
    rows = [(1, "mail jo.7@mail.example.com or 10.0.0.1 now"), (2, None), (3, ""), (1, "mail jo.7@mail.example.com or 10.0.0.1 now"),
            (None, "call (743) 555-3824 today or pay 4111 1111 1111 1111"), (4, "é +1 (743) 555-3824 " + "x" * 5000 + " 1.2.3.400")]
    docs = spark.createDataFrame([(i, t, 0, "b") for i, t in rows], "doc_id long, text string, n_email long, base string")
    found = pii.personal_data(docs, weights).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", pii.joined("base").alias("b"), pii.joined("spans").alias("s"))
    got = sorted(map(str, (tuple(r)[:6] for r in found.collect())))
    expected = []
    for i, t in rows:
        base = plain(t or "")
        counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
        expected.append(str((i, *counts, ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base))))
    assert got == sorted(expected)
    assert all(r.b in r.s or set(r.b.split(",")) <= set(r.s.split(",")) for r in found.collect())
    assert pii.personal_data(docs.limit(0), weights).count() == 0
    assert re.match("phone:[56]:19,", found.where(F.col("doc_id").isNull()).first().s)


def test_examples_come_from_different_texts(spark):
    docs = spark.createDataFrame([(i, "the same text" if i % 3 else f"text {i}") for i in range(300)] + [(400, None)], "doc_id long, text string")
    found = pii.contexts_of(docs, sample=20)
    assert len(found) == len(set(found)) and 10 <= len(found) <= 20
    assert pii.contexts_of(docs.limit(0)) == []
