"""Repeated byte strings by suffix arrays of shards."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm import texts as X
from stayline.llm.repeats import SLICE, Repeats, keyed, overlapping

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary()),
    ("n_passage_words", pa.int64()),
])
COLUMNS = (
    "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary,"
    " n_passage_words long"
)
#: Words of the shortest passage: one of over 50 words.
PASSAGE = 51
#: Between pieces; no byte of UTF-8 text has this value.
SEPARATOR = b"\xff"


def suffix_array(key, depth):
    """Suffixes in order, by Larsson-Sadakane refinement.

    `key` orders the suffixes by their first `depth` symbols. Each round sorts only the
    groups that are still tied, by the rank of the suffix `depth` symbols further on, and
    doubles the depth, until no tie is left. Places are 32-bit numbers: a shard has far
    fewer than 2^31 symbols.
    """
    n = len(key)
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    del key
    while True:
        head = np.flatnonzero(new).astype(np.int32)
        rank = np.empty(n + 1, np.int32)
        rank[n] = -1
        rank[order] = np.repeat(head, np.diff(np.append(head, n)))
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            return order
        suffix = order[tied]
        pair = rank[suffix].astype(np.int64) * (n + 1)
        pair += rank[np.minimum(suffix.astype(np.int64) + depth, n)]
        by = np.argsort(pair, kind="stable")
        order[tied] = suffix[by]
        pair = pair[by]
        new[tied[1:]] = pair[1:] != pair[:-1]
        new[tied[0]] = True
        depth *= 2


def common_prefixes(symbols, order):
    """Kasai: common prefix of every suffix and its predecessor in the order, by suffix.

    Where the symbols before both suffixes are equal the value is one less than that of
    the suffix before; only the other suffixes are compared symbol by symbol.
    """
    n = len(order)
    before = np.empty(n, np.int32)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    place = np.arange(n, dtype=np.int32)
    fresh = (before <= 0) | (place == 0)
    fresh[1:] |= symbols[:n - 1] != symbols[before[1:] - 1]
    at = np.flatnonzero(fresh).astype(np.int32)
    length = np.zeros(len(at), np.int32)
    live = np.flatnonzero(before[at] >= 0)
    while len(live):
        a, b = at[live] + length[live], before[at[live]] + length[live]
        inside = np.maximum(a, b) < n
        live = live[inside]
        same = symbols[a[inside]] == symbols[b[inside]]
        live = live[same]
        length[live] += 1
    last = np.cumsum(fresh, dtype=np.int32) - 1
    return (length + at)[last] - place


def _eights(raw):
    """The eight bytes from every place on, as one big-endian number."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(raw), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(raw)]
    return out


def repeated_starts(pieces, counts, width):
    """For each piece, which of its first `count` windows of `width` bytes occur twice."""
    raw = np.frombuffer(SEPARATOR.join([*pieces, b""]), np.uint8)
    order = suffix_array(_eights(raw), 8)
    shared = common_prefixes(raw, order)[order] >= width
    shared[:-1] |= shared[1:]
    found = np.zeros(len(raw), bool)
    found[order] = shared
    begin = np.cumsum([0, *[len(p) + 1 for p in pieces]])
    return [found[b:b + c] for b, c in zip(begin, counts)]


def repeated_word_starts(pieces, counts, width):
    """The same for pieces of words (hashes of 8 bytes each) and windows of `width` words."""
    hashes = np.frombuffer(b"".join(pieces), np.uint64)
    _, codes = np.unique(hashes, return_inverse=True)
    begin = np.cumsum([0, *[len(p) // 8 + 1 for p in pieces]])
    # The separator 0 is in no window, so windows that meet agree on words only.
    sequence = np.zeros(begin[-1], np.int64)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    sequence[inside] = codes + 1
    order = suffix_array(sequence, 1)
    shared = common_prefixes(sequence, order)[order] >= width
    shared[:-1] |= shared[1:]
    found = np.zeros(len(sequence), bool)
    found[order] = shared
    return [found[b:b + c] for b, c in zip(begin, counts)]


def _symbols(texts):
    raw = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) if t else 0 for t in texts], out=bounds[1:])
    return X.byte_values(raw), bounds


def byte_repeats(width, gram):
    return Repeats(
        width, gram, _symbols,
        lambda text: overlapping(np.frombuffer(text, np.uint8), width, hashes=X.byte_values),
        lambda text, ranges: [text[a:b] for a, b in ranges],
        lambda piece: X.byte_values(np.frombuffer(piece, np.uint8)),
        lambda pieces, counts: repeated_starts(pieces, counts, width))


def passage_repeats(width=PASSAGE, gram=7):
    """Passages of `width` words and more, from suffix arrays over words."""
    from stayline.llm.fmindex import word_repeats

    return word_repeats(width, gram, repeated_word_starts)


def both_repeats(docs, width, gram, words):
    """own, text, `spans` of repeated bytes and `passages` (spans of words) of every row."""
    rows = keyed(docs)
    spans = byte_repeats(width, gram).spans(rows)
    passages = passage_repeats(words).spans(rows).withColumnRenamed("spans", "passages")
    return rows.join(spans, "row", "left").join(passages, "row", "left").select("own", "text", "spans", "passages")


def remove_repeats(docs, width=400, gram=32, words=PASSAGE):
    """Texts without the bytes of any `width`-byte string that starts at two places.

    Candidate windows are found by anchors and brought together in shards. Each shard
    builds a suffix array by Larsson-Sadakane refinement and reads repeats off the common
    prefixes; shards that share a frequent anchor are merged by binary search in their
    sorted window digests.

    Returns doc_id, n_bytes, n_removed, spans (maximal removed runs) and kept (the other
    bytes) of every row, and n_passage_words: its words in passages of `words` words or
    more that start elsewhere too, found by suffix arrays over words, whatever their length
    in bytes. Both places of a repeat are removed, also in one document. A null text is
    empty; a text shorter than `width` stays; a long text is read in parts; repeated rows
    are copies of each other; a null id stays null; an empty table gives no rows; columns
    beside doc_id and text are ignored.
    """

    def work(batches):
        for batch in X.slices(batches, limit=SLICE):
            out = {f.name: [] for f in RESULT}
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "spans", "passages"))
            for doc, text, spans, passages in zip(*columns):
                text = text or b""
                gone = joined(spans)
                out["doc_id"].append(doc)
                out["n_bytes"].append(len(text))
                out["n_removed"].append(sum(b - a for a, b in gone))
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                edges = [0, *[x for span in gone for x in span], len(text)]
                out["kept"].append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                out["n_passage_words"].append(sum(b - a for a, b in joined(passages)))
            yield X.batch_of(RESULT, **out)

    found = both_repeats(docs, width, gram, words)
    return found.select(
        F.col("own.doc_id").cast("long").alias("doc_id"), "text", "spans", "passages").mapInArrow(work, COLUMNS)


def joined(spans):
    """Sorted spans with those that overlap or touch made one."""
    out = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return out


def _whole_characters(text, start, end):
    """The span without a character that it holds only in part."""
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def _places(text, passages):
    """Spans of words as spans of bytes, from the first byte of the first word to the last of the last."""
    words = X.Words([text])
    # One blank stands before the text.
    return [{"start": int(words.starts[p["start"]]) - 1, "end": int(words.ends[p["end"] - 1]) - 1} for p in passages]


def without_repeats(docs, width=400, gram=32, words=PASSAGE):
    """The rows of `docs` with repeated passages taken out of the text; n_chars follows it.

    What goes: passages of `words` words or more, and strings of `width` bytes or more, that
    start at two places. Each window is judged by itself, so quotations of different origin
    that only touch stay. A character that a span holds only in part stays, so that texts
    stay valid. A text of which nothing is left becomes empty; a null text stays null.
    """
    def work(batches):
        for batch in X.slices(batches, limit=SLICE):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("text", "spans", "passages"))
            for text, spans, passages in zip(*columns):
                if text is not None:
                    gone = [*(spans or ()), *(_places(text, passages) if passages else ())]
                    gone = joined(sorted(gone, key=lambda s: (s["start"], s["end"])))
                    edges = [0, *[x for span in gone for x in _whole_characters(text, *span)], len(text)]
                    text = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "replace")
                out.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(out, pa.string())], ["own", "text"])

    found = both_repeats(docs, width, gram, words)
    schema = T.StructType([found.schema["own"], T.StructField("text", T.StringType())])
    left = found.mapInArrow(work, schema)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[changed.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
