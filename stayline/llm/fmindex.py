"""Repeated word windows by compressed FM-indexes of shards."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.llm.repeats import SLICE, Repeats, overlapping
from stayline.llm.suffixarray import joined, suffix_array

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary()),
])
COLUMNS = (
    "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary"
)


class BitRank:
    """Bits in words of 64, with the number of ones before each word."""

    def __init__(self, bits):
        n = -(-(len(bits) + 1) // 64) * 64
        packed = np.packbits(np.pad(bits, (0, n - len(bits))), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i):
        """Ones in the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletTree:
    """Occurrences of a symbol in any prefix of a sequence, one bit per symbol and level.

    Levels go from the highest bit down; each level is ordered by the bits above it, with
    zeros first, so nodes need no pointers.
    """

    def __init__(self, symbols, height):
        self.levels = []
        for shift in range(height - 1, -1, -1):
            bits = ((symbols >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, BitRank(bits), int(len(bits) - bits.sum())))
            symbols = symbols[np.argsort(bits, kind="stable")]

    def ranks(self, symbols, low, high):
        """Places that the symbols' occurrences before `low` and before `high` reach at the
        lowest level; their difference is the number of occurrences in between."""
        for shift, bits, zeros in self.levels:
            one = ((symbols >> shift) & 1).astype(bool)
            a, b = bits.ones(low), bits.ones(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return low, high


class FMIndex:
    """Burrows-Wheeler transform of a sequence of positive integers in a wavelet tree."""

    def __init__(self, sequence):
        n, height = len(sequence), max(1, int(sequence.max()).bit_length())
        # The end of the sequence, symbol 0, stands before all others.
        order = suffix_array(np.append(sequence, 0), 1)
        transform = np.append(sequence, 0)[order - 1]
        self.tree = WaveletTree(transform, height)
        count = np.bincount(transform, minlength=(1 << height) + 1)
        self.less = np.concatenate([[0], np.cumsum(count)])
        zero = np.zeros(1 << height, np.int64)
        self.base, _ = self.tree.ranks(np.arange(1 << height), zero, zero)
        self.size = n + 1

    def step(self, symbols, low, high):
        """Suffix ranges of the pattern with the symbol put before it."""
        a, b = self.tree.ranks(symbols, low, high)
        start = self.less[symbols] - self.base[symbols]
        return start + a, start + b

    def matches(self, sequence, ends, longest):
        """Length, up to `longest`, of the longest match that ends before each of `ends`
        and lies in the index twice: matching statistics by backward search.

        Every place searches on its own; those whose pattern is unique stop.
        """
        length = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for step in range(1, longest + 1):
            live = live[ends[live] >= step]
            symbols = sequence[ends[live] - step]
            low[live], high[live] = self.step(symbols, low[live], high[live])
            live = live[high[live] - low[live] >= 2]
            if not len(live):
                break
            length[live] = step
        return length


def repeated_starts(pieces, counts, width):
    """For each piece, which of its first `count` windows of `width` words occur twice.

    The pieces (hashes of words, 8 bytes each) are indexed together and then streamed
    through the index; a match never crosses the separator 1 between two pieces because
    no window holds it.
    """
    size = [len(p) // 8 for p in pieces]
    hashes = np.frombuffer(b"".join(pieces), np.uint64)
    _, codes = np.unique(hashes, return_inverse=True)
    begin = np.cumsum([0, *[s + 1 for s in size]])
    sequence = np.ones(begin[-1], np.int64)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    sequence[inside] = codes + 2
    starts = np.concatenate([np.arange(b, b + c) for b, c in zip(begin, counts)])
    found = FMIndex(sequence).matches(sequence, starts + width, width) >= width
    return np.split(found, np.cumsum(counts)[:-1])


def _symbols(texts):
    words = X.Words(texts)
    return words.hashes(), words.bounds


def _cut(text, ranges):
    hashes = X.long_words(text)
    return [hashes[a:b].tobytes() for a, b in ranges]


def word_repeats(width, gram, index):
    """Repeats of windows of words, told apart by 64-bit hashes of the words."""
    return Repeats(
        width, gram, _symbols, lambda text: overlapping(X.long_words(text), width), _cut,
        lambda piece: np.frombuffer(piece, np.uint64), lambda pieces, counts: index(pieces, counts, width))


def remove_repeats(docs, width=35, gram=5):
    """Texts without the words of any window of `width` words that starts at two places.

    Candidate windows are found by anchors and brought together in shards. Each shard
    builds an FM-index, a Burrows-Wheeler transform in a wavelet tree, streams its
    documents' pieces through it by backward search, and reports the places whose match
    reaches the threshold `width`. Shards that share a frequent anchor exchange window
    digests. Words are told apart by 64-bit hashes.

    Returns doc_id, n_words, n_removed, spans (of words) and kept (the other words joined
    by one space) of every row. Both places of a repeat are removed, also in one
    document. A null text has no words; a text with fewer than `width` words stays;
    repeated rows are copies of each other; a null id stays null; an empty table gives no
    rows; columns beside doc_id and text are ignored.
    """
    repeats = word_repeats(width, gram, repeated_starts)

    def work(batches):
        for batch in X.slices(batches, limit=SLICE):
            out = {f.name: [] for f in RESULT}
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))
            for doc, text, spans in zip(*columns):
                words = text.split() if text else []
                gone = joined(spans)
                out["doc_id"].append(doc)
                out["n_words"].append(len(words))
                out["n_removed"].append(sum(b - a for a, b in gone))
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                edges = [0, *[x for span in gone for x in span], len(words)]
                out["kept"].append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]))
            yield X.batch_of(RESULT, **out)

    return repeats.find(docs).select(F.col("own.doc_id").cast("long").alias("doc_id"), "text", "spans").mapInArrow(work, COLUMNS)
