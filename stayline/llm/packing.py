"""Examples packed into training sequences under several limits at once.

Vector bin packing by the dot-product heuristic: an example has a demand in tokens,
segments and loss-bearing tokens; the open sequence takes the example whose demand has
the largest dot product with what is left of the limits, both scaled by the limits.
Each task packs its own examples, so nothing is shuffled.
"""

import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from stayline.llm import texts as X

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ("loss_tokens", pa.int64()),
])
COLUMNS = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long,"
    " offset long, loss_tokens long"
)


# Closing marks that the tokenizer cuts off a word by itself.
_MARK = np.zeros(256, bool)
_MARK[list(b".,!?;:")] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True


class KnownUnits:
    """Rows of the hashes met so far, as sorted arrays: 16 bytes each."""

    def __init__(self):
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def places(self, keys):
        """Row of each of the sorted, distinct keys, and which keys are new; these get the next rows."""
        n, at = len(self.keys), np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < n
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        found = np.empty(len(keys), np.int64)
        found[known] = self.rows[at[known]]
        found[new] = np.arange(n, n + len(new))
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.rows = np.insert(self.rows, at[new], found[new])
        return found, new


class WordTokenizer:
    """Token ids of texts by way of their distinct words.

    For a vocabulary of lower case whose pre-tokenizer drops white space and cuts runs of
    letters from runs of marks. Closing marks after a letter or digit are taken as a unit
    of their own; each distinct unit is encoded once and kept, up to `bound` units. Units
    of Latin letters alone go straight to the merges, all others through the tokenizer.
    """

    def __init__(self, path, bound=800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.encoder, self.bound = Tokenizer.from_file(path), bound
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(256) if chr(c).isalpha()]
        self.letters = {ord(c): level.pre_tokenize_str(c.lower())[0][0] for c in letters}
        self._clear()

    def _clear(self):
        self.seen, self.flat, self.first = KnownUnits(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, units):
        model, out, rest = self.encoder.model, [None] * len(units), []
        for i, unit in enumerate(units):
            text = unit.decode("utf-8", "replace")
            if text.isalpha() and max(text) < "\u0100":
                out[i] = [t.id for t in model.tokenize(text.translate(self.letters))]
            else:
                rest.append((i, text))
        for k in range(0, len(rest), 4096):
            part = rest[k:k + 4096]
            texts = [t for _, t in part]
            for (i, _), e in zip(part, self.encoder.encode_batch_fast(texts, add_special_tokens=False)):
                out[i] = e.ids
        return out

    def _units(self, words):
        """Starts and ends of all units, and how many units each word has."""
        ends, buffer = words.ends.copy(), words.buffer
        for _ in range(4):
            ends -= _MARK[buffer[ends - 1]] & (ends - 1 > words.starts)
        cut = (ends < words.ends) & _PLAIN[buffer[ends - 1]]
        ends = np.where(cut, ends, words.ends)
        count = 1 + cut
        at = np.cumsum(count) - count
        start, end = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
        start[at], end[at] = words.starts, ends
        start[at[cut] + 1], end[at[cut] + 1] = ends[cut], words.ends[cut]
        return start, end, count

    def __call__(self, texts):
        """Ids of all texts in one array, and the bounds of each text."""
        words = X.Words(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if len(self.first) > self.bound:
            self._clear()
        start, end, count = self._units(words)
        keys, one, place = np.unique(
            words.spans(start, end), return_index=True, return_inverse=True)
        rows, new = self.seen.places(keys)
        found = self._encode([words.raw[start[i]:end[i]] for i in one[new].tolist()])
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32, size.sum())])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
        rows = rows[place]
        first, size = self.first[rows], self.first[rows + 1] - self.first[rows]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(first - (ends - size), size) + np.arange(ends[-1])]
        units = np.concatenate([[0], np.cumsum(count)])[words.bounds]
        return ids, np.concatenate([[0], ends])[units]


@cache
def tokenizer(path):
    """The tokenizer of this worker process; its known units serve the next task too."""
    return WordTokenizer(path)


class Packer:
    """Packs examples of one task; `sequences` yields each closed sequence's pieces."""

    def __init__(self, capacity, max_segments, max_loss, pool):
        if min(capacity, max_segments, max_loss) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits = np.array([capacity, max_segments, max_loss], np.int64)
        self.size = pool
        # (document, start, ids, loss start): parts of documents not yet placed.
        self.items = []

    def add(self, items):
        """Whole documents, cut so that every part alone keeps the limits."""
        for doc, ids, loss_start in items:
            for start in range(0, len(ids), self.limits[0]):
                part = ids[start:start + self.limits[0]]
                self.items.append((doc, start, part, max(0, loss_start - start)))

    def _demands(self):
        n = len(self.items)
        length = np.fromiter((len(i[2]) for i in self.items), np.int64, n)
        loss = np.maximum(0, length - np.fromiter((i[3] for i in self.items), np.int64, n))
        return np.stack([length, np.ones(n, np.int64), loss])

    def sequences(self, last=False):
        """Close sequences while the pool is full, or until it is empty at the end."""
        while self.items and (last or len(self.items) > self.size):
            demand, taken = self._demands(), set()
            returned = []
            keep = 0 if last else self.size // 2
            while len(self.items) - len(taken) > keep:
                pieces = self._fill(demand, taken)
                yield self._closed(pieces, returned)
            self.items = [x for i, x in enumerate(self.items) if i not in taken] + returned

    def _fill(self, demand, taken):
        left, pieces = self.limits.copy(), []
        while left[:2].min() > 0:
            weight = left / self.limits**2
            value = weight @ demand
            fits = (demand <= left[:, None]).all(axis=0)
            if fits.any():
                best = int(np.argmax(np.where(fits, value, -1.0)))
                pieces.append(self.items[best])
                left -= demand[:, best]
                demand[:, best] = np.iinfo(np.int32).max
                taken.add(best)
                continue
            open_ = demand[0] < np.iinfo(np.int32).max
            if not open_.any():
                break
            best = int(np.argmax(np.where(open_, value, -1.0)))
            doc, start, ids, loss_start = self.items[best]
            cut = int(min(left[0], len(ids) - 1, loss_start + left[2]))
            if cut <= 0:
                break
            pieces.append((doc, start, ids[:cut], loss_start))
            left -= [cut, 1, max(0, cut - loss_start)]
            rest = (doc, start + cut, ids[cut:], max(0, loss_start - cut))
            self.items[best] = rest
            demand[:, best] = [len(rest[2]), 1, max(0, len(rest[2]) - rest[3])]
        return pieces

    def _closed(self, pieces, returned):
        """Pieces cut back to a length that needs no padding: full, or a power of two."""
        length = sum(len(p[2]) for p in pieces)
        if length == self.limits[0]:
            return pieces
        surplus = length - (1 << (length.bit_length() - 1))
        while surplus:
            doc, start, ids, loss_start = pieces.pop()
            cut = max(0, len(ids) - surplus)
            if cut:
                pieces.append((doc, start, ids[:cut], loss_start))
            returned.append((doc, start + cut, ids[cut:], max(0, loss_start - cut)))
            surplus -= len(ids) - cut
        return pieces


def pack(docs, tokenizer_path, capacity=4096, max_segments=256, max_loss=4096, end_id=2,
         loss_start=None, pool=1024):
    """Pieces of all documents, each id in exactly one piece.

    A document is its text's ids and then `end_id`; a null or empty text is that id
    alone. `loss_start` names a column with the first loss-bearing token (null: 0);
    without it every token bears loss. Returns doc_id, start (ids of the document
    before the piece), length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id (unique in the result), offset (in the sequence, gapless from 0) and
    loss_tokens. A sequence has at most `capacity` tokens, `max_segments` pieces and
    `max_loss` loss-bearing tokens, and ends full or at a power of two.

    Rows are handled one by one: repeated rows are packed again, a null doc_id stays
    null, other columns are ignored, an empty table gives no pieces. `pool` bounds the
    parts of documents that a task holds at a time.
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        (F.coalesce(F.col(loss_start), F.lit(0)) if loss_start else F.lit(0)).cast("long").alias("loss"))

    def work(batches):
        encode, packer = tokenizer(tokenizer_path), Packer(capacity, max_segments, max_loss, pool)
        first, made = TaskContext.get().partitionId() << 33, 0
        for batch in X.slices(batches):
            ids, bounds = encode(batch.column("text").to_pylist())
            docs = zip(batch.column("doc_id").to_pylist(), batch.column("loss").to_pylist())
            for k, (doc, loss) in enumerate(docs):
                own = np.append(ids[bounds[k]:bounds[k + 1]], np.uint32(end_id))
                packer.add([((doc, len(own)), own, loss)])
            rows = list(packer.sequences())
            if rows:
                yield _batch(rows, first + made)
                made += len(rows)
        rows = list(packer.sequences(last=True))
        if rows:
            yield _batch(rows, first + made)

    return source.mapInArrow(work, COLUMNS)


def _batch(sequences, first):
    rows = []
    for k, pieces in enumerate(sequences):
        offset = 0
        for (doc, tokens), start, ids, loss_start in pieces:
            loss = max(0, len(ids) - loss_start)
            rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), tokens, first + k, offset, loss))
            offset += len(ids)
    return X.batch_of(PIECES, **dict(zip(PIECES.names, zip(*rows))))
