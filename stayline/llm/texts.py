"""Words, windows and hashes of many texts at once, as numpy arrays inside a task.

Texts arrive as UTF-8 bytes. A word is `[^\\x20\\x09-\\x0D]+`, and lower case changes A-Z
only.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier of the rolling window hash, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def slices(batches, column="text", limit=1 << 20):
    """Record batches cut so that each piece has about `limit` bytes of text.

    One row is never cut, however long its text is.
    """
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        start = 0
        for end in [*(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """All words of some texts: where they lie in one byte buffer, and their hashes.

    Word i is `buffer[starts[i]:ends[i]]`; text k has the words `bounds[k]` to
    `bounds[k + 1]`.
    """

    def __init__(self, texts):
        texts = [t or b"" for t in texts]
        self.raw = b" ".join([b"", *texts, b""])
        self.buffer = np.frombuffer(self.raw, np.uint8)
        space = _SPACE[self.buffer]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        begin = np.ones(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        begin[1:] += 1
        self.bounds = np.searchsorted(self.starts, begin)

    def __len__(self):
        return len(self.starts)

    def hashes(self, lower=False):
        """64-bit hash of every word's bytes, A-Z as a-z if `lower`."""
        return self.spans(self.starts, self.ends, lower)

    def spans(self, starts, ends, lower=False):
        """64-bit hashes of ranges of the buffer."""
        return Rolling((_LOWER if lower else _BYTES)[self.buffer])(starts, ends)

    def word(self, i):
        return self.raw[self.starts[i]:self.ends[i]]

    def texts(self):
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


class Seen:
    """Rows of the hashes met so far; what was computed once for a word is found again."""

    def __init__(self):
        self.rows = {}

    def places(self, keys):
        """Row of each (distinct) key, and which keys are new; these get the next rows."""
        get = self.rows.get
        keys = keys.tolist()
        found = np.array([get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(found < 0)
        for row, i in enumerate(new.tolist(), len(self.rows)):
            self.rows[keys[i]] = row
        found[new] = np.arange(len(self.rows) - len(new), len(self.rows))
        return found, new


def mixed(x):
    """Final avalanche of a 64-bit hash."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Random value of each byte, and the same with A-Z as a-z.
_BYTES = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 256, np.uint64)
_LOWER = _BYTES.copy()
_LOWER[0x41:0x5B] = _BYTES[0x61:0x7B]



def byte_values(raw):
    """Random 64-bit value of each byte."""
    return _BYTES[raw]


_POWERS = {}


def powers(base, n):
    """The first n powers of `base`; the longest array asked for so far is kept."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


class Rolling:
    """Hash of any range of a sequence of integers, by prefix sums modulo 2^64.

    The hash of a range depends on its values only, not on where it lies.
    """

    def __init__(self, values):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64, copy=False) * powers(INVERSE, n), dtype=np.uint64, out=self.sums[1:])
        self.lift = powers(BASE, n + 1)

    def __call__(self, start, end):
        """Hashes of [start, end), arrays or slices of equal length."""
        return mixed((self.sums[end] - self.sums[start]) * self.lift[start])

    def windows(self, width):
        """Hash of each range of `width` values, by start."""
        n = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:n]) * self.lift[:n]) if n else np.zeros(0, np.uint64)


def long_hash(word, size=1 << 18):
    """The hash that `Words` gives a word, taken part by part."""
    total = 0
    for at in range(0, len(word), size):
        values = _BYTES[np.frombuffer(word[at:at + size], np.uint8)]
        part = int((values * powers(INVERSE, len(values))).sum(dtype=np.uint64))
        total += part * pow(INVERSE, at, 1 << 64)
    return mixed(np.array([total % (1 << 64)], np.uint64))


def long_words(text, size=1 << 18):
    """Hashes of all words of a long text, read in parts that end at white space."""
    out, start = [np.zeros(0, np.uint64)], 0
    while start < len(text):
        end = min(len(text), start + size)
        last = end
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        if end - last > size:
            # One word goes on for more than a part.
            while last > start and not _SPACE[text[last - 1]]:
                last -= 1
            out += [Words([text[start:last]]).hashes(), long_hash(text[last:end])]
        else:
            out.append(Words([text[start:end]]).hashes())
        start = end
    return np.concatenate(out)


def runs(marked):
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def covered(starts, ends, n):
    """Which of n places lie in any of the ranges [start, end)."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:n]) > 0


def map_rows(docs, work):
    """`mapInArrow` that gives rows of the same columns, whatever these are called."""
    names, plain = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    numbered = docs.toDF(*plain)

    def renamed(batches):
        for batch in work(b.rename_columns(names) for b in batches):
            yield batch.rename_columns(plain)

    return numbered.mapInArrow(renamed, numbered.schema).toDF(*names)


def batch_of(schema, **columns):
    """Record batch with the columns in the order of the Arrow schema."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
