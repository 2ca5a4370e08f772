"""Benchmark passages in documents, also with other numbers, names or units.

Words become canonical tokens: numbers, units after numbers, and names turn into typed
placeholders. Windows of canonical tokens of the documents are hash-joined with those of
the benchmark; a match counts if the slots behind the placeholders map consistently.
"""

import re
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.session import scratch_path

#: Bits of the filter of template keys that every task gets (2 MB), and bytes of text read at a time.
FILTER_BITS, SLICE = 24, 1 << 18

LITERAL, NUMBER, UNIT, NAME, NOTHING = range(5)

# Names of units.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l ms s sec min h hr hrs day days week weeks"
    " month months year years second seconds minute minutes hour hours meter meters metre metres"
    " kilometer kilometers kilometre kilometres mile miles inch inches foot feet gram grams"
    " kilogram kilograms pound pounds liter liters litre litres percent dollar dollars euro euros"
    " cent cents usd eur gbp mph kmh hz khz mhz ghz kb mb gb tb w kw mw v a pa bar c f k".split()
)
NUMERIC = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?(?:[a-z]{1,3})?$", re.I)
SENTENCE_END = re.compile(r"[.!?:;][\"')\]]*$")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "$%") + "«»“”„‘’–—…¿¡"

MATCHES = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_windows", pa.int64()),
    ("n_matched", pa.int64()), ("n_slots", pa.int64()), ("n_changed", pa.int64()),
])
TEMPLATES = pa.schema([
    ("item", pa.int64()), ("n", pa.int64()), ("own", pa.int64()), ("key", pa.int64()),
    ("width", pa.int64()), ("kinds", pa.binary()), ("item_values", pa.binary()),
])
TEMPLATE_COLUMNS = "item long, n long, own long, key long, width long, kinds binary, item_values binary"
WINDOWS = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("at", pa.int64()), ("doc_values", pa.binary()),
])
WINDOW_COLUMNS = "row long, doc_id long, key long, at long, doc_values binary"
JOINED = ["row", "item", "doc_id", "n", "own", "at", "kinds", "item_values", "doc_values"]
FOUND = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("item", pa.int64()), ("n_windows", pa.int64()),
    ("n_matched", pa.int64()), ("n_slots", pa.int64()), ("n_changed", pa.int64()),
])
FOUND_COLUMNS = (
    "row long, doc_id long, item long, n_windows long, n_matched long, n_slots long, n_changed long"
)


def _kind(word):
    """(canonical text, kind without context, is a unit, is capitalised, ends a sentence)."""
    word = word.decode("utf-8", "replace")
    core = word.strip(EDGE)
    if not core:
        return "", NOTHING, False, False, bool(SENTENCE_END.search(word))
    if core[0] in "+-$€£0123456789" and NUMERIC.match(core):
        return core.lower(), NUMBER, False, False, bool(SENTENCE_END.search(word))
    low = core.lower()
    return low, LITERAL, low in UNITS, core[0] != low[0], word[-1] in ".!?:;\"')]" and bool(SENTENCE_END.search(word))


class Kinds:
    """What `_kind` says of each word; kept for words met again, up to `bound` words."""

    def __init__(self, bound=500_000):
        self.bound = bound
        self._clear()

    def _clear(self):
        self.seen, self.table, self.values = X.Seen(), np.zeros((0, 4), np.int8), np.zeros(0, np.uint64)

    def __call__(self, words):
        """(value hash, kind, unit, capital, end) of every word, as arrays."""
        if len(self.values) > self.bound:
            self._clear()
        keys, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
        rows, new = self.seen.places(keys)
        found = [_kind(words.word(i)) for i in first[new].tolist()]
        value = X.Words([f[0].encode() for f in found])
        if len(value) == len(found):
            hashes = value.hashes()
        else:
            hashes = np.zeros(len(found), np.uint64)
            hashes[np.diff(value.bounds) > 0] = value.hashes()
        self.values = np.concatenate([self.values, hashes])
        self.table = np.concatenate([self.table, np.array([f[1:] for f in found], np.int8).reshape(-1, 4)])
        rows = rows[place]
        return (self.values[rows], *self.table[rows].T)


@cache
def kinds_of_worker():
    """The known words of this worker process; they serve the next task too."""
    return Kinds()


class Canonical:
    """Canonical tokens of many texts: kind, value hash and token hash of each, and bounds."""

    def __init__(self, texts, kinds):
        words = X.Words(texts)
        bounds = words.bounds
        value, kind, unit, capital, end = kinds(words)
        n = len(words)
        first = np.zeros(n, bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        before = np.concatenate([[False], end[:-1].astype(bool)])[:n]
        number = np.concatenate([[False], (kind == NUMBER)[:-1]])[:n] & ~first
        kind = np.where((kind == LITERAL) & unit.astype(bool) & number, UNIT, kind)
        start = first | before
        kind = np.where((kind == LITERAL) & capital.astype(bool) & ~start, NAME, kind)
        kept = kind != NOTHING
        self.kind, self.value = kind[kept], value[kept]
        # A capital at a sentence's start: a word, or a name.
        self.unsure = ((kind == LITERAL) & capital.astype(bool) & start)[kept]
        self.bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        self.symbols = X.mixed(np.where(self.kind == LITERAL, self.value, self.kind.astype(np.uint64)))
        self.rolling = X.Rolling(self.symbols)

    def windows(self, width):
        """Places where a window of `width` tokens of one text begins, its hash, the text, and
        whether its first token is read as a name: a window that begins with an unsure token
        comes twice.
        """
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        key = self.rolling.windows(width) + np.uint64(width)
        place = np.flatnonzero(text[width - 1:] == text[:len(key)]) if len(key) else np.zeros(0, np.int64)
        both = place[self.unsure[place]]
        symbols = self.symbols[both[:, None] + np.arange(width)]
        symbols[:, 0] = _NAME_SYMBOL
        named = X.mixed((symbols * X.powers(X.INVERSE, width)).sum(axis=1, dtype=np.uint64)) + np.uint64(width)
        read = np.repeat([False, True], [len(place), len(both)])
        place = np.concatenate([place, both])
        return place, np.concatenate([key[place[~read]], named]), text[place], read


_NAME_SYMBOL = X.mixed(np.array([NAME], np.uint64))[0]


def template_windows(benchmark, width):
    """Windows of all different benchmark texts: item (key of the text), n (windows of the text),
    own (place in it), key, width, kinds and values of its tokens.

    A text with fewer tokens than `width` is one window of its own width. A window that
    begins with a capital at a sentence's start has two keys, one for each reading.
    """
    texts = benchmark.where("text is not null").groupBy(F.xxhash64("text").alias("item")).agg(
        F.first("text").cast("binary").alias("text"))

    def work(batches):
        for batch in X.slices(batches, limit=SLICE):
            items = batch.column("item").to_numpy()
            tokens = Canonical(batch.column("text").to_pylist(), kinds_of_worker())
            size = np.diff(tokens.bounds)
            widths = np.minimum(size, width)
            for w in np.unique(widths[size > 0]).tolist():
                place, key, text, named = tokens.windows(w)
                own = widths[text] == w
                place, key, text, named = place[own], key[own], text[own], named[own]
                at = place[:, None] + np.arange(w)
                kinds = tokens.kind[at].astype(np.int8)
                kinds[named, 0] = NAME
                yield X.batch_of(
                    TEMPLATES, item=items[text], n=size[text] - w + 1, own=place - tokens.bounds[text],
                    key=key.view(np.int64), width=np.full(len(place), w),
                    kinds=[k.tobytes() for k in kinds],
                    item_values=[v.tobytes() for v in tokens.value[at]])

    return texts.mapInArrow(work, TEMPLATE_COLUMNS)


def key_filter(templates):
    """The keys of all template windows as bits, 64 to a number; its size is fixed."""
    place = F.pmod("key", F.lit(1 << FILTER_BITS))
    found = templates.select(
        F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy(
        "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS >> 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def document_windows(rows, widths, bits):
    """Windows of all documents whose key passes the filter: row, doc_id, key, at, doc_values."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def work(batches):
        known, kinds = shared.value, kinds_of_worker()
        for batch in X.slices(batches, limit=SLICE):
            tokens = Canonical(batch.column("text").to_pylist(), kinds)
            for w in widths:
                place, key, text, _ = tokens.windows(w)
                bit = key.view(np.int64) % (1 << FILTER_BITS)
                hit = np.flatnonzero((known[bit >> 6] >> (bit & 63)) & 1)
                if len(hit):
                    place, text = place[hit], pa.array(text[hit])
                    yield X.batch_of(
                        WINDOWS, row=batch.column("row").take(text), doc_id=batch.column("doc_id").take(text),
                        key=key[hit].view(np.int64), at=place - tokens.bounds[text.to_numpy()],
                        doc_values=[v.tobytes() for v in tokens.value[place[:, None] + np.arange(w)]])

    return rows.mapInArrow(work, WINDOW_COLUMNS)


def agreement(windows):
    """(item windows matched, slots) of one document and item.

    `windows` are (own, at, kinds, item values, document values). Windows on one diagonal
    (`at` minus `own`) belong together, and count if no slot value of the item stands for two
    values of the text. The largest diagonal comes first; others join it as long as all slots
    of the document still map one value to one.
    """
    diagonals = {}
    for own, at, kinds, item_values, doc_values in windows:
        kinds = np.frombuffer(kinds, np.int8)
        slot = kinds != LITERAL
        pairs = zip(kinds[slot].tolist(), np.frombuffer(item_values, np.uint64)[slot].tolist(),
                    np.frombuffer(doc_values, np.uint64)[slot].tolist())
        places, slots = diagonals.setdefault(at - own, (set(), set()))
        places.add(own)
        slots.update(pairs)
    matched, mapping = set(), {}
    for shift, (places, slots) in sorted(diagonals.items(), key=lambda x: (-len(x[1][0]), x[0])):
        found = {}
        if all(mapping.get((kind, a), b) == b == found.setdefault((kind, a), b) for kind, a, b in slots):
            matched |= places
            mapping |= found
    return matched, mapping


def confirmed(batches, min_windows, min_share):
    """Matches of windows sorted by row and item."""

    def rows():
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                yield from zip(*(part.column(c).to_pylist() for c in JOINED))

    out = []
    for (row, item), own in groupby(rows(), key=lambda r: r[:2]):
        own = list(own)
        _, _, doc_id, n = own[0][:4]
        matched, mapping = agreement([w[4:] for w in own])
        if matched and (len(matched) >= min_windows or len(matched) >= min_share * n):
            out.append((row, doc_id, item, n, len(matched), len(mapping), sum(a != b for (_, a), b in mapping.items())))
        if len(out) >= 4096:
            yield X.batch_of(FOUND, **dict(zip(FOUND.names, zip(*out))))
            out = []
    if out:
        yield X.batch_of(FOUND, **dict(zip(FOUND.names, zip(*out))))


def matches(docs, benchmark, width=8, min_windows=5, min_share=0.5):
    """Confirmed matches of different documents (row: key of id and text) and different items.

    The documents' windows that pass a filter of the template keys are joined with the
    templates by hash; Spark splits what lies under a frequent window. The benchmark
    never passes through the driver.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "templates")
    template_windows(benchmark, width).write.parquet(path)
    templates = spark.read.parquet(path)
    # At most `width` numbers.
    widths = sorted(r["width"] for r in templates.select("width").distinct().collect())
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"))
    found = document_windows(rows, widths, key_filter(templates))
    joined = found.join(templates.drop("width"), "key").select(*JOINED).distinct()
    sorted_ = joined.repartition("row", "item").sortWithinPartitions("row", "item")
    return sorted_.mapInArrow(lambda batches: confirmed(batches, min_windows, min_share), FOUND_COLUMNS)


def contaminated(docs, benchmark, width=8, min_windows=5, min_share=0.5):
    """Confirmed matches: doc_id, item_id, n_windows (of the item), n_matched, n_slots, n_changed.

    A document matches an item if at least `min_windows` of the item's windows of
    `width` canonical tokens, or the share `min_share` of them, lie in it with slots that
    map consistently over the whole document; an item shorter than a window is one window.
    A capital at a sentence's start may be a name or not, so windows that begin with one
    are compared under both readings. n_changed counts slots whose value differs from the
    item's. Null and empty texts match nothing; repeated rows of documents or items give
    repeated matches; a null id stays null; empty tables give no rows; other columns are
    ignored.
    """
    path = scratch_path(docs.sparkSession, "matches")
    matches(docs, benchmark, width, min_windows, min_share).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    items = benchmark.where("text is not null").select(
        F.xxhash64("text").alias("item"), F.col("item_id").cast("long").alias("item_id"))
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row")).groupBy("row").agg(F.count("*").alias("copies"))
    again = found.join(rows, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.join(items, "item").select(*MATCHES.names)


def decontaminated(docs, benchmark, width=8, min_windows=5, min_share=0.5):
    """The rows of `docs` that match no benchmark item, all columns as they are.

    The same decision as `contaminated`; only keys of matching rows are joined.
    """
    path = scratch_path(docs.sparkSession, "matches")
    matches(docs, benchmark, width, min_windows, min_share).select("row").distinct().write.parquet(path)
    gone = docs.sparkSession.read.parquet(path).withColumnRenamed("row", "_row")
    key = F.xxhash64("doc_id", "text")
    return docs.join(gone, key == F.col("_row"), "left_anti")
