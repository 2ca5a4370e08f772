"""Windows that occur twice in a corpus: candidate search and sharding for exact indexes.

A window is `width` consecutive symbols (bytes or words) of one document. Every window
has an anchor: the least hashed run of `gram` symbols in it, the last one if several are
equal. The anchor depends on the window's symbols only, so equal windows have equal
anchors at equal places. The windows of one anchor form a segment. Segments whose anchor
occurs once hold no repeat; equal segments are one class; only classes that share an
anchor and differ go to the shards, where an index compares them in full. All windows
count, at every size of the input; nothing is sampled.
"""

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.session import scratch_path

#: Bytes of text that are hashed at a time.
SLICE = 1 << 18

SPOTS = pa.schema([
    ("row", pa.int64()), ("start", pa.int32()), ("count", pa.int32()),
    ("anchor", pa.int64()), ("content", pa.int64()),
])
PIECES = pa.schema([
    ("row", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("n", pa.int64()),
    ("anchor", pa.int64()), ("content", pa.int64()), ("classes", pa.int64()), ("piece", pa.binary()),
])
SPANS = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
DIGESTS = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("digests", pa.binary())])


def delete_scratch(spark, path):
    """Delete a written table that nothing reads any more."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def overlapping(values, width, step=1 << 16, hashes=lambda x: x):
    """Parts of a long sequence with `step` windows each: first symbol, hashes of the symbols."""
    for first in range(0, max(1, len(values) - width + 1), step):
        yield first, hashes(values[first:first + step + width - 1])


def _sliding_min(values, span):
    size = 1
    while size * 2 <= span:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    rest = span - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def segments(values, bounds, width, gram):
    """(text, start in it, number of windows, anchor hash, content hash) of all segments."""
    size = np.diff(bounds)
    long = size >= width
    if not long.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    rolling = X.Rolling(values)
    grams = rolling.windows(gram)
    low = np.uint64(0xFFFFFFFF)
    key = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    at = (low - (_sliding_min(key, width - gram + 1) & low)).astype(np.int64)
    inside = X.covered(bounds[:-1][long], bounds[:-1][long] + size[long] - width + 1, len(at))
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    first = np.zeros(len(at) + 1, bool)
    first[bounds[:-1][long]] = True
    if first.any():
        start = np.unique(np.concatenate([start, np.flatnonzero(first)]))
    stop = np.flatnonzero(inside)
    place = np.searchsorted(stop, np.append(start[1:], len(at))) - 1
    end = stop[place] + 1
    text = np.searchsorted(bounds, start, side="right") - 1
    offset = (at[start] - start).astype(np.uint64)
    content = X.mixed(rolling(start, end + width - 1) + offset * np.uint64(X.BASE))
    return text, start - bounds[text], end - start, grams[at[start]], content


def keyed(docs):
    """row (a key of id and text), `own` (all columns but the text) and the text in bytes."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.struct(*[f"`{c}`" for c in docs.columns if c != "text"]).alias("own"),
        F.col("text").cast("binary").alias("text"))


def spread(df, counts, on, by, share=0.001, least=10_000):
    """The rows of `df` that have a partner in `counts` (columns `on`, n), for frequent keys.

    A key with more than `share` of all rows is dealt over as many parts as it has shares, by
    a hash of the columns `by`. There are fewer than 1/share such keys.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(least, int(total * share))
    parts = counts.select(*on, F.ceil(F.col("n") / limit).cast("int").alias("parts"))
    frequent = F.broadcast(parts.where("parts > 1").select(*[F.col(c).alias(f"_{c}") for c in on], "parts"))
    met = functools.reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in on])
    dealt = df.join(frequent, met, "left").withColumn(
        "part", F.pmod(F.xxhash64(*by), F.coalesce("parts", F.lit(1))).cast("int")).select(*df.columns, "part")
    partners = parts.select(*on, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return dealt.join(partners, [*on, "part"], "left_semi").drop("part")


class Repeats:
    """The job for one kind of symbol and one index.

    `symbols(texts)` gives the symbols' hashes and the bounds of each text, `long(text)` the
    same for one long text as parts (first symbol, hashes) that overlap by less than a window,
    `cut(text, ranges)` the stored form of ranges of symbols, `restore(piece)` their hashes
    again, and `index(pieces)` marks, for each piece with its number of windows, the windows
    that occur in another place of the given pieces.
    """

    def __init__(self, width, gram, symbols, long, cut, restore, index, shard_bytes=1 << 18, shard_classes=3000):
        self.width, self.gram = width, gram
        self.symbols, self.long, self.cut, self.restore, self.index = symbols, long, cut, restore, index
        self.shard_bytes, self.shard_classes = shard_bytes, shard_classes

    def find(self, docs):
        """`own` (all columns of the row), text in bytes, and `spans` of symbols to remove.

        spans is null where nothing repeats, else an array of (start, end).
        """
        rows = keyed(docs)
        return rows.join(self.spans(rows), "row", "left").select("own", "text", "spans")

    def spans(self, rows):
        """row and its spans of symbols to remove, as a written table; `rows` is `keyed`.

        The tables in between are deleted once it is written.
        """
        spark, paths = rows.sparkSession, []

        def stored(df, name):
            paths.append(scratch_path(spark, name))
            df.write.option("compression", "zstd").parquet(paths[-1])
            return spark.read.parquet(paths[-1])

        found = self._found(rows, stored)
        path = scratch_path(spark, "repeats")
        found.write.option("compression", "zstd").parquet(path)
        for old in paths:
            delete_scratch(spark, old)
        return spark.read.parquet(path)

    def _found(self, rows, stored):
        spots = stored(self._spots(rows), "segments")
        # Written tables on both sides of a join let adaptive execution split a frequent anchor.
        shared = stored(spots.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
        spots = stored(spread(spots, shared, ["anchor"], ["row", "start"]), "shared")
        classes = stored(spots.groupBy("anchor", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("row", "start", "count")).alias("one")), "classes")
        copies = classes.where("n > 1").select("anchor", "content", "n")
        spans = [spread(spots, copies, ["anchor", "content"], ["row", "start"]).select(
            "row", "start", (F.col("start") + F.col("count") + self.width - 1).alias("end"))]
        several = stored(
            classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1"), "several")
        differing = classes.join(several, "anchor").select("one.*", "n", "anchor", "content", "classes")
        pieces = stored(self._pieces(differing, rows), "pieces")
        total, most = pieces.agg(F.sum(F.octet_length("piece")), F.max("classes")).first()
        if total:
            spans += self._shards(pieces, total, most, stored)
        whole = spans[0]
        for more in spans[1:]:
            whole = whole.unionByName(more)
        return whole.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def _spots(self, rows):
        """Segments of all texts. A long text is read in parts, whose windows are told apart
        by their symbols only, so where a part ends changes no window and no result."""

        def spots(row, first, values, bounds):
            text, start, count, anchor, content = segments(values, bounds, self.width, self.gram)
            return X.batch_of(
                SPOTS, row=row.take(pa.array(text)), start=(start + first).astype(np.int32),
                count=count.astype(np.int32), anchor=anchor.view(np.int64), content=content.view(np.int64))

        def work(batches):
            for batch in X.slices(batches, limit=SLICE):
                texts = batch.column("text").to_pylist()
                row = batch.column("row")
                short = [t if t is not None and len(t) <= 2 * SLICE else None for t in texts]
                yield spots(row, 0, *self.symbols(short))
                for i, (t, s) in enumerate(zip(texts, short)):
                    if t is not None and s is None:
                        for first, values in self.long(t):
                            yield spots(row.slice(i, 1), first, values, np.array([0, len(values)]))

        return rows.select("row", "text").mapInArrow(
            work, "row long, start int, count int, anchor long, content long")

    def _pieces(self, differing, rows):
        """The symbols of every class that shares its anchor with another class."""
        wanted = differing.groupBy("row").agg(F.collect_list(
            F.struct("start", "count", "n", "anchor", "content", "classes")).alias("wanted"))
        texts = rows.select(F.col("row").alias("row2"), "text")
        joined = wanted.join(texts, F.col("row") == F.col("row2")).select("row", "text", "wanted")

        def work(batches):
            for batch in X.slices(batches, limit=SLICE):
                out = {f.name: [] for f in PIECES}
                columns = (batch.column(c).to_pylist() for c in ("row", "text", "wanted"))
                for row, text, wanted in zip(*columns):
                    ranges = [(w["start"], w["start"] + w["count"] + self.width - 1) for w in wanted]
                    out["row"] += [row] * len(wanted)
                    out["piece"] += self.cut(text, ranges)
                    for name in ("start", "count", "n", "anchor", "content", "classes"):
                        out[name] += [w[name] for w in wanted]
                yield X.batch_of(PIECES, **out)

        # Repeated rows have the same key and text; one of them is enough.
        return joined.mapInArrow(
            work, "row long, start int, count int, n long, anchor long, content long, classes long,"
            " piece binary").dropDuplicates(["anchor", "content"])

    def _shards(self, pieces, total, most, stored):
        """Spans of the windows that two different classes share.

        Classes of one anchor are in one shard of bounded size. An anchor with more than
        `shard_classes` classes is split over several shards, which then exchange the
        sorted digests of their windows by ranges.
        """
        shards = max(1, -(-total // self.shard_bytes))
        parts = F.ceil(F.col("classes") / self.shard_classes)
        split = F.col("classes") > self.shard_classes
        dealt = pieces.withColumn("split", split).withColumn("shard", F.when(
            split, F.xxhash64("anchor", F.pmod(F.xxhash64("content"), parts))
        ).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))))
        spans = [dealt.groupBy("shard").applyInArrow(
            lambda t: self._index_shard(t), "row long, start int, end int")]
        if most > self.shard_classes:
            hot = dealt.where("split")
            ranges = int(hot.select("shard").distinct().count())
            digests = stored(hot.groupBy("shard").applyInArrow(
                lambda t: self._digests(t, ranges), "shard long, range long, digests binary"), "digests")
            both = digests.groupBy("range").applyInArrow(_merged, "shard long, range long, digests binary")
            spans.append(hot.groupBy("shard").cogroup(both.groupBy("shard")).applyInArrow(
                lambda t, hits: self._elsewhere(t, hits), "row long, start int, end int"))
        return spans

    def _spans(self, table, marks):
        """Spans of the marked windows; classes with copies have theirs already."""
        rows, starts, counts = (table.column(c).to_pylist() for c in ("row", "start", "n"))
        out = {"row": [], "start": [], "end": []}
        for row, start, n, mark in zip(rows, starts, counts, marks):
            if n == 1 and mark.any():
                a, b = X.runs(mark)
                out["row"] += [row] * len(a)
                out["start"] += (a + start).tolist()
                out["end"] += (b + (start + self.width - 1)).tolist()
        return pa.Table.from_batches([X.batch_of(SPANS, **out)], SPANS)

    def _index_shard(self, table):
        marks = self.index(table.column("piece").to_pylist(), table.column("count").to_pylist())
        return self._spans(table, marks)

    def _windows(self, piece):
        return X.Rolling(self.restore(piece)).windows(self.width)

    def _digests(self, table, ranges):
        own = np.unique(np.concatenate([self._windows(p) for p in table.column("piece").to_pylist()]))
        cut = np.searchsorted(own, np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64))
        parts = [(i, p.tobytes()) for i, p in enumerate(np.split(own, cut)) if len(p)]
        shard = table.column("shard")[0].as_py()
        return pa.Table.from_batches([X.batch_of(
            DIGESTS, shard=[shard] * len(parts), range=[i for i, _ in parts],
            digests=[p for _, p in parts])], DIGESTS)

    def _elsewhere(self, table, hits):
        if not table.num_rows or not hits.num_rows:
            return SPANS.empty_table()
        known = np.sort(np.concatenate([np.frombuffer(d, np.uint64) for d in hits.column("digests").to_pylist()]))
        marks = [_in_sorted(known, self._windows(p)) for p in table.column("piece").to_pylist()]
        return self._spans(table, marks)


def _in_sorted(known, values):
    """Which values are among the sorted ones, by binary search."""
    if not len(known):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[place] == values


def _merged(table):
    """For each shard, its digests of this range that another shard has too."""
    lists = [np.frombuffer(d, np.uint64) for d in table.column("digests").to_pylist()]
    whole = np.sort(np.concatenate(lists))
    twice = whole[1:][whole[1:] == whole[:-1]]
    hits = [own[_in_sorted(twice, own)].tobytes() for own in lists]
    return pa.Table.from_batches([X.batch_of(
        DIGESTS, shard=table.column("shard").to_pylist(), range=table.column("range").to_pylist(),
        digests=hits)], DIGESTS)
