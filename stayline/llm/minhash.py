"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Each permutation of the shingle hashes gives two signature values, the minimum and the
maximum, so a signature costs half the hash evaluations. Values go into bands; documents
that agree on a band are candidates. Within a bucket every document is first compared
with two representatives; only buckets that still hold several components compare
documents of different components, and of these only such that share enough shingles
with documents of other components at all.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.llm.components import components
from stayline.llm.repeats import delete_scratch
from stayline.session import scratch_path

SIGNATURES = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()),
    ("bands", pa.list_(pa.int64())),
])
COLUMNS = "doc_id long, n_shingles long, set_hash binary, bands array<long>"

#: Sets up to this size also get bands of half as many permutations: in small sets the
#: minimum and the maximum agree less often than the square of the similarity.
SMALL = 32
#: Bytes of text that are hashed at a time, and shingles that a document of a block has at most on average.
SLICE = 1 << 18
SHINGLES = 1500


def shingle_sets(texts, width):
    """Sorted hashes of each text's distinct shingles of `width` words.

    A text with fewer words is one shingle; without words the set is empty.
    """
    words = X.Words(texts)
    rolling = X.Rolling(words.hashes(lower=True))
    windows = rolling.windows(width)
    for start, end in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if end - start >= width:
            found = np.sort(windows[start:end - width + 1])
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]
        elif end > start:
            yield rolling(np.array([start]), np.array([end])) + np.uint64(end - start)
        else:
            yield np.zeros(0, np.uint64)


class MinMax:
    """Band keys of shingle sets: `bands` bands of `rows` permutations, two values each."""

    def __init__(self, bands, rows, seed=20240229):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.bands, self.rows = bands, rows
        self.factor = draw.integers(0, 1 << 31, bands * rows, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = draw.integers(0, 1 << 32, bands * rows, np.uint32)
        self.salt = X.mixed(np.arange(2 * bands, dtype=np.uint64) + np.uint64(1))

    def signature(self, shingles):
        """Minimum and maximum of the set under each permutation."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        high = np.zeros(len(self.factor), np.uint32)
        for i in range(0, len(x), 256):
            value = self.factor[:, None] * x[None, i:i + 256]
            value += self.shift[:, None]
            np.minimum(low, value.min(axis=1), out=low)
            np.maximum(high, value.max(axis=1), out=high)
        return low, high

    def keys(self, shingles):
        low, high = self.signature(shingles)
        both = X.mixed((low.astype(np.uint64) << np.uint64(32)) | high)
        wide = self._bands(both, self.rows, self.salt[:self.bands])
        if len(shingles) > SMALL:
            return wide
        rows = max(1, self.rows // 2)
        return np.concatenate([wide, self._bands(both[:self.bands * rows], rows, self.salt[self.bands:])])

    def _bands(self, values, rows, salt):
        values = values.reshape(self.bands, rows)
        key = salt.copy()
        for i in range(rows):
            key = X.mixed(key * np.uint64(X.BASE) + values[:, i])
        return key


def signatures(docs, width=5, bands=64, rows=4):
    """n_shingles, a 128-bit hash of the whole set, and the band keys of every row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def work(batches):
        hasher = MinMax(bands, rows)
        for batch in X.slices(batches, limit=SLICE):
            sets = list(shingle_sets(batch.column("text").to_pylist(), width))
            yield X.batch_of(
                SIGNATURES, doc_id=batch.column("doc_id"), n_shingles=[len(s) for s in sets],
                set_hash=[xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                bands=[hasher.keys(s).view(np.int64) if len(s) else [] for s in sets])

    return source.mapInArrow(work, COLUMNS)


def _size_fits(a, b, percent):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def alike(a, b, percent):
    """Whether two sorted shingle sets reach the similarity; empty sets never do."""
    if not len(a) or not len(b):
        return False
    common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed(pairs, docs, width, percent, chunk=256):
    """The pairs (a, b) whose full sets reach the similarity.

    Texts are brought together by a: a's text is followed by those of its partners,
    which pass one by one. An a with many partners is split into chunks of about `chunk`.
    """
    count = pairs.groupBy("a").agg(F.count("*").alias("n")).withColumnRenamed("a", "a2")
    dealt = pairs.join(count, F.col("a") == F.col("a2")).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / chunk)).alias("part"))
    wanted = dealt.select("a", "part", F.col("b").alias("id"), F.lit(True).alias("partner")).unionByName(
        dealt.select("a", "part", F.col("a").alias("id"), F.lit(False).alias("partner")).distinct())
    rows = wanted.join(docs.select("doc_id", "text"), F.col("id") == F.col("doc_id")).select(
        "a", "part", "partner", "id", F.col("text").cast("binary").alias("text"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "partner", "id")

    def work(batches):
        first, of = None, None
        for batch in X.slices(batches, limit=SLICE):
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            a, b = [], []
            keys = zip(batch.column("a").to_pylist(), batch.column("partner").to_pylist(), batch.column("id").to_pylist())
            for (own, partner, other), s in zip(keys, sets):
                if not partner:
                    first, of = s, own
                elif of == own and alike(first, s, percent):
                    a.append(own)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(work, "a long, b long")


def shared_elsewhere(rows, texts, width, per_range=400_000):
    """rep, common: how many of its shingles documents of another label hold as well.

    `rows` has rep, n and label. Shingles meet by ranges of their hashes, as one array
    for each document and range; a range has about `per_range` shingles.
    """
    ranges = 1 + (rows.agg(F.sum("n")).first()[0] or 0) // per_range
    held = rows.select("rep", "label").join(texts, F.col("rep") == F.col("doc_id")).select(
        "rep", "label", F.col("text").cast("binary").alias("text"))
    cuts = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    parts = pa.schema([("range", pa.int64()), ("rep", pa.int64()), ("label", pa.int64()), ("set", pa.binary())])
    counts = pa.schema([("rep", pa.int64()), ("common", pa.int64())])

    def cut(batches):
        for batch in X.slices(batches, limit=SLICE):
            out = []
            sets = shingle_sets(batch.column("text").to_pylist(), width)
            for rep, label, s in zip(batch.column("rep").to_pylist(), batch.column("label").to_pylist(), sets):
                pieces = np.split(s, np.searchsorted(s, cuts))
                out += [(i, rep, label, p.tobytes()) for i, p in enumerate(pieces) if len(p)]
            if out:
                yield X.batch_of(parts, **dict(zip(parts.names, zip(*out))))

    def count(table):
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        size = [len(s) for s in sets]
        label = np.repeat(table.column("label").to_numpy(), size)
        row = np.repeat(np.arange(len(sets)), size)
        shingle = np.concatenate(sets)
        order = np.lexsort((label, shingle))
        shingle, label, row = shingle[order], label[order], row[order]
        first = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
        last = np.append(first[1:], len(shingle)) - 1
        several = np.repeat(label[first] != label[last], last - first + 1)
        common = np.bincount(row[several], minlength=len(sets))
        return pa.Table.from_batches([X.batch_of(counts, rep=table.column("rep").to_numpy(), common=common)], counts)

    return held.mapInArrow(cut, "range long, rep long, label long, set binary").groupBy("range").applyInArrow(
        count, "rep long, common long").groupBy("rep").agg(F.sum("common").alias("common"))


def compared(rows, texts, width, percent, block=256):
    """Links between documents of different labels that share a bucket.

    `rows` has key (of a bucket), rep, n, label and common. Documents connected by
    buckets are dealt into blocks of about `block`, fewer if they have more than `SHINGLES`
    shingles each; every two blocks meet in one task, which compares those of their documents
    that share a bucket and can be alike.
    """
    low = rows.groupBy("key").agg(F.min("rep").alias("a"))
    cluster = components(rows.join(low, "key").select("a", F.col("rep").alias("b")))
    members = rows.groupBy("rep", "n", "label", "common").agg(F.collect_set("key").alias("keys")).join(
        cluster.select(F.col("id").alias("rep"), F.col("label").alias("cluster")), "rep")
    size = members.groupBy("cluster").agg(F.ceil(F.greatest(
        F.count("*") / block, F.sum("n") / (block * SHINGLES))).alias("blocks"))
    dealt = members.join(size, "cluster").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    dealt = dealt.join(texts, F.col("rep") == F.col("doc_id")).select(
        "cluster", "i", "j", "own", "rep", "n", "label", "common", "keys", F.col("text").cast("binary").alias("text"))
    result = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(table):
        own, rep, n, label, common = (
            table.column(c).to_numpy() for c in ("own", "rep", "n", "label", "common"))
        within = table.column("i")[0] == table.column("j")[0]
        order = np.argsort(own, kind="stable")
        half = len(own) if within else int((own == own.min()).sum())
        if not within and half == len(own):
            return result.empty_table()
        x, y = np.triu_indices(len(own), 1) if within else (
            part.ravel() for part in np.meshgrid(order[:half], order[half:], indexing="ij"))
        low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        fits = (label[x] != label[y]) & (low * 100 >= high * percent) & (
            np.minimum(common[x], common[y]) * (100 + percent) >= (low + high) * percent)
        sets = [s for batch in X.slices(table.select(["text"]).to_batches(), limit=SLICE)
                for s in shingle_sets(batch.column("text").to_pylist(), width)]
        keys = [set(k) for k in table.column("keys").to_pylist()]
        a, b = [], []
        for i, j in zip(x[fits].tolist(), y[fits].tolist()):
            if not keys[i].isdisjoint(keys[j]) and alike(sets[i], sets[j], percent):
                a.append(rep[i])
                b.append(rep[j])
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=result)

    return dealt.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs, width=5, percent=75, bands=64, rows=4):
    """doc_id, n_shingles and component_id (the least doc_id reachable) of every row.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets
    of lower-cased `width`-word shingles, counted on the full sets (64-bit hashes).
    Candidates share a band of 2 * `rows` signature values; at similarity 0.75 a pair
    escapes all 64 bands with probability 0.0012, at 0.8 with 0.000008.

    A document without words (or a null text) has an empty set and is its own component;
    one with fewer than `width` words is one shingle. Equal sets are linked without a
    comparison of texts. Repeated rows share their component; a row with a null doc_id is linked with nothing
    and has a null component. An empty table gives an empty result.
    Columns beside doc_id and text are ignored.
    """
    spark, paths = docs.sparkSession, []

    def stored(df, name):
        paths.append(scratch_path(spark, name))
        df.write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    signed = stored(signatures(docs, width, bands, rows), "signatures")
    linked = signed.where("doc_id is not null and n_shingles > 0")
    groups = linked.groupBy("set_hash").agg(F.min("doc_id").alias("rep"))
    single = stored(
        linked.groupBy("set_hash").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        ).drop("set_hash"), "representatives")
    keyed = single.select("rep", "n", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(
        F.min(F.struct("rep", "n")).alias("low"), F.max(F.struct("rep", "n")).alias("high")
    ).where("low.rep <> high.rep").withColumnRenamed("key", "key2")
    shared = stored(keyed.join(hubs, F.col("key") == F.col("key2")).drop("key2"), "buckets")
    texts = docs.select("doc_id", "text").join(
        shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = stored(texts, "candidates")

    def towards(hub):
        return shared.where(F.col("rep") != F.col(f"{hub}.rep")).where(
            _size_fits(F.col("n"), F.col(f"{hub}.n"), percent)
        ).select(F.col(f"{hub}.rep").alias("a"), F.col("rep").alias("b"))

    tried = stored(towards("low").unionByName(towards("high")).distinct(), "tried")
    links = stored(confirmed(tried, texts, width, percent), "links")
    label = components(links).withColumnRenamed("id", "id2")
    open_ = shared.join(label, F.col("rep") == F.col("id2"), "left").select(
        "key", "rep", "n", F.coalesce("label", "rep").alias("label"))
    several = open_.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where(
        "l <> h").select("key")
    open_ = stored(open_.join(several, "key", "left_semi"), "open")
    for turn in range(3):
        # No partner under another label can have more than `common` shingles in common;
        # documents that go take their shingles with them, so it pays to look again.
        common = shared_elsewhere(open_.select("rep", "n", "label").distinct(), texts, width)
        open_ = stored(open_.drop("common").join(common, "rep").where(
            F.col("common") * 100 >= F.col("n") * percent), f"open{turn}")
    links = links.unionByName(compared(open_, texts, width, percent))
    label = components(links).withColumnRenamed("id", "id2")
    named = groups.join(label, F.col("rep") == F.col("id2"), "left").select(
        F.col("set_hash").alias("set2"), F.coalesce("label", "rep").alias("component_id"))
    found = signed.join(
        named, (F.col("set_hash") == F.col("set2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(),
        "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    # The result is written, and the tables that led to it go.
    old, paths = paths, []
    path = scratch_path(spark, "near-duplicates")
    found.write.parquet(path)
    for one in old:
        delete_scratch(spark, one)
    return spark.read.parquet(path)


def one_of_each(docs, **options):
    """The rows of `docs` whose document is the least of its group, as they are.

    Rows with a null doc_id stay. Of rows that repeat a doc_id and its text one stays.
    """
    found = near_duplicates(docs, **options)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    names = [f"`{c}`" for c in docs.columns]
    kept = docs.join(gone, "doc_id", "left_anti").select(names)
    again = kept.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    repeated = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, "doc_id", "left_anti").select(names).unionByName(repeated.select(names))
