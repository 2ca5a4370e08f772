"""Rule-based text measures, and a hashed n-gram likelihood ratio against the raw corpus."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.session import scratch_path

RULES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("ratio", pa.float64()), ("apart", pa.float64()),
])
COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, ratio double, apart double"
)

# Code points that a byte begins, unless it is white space; and the symbols.
_CHARS = np.ones(256, np.int64)
_CHARS[0x80:0xC0] = 0
_CHARS[[0x20, *range(0x09, 0x0E)]] = 0
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1


def buckets(hashes, bounds, size):
    """Bucket of every word and of every pair of neighbours, and the text of each."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pair = X.mixed(hashes[:-1] * np.uint64(X.BASE) + hashes[1:])
    inside = text[1:] == text[:-1]
    found = np.concatenate([X.mixed(hashes), pair[inside]])
    return (found >> np.uint64(64 - size)).astype(np.int64), np.concatenate([text, text[1:][inside]])


def repeated_lines(text):
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def words_in_repeats(hashes, bounds, width=3):
    """For each text, its words that lie in a window of `width` words found twice in it."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(hashes)
    if n < width:
        return np.zeros(len(bounds) - 1, np.int64)
    key = X.Rolling(hashes).windows(width)
    inside = np.flatnonzero(text[width - 1:] == text[:n - width + 1])
    key = X.mixed(key[inside] + text[inside].astype(np.uint64) * np.uint64(X.BASE))
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    twice = np.concatenate([equal, [False]]) | np.concatenate([[False], equal])
    start = inside[order[twice]]
    return np.bincount(text[X.covered(start, start + width, n)], minlength=len(bounds) - 1)


def fold_of(text, folds):
    """Fold of a text: copies share one, so that none is scored with the counts of another."""
    return F.pmod(F.xxhash64(text), F.lit(folds)).cast("int")


#: Bits of the filter of trusted ids that every task gets: 2 MB, however many there are.
FILTER_BITS = 24
#: Most ids that a join broadcasts; beyond it Spark shuffles.
BROADCAST_IDS = 100_000


def _place(doc_id):
    """Place of an id in the filter."""
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << FILTER_BITS))


def id_filter(ids):
    """The ids (column doc_id) as bits, 64 to a number."""
    marked = ids.select(_place(F.col("doc_id")).alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.col("place").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS >> 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _counted(rows, shared, size, folds, sign=1):
    """Counts of the n-grams of `rows` (text, fold, place), as target where the place is in the filter."""
    names = ["raw", *[f"target_{k}" for k in range(folds)]]

    def work(batches):
        raw, target = np.zeros(1 << size, np.int64), np.zeros((folds + 1, 1 << size), np.int64)
        bits = None if shared is None else shared.value
        for batch in X.slices(batches, limit=1 << 18):
            words = X.Words(batch.column("text").to_pylist())
            found, text = buckets(words.hashes(lower=True), words.bounds, size)
            if bits is None:
                hit = np.ones(batch.num_rows, bool)
            else:
                raw += np.bincount(found, minlength=1 << size)
                place = batch.column("place").to_numpy()
                hit = (place >= 0) & ((bits[place >> 6] >> (place & 63)) & 1 == 1)
            fold = np.where(hit, batch.column("fold").to_numpy(), folds)[text]
            some = fold < folds
            np.add.at(target.reshape(-1), (fold[some].astype(np.int64) << size) + found[some], 1)
        used = np.flatnonzero(raw + target[:folds].sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (used, raw[used], *(sign * target[:folds, used]))], ["bucket", *names])

    return rows.mapInArrow(work, ", ".join(f"{x} long" for x in ["bucket", *names]))


def ngram_counts(docs, trusted, size=16, folds=8):
    """Counts of hashed words and word pairs: bucket, raw, and target_k of each fold k.

    `trusted` has the doc_id of the trusted documents (nulls and repeats don't matter).
    Every document counts as raw corpus. No text is shuffled: one scan counts every document
    whose id passes a filter of fixed size as trusted; ids alone are joined to find those
    that passed wrongly, and what these documents added is taken off again.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(ids))
    text, doc_id = F.col("text").cast("binary"), F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), text.alias("text"), fold_of(text, folds).alias("fold"),
        F.when(doc_id.isNotNull(), _place(doc_id)).otherwise(-1).alias("place"))
    counts = _counted(rows.select("text", "fold", "place"), shared, size, folds)
    names = counts.columns[1:]

    path = scratch_path(docs.sparkSession, "passed")
    others = docs.select(doc_id.alias("doc_id")).where("doc_id is not null").distinct().join(ids, "doc_id", "left_anti")
    taken = ids.select(_place(F.col("doc_id")).alias("place")).distinct()
    others.withColumn("place", _place(F.col("doc_id"))).join(taken, "place").select("doc_id").write.parquet(path)
    wrong = docs.sparkSession.read.parquet(path)
    n = wrong.count()
    if n:
        few = F.broadcast(wrong) if n <= BROADCAST_IDS else wrong
        again = rows.join(few, "doc_id", "left_semi").select("text", "fold")
        counts = counts.unionByName(_counted(again, None, size, folds, sign=-1))
    return counts.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in names])


def log_ratios(counts, size=16, smoothing=1.0, folds=8):
    """log(target probability / raw probability) of each bucket; at most 2^size rows are read.

    Row k leaves the target counts of fold k out; the last row has all of them.
    """
    raw, target = np.zeros(1 << size), np.zeros((folds + 1, 1 << size))
    for row in counts.collect():
        raw[row[0]], target[:folds, row[0]] = row[1], row[2:]
    target = target.sum(axis=0) - target + smoothing
    raw = raw + smoothing
    return np.log(target / target.sum(axis=1, keepdims=True)) - np.log(raw / raw.sum())


def measured(docs, ratios, size=16):
    """Rule measures of every document, and `ratio`: the mean log ratio of its n-grams.

    `apart` is the same without the target counts of the document's own fold.
    """
    text = F.col("text").cast("binary")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), fold_of(text, len(ratios) - 1).alias("fold"))

    def work(batches):
        for batch in X.slices(batches, limit=1 << 18):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            words = X.Words(texts)
            bounds = words.bounds
            found, text = buckets(words.hashes(lower=True), bounds, size)
            n = len(texts)
            grams = np.bincount(text, minlength=n)
            fold = batch.column("fold").to_numpy()[text]
            ratio, apart = (np.bincount(text, weights=ratios[k, found], minlength=n) / np.maximum(grams, 1)
                            for k in (-1, fold))
            first = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1] + 1
            sums = [np.concatenate([[0], np.cumsum(x[words.buffer])]) for x in (_CHARS, _SYMBOLS)]
            last = first + [len(t) for t in texts]
            yield X.batch_of(
                RULES, doc_id=batch.column("doc_id"), n_words=np.diff(bounds),
                word_chars=sums[0][last] - sums[0][first],
                n_symbols=sums[1][last] - sums[1][first],
                n_dup_lines=[repeated_lines(t) for t in texts],
                n_repeat_words=words_in_repeats(words.hashes(), bounds), ratio=ratio, apart=apart)

    return source.mapInArrow(work, COLUMNS)


def threshold(scores, lost=0.005, step=0.001):
    """Largest threshold on a grid of `step` that loses at most the share `lost` of the scores.

    `scores` are of trusted documents. The driver gets one row for each grid cell in use.
    None if there are no scores.
    """
    cells = scores.groupBy(F.floor(F.col("ratio") / step).alias("cell")).count().collect()
    total, below = sum(r["count"] for r in cells), 0
    for row in sorted(cells, key=lambda r: r["cell"]):
        if below + row["count"] > lost * total:
            return float(row["cell"] * step)
        below += row["count"]
    return None


def likelihood_filter(docs, labels, size=16, lost=0.005, min_words=50, folds=8):
    """Measures of every document and whether it stays.

    Target: documents that `labels` (doc_id, quality, toxic) has with quality 1 and not
    toxic. Raw corpus: all of `docs`. `ratio` is log p_target - log p_raw of the hashed
    lower-cased words and word pairs of a document, divided by their number (0 without
    any). The ratio of a trusted document leaves out the target counts of its fold
    (`folds` of them, by text), so it stands where the ratio of any other clean document
    would. A document stays if it passes the rules and its ratio reaches the threshold:
    the largest, so the one with most toxic documents below it, that loses at most `lost`
    of the trusted documents that pass the rules.

    A null text has no words and fails the rules; a null doc_id is never trusted;
    repeated rows count and are judged each on its own; labels that contradict each
    other count as trusted if any row does; an empty table or no trusted document
    leaves the rules alone. Columns beside those named are ignored.
    """
    trusted = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    ratios = log_ratios(ngram_counts(docs, trusted, size, folds), size, folds=folds)
    path = scratch_path(docs.sparkSession, "quality")
    failed = F.expr(f"n_words < {min_words} or 100 * n_repeat_words > 50 * n_words")
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null")
    rows = measured(docs, ratios, size).join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    rows = rows.withColumn("trusted", F.col("trusted_id").isNotNull())
    rows = rows.withColumn("ratio", F.when(F.col("trusted"), F.col("apart")).otherwise(F.col("ratio")))
    rows.drop("apart", "trusted_id").withColumn("base_failed", failed).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    least = threshold(rows.where("trusted and not base_failed"), lost)
    verdict = F.lit(True) if least is None else F.col("ratio") >= least
    return rows.drop("trusted").withColumn("kept", ~F.col("base_failed") & verdict)
