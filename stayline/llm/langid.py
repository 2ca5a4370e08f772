"""Language proportions of each document by expectation-maximisation.

A document is a mixture of languages; each language is a multinomial over hashed
letter n-grams. EM finds the proportions; languages leave the mixture while the
penalised likelihood gains by it.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
    ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64())),
])
COLUMNS = "doc_id long, lang_pred string, score double, languages array<string>, shares array<double>"

LETTER = re.compile(r"[^\W\d_]")
# A-Z as a-z, bytes beyond ASCII as they are, whatever else a gap.
_KEEP = bytes(
    b if b >= 0x80 or 0x61 <= b < 0x7B else b + 0x20 if 0x41 <= b < 0x5B else 0x20 for b in range(256))


def grams(text, size):
    """Counts of the buckets of the text's windows of three bytes."""
    raw = np.frombuffer(b" " + text.translate(_KEEP) + b" ", np.uint8).astype(np.int64)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    code *= 0x9E3779B1
    code >>= 7
    code &= (1 << size) - 1
    return np.bincount(code, minlength=1 << size)


def has_letter(text):
    """Whether any character is a letter, of any script."""
    return bool(text) and LETTER.search(text.decode("utf-8", "replace")) is not None


def fit(docs, size=15, smoothing=0.5):
    """Languages (sorted) and the matrix of their n-gram probabilities, buckets by languages.

    Learns from the text and lang of all rows where both are known. The driver gets one
    count for each bucket in use and language.
    """
    source = docs.where("lang is not null and text is not null").select(
        "lang", F.col("text").cast("binary").alias("text"))

    def work(batches):
        total = {}
        for batch in X.slices(batches, limit=1 << 18):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts = grams(text, size)
                total[lang] = total[lang] + counts if lang in total else counts
        for lang, counts in total.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])],
                ["lang", "bucket", "n"])

    rows = source.mapInArrow(work, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.full((1 << size, len(languages)), smoothing)
    for r in rows:
        counts[r["bucket"], place[r["lang"]]] += r["n"]
    return languages, counts / counts.sum(axis=0)


def mixture(counts, probability, share, rounds=30, close=1e-4):
    """Proportions by EM from the start `share`, and their log-likelihood."""
    n = counts.sum()
    for _ in range(rounds):
        mixed = probability @ share
        new = share * (probability.T @ (counts / mixed)) / n
        done = np.abs(new - share).max() < close
        share = new
        if done:
            break
    return share, float(counts @ np.log(probability @ share))


def selected(counts, probability, penalty=1.0):
    """Proportions over all languages; those outside the selected set are 0.

    Starts with all languages and drops the one with the least share as long as
    -2 log-likelihood + penalty * log(n) * (languages) becomes smaller.

    The likelihood is concave in the shares, so its slope at the best single language
    bounds what any mixture can gain; a bound below the penalty ends the search there.
    """
    n, active = counts.sum(), np.arange(probability.shape[1])
    unit = penalty * np.log(max(2.0, n))
    best = int(np.argmax(counts @ np.log(probability)))
    slope = (counts / probability[:, best]) @ probability - n
    if 2 * slope.max() <= unit:
        return (active == best).astype(float)
    share, fitness = mixture(counts, probability, np.full(len(active), 1 / len(active)))
    while len(active) > 1:
        stays = np.delete(np.arange(len(active)), np.argmin(share))
        start = share[stays] / share[stays].sum() if share[stays].sum() > 0 else np.full(len(stays), 1 / len(stays))
        fewer, likelihood = mixture(counts, probability[:, active[stays]], start)
        if 2 * (fitness - likelihood) > unit:
            break
        active, share, fitness = active[stays], fewer, likelihood
    out = np.zeros(probability.shape[1])
    out[active] = share / share.sum()
    return out


def _judge(spark, model, size, penalty):
    """Function of a text in bytes: language, score, selected languages and their shares."""
    languages, probability = model
    shared = spark.sparkContext.broadcast(probability)

    def judge(text):
        if not languages or not has_letter(text):
            return "und", 0.0, [], []
        counts = grams(text, size)
        used = np.flatnonzero(counts)
        share = selected(counts[used].astype(float), shared.value[used], penalty)
        order = [i for i in np.argsort(-share, kind="stable") if share[i] > 0]
        return languages[order[0]], float(min(1.0, share[order[0]])), [languages[i] for i in order], share[order].tolist()

    return judge


def known_language(docs, model, least=0.5, wanted=None, size=15, penalty=1.0):
    """The rows of `docs` with a language whose share is at least `least`; a null lang is filled.

    The decisions of `identify`, taken where a row is read: it rejects texts without a
    letter, mixtures in which no language has that share, and languages not in `wanted`
    (all learned ones if None). Other columns stay as they are.
    """
    judge = _judge(docs.sparkSession, model, size, penalty)
    place = docs.columns.index("lang") if "lang" in docs.columns else None

    def work(batches):
        for batch in X.slices(batches, limit=1 << 18):
            found = [judge(t and t.encode())[:2] for t in batch.column("text").to_pylist()]
            kept = [lang != "und" and score >= least and (wanted is None or lang in wanted) for lang, score in found]
            if place is not None:
                langs = [own if own is not None else lang for own, (lang, _) in zip(batch.column(place).to_pylist(), found)]
                batch = batch.set_column(place, "lang", pa.array(langs, pa.string()))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return X.map_rows(docs, work)


def identify(docs, model, size=15, penalty=1.0):
    """Language of every document: doc_id, lang_pred, score, languages, shares.

    `languages` is the selected set by falling share, `lang_pred` its first (ties: the
    first by name), `score` its share from 0 to 1. `und` with score 0 if the text is null or has no letter, or if nothing
    was learned. Rows are judged one by one by their text alone, so repeated rows give
    repeated results; an empty table gives none; other columns are ignored.
    """
    judge = _judge(docs.sparkSession, model, size, penalty)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))

    def work(batches):
        for batch in X.slices(batches):
            rows = [judge(t) for t in batch.column("text").to_pylist()]
            yield X.batch_of(RESULT, doc_id=batch.column("doc_id"), **dict(zip(RESULT.names[1:], zip(*rows))))

    return source.mapInArrow(work, COLUMNS)


def held_out(doc_id, folds, fold):
    """Whether crc32 of the id as text falls into `fold`; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
