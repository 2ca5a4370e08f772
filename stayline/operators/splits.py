"""Hold-out splits, folds, class weights, oversampling."""

from functools import reduce

from pyspark.sql import Window, functions as F

from stayline import schema as S
from stayline.operators.neighbours import nearest
from stayline.operators.prefix import global_rank, join_null_safe


def hash_number(*parts, buckets=10000):
    """Stable bucket of the md5 of the joined parts; the same on every engine."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def sample_customers(df, n, seed=42, key=S.ID):
    """Exactly n rows (or all) in the order of a seeded hash; a top-n, not a full sort."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)))), key).limit(n)


def stratified_split(
    df, label=S.TARGET, key=S.ID, test=0.2, validation=0.2, seed=42, exact=False
):
    """Add `split`: train, validation or test.

    By default a seeded hash of the key decides, so the shares hold up to sampling error
    within every label and nothing is shuffled. `exact=True` ranks the keys by hash within
    each label and gives every label its rounded share.
    """
    digest = F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed))))
    if exact:
        sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
        ranked = global_rank(
            df.withColumn("_digest", digest), [F.col("_digest"), F.col(key)], [label], "_rank"
        )
        n_test = F.round(F.col("_size") * test)
        n_validation = F.round((F.col("_size") - n_test) * validation)
        return (
            join_null_safe(ranked, sizes, [label])
            .withColumn(
                "split",
                F.when(F.col("_rank") <= n_test, "test")
                .when(F.col("_rank") <= n_test + n_validation, "validation")
                .otherwise("train"),
            )
            .drop("_digest", "_rank", "_size")
        )
    slot = hash_number(F.col(key), F.lit(str(seed)))
    return df.withColumn(
        "split",
        F.when(slot < int(10000 * test), "test")
        .when(slot < int(10000 * (test + (1 - test) * validation)), "validation")
        .otherwise("train"),
    )


def kfold(df, k=5, key=S.ID, seed=42, label=None):
    """Add `fold` 0..k-1 from a seeded hash.

    With `label` the folds are stratified: keys are ranked by hash within each label and
    dealt in turn, so the rows of a label differ by at most one between folds.
    """
    if label:
        digest = F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed))))
        ranked = global_rank(df.withColumn("_digest", digest), [F.col("_digest"), F.col(key)], [label], "_rank")
        return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_digest", "_rank")
    return df.withColumn("fold", (hash_number(F.col(key), F.lit(str(seed))) % k).cast("int"))


def fold_balance(folded, label=S.TARGET):
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == "Yes").cast("int")).alias("positive_rate"),
    )


def class_weights(df, label=S.TARGET):
    """n / (classes * n_class) per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("n")))


def _minority(df, label):
    """(minority class, its size, the other's size); two rows at most reach the driver."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    if len(counts) != 2:
        raise ValueError(f"oversampling needs two classes, found {sorted(counts)}")
    small, large = sorted(counts, key=lambda c: (counts[c], c))
    return small, counts[small], counts[large]


def copies_needed(row_number, size, missing):
    """How many new rows a minority row yields so that all of them yield `missing`."""
    return F.lit(missing // size) + F.when(row_number <= missing % size, 1).otherwise(0)


def oversample(df, features, label="label", key=S.ID, method="neighbours", k=5, seed=42):
    """Add minority rows until both classes are equal; new rows carry `synthetic = true`.

    "duplicate" repeats rows. "neighbours" places each new row on the line between a
    minority row and one of its k nearest minority rows, found by hash tables and ranked by
    true distance (`neighbours.nearest`). Which rows yield one copy more goes by a seeded hash.
    """
    small, size, large = _minority(df, label)
    missing = large - size
    originals = df.withColumn("synthetic", F.lit(False))
    if missing == 0:
        return originals
    minority = df.where(F.col(label) == small)

    def fraction(*parts):
        return hash_number(F.col(key), F.col("_copy").cast("string"), *parts) / 10000.0

    ranked = global_rank(minority, [F.md5(F.concat_ws("|", key, F.lit(str(seed)))), F.col(key)])
    copies = F.explode(F.sequence(F.lit(0), copies_needed(F.col("rank_no"), size, missing)))
    if method == "duplicate":
        new = ranked.withColumn("_copy", copies).where("_copy > 0").drop("_copy", "rank_no")
        return originals.unionByName(new.withColumn("synthetic", F.lit(True)))
    if method != "neighbours":
        raise ValueError("method is 'neighbours' or 'duplicate'")
    near = nearest(minority, key, features, k, seed=seed).select(F.col("key").alias(key), "near")
    pick = F.floor(fraction(F.lit("pick")) * F.size("near")) + 1
    new = (
        ranked.join(near, key, "left")
        .withColumn("_copy", copies)
        .where("_copy > 0")
        .withColumn("_to", F.when(F.size("near") > 0, F.element_at("near", pick.cast("int"))["point"]))
        .withColumn("_f", fraction(F.lit("step")))
        .withColumns({
            c: F.coalesce(F.col(c) + F.col("_f") * (F.col("_to")[i] - F.col(c)), F.col(c).cast("double"))
            for i, c in enumerate(features)
        })
    )
    return originals.unionByName(new.select(*df.columns).withColumn("synthetic", F.lit(True)))
