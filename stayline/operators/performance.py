"""Model performance over time, degradation against a baseline, promotion."""

from pyspark.sql import Window, functions as F

from stayline import schema as S
from stayline.operators.metrics import classification_metrics, roc_auc, score_prefix
from stayline.operators.prefix import join_null_safe

# Fixed values.
DROP_LIMIT = 0.05
MEDIUM_DROP, HIGH_DROP = 0.05, 0.15
WATCHED = ["roc_auc", "accuracy", "f1"]
COMPARED = ["roc_auc", "accuracy", "f1", "precision", "recall"]
PROMOTION_AUC = 0.85


def aligned(scores, labels, key=S.ID):
    """Score and label of the keys both tables have."""
    return scores.join(labels, key)


def perf_metrics(df, by=(), threshold=0.5):
    """Metrics per group; without groups an empty input gives one row of size 0."""
    base = classification_metrics(df, by, threshold)
    auc = roc_auc(df, by, score_prefix(df, by))
    joined = join_null_safe(base, auc, list(by), "left") if by else base.withColumn("roc_auc", auc.scalar())
    return joined.withColumn("prediction_threshold", F.lit(float(threshold)))


def compare(current, baseline, on=(), keep=()):
    """Drops of the watched metrics against the baseline, and the verdict.

    `current` and `baseline` are metric rows; without `on`, a baseline of one row applies
    to all. `keep` names further columns of `current`.
    Differences stay doubles: 0.90 - 0.85 counts as more than 0.05.
    """
    wanted = ["sample_size", *COMPARED]
    now = current.select(*on, *keep, *[c for c in wanted if c in current.columns])
    then = F.struct(*COMPARED)
    if on:
        pairs = join_null_safe(now, baseline.select(*on, then.alias("_base")), list(on))
    else:
        pairs = now.withColumn("_base", baseline.select(then).scalar())
    pairs = pairs.withColumns(
        {f"{m}_drop": F.col(f"_base.{m}") - F.col(m) for m in WATCHED}
    )
    worst = F.greatest(
        *[F.when(F.col(f"{m}_drop") > DROP_LIMIT, F.col(f"{m}_drop")) for m in WATCHED]
    )
    return pairs.withColumn("_worst", worst).select(
        *now.columns,
        *[F.col(f"_base.{m}").alias(f"baseline_{m}") for m in COMPARED],
        *[f"{m}_drop" for m in WATCHED],
        F.col("_worst").isNotNull().alias("degraded"),
        F.when(F.col("_worst").isNull(), "none")
        .when(F.col("_worst") < MEDIUM_DROP, "low")
        .when(F.col("_worst") < HIGH_DROP, "medium")
        .otherwise("high")
        .alias("severity"),
    )


def compare_long(compared, keys=()):
    """Rows (metric, baseline, current) where both values are known."""
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"baseline_{m}").alias("baseline"),
            F.col(m).alias("current"),
        )
        for m in COMPARED
    ]
    return compared.select(*keys, F.inline(F.array(*rows))).where(
        "baseline IS NOT NULL AND current IS NOT NULL"
    )


def keep_last(log, order, n):
    """The newest `n` rows of a log: a distributed top-n, not a full sort."""
    return log.orderBy(*order).limit(n)


def append_history(history, new, n=100):
    """History with the new rows, cut to the last `n` by timestamp."""
    return keep_last(history.unionByName(new, allowMissingColumns=True), [F.desc("timestamp")], n)


def perf_trend(history):
    """Metrics in time order with the change since the previous point.

    Unreadable timestamps become null and sort last. All points of the history count;
    a history has one row per evaluation.
    """
    at = F.try_to_timestamp("timestamp", F.lit(S.TIMESTAMP_PATTERN))
    window = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("at"), "timestamp")
    return (
        history.withColumn("at", at)
        .select(
            "timestamp", "at", *COMPARED,
            *[(F.col(m) - F.lag(m).over(window)).alias(f"{m}_change") for m in COMPARED],
        )
    )


def promotion(scored, version="model_version", min_auc=PROMOTION_AUC):
    """Status per model version: the newest that meets the bar is in production.

    Earlier ones that met it are archived, the rest skipped. One row per version.
    """
    auc = roc_auc(scored, [version])
    passed = F.coalesce(F.col("roc_auc") >= min_auc, F.lit(False))
    newest = F.max(F.when(passed, F.col(version))).over(Window.partitionBy(F.lit(0)))
    return auc.withColumn("_newest", newest).select(
        version,
        "roc_auc",
        F.when(~passed, "skipped")
        .when(F.col(version) == F.col("_newest"), "production")
        .otherwise("archived")
        .alias("status"),
    )
