"""Classifier evaluation on a scored table, one row set per group.

All inputs have `label` (0/1) and `score`; `by` names grouping columns such as model,
split or period, so several models or splits cost one pass.
"""

from functools import reduce

from pyspark.sql import functions as F

from stayline.operators.prefix import global_rank, join_null_safe, prefix_counts


def _ones(condition):
    return F.sum(F.when(condition, 1).otherwise(0))


def usable(df):
    return df.where(F.col("label").isNotNull() & F.col("score").isNotNull())


def threshold_counts(df, by=(), threshold=0.5):
    hit = F.col("score") >= threshold
    actual = F.col("label") == 1
    return usable(df).groupBy(*by).agg(
        F.coalesce(_ones(hit & actual), F.lit(0)).alias("tp"),
        F.coalesce(_ones(hit & ~actual), F.lit(0)).alias("fp"),
        F.coalesce(_ones(~hit & ~actual), F.lit(0)).alias("tn"),
        F.coalesce(_ones(~hit & actual), F.lit(0)).alias("fn"),
    )


def ratio(a, b):
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification_metrics(df, by=(), threshold=0.5):
    tp, fp, tn, fn = (F.col(c) for c in ["tp", "fp", "tn", "fn"])
    n = tp + fp + tn + fn
    return threshold_counts(df, by, threshold).select(
        *by,
        n.alias("sample_size"),
        F.try_divide(tp + tn, n).alias("accuracy"),
        F.when(n > 0, ratio(tp, tp + fp)).alias("precision"),
        F.when(n > 0, ratio(tp, tp + fn)).alias("recall"),
        F.when(n > 0, ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def score_prefix(df, by=()):
    """Positives and negatives per distinct score, with running totals from the lowest."""
    return prefix_counts(
        usable(df),
        "score",
        {
            "pos": F.sum(F.when(F.col("label") == 1, 1).otherwise(0)),
            "neg": F.sum(F.when(F.col("label") == 1, 0).otherwise(1)),
        },
        by,
    )


def _with_totals(prefix, by):
    totals = prefix.groupBy(*by).agg(
        F.max("pos_cum").alias("_p"), F.max("neg_cum").alias("_n")
    )
    if not by:
        both = totals.select(F.struct("_p", "_n")).scalar()
        return prefix.withColumn("_both", both).select(
            "*", F.col("_both._p").alias("_p"), F.col("_both._n").alias("_n")
        ).drop("_both")
    return join_null_safe(prefix, totals, list(by))


def roc_auc(df, by=(), prefix=None):
    """Exact area with ties counting half; null where only one class occurs."""
    prefix = score_prefix(df, by) if prefix is None else prefix
    below = F.col("neg_cum") - F.col("neg")
    wins = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return prefix.groupBy(*by).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def pr_auc(df, by=(), prefix=None):
    """Trapezoid under precision over recall, starting at recall 0 with precision 1."""
    prefix = score_prefix(df, by) if prefix is None else prefix
    rows = _with_totals(prefix, by)
    tp_before = F.col("_p") - F.col("pos_cum")
    all_before = tp_before + F.col("_n") - F.col("neg_cum")
    tp, everything = tp_before + F.col("pos"), all_before + F.col("pos") + F.col("neg")
    before = F.coalesce(F.try_divide(tp_before, all_before), F.lit(1.0))
    width = F.try_divide(F.col("pos"), F.col("_p"))
    return rows.groupBy(*by).agg(
        F.sum(width * (F.try_divide(tp, everything) + before) / 2).alias("pr_auc")
    )


def curve_points(df, by=(), prefix=None, points=None):
    """tpr, fpr and precision at every distinct score as threshold.

    With `points`, thresholds are thinned to about that many steps of flagged rows; the
    kept points stay exact.
    """
    prefix = score_prefix(df, by) if prefix is None else prefix
    rows = _with_totals(prefix, by)
    tp = F.col("_p") - F.col("pos_cum") + F.col("pos")
    fp = F.col("_n") - F.col("neg_cum") + F.col("neg")
    out = rows.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(fp, F.col("_n")).alias("fpr"),
        F.try_divide(tp, F.col("_p")).alias("tpr"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.floor((tp + fp) / (F.col("_p") + F.col("_n")) * (points or 1)).alias("_step"),
    )
    if points:
        kept = out.groupBy(*by, "_step").agg(
            F.max_by(F.struct("threshold", "fpr", "tpr", "precision"), "threshold").alias("_at")
        )
        return kept.select(*by, "_at.*")
    return out.drop("_step")


def roc_curve(df, by=(), points=None):
    return curve_points(df, by, points=points).select(*by, "threshold", "fpr", "tpr")


def pr_curve(df, by=(), points=None):
    return curve_points(df, by, points=points).select(
        *by, "threshold", F.col("tpr").alias("recall"), "precision"
    )


def ranked_scores(df, key, by=()):
    """Rows ranked from the highest score, ties by key."""
    rows = usable(df).select(*by, key, "score", "label")
    ranked = global_rank(rows, [F.desc("score"), F.col(key)], by)
    sizes = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_size"), F.sum("label").alias("_positives")
    )
    if by:
        return join_null_safe(ranked, sizes, list(by))
    both = sizes.select(F.struct("_size", "_positives")).scalar()
    return ranked.withColumn("_both", both).select("*", "_both.*").drop("_both")


def topk_metrics(df, key, by=(), percents=(10, 20, 30)):
    """Precision and recall among the top k percent; k of 0 rows gives 0."""
    ranked = ranked_scores(df, key, by)
    tops = []
    for p in percents:
        k = F.floor(F.col("_size") * p / 100)
        tops.append(_ones((F.col("rank_no") <= k) & (F.col("label") == 1)).alias(f"hits_{p}"))
    counted = ranked.groupBy(*by, "_size", "_positives").agg(*tops)
    rows = [
        F.struct(
            F.lit(p).alias("percent"),
            F.floor(F.col("_size") * p / 100).alias("k"),
            ratio(F.col(f"hits_{p}"), F.floor(F.col("_size") * p / 100)).alias("precision_at_k"),
            ratio(F.col(f"hits_{p}"), F.col("_positives")).alias("recall_at_k"),
        )
        for p in percents
    ]
    return counted.select(*by, F.inline(F.array(*rows)))


def lift_deciles(df, key, by=(), groups=10):
    """Positive rate per score decile (1 is the highest) over the overall rate."""
    decile = F.floor((F.col("rank_no") - 1) * groups / F.col("_size")).cast("int") + 1
    per = (
        ranked_scores(df, key, by)
        .groupBy(*by, decile.alias("decile"), "_size", "_positives")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("label").alias("positives"),
        )
    )
    return per.select(
        *by, "decile", "n", "positives",
        (F.col("positives") / F.col("n")).alias("rate"),
        F.try_divide(
            F.col("positives") / F.col("n"), F.col("_positives") / F.col("_size")
        ).alias("lift"),
    )


def calibration_curve(df, by=(), bins=10):
    """Mean score and positive rate per equal-width (low, high] bin; empty bins are absent."""
    edges = [i / bins for i in range(1, bins)]
    index = reduce(lambda a, e: a + (F.col("score") > e).cast("int"), edges, F.lit(0))
    return (
        usable(df)
        .groupBy(*by, index.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("score").alias("mean_score"),
            F.avg("label").alias("positive_rate"),
        )
    )


def confusion_matrix(df, by=(), threshold=0.5):
    """Four rows per group, zeros included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(
            F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(c).alias("n")
        )
        for a, p, c in cells
    ]
    return threshold_counts(df, by, threshold).select(*by, F.inline(F.array(*rows)))


def classification_report(df, by=(), threshold=0.5):
    """Precision, recall, f1 and support per class, with accuracy, macro and weighted rows."""
    tp, fp, tn, fn = (F.col(c) for c in ["tp", "fp", "tn", "fn"])
    n = tp + fp + tn + fn
    counts = threshold_counts(df, by, threshold).select(
        *by,
        n.alias("n"), (tn + fp).alias("s0"), (tp + fn).alias("s1"),
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"),
        ratio(2 * tn, 2 * tn + fn + fp).alias("f0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, n).alias("acc"),
    )

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("bigint").alias("support"),
        )

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return ratio(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), F.col("n"))

    acc = F.col("acc")
    rows = [
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", acc, acc, acc, F.col("n")),
        row("macro avg", macro("p"), macro("r"), macro("f"), F.col("n")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("n")),
    ]
    return counts.select(*by, F.inline(F.array(*rows)))


def evaluate(df, by=(), threshold=0.5):
    """Threshold metrics and both areas per group."""
    prefix = score_prefix(df, by)
    areas = [roc_auc(df, by, prefix), pr_auc(df, by, prefix)]
    base = classification_metrics(df, by, threshold)
    if not by:
        return base.withColumns(
            {"roc_auc": areas[0].scalar(), "pr_auc": areas[1].scalar()}
        )
    return reduce(lambda a, b: join_null_safe(a, b, list(by), "left"), areas, base)


def best_model(df, model="model"):
    """The model with the highest area under the curve, with its metrics."""
    results = evaluate(df, [model])
    best = F.struct(*[F.col(c) for c in results.columns])
    return results.agg(
        F.max_by(best, F.struct("roc_auc", model)).alias("best")
    ).select("best.*")
