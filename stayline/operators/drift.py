"""Drift between a reference and a current table.

All number columns are handled in one job and all text columns in another. Values are
counted per (feature, value, side) before anything else, so both statistics of a number
column come from one read and one ordering of those counts.
"""

from functools import reduce

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.stats import kolmogorov_p, kolmogorov_p_exact
from stayline.operators.prefix import prefix_counts
from stayline.operators.profile import numeric_columns, unpivot_numeric, unpivot_text

# Fixed values.
PSI_LOW, PSI_HIGH = 0.1, 0.25
KS_ALPHA = 0.05
EPSILON = 1e-6
BINS = 10
EXACT_LIMIT = 10000


def shared_columns(reference, current):
    """(numeric, text): columns both tables have, typed by the reference."""
    numbers = set(numeric_columns(reference))
    shared = [c for c in reference.columns if c in set(current.columns)]
    return [c for c in shared if c in numbers], [c for c in shared if c not in numbers]


def _both_sides(pairs, unpivot):
    """Rows (feature, value, _ref) of (reference, current, columns) triples."""
    parts = [
        unpivot(df, columns).where("value IS NOT NULL").withColumn("_ref", F.lit(ref))
        for reference, current, columns in pairs
        for df, ref in ((reference, 1), (current, 0))
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _counts_of(pairs):
    return prefix_counts(
        _both_sides(pairs, unpivot_numeric),
        "value",
        {"ref": F.sum("_ref"), "cur": F.sum(1 - F.col("_ref"))},
        ["feature"],
    )


def value_counts(reference, current, columns):
    """Running counts per (feature, value) for both sides."""
    return _counts_of([(reference, current, columns)])


def _psi_term():
    expected = F.try_divide("ref", "n_ref")
    actual = F.try_divide("cur", "n_cur")
    e = F.when(expected == 0, EPSILON).otherwise(expected)
    a = F.when(actual == 0, EPSILON).otherwise(actual)
    return (a - e) * F.ln(a / e)


def _feature_sizes(counts):
    return counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"),
        F.sum("cur").alias("n_cur"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def psi_numeric(counts, bins=BINS):
    """PSI per feature from `value_counts`: equal-width bins over the joint range."""
    return _psi_of(counts, _feature_sizes(counts), bins)


def psi_by_bins(reference, current, columns, bins=BINS):
    """PSI per feature in two reads: sizes and extremes, then the counts of the bins.

    No value is ordered, and only bin counts are shuffled.
    """
    rows = _both_sides([(reference, current, columns)], unpivot_numeric)
    rows = rows.select("feature", "value", F.col("_ref").alias("ref"), (1 - F.col("_ref")).alias("cur"))
    return _psi_of(rows, _feature_sizes(rows), bins)


def _psi_of(rows, sizes, bins):
    # One row per column.
    placed = rows.join(F.broadcast(sizes), "feature")
    width = (F.col("high") - F.col("low")) / bins
    inner = reduce(
        lambda a, i: a + (F.col("value") >= F.col("low") + i * width).cast("int"),
        range(1, bins),
        F.lit(0),
    )
    binned = placed.groupBy("feature", "n_ref", "n_cur", "low", "high", inner.alias("bin")).agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur")
    )
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    term = F.when(both, F.when(F.col("low") == F.col("high"), 0.0).otherwise(_psi_term()))
    return binned.groupBy("feature").agg(F.sum(term).alias("psi"))


def ks_two_sample(counts, method="limit", exact_limit=EXACT_LIMIT):
    """Largest distance of the two distribution functions, with its p-value.

    "limit" is the limit distribution as a native expression. "exact" counts lattice
    paths and fails on samples of more than `exact_limit` values; "auto" takes the exact
    value up to that limit and the limit distribution above, and says in `ks_distribution`
    which one it was. The statistic is the same.
    """
    placed = counts.join(F.broadcast(_feature_sizes(counts)), "feature")
    gap = F.abs(
        F.try_divide("ref_cum", "n_ref") - F.try_divide("cur_cum", "n_cur")
    )
    found = placed.groupBy("feature", "n_ref", "n_cur").agg(F.max(gap).alias("ks_statistic"))
    limit = kolmogorov_p(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    if method in ("exact", "auto"):
        small = F.greatest("n_ref", "n_cur") <= exact_limit
        exact = kolmogorov_p_exact(
            F.when(small, F.col("ks_statistic")), F.col("n_ref"), F.col("n_cur")
        )
        beyond = limit if method == "auto" else F.raise_error(
            F.lit(f"exact p-value asked for more than {exact_limit} values")
        ).cast("double")
        p = F.when(small, exact).otherwise(beyond)
    elif method == "limit":
        p = limit
    else:
        raise ValueError("method is 'limit', 'exact' or 'auto'")
    if method == "auto":
        found = found.withColumn("ks_distribution", F.when(small, "exact").otherwise("limit"))
    return found.withColumn("ks_pvalue", p)


def psi_categorical(reference, current, columns):
    """PSI per text column over the union of its values."""
    return _psi_text([(reference, current, columns)])


def _psi_text(pairs):
    counts = (
        _both_sides(pairs, unpivot_text)
        .groupBy("feature", "value")
        .agg(F.sum("_ref").alias("ref"), F.sum(1 - F.col("_ref")).alias("cur"))
    )
    sizes = counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur")
    )
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    # One row per column.
    return (
        counts.join(F.broadcast(sizes), "feature")
        .groupBy("feature")
        .agg(F.sum(F.when(both, _psi_term())).alias("psi"))
    )


def importance(psi, statistic, pvalue, alpha=KS_ALPHA):
    """PSI capped at 1; number columns mix in the distance, weighted by significance."""
    psi_part = F.least(psi, F.lit(1.0))
    weight = 1 + (1 - F.least(pvalue / alpha, F.lit(1.0)))
    # `least` skips nulls, so a missing statistic has to be kept apart.
    ks_part = F.when(statistic.isNotNull(), F.least(statistic * weight, F.lit(1.0)))
    return F.when(psi.isNull(), F.lit(None)).otherwise(
        F.when(ks_part > 0, 0.7 * psi_part + 0.3 * ks_part).otherwise(psi_part)
    )


def with_verdict(metrics, psi_low=PSI_LOW, psi_high=PSI_HIGH, alpha=KS_ALPHA):
    psi = F.col("psi")
    by_psi = F.when(psi >= psi_high, "high").when(psi >= psi_low, "low").otherwise("none")
    by_ks = F.coalesce(F.col("ks_pvalue") < alpha, F.lit(False))
    severity = F.when(by_ks & (by_psi == "none"), "low").otherwise(by_psi)
    return metrics.select(
        "feature", "feature_type", "psi", "ks_statistic", "ks_pvalue",
        (by_ks | (by_psi != "none")).alias("drift_detected"),
        severity.alias("drift_severity"),
        importance(psi, F.col("ks_statistic"), F.col("ks_pvalue"), alpha).alias("importance"),
    )


def drift_features(reference, current, numeric=None, categorical=None, ks_method="limit", **limits):
    """One row per feature: PSI, KS, verdict and importance.

    A requested feature that one table lacks comes back as unknown, without drift.
    """
    numbers, texts = shared_columns(reference, current)
    wanted_numbers = numbers if numeric is None else numeric
    wanted_texts = texts if categorical is None else categorical
    shared = set(numbers) | set(texts)
    absent = [c for c in [*wanted_numbers, *wanted_texts] if c not in shared]
    numbers = [(reference, current, [c for c in wanted_numbers if c in shared])]
    texts = [(reference, current, [c for c in wanted_texts if c in shared])]
    return with_verdict(_measured(numbers, texts, absent, ks_method), **limits)


def _measured(numbers, texts, absent=(), ks_method="limit"):
    """Unjudged metrics of all number pairs in one job and all text pairs in another."""
    numbers = [p for p in numbers if p[2]]
    texts = [p for p in texts if p[2]]
    parts = []
    if numbers:
        counts = _counts_of(numbers)
        parts.append(
            psi_numeric(counts)
            .join(ks_two_sample(counts, ks_method), "feature")
            .select("feature", F.lit("numeric").alias("feature_type"), "psi", "ks_statistic", "ks_pvalue")
        )
    if texts:
        parts.append(
            _psi_text(texts).select(
                "feature",
                F.lit("categorical").alias("feature_type"),
                "psi",
                F.lit(None).cast("double").alias("ks_statistic"),
                F.lit(None).cast("double").alias("ks_pvalue"),
            )
        )
    if absent:
        named = F.explode(F.array(*[F.lit(c) for c in absent])).alias("feature")
        nothing = [F.lit(None).cast("double").alias(c) for c in ("psi", "ks_statistic", "ks_pvalue")]
        one_row = SparkSession.active().range(1)
        parts.append(one_row.select(named, F.lit("unknown").alias("feature_type"), *nothing))
    return reduce(lambda a, b: a.unionByName(b), parts)


PREDICTIONS, LABELS = "predictions", "labels"


def _scores(pair, score):
    return (*[df.select(F.col(score).alias(PREDICTIONS)) for df in pair], [PREDICTIONS])


def _labels(pair, label):
    return (*[df.select(F.col(label).cast("string").alias(LABELS)) for df in pair], [LABELS])


def drift_predictions(reference, current, score="churn_probability", ks_method="limit", **limits):
    pairs = [_scores((reference, current), score)]
    return with_verdict(_measured(pairs, [], ks_method=ks_method), **limits)


def drift_labels(reference, current, label=S.TARGET, **limits):
    return with_verdict(_measured([], [_labels((reference, current), label)]), **limits)


def drift_report(
    reference, current, predictions=None, labels=None, score="churn_probability",
    label=S.TARGET, numeric=None, categorical=None, ks_method="limit", **limits,
):
    """Data, prediction and label drift in one table with a `kind`.

    `predictions` and `labels` are optional (reference, current) pairs. Scores join the job
    of the number columns and labels that of the text columns.
    """
    numbers, texts = shared_columns(reference, current)
    number_pairs = [(reference, current, numbers if numeric is None else numeric)]
    text_pairs = [(reference, current, texts if categorical is None else categorical)]
    if predictions:
        number_pairs.append(_scores(predictions, score))
    if labels:
        text_pairs.append(_labels(labels, label))
    kind = F.when(F.lit(bool(predictions)) & (F.col("feature") == PREDICTIONS), "prediction").when(
        F.lit(bool(labels)) & (F.col("feature") == LABELS), "label"
    )
    judged = with_verdict(_measured(number_pairs, text_pairs, ks_method=ks_method), **limits)
    return judged.withColumn("kind", kind.otherwise("data"))


def rank_features(metrics, top=None):
    """By importance, unscored features last; ties by name."""
    ranked = metrics.orderBy(F.desc_nulls_last("importance"), "feature")
    return ranked.limit(top) if top is not None else ranked


def top_psi(metrics, top=20):
    return metrics.where("psi IS NOT NULL").orderBy(F.desc("psi"), "feature").limit(top)


def enrich(metrics, catalogue):
    """Attach description, owner and tags where the catalogue knows the feature.

    Of a catalogue with versions the newest entry of each feature counts.
    """
    entry = F.struct("description", "owner", "tags")
    newest = F.max_by(entry, F.col("version")) if "version" in catalogue.columns else F.first(entry)
    known = catalogue.groupBy("feature").agg(newest.alias("_entry")).select("feature", "_entry.*")
    return metrics.join(known, "feature", "left")


def drift_summary(rows):
    """Totals over a `drift_report`, in one row.

    Prediction and label drift enter the severity counts only when detected.
    """
    is_data, found = F.col("kind") == "data", F.col("drift_detected")

    def number(condition):
        return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))

    def flag(condition):
        return F.coalesce(F.max(condition), F.lit(False))

    counted = is_data | found
    return rows.agg(
        number(is_data).alias("features_checked"),
        number(is_data & found).alias("features_with_drift"),
        *[
            number(counted & (F.col("drift_severity") == s)).alias(f"severity_{s}")
            for s in S.SEVERITIES
        ],
        flag(found).alias("overall_drift"),
        flag((F.col("kind") == "prediction") & found).alias("prediction_drift"),
        flag((F.col("kind") == "label") & found).alias("label_drift"),
        F.max(
            F.array_position(F.array(*[F.lit(s) for s in S.SEVERITIES]), F.col("drift_severity"))
        ).alias("_level"),
    ).withColumn(
        "max_severity",
        F.coalesce(
            F.try_element_at(F.array(*[F.lit(s) for s in S.SEVERITIES]), F.col("_level").cast("int")),
            F.lit("none"),
        ),
    ).drop("_level")


def top_drifted(metrics, top=10):
    """The first `top` of the ranking, those without drift then left out."""
    return rank_features(metrics, top).where("drift_detected")
