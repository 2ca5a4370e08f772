import math
import random

import pytest
from pyspark.sql import functions as F

from stayline.functions.stats import kolmogorov_p
from stayline.operators import alerts, drift, performance
from tests.helpers import plan_text


def _normal(spark, seed, n=1000, shift=0.0):
    draw = random.Random(seed)
    return spark.createDataFrame([(draw.gauss(0, 1) + shift, "ABC"[i % 3]) for i in range(n)], "x double, c string")


def _psi_by_hand(a, b, bins=10):
    low, high = min(a + b), max(a + b)
    width = (high - low) / bins

    def share(values, i):
        n = sum(1 for v in values if sum(v >= low + j * width for j in range(1, bins)) == i)
        return n / len(values) or 1e-6

    return sum(
        (share(b, i) - share(a, i)) * math.log(share(b, i) / share(a, i)) for i in range(bins)
    )


def test_same_distribution_is_stable(spark):
    rows = drift.drift_features(_normal(spark, 1), _normal(spark, 2)).collect()
    by = {r.feature: r for r in rows}
    assert 0 <= by["x"].psi < 0.1 and 0 <= by["x"].ks_statistic <= 1 and 0 <= by["x"].ks_pvalue <= 1
    assert by["c"].psi == pytest.approx(0) and by["c"].ks_statistic is None
    assert by["c"].importance == pytest.approx(0)


def test_psi_and_ks_by_brute_force(spark):
    draw = random.Random(3)
    a = [round(draw.random(), 1) for _ in range(150)]
    b = [round(draw.random() * 0.8 + 0.1, 1) for _ in range(90)]
    frame = lambda values: spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    row = drift.drift_features(frame(a), frame(b)).first()
    assert row.psi == pytest.approx(_psi_by_hand(a, b))
    gap = max(abs(sum(v <= t for v in a) / 150 - sum(v <= t for v in b) / 90) for t in a + b)
    assert row.ks_statistic == pytest.approx(gap)


def test_ks_is_symmetric_and_zero_on_itself(spark):
    one, two = _normal(spark, 5), _normal(spark, 6, shift=0.3)
    there, back = (
        drift.ks_two_sample(drift.value_counts(a, b, ["x"])).first() for a, b in ((one, two), (two, one))
    )
    assert there.ks_statistic == pytest.approx(back.ks_statistic)
    same = drift.ks_two_sample(drift.value_counts(one, one, ["x"])).first()
    assert same.ks_statistic == 0 and same.ks_pvalue == 1.0


def test_limit_p_values(spark):
    # Published points of the limit distribution: Q(1.3581) = 0.05, Q(1.6276) = 0.01.
    df = spark.createDataFrame([(1.3581, 0.05), (1.6276, 0.01), (0.5, 0.9639)], "lam double, q double")
    n = F.lit(2000000)
    rows = df.select("q", kolmogorov_p(F.col("lam") / 1000.0, n, n).alias("p")).collect()
    for row in rows:
        assert row.p == pytest.approx(row.q, abs=2e-4)


def test_exact_p_value_by_enumeration(spark):
    from itertools import combinations

    n, m = 4, 3
    a, b = [1.0, 2.0, 5.0, 6.0], [3.0, 4.0, 7.0]

    def statistic(first):
        first = set(first)
        i = j = best = 0
        for rank in range(n + m):
            i, j = i + (rank in first), j + (rank not in first)
            best = max(best, abs(i * m - j * n))
        return best

    own = statistic([0, 1, 4, 5])
    orders = list(combinations(range(n + m), n))
    expected = sum(statistic(o) >= own for o in orders) / len(orders)
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "x double")
    row = drift.ks_two_sample(drift.value_counts(frame(a), frame(b), ["x"]), method="exact").first()
    assert row.ks_pvalue == pytest.approx(expected)


def test_exact_and_limit_agree_on_large_samples(spark):
    counts = drift.value_counts(_normal(spark, 8, 4000), _normal(spark, 9, 5000, 0.03), ["x"])
    exact = drift.ks_two_sample(counts, method="exact").first().ks_pvalue
    limit = drift.ks_two_sample(counts).first().ks_pvalue
    assert exact == pytest.approx(limit, abs=0.02)


def test_edge_cases_of_features(spark):
    a = spark.createDataFrame([(5.0, None, "u")] * 3, "k double, e double, t string")
    b = spark.createDataFrame([(5.0, 1.0, None)] * 3, "k double, e double, t string")
    rows = {r.feature: r for r in drift.drift_features(a, b, ["k", "e", "gone"], ["t"]).collect()}
    assert rows["k"].psi == 0.0 and not rows["k"].drift_detected
    assert rows["e"].psi is None and rows["e"].importance is None and not rows["e"].drift_detected
    assert rows["t"].psi is None
    assert rows["gone"].feature_type == "unknown" and rows["gone"].drift_severity == "none"
    ranked = [r.feature for r in drift.rank_features(drift.drift_features(a, b)).collect()]
    assert ranked == ["k", "e", "t"]


def test_strong_shift_is_high_and_alerts(spark):
    one, two = _normal(spark, 10), _normal(spark, 11, shift=2.0)
    report = drift.drift_report(
        one, two, predictions=(one, two), labels=(one, one), score="x", label="c"
    ).cache()
    summary = drift.drift_summary(report)
    row = summary.first()
    assert (row.features_checked, row.features_with_drift, row.max_severity) == (2, 1, "high")
    assert row.prediction_drift and not row.label_drift and row.severity_high == 2 and row.severity_none == 1
    alert = alerts.drift_alerts(summary).first()
    assert alert.severity == "high" and "Features with drift: 1/2" in alert.message
    assert "Prediction drift detected" in alert.message and "Label" not in alert.message


def test_no_drift_no_alert(spark):
    same = _normal(spark, 12)
    summary = drift.drift_summary(drift.drift_report(same, same))
    assert summary.first().max_severity == "none" and alerts.drift_alerts(summary).count() == 0


def test_enrichment_keeps_unknown_features(spark):
    metrics = drift.drift_features(_normal(spark, 1), _normal(spark, 2))
    known = spark.createDataFrame([("x", "a number", "me", ["t"])], "feature string, description string, owner string, tags array<string>")
    rows = {r.feature: r.description for r in drift.enrich(metrics, known).collect()}
    assert rows == {"x": "a number", "c": None}


_METRICS = "sample_size bigint, roc_auc double, accuracy double, f1 double, precision double, recall double"


def _metrics(spark, *values):
    return spark.createDataFrame([(10, *values)], _METRICS)


@pytest.mark.parametrize(
    "current, degraded, severity",
    [
        ((0.85, 0.80, 0.75, 0.5, 0.5), True, "medium"),
        ((0.90, 0.85, 0.80, 0.1, 0.1), False, "none"),
        ((0.70, 0.85, 0.80, 0.5, 0.5), True, "high"),
        ((None, 0.85, 0.80, 0.5, 0.5), False, "none"),
    ],
)
def test_comparison_with_baseline(spark, current, degraded, severity):
    base = _metrics(spark, 0.90, 0.85, 0.80, 0.7, 0.7)
    compared = performance.compare(_metrics(spark, *current), base)
    row = compared.first()
    assert (row.degraded, row.severity) == (degraded, severity)
    assert alerts.performance_alerts(compared).count() == int(degraded)
    assert performance.compare_long(compared).count() == (5 if current[0] else 4)


def test_alert_threshold_and_text(spark):
    base = _metrics(spark, 0.90, 0.85, 0.80, 0.7, 0.7)
    compared = performance.compare(_metrics(spark, 0.80, 0.85, 0.80, 0.7, 0.7), base)
    assert alerts.performance_alerts(compared, "high").count() == 0
    assert "  roc_auc: 0.1000\n" in alerts.performance_alerts(compared).first().message


def test_history_keeps_the_newest(spark):
    rows = [(f"2024{m:02d}01T000000Z", 0.5 + m / 100, 0.5, 0.5, 0.5, 0.5) for m in range(1, 13)]
    schema = "timestamp string, roc_auc double, accuracy double, precision double, recall double, f1 double"
    history = spark.createDataFrame(rows[:8], schema)
    kept = performance.append_history(history, spark.createDataFrame(rows[8:], schema), n=5)
    assert sorted(r.timestamp for r in kept.collect()) == [r[0] for r in rows[7:]]
    trend = performance.perf_trend(
        kept.unionByName(spark.createDataFrame([("unreadable", *rows[0][1:])], schema))
    ).collect()
    assert trend[0].roc_auc_change is None and trend[1].roc_auc_change == pytest.approx(0.01)
    assert sum(r["at"] is None for r in trend) == 1


def test_promotion_archives_earlier_versions(spark):
    def version(v, order):
        return [(v, i, s) for i, s in zip([0, 0, 1, 1], order)]

    rows = version(1, [0.1, 0.2, 0.8, 0.9]) + version(2, [0.1, 0.2, 0.8, 0.9]) + version(3, [0.9, 0.8, 0.2, 0.1])
    df = spark.createDataFrame(rows, "model_version int, label int, score double")
    status = {r.model_version: r.status for r in performance.promotion(df).collect()}
    assert status == {1: "archived", 2: "production", 3: "skipped"}


def test_alignment_by_key(spark):
    scores = spark.createDataFrame([("a", 0.9), ("b", 0.2), ("x", 0.5)], "customerID string, score double")
    labels = spark.createDataFrame([("b", 0), ("a", 1), ("y", 1)], "customerID string, label int")
    row = performance.perf_metrics(performance.aligned(scores, labels)).first()
    assert row.sample_size == 2 and row.roc_auc == 1.0 and row.prediction_threshold == 0.5


def test_psi_needs_no_order(spark):
    frame = lambda seed, shift: spark.range(500).select(
        (F.rand(seed) + shift).alias("x"), F.when(F.rand(seed + 1) < 0.9, F.floor(F.rand(seed + 2) * 5)).alias("y"))
    a, b = frame(1, 0.0).cache(), frame(7, 0.2).cache()
    ordered = {r.feature: r.psi for r in drift.psi_numeric(drift.value_counts(a, b, ["x", "y"])).collect()}
    binned = drift.psi_by_bins(a, b, ["x", "y"])
    assert {r.feature: r.psi for r in binned.collect()} == pytest.approx(ordered)
    assert "rangepartitioning" not in plan_text(binned) and "Window" not in plan_text(binned)


def test_the_p_value_says_where_it_comes_from(spark):
    frame = lambda n: spark.range(n).select(F.col("id").cast("double").alias("x"))
    counts = drift.value_counts(frame(30), frame(40), ["x"])
    found = [drift.ks_two_sample(counts, "auto", limit).first() for limit in (100, 10)]
    assert [r.ks_distribution for r in found] == ["exact", "limit"]
    assert found[0].ks_pvalue == drift.ks_two_sample(counts, "exact").first().ks_pvalue
    assert found[1].ks_pvalue == drift.ks_two_sample(counts).first().ks_pvalue


def test_enrich_takes_the_newest_version(spark):
    catalogue = spark.createDataFrame(
        [("x", "1", "old", "a", ["t"]), ("x", "2", "new", "b", None), ("y", "1", "kept", None, None)],
        "feature string, version string, description string, owner string, tags array<string>")
    metrics = spark.createDataFrame([("x",), ("y",), ("z",)], "feature string")
    found = {r.feature: (r.description, r.owner) for r in drift.enrich(metrics, catalogue).collect()}
    assert found == {"x": ("new", "b"), "y": ("kept", None), "z": (None, None)}
