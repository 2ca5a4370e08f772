"""Rows with null labels, groups and values stay in."""

import datetime

from stayline.operators import clv, kpis, metrics, performance, prefix, profile, splits


def test_exact_split_keeps_null_labels(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", None), ("e", None)], "id string, label string")
    assert splits.stratified_split(df, "label", "id", exact=True).count() == 5


def test_null_group_is_measured(spark):
    rows = [(g, f"{g}{i}", i / 10, int(i > 5)) for g in ("x", None) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, id string, score double, label int")
    areas = {r.g: r.roc_auc for r in metrics.evaluate(df, ["g"]).collect()}
    assert areas == {"x": 1.0, None: 1.0}
    assert {r.g for r in metrics.topk_metrics(df, "id", ["g"]).collect()} == {"x", None}


def test_rows_join_to_a_null_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", None)], "id string, v double")
    per_value = df.groupBy("v").count().withColumnRenamed("count", "n")
    assert prefix.join_by_value(df, per_value, "v").count() == 3


def test_null_value_has_no_percentile(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0), ("e", 7.0)], f"{clv.S.ID} string, predicted_clv double")
    found = {r[0]: r.clv_percentile for r in clv.clv_percentile(df).collect()}
    assert found == {"a": 0.0, "b": None, "c": 25.0, "d": 25.0, "e": 75.0}


def test_trend_has_every_point(spark):
    start = datetime.datetime(2024, 1, 1)
    fields = ", ".join(f"{m} double" for m in performance.COMPARED)
    rows = [((start + datetime.timedelta(days=i)).isoformat(), *[0.5] * len(performance.COMPARED)) for i in range(150)]
    history = spark.createDataFrame(rows, f"timestamp string, {fields}")
    assert performance.perf_trend(history).count() == 150


def test_null_group_has_an_area_and_a_comparison(spark):
    rows = [(g, f"{g}{i}", i / 10, int(i > 5)) for g in ("x", None) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, id string, score double, label int")
    now = performance.perf_metrics(df, ["g"])
    assert {r.g: r.roc_auc for r in now.collect()} == {"x": 1.0, None: 1.0}
    compared = performance.compare(now, now, ["g"]).collect()
    assert {r.g for r in compared} == {"x", None} and not any(r.degraded for r in compared)


def test_null_group_has_key_figures_and_a_density(spark):
    rows = [(g, 0.8, float(m)) for g in ("x", None) for m in (10, 20, 30, 40)]
    df = spark.createDataFrame(rows, "g string, churn_probability double, MonthlyCharges double")
    table = {r.g: r.intervention_readiness_score for r in kpis.kpi_table(df, ["g"]).collect()}
    assert table == {"x": 25.0, None: 25.0}
    bars = profile.histogram(df, ["MonthlyCharges"], bins=2, by=["g"], density=True).collect()
    assert {r.g for r in bars} == {"x", None} and all(r.density is not None for r in bars)
