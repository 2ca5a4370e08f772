from collections import Counter

import pytest

from stayline.operators import metrics
from stayline.operators.prefix import global_rank, prefix_counts
from stayline.operators.quantiles import exact_quantiles
from tests.helpers import plan_text, tied_scores


@pytest.fixture(scope="module")
def tied(spark):
    return spark.createDataFrame(tied_scores(), "customerID string, score double, label int").cache()


@pytest.fixture(scope="module")
def known():
    return [(i, s, y) for i, s, y in tied_scores() if s is not None]


def test_prefix_counts_by_brute_force(spark, tied, known):
    from pyspark.sql import functions as F

    rows = prefix_counts(tied.where("score IS NOT NULL"), "score", {"n": F.count(F.lit(1))}).collect()
    scores = [s for _, s, _ in known]
    assert {r.score: (r.n, r.n_cum) for r in rows} == {
        s: (scores.count(s), sum(x <= s for x in scores)) for s in set(scores)
    }


def test_global_rank_is_a_permutation_in_order(spark, tied):
    from pyspark.sql import functions as F

    rows = global_rank(tied.where("score IS NOT NULL"), [F.desc("score"), F.col("customerID")]).collect()
    ordered = sorted(rows, key=lambda r: (-r.score, r.customerID))
    assert [r.rank_no for r in ordered] == list(range(1, len(rows) + 1))


def test_ranks_over_many_ranges(spark):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select("id", (F.col("id") % 2).alias("g"), F.expr("(id * 7919) % 1009").alias("v"))
        ranked = global_rank(df, [F.col("v"), F.col("id")], ["g"]).cache()
        assert ranked.where("rank_no = 1").count() == 2
        assert ranked.agg(F.countDistinct("g", "rank_no"), F.max("rank_no")).first()[:] == (5000, 2500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
def test_quantiles_interpolate(spark, p):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered, at = sorted(values), p * (len(values) - 1)
    low = ordered[int(at)]
    expected = low + (ordered[min(int(at) + 1, 7)] - low) * (at - int(at))
    assert exact_quantiles(df, "v", {"q": p}).first().q == pytest.approx(expected)


def test_measures_by_hand(spark):
    """Three hits, two false alarms, one miss; 12 of 16 pairs in the right order."""
    y, p = [1, 1, 0, 1, 0, 0, 1, 0], [0.91, 0.84, 0.77, 0.66, 0.52, 0.41, 0.35, 0.08]
    row = metrics.evaluate(spark.createDataFrame(list(zip(y, p)), "label int, score double")).first()
    found = (row.sample_size, row.accuracy, row.precision, row.recall, row.f1, row.roc_auc)
    assert found == pytest.approx((8, 5 / 8, 3 / 5, 3 / 4, 2 / 3, 12 / 16))


def test_roc_auc_by_brute_force(tied, known):
    wins = sum(
        1.0 if a > b else 0.5 if a == b else 0.0
        for _, a, y in known if y for _, b, z in known if not z
    )
    pairs = sum(y for *_, y in known) * sum(1 - y for *_, y in known)
    assert metrics.roc_auc(tied).first().roc_auc == pytest.approx(wins / pairs)


def test_pr_auc_by_brute_force(tied, known):
    positives = sum(y for *_, y in known)
    points = [(0.0, 1.0)]
    for t in sorted({s for _, s, _ in known}, reverse=True):
        flagged = [y for _, s, y in known if s >= t]
        points.append((sum(flagged) / positives, sum(flagged) / len(flagged)))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert metrics.pr_auc(tied).first().pr_auc == pytest.approx(area)


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    row = metrics.evaluate(df).first()
    assert row.roc_auc is None and row.recall == 0.5


def test_empty_input(spark):
    df = spark.createDataFrame([], "label int, score double")
    row = metrics.evaluate(df).first()
    assert row.sample_size == 0 and row.accuracy is None and row.roc_auc is None


def test_topk_by_brute_force(tied, known):
    ordered = sorted(known, key=lambda r: (-r[1], r[0]))
    positives = sum(y for *_, y in known)
    for row in metrics.topk_metrics(tied, "customerID").collect():
        k = len(known) * row.percent // 100
        hits = sum(y for *_, y in ordered[:k])
        assert (row.k, row.precision_at_k) == (k, pytest.approx(hits / k))
        assert row.recall_at_k == pytest.approx(hits / positives)


def test_topk_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 0)], "customerID string, score double, label int")
    assert [tuple(r) for r in metrics.topk_metrics(df, "customerID", percents=(10,)).collect()] == [(10, 0, 0.0, 0.0)]


def test_deciles_cover_all_rows(tied, known):
    rows = metrics.lift_deciles(tied, "customerID").collect()
    assert sum(r.n for r in rows) == len(known) and len(rows) == 10
    assert sum(r.lift * r.n for r in rows) / len(known) == pytest.approx(1.0)


def test_calibration_bins_are_open_below(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.11), (1, 1.0), (0, 0.0)], "label int, score double")
    assert {r.bin: r.n for r in metrics.calibration_curve(df).collect()} == {0: 2, 1: 1, 9: 1}


def test_confusion_matrix_fills_zeros(spark):
    df = spark.createDataFrame([(1, 0.9)], "label int, score double")
    rows = {(r.label, r.predicted): r.n for r in metrics.confusion_matrix(df).collect()}
    assert rows == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_report_averages(tied, known):
    rows = {r["class"]: r for r in metrics.classification_report(tied).collect()}
    assert rows["0"].support + rows["1"].support == len(known) == rows["macro avg"].support
    assert rows["macro avg"].f1 == pytest.approx((rows["0"].f1 + rows["1"].f1) / 2)


def test_thinned_curve_keeps_exact_points(tied):
    full = {tuple(r) for r in metrics.roc_curve(tied).collect()}
    few = [tuple(r) for r in metrics.roc_curve(tied, points=5).collect()]
    assert 0 < len(few) <= 6 and set(few) <= full


def test_groups_equal_single_runs(spark, tied):
    from pyspark.sql import functions as F

    both = tied.withColumn("model", F.lit("a")).unionByName(
        tied.withColumn("model", F.lit("b")).withColumn("score", 1 - F.col("score"))
    )
    rows = {r.model: r for r in metrics.evaluate(both, ["model"]).collect()}
    assert rows["a"].roc_auc == pytest.approx(1 - rows["b"].roc_auc)
    assert metrics.best_model(both).first().model == max(rows, key=lambda m: rows[m].roc_auc)
    assert Counter(r.model for r in metrics.roc_curve(both, ["model"]).collect()).keys() == {"a", "b"}


def test_rows_never_meet_on_one_task(spark):
    """No unpartitioned exchange below a row-level window."""
    from pyspark.sql import functions as F

    df = spark.range(1000).select(F.col("id").alias("customerID"), F.rand(1).alias("score"), F.lit(1).alias("label"))
    ranked = global_rank(df, [F.col("score"), F.col("customerID")])
    for line in plan_text(ranked).splitlines():
        if "SinglePartition" in line:
            assert "score" not in line
