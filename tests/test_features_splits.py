import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import features as X
from stayline.operators import features, splits


def test_stratified_folds_share_rare_labels(spark):
    rows = [(f"k{i}", "Yes" if i < 8 else "No" if i < 40 else None) for i in range(47)]
    folded = splits.kfold(spark.createDataFrame(rows, "id string, label string"), 5, "id", label="label")
    assert folded.count() == 47
    for label in ("Yes", "No", None):
        n = [folded.where(F.col("label").eqNullSafe(label) & (F.col("fold") == i)).count() for i in range(5)]
        assert max(n) - min(n) <= 1


def test_tenure_buckets(spark):
    df = spark.createDataFrame([(x,) for x in [0, 5, 12, 13, 30, 50, 70, 73, 101, None]], "t int")
    got = [r.b for r in df.select("t", X.tenure_bucket(F.col("t")).alias("b")).collect()]
    assert got == ["0-12", "0-12", "0-12", "13-24", "25-36", "49-60", "61-72", "73+", None, None]


def test_eda_buckets_leave_zero_out(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, 35.0, 10000.0)], "tenure int, MonthlyCharges double, TotalCharges double")
    from stayline.operators.profile import with_eda_buckets

    rows = with_eda_buckets(df).collect()
    assert tuple(rows[0][3:]) == (None, None, None) and tuple(rows[1][3:]) == ("0-12", "0-35", "5001+")


def test_revenue_signals_and_clv(spark):
    df = spark.createDataFrame(
        [(50.0, 500.0, 10, "Month-to-month"), (100.0, 1200.0, 12, "One year"), (10.0, 0.0, 0, "Two year"),
         (10.0, None, 5, "other")],
        "m double, t double, k int, c string",
    )
    m, t, k = F.col("m"), F.col("t"), F.col("k")
    average = X.avg_monthly_charge(t, k)
    rows = df.select(
        X.charges_ratio(m, t), average, X.charge_increase_flag(m, average),
        X.clv_proxy(t, m, F.col("c")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (0.1, 50.0, 0, 1100.0), (100 / 1200, 100.0, 0, 2400.0), (None, None, 0, 240.0), (None, None, 0, 120.0),
    ]


def test_scaling_uses_the_population_deviation_after_filling(spark, customers):
    rows = customers.toPandas()
    model = features.fit_features(customers)
    filled = rows.TotalCharges.fillna(rows.TotalCharges.mean())
    assert model.means["TotalCharges"] == pytest.approx(filled.mean())
    assert model.deviations["TotalCharges"] == pytest.approx(filled.std(ddof=0))
    matrix = model.transform(customers)
    assert matrix.columns[:2] == [S.ID, "label"] and len(model.features) == len(matrix.columns) - 2
    check = matrix.agg(F.avg("num__TotalCharges"), F.stddev_pop("num__TotalCharges")).first()
    assert check[0] == pytest.approx(0, abs=1e-9) and check[1] == pytest.approx(1)


def test_constant_column_is_divided_by_one(spark, customers):
    constant = customers.withColumn("SeniorCitizen", F.lit(1))
    model = features.fit_features(constant, categorical=["gender"])
    assert model.transform(constant).agg(F.max(F.abs("num__SeniorCitizen"))).first()[0] == 0.0


def test_all_null_column_can_be_fitted(spark, customers):
    empty = customers.withColumn("TotalCharges", F.lit(None).cast("double"))
    model = features.fit_features(empty, categorical=["gender"])
    assert model.transform(empty).agg(F.max(F.abs("num__TotalCharges"))).first()[0] == 0.0


def test_unknown_category_raises_or_is_ignored(spark, customers):
    odd = customers.withColumn("gender", F.lit("Other"))
    strict = features.fit_features(customers)
    with pytest.raises(SparkRuntimeException, match="unknown category in gender"):
        strict.transform(odd).collect()
    loose = features.fit_features(customers, handle_unknown="ignore")
    assert loose.transform(odd).agg(F.max("cat__gender_Male")).first()[0] == 0.0


def test_missing_bucket_is_a_category_of_its_own(spark, customers):
    long_ago = customers.withColumn("tenure", F.when(F.col("tenure") > 30, 101).otherwise(F.col("tenure")))
    model = features.fit_features(long_ago)
    assert model.categories["tenure_bucket"][-1] is None
    assert "cat__tenure_bucket_None" in model.transform(long_ago).columns


def test_required_columns_are_checked_at_once(customers):
    with pytest.raises(ValueError, match="tenure"):
        features.engineer(customers.drop("tenure"))


def test_fill_missing_uses_medians(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    rows = features.fill_missing(df, ["a", "b"]).collect()
    assert sorted(tuple(r) for r in rows) == [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]


def test_catalogue_lists_and_latest(spark, folder):
    from stayline.sources import derived

    catalogue = features.feature_catalogue(
        derived.snapshots(spark, folder), ["tenure"], ["Contract"], transformer_config={"scale": True}
    ).cache()
    assert [r.feature for r in features.list_features(catalogue).collect()] == ["Contract", "tenure"]
    newest = features.latest_version(catalogue).collect()
    assert {r.version for r in newest} == {"20240103T000000Z"}
    assert newest[0].column_order == ["tenure", "Contract"] and newest[0].transformer_config == {"scale": "True"}


def test_exact_split_shares(customers):
    counts = {
        (r.Churn, r.split): r["count"]
        for r in splits.stratified_split(customers, exact=True).groupBy("Churn", "split").count().collect()
    }
    for label in ("Yes", "No"):
        n = sum(v for (c, _), v in counts.items() if c == label)
        assert counts[label, "test"] == int(n * 0.2 + 0.5)


def test_hash_split_is_stable_and_complete(customers):
    one = splits.stratified_split(customers).select(S.ID, "split")
    two = splits.stratified_split(customers.repartition(7)).select(S.ID, "split")
    assert one.exceptAll(two).count() == 0
    assert {r.split for r in one.distinct().select("split").distinct().collect()} == {"train", "validation", "test"}


@pytest.mark.parametrize("method", ["neighbours", "duplicate"])
def test_oversampling_balances_inside_the_minority_range(spark, method):
    rows = [(f"c{i}", int(i < 30), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "customerID string, label int, x double")
    out = splits.oversample(df, ["x"], method=method)
    counts = {(r.label, r.synthetic): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(1, False): 30, (1, True): 140, (0, False): 170}
    low, high = out.where("synthetic").agg(F.min("x"), F.max("x")).first()
    assert 0 <= low and high <= 29


def test_oversampling_crosses_window_blocks(spark):
    df = spark.range(12000).select(
        F.concat(F.lit("c"), "id").alias("customerID"), (F.col("id") < 5000).cast("int").alias("label"),
        F.col("id").cast("double").alias("x"),
    )
    out = splits.oversample(df, ["x"])
    assert out.where("synthetic").count() == 2000
