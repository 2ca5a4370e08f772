import pytest
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import profile, quality
from tests.helpers import plan_text


def test_label_distribution(spark):
    df = spark.createDataFrame([(x,) for x in ["Yes", "No", "No", "Yes", "No"]], "Churn string")
    assert [tuple(r) for r in profile.label_distribution(df).collect()] == [("No", 3, 0.6), ("Yes", 2, 0.4)]


def test_missingness_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "a int, b int")
    (row,) = profile.missingness(df).collect()
    assert row.column_name == "a" and round(row.share, 3) == 0.333


def test_numeric_summary_of_one_to_five(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double")
    (row,) = profile.numeric_summary(df).collect()
    assert tuple(row) == ("x", 3.0, 1.581, 1.0, 3.0, 5.0)


def test_describe_skips_nulls_and_interpolates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 10.0)], "g string, x double")
    rows = {r.g: r for r in profile.describe(df, ["x"], ["g"]).collect()}
    assert rows["a"].rows == 2 and rows["a"].median == 1.5 and rows["a"].p25 == 1.25
    assert rows["b"].std is None


def test_cardinality_leaves_out_wide_columns(spark):
    df = spark.range(300).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("string").alias("c")
    )
    assert [tuple(r) for r in profile.cardinality(df).collect()] == [("c", 3)]


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "customerID string, x int")
    assert tuple(profile.duplicates(df).first()) == (1, 2)


def test_histogram_closes_the_last_bin_and_takes_constants(spark):
    df = spark.createDataFrame([(0.0, 5.0), (5.0, 5.0), (10.0, 5.0)], "x double, c double")
    rows = {(r.feature, r.bin): r.n for r in profile.histogram(df, ["x", "c"], 2).collect()}
    assert rows == {("x", 0): 1, ("x", 1): 2, ("c", 0): 3}


def test_category_rates_need_one_scan(spark, folder):
    from stayline.sources import derived

    rates = profile.rate_by_category(derived.dirty_customers(spark, folder), ["gender", "Contract"])
    scans = [line for line in plan_text(rates).splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2


def test_iqr_on_known_values(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    row = profile.iqr_outliers(df, ["x"]).first()
    assert (row.lower_bound, row.upper_bound, row.outliers) == (-1.0, 7.0, 1)
    assert row.outlier_pct == pytest.approx(100 / 6)


def _valid(**changes):
    row = dict.fromkeys(S.SERVICES, "No")
    row.update(
        customerID="1234-ABCD", gender="Male", SeniorCitizen=0, Partner="Yes", Dependents="No",
        tenure=12, PhoneService="Yes", MultipleLines="No", InternetService="DSL",
        Contract="One year", PaperlessBilling="Yes", PaymentMethod="Mailed check",
        MonthlyCharges=70.5, TotalCharges=845.0, Churn="No",
    )
    row.update(changes)
    return tuple(row[c] for c in S.CUSTOMER_COLUMNS)


def test_expectations_find_each_damage(spark):
    rows = [
        _valid(), _valid(customerID=None), _valid(customerID="dup"), _valid(customerID="dup"),
        _valid(customerID="x1", Churn="Maybe"), _valid(customerID="x2", MonthlyCharges=250.0),
        _valid(customerID="x3", tenure=101), _valid(customerID="bad id!"),
        _valid(customerID="x4", TotalCharges=None),
    ]
    df = spark.createDataFrame(rows, S.CUSTOMERS)
    found = {r.expectation: r for r in quality.expectations(df).collect()}
    assert found["not_null:customerID"].unexpected_count == 1
    assert found["unique:customerID"].unexpected_count == 2
    assert found["in_set:Churn"].unexpected_count == 1
    assert found["regex:customerID"].unexpected_count == 1
    assert found["between:MonthlyCharges"].unexpected_count == 1
    assert found["between:tenure"].unexpected_count == 1
    assert not found["not_null:TotalCharges"].success
    assert found["column_count"].success
    with pytest.raises(ValueError, match="unique:customerID"):
        quality.require_quality(quality.expectations(df))


def test_few_missing_charges_pass(spark):
    rows = [_valid(customerID=f"c{i}", TotalCharges=None if i < 2 else 1.0) for i in range(1000)]
    summary = quality.suite_summary(quality.expectations(spark.createDataFrame(rows, S.CUSTOMERS)))
    assert tuple(summary.first()) == (True, 8, 8, 0, 100.0)


def test_expectations_on_an_empty_table(spark):
    summary = quality.suite_summary(quality.expectations(spark.createDataFrame([], S.CUSTOMERS)))
    assert summary.first().success


def test_contract_names_every_broken_rule(spark):
    rows = [_valid(), _valid(gender="X", tenure=-1, SeniorCitizen=2), _valid(Contract=None, TotalCharges=-1.0)]
    valid, rejected = quality.split_valid(spark.createDataFrame(rows, S.CUSTOMERS))
    assert valid.count() == 1
    errors = sorted(r.errors for r in rejected.collect())
    assert errors == [
        ["Contract: not an allowed value", "TotalCharges: negative"],
        ["gender: not an allowed value", "SeniorCitizen: outside 0..1", "tenure: missing or negative"],
    ]
