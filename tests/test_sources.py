import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.sources import customers as files
from stayline.sources import derived, snapshots


def test_clean_trims_casts_and_drops_missing_ids(spark):
    raw = spark.createDataFrame(
        [(" 1234-ABCD ", "100.5", "0"), ("5678-EFGH", " ", "1"), (None, "1", "0")],
        " customerID  string, TotalCharges string, SeniorCitizen string".replace(" customerID ", "customerID"),
    ).withColumnRenamed("customerID", " customerID ")
    rows = files.clean_customers(raw).orderBy("customerID").collect()
    assert [tuple(r) for r in rows] == [("1234-ABCD", 100.5, 0), ("5678-EFGH", None, 1)]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_customers(spark, str(tmp_path / "absent.csv"))


def test_csv_round_trip(spark, folder, tmp_path):
    path = str(tmp_path / "customers")
    rows = derived.raw_customers(spark, folder)
    rows.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    again = files.read_customers(spark, path)
    assert again.schema == S.RAW_CUSTOMERS
    assert again.exceptAll(rows).count() == 0 and again.count() == rows.count()


def test_snapshots_latest_and_pair(spark, tmp_path):
    path = str(tmp_path / "snaps")
    one = spark.createDataFrame([("a", 1)], "customerID string, tenure int")
    snapshots.write_snapshot(one, path, "20240101T000000Z")
    only, same = snapshots.snapshot_pair(spark, path)
    assert only.collect() == same.collect()
    snapshots.write_snapshot(one.withColumn("tenure", F.lit(2)), path, "20240201T000000Z")
    snapshots.write_snapshot(one.withColumn("tenure", F.lit(3)), path, "20240301T000000Z")
    reference, current = snapshots.snapshot_pair(spark, path)
    assert [reference.first().tenure, current.first().tenure] == [2, 3]
    assert snapshots.read_snapshot(spark, path).first().snapshot_ts == "20240301T000000Z"
    assert snapshots.read_snapshot(spark, path, "20240101T000000Z").first().tenure == 1


def test_snapshot_without_timestamp_gets_the_current_second(spark, tmp_path):
    path = str(tmp_path / "snaps")
    snapshots.write_snapshot(spark.range(1), path)
    (stamp,) = snapshots.list_stamps(spark, path)
    assert len(stamp) == 16 and stamp[8] == "T" and stamp.endswith("Z")


def test_no_snapshot_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, str(tmp_path / "nothing"))


def test_derived_customers_keep_the_contract(spark, folder):
    from stayline.operators import quality

    rows = derived.customers(spark, folder)
    assert rows.columns == S.CUSTOMER_COLUMNS
    assert quality.with_errors(rows).where(F.size("errors") > 0).count() == 0
