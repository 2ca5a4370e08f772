"""Timestamped parquet snapshots, one partition folder per timestamp."""

from pyspark.sql import functions as F

from stayline import schema as S

STAMP = "snapshot_ts"


def write_snapshot(df, folder, ts=None):
    """Append `df` under its timestamp; without `ts`, the current UTC second."""
    stamp = F.lit(ts) if ts else F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), S.TIMESTAMP_PATTERN
    )
    if STAMP not in df.columns:
        df = df.withColumn(STAMP, stamp)
    df.write.mode("append").partitionBy(STAMP).parquet(folder)
    return folder


def list_stamps(spark, folder):
    """Timestamps present, oldest first. Folder names only; no data file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise FileNotFoundError(f"no snapshots in {folder}")
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{STAMP}="))


def read_snapshot(spark, folder, ts=None):
    """One snapshot, the newest by default. Only its own folder is listed and read."""
    if ts is None:
        found = list_stamps(spark, folder)
        if not found:
            raise FileNotFoundError(f"no snapshots in {folder}")
        ts = found[-1]
    frame = spark.read.parquet(f"{folder}/{STAMP}={ts}")
    return frame.withColumn(STAMP, F.lit(ts))


def snapshot_pair(spark, folder):
    """(reference, current): second newest and newest; one alone serves as both."""
    newest = list_stamps(spark, folder)[-2:]
    if not newest:
        raise FileNotFoundError(f"no snapshots in {folder}")
    return read_snapshot(spark, folder, newest[0]), read_snapshot(spark, folder, newest[-1])
