"""Session settings and the shared scratch folder."""

import tempfile

from pyspark.sql import SparkSession


def build_session(app="stayline", master=None, conf=None):
    """Session with adaptive execution; `conf` overrides any setting."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """Folder every executor reaches, as `spark.checkpoint.dir` names it.

    Only a local-mode session without that setting gets a temporary folder:
    on a cluster a machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="stayline-")


def checkpointed(df):
    """Write `df` to the shared folder and continue from the written copy."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def scratch_path(spark, name):
    """New path for one written table below the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    import uuid

    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
