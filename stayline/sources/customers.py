"""Customer files: read, clean, write."""

from pyspark.sql import functions as F

from stayline import schema as S


def read_customers(spark, path, schema=S.RAW_CUSTOMERS):
    """Customer CSV with a header. The schema is declared, so nothing is scanned to infer it."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=True)


def clean_customers(df):
    """Trim names and ids, turn charges into numbers, drop rows without an id."""
    df = df.toDF(*[c.strip() for c in df.columns])
    fixes = {S.ID: F.trim(F.col(S.ID).cast("string"))}
    if "TotalCharges" in df.columns:
        fixes["TotalCharges"] = F.trim(F.col("TotalCharges").cast("string")).try_cast("double")
    if "SeniorCitizen" in df.columns:
        fixes["SeniorCitizen"] = F.col("SeniorCitizen").cast("int")
    return df.where(F.col(S.ID).isNotNull()).withColumns(fixes)


def read_scores(spark, path):
    """CSV of `customerID, churn_probability`; the key makes alignment explicit."""
    return spark.read.schema(S.PREDICTIONS).csv(path, header=True)


def read_labels(spark, path):
    """CSV of `customerID, label`."""
    return spark.read.schema("customerID STRING, label INT").csv(path, header=True)


def write_json(df, path, mode="overwrite"):
    """Report rows as JSON lines."""
    df.write.mode(mode).json(path)
    return path
