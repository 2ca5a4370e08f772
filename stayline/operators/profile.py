"""Profiling: distributions, missing values, summaries, rates, outliers, correlations."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions import features as X
from stayline.operators.prefix import join_null_safe
from stayline.operators.quantiles import bin_counts, exact_quantiles, moments, quantiles_from_bins
from stayline.session import checkpointed


def numeric_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def unpivot_numeric(df, columns, keep=()):
    """Rows (keep..., feature, value) with the value as double."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), columns, "feature", "value")


def unpivot_text(df, columns, keep=()):
    wide = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot(list(keep), columns, "feature", "value")


def label_distribution(df, label=S.TARGET):
    """Rows per label and its share of all rows. The counts are summed, not the rows again."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.where(F.col("label").isNotNull())
        .select("label", "n", F.bround(F.col("n") / total, 3).alias("share"))
        .orderBy(F.desc("n"), "label")
    )


def missingness(df):
    """Null share per column, columns without nulls left out."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    return (
        wide.unpivot([], df.columns, "column_name", "share")
        .where("share > 0")
        .orderBy(F.desc("share"), "column_name")
    )


def describe(df, columns=None, by=(), probs=None):
    """Count, mean, sample deviation, extremes and quantiles per (by, feature).

    The first read counts bins and takes all moments; each further one divides the bins that
    hold a quantile. Only bin counts are shuffled. Null groups are kept.
    """
    by = list(by)
    columns = columns or numeric_columns(df)
    probs = probs or {"p25": 0.25, "median": 0.5, "p75": 0.75}
    long = unpivot_numeric(df, columns, by).where("value IS NOT NULL")
    keys = [*by, "feature"]
    bins = checkpointed(bin_counts(long, "value", keys))
    quantiles = quantiles_from_bins(long, bins, "value", probs, keys)
    return join_null_safe(moments(bins, keys), quantiles, keys)


def numeric_summary(df, columns=None):
    summary = describe(df, columns, probs={"median": 0.5})
    return summary.select(
        "feature", *[F.bround(c, 3).alias(c) for c in ["mean", "std", "min", "median", "max"]]
    ).orderBy("feature")


def cardinality(df, columns=None, limit=50):
    """Distinct non-null values of the text columns that have at most `limit`.

    All columns are counted exactly; repeated values are dropped before the shuffle.
    """
    columns = columns or text_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, n_unique bigint")
    long = unpivot_text(df, columns).where("value IS NOT NULL").distinct()
    return (
        long.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_unique"))
        .where(F.col("n_unique") <= limit)
        .orderBy("feature")
    )


def duplicates(df, key=S.ID):
    """Rows and keys beyond the first of their kind."""
    whole = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    rows = whole.agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))
    keys = whole.groupBy(key).agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") - 1))
    return rows.select(
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
        F.coalesce(keys.scalar(), F.lit(0)).alias("duplicate_keys"),
    )


def rate_by_category(df, columns, label=S.TARGET, positive="Yes"):
    """Rows and positive rate (percent) per (feature, value), all features in one job."""
    wide = df.withColumns(
        {"SeniorCitizen": F.when(F.col("SeniorCitizen") == 1, "Yes").otherwise("No")}
        if "SeniorCitizen" in columns
        else {}
    )
    is_positive = (F.col(label) == positive).cast("int").alias("_positive")
    labelled = wide.where(F.col(label).isNotNull()).select(*columns, is_positive)
    long = unpivot_text(labelled, columns, ["_positive"]).where("value IS NOT NULL")
    return (
        long.groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_positive").alias("positives"))
        .withColumn("rate_pct", F.col("positives") / F.col("n") * 100)
    )


def mean_rate(rates):
    """Mean of the category rates per feature, each category counting the same."""
    return rates.groupBy("feature").agg(F.avg("rate_pct").alias("mean_rate_pct"))


def with_eda_buckets(df):
    """Right-closed cut columns; unlike the feature bucket, the lowest edge is outside."""
    return df.select(
        "*",
        X.bucket(F.col("tenure"), X.TENURE_EDGES, X.TENURE_LABELS).alias("tenure_cut"),
        X.bucket(F.col("MonthlyCharges"), X.MONTHLY_EDGES, X.MONTHLY_LABELS).alias("monthly_cut"),
        X.bucket(F.col("TotalCharges"), X.TOTAL_EDGES, X.TOTAL_LABELS).alias("total_cut"),
    )


def iqr_outliers(df, columns, whisker=1.5):
    """Rows outside the quartile fences per column; the share is of all rows, nulls included."""
    long = unpivot_numeric(df, columns)
    quartiles = exact_quantiles(long, "value", {"q1": 0.25, "q3": 0.75}, ["feature"])
    fences = quartiles.select(
        "feature",
        (F.col("q1") - whisker * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
        (F.col("q3") + whisker * (F.col("q3") - F.col("q1"))).alias("upper_bound"),
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    number = F.sum(F.when(outside, 1).otherwise(0))
    # One row per column.
    return (
        long.join(F.broadcast(fences), "feature")
        .groupBy("feature", "lower_bound", "upper_bound")
        .agg(number.alias("outliers"), (number / F.count(F.lit(1)) * 100).alias("outlier_pct"))
    )


def correlations(df, columns):
    """Pearson correlation of every column pair (pairwise complete), both directions."""
    pairs = [(a, b) for a in columns for b in columns]
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in upper]
    )
    entries = [
        F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.col(f"`{a}|{b}`" if (a, b) in upper else f"`{b}|{a}`").alias("r"),
        )
        for a, b in pairs
    ]
    return wide.select(F.inline(F.array(*entries)))


def histogram(df, columns, bins=50, by=(), density=False):
    """Equal-width bin counts between each column's extremes; the last bin is closed.

    The extremes come from a first read, so that the second one can count bins before it
    shuffles: distinct values never leave their task.
    """
    by = list(by)
    long = unpivot_numeric(df, columns, by).where("value IS NOT NULL")
    span = long.groupBy("feature").agg(
        F.min("value").alias("_low"), ((F.max("value") - F.min("value")) / bins).alias("_width")
    )
    # One row per column.
    placed = long.join(F.broadcast(span), "feature").withColumn(
        "bin",
        F.when(F.col("_width") == 0, 0)
        .otherwise(
            F.least(
                F.lit(bins - 1),
                F.floor(F.try_divide(F.col("value") - F.col("_low"), F.col("_width"))),
            )
        )
        .cast("int"),
    )
    binned = placed.groupBy(*by, "feature", "bin", "_low", "_width").agg(
        F.count(F.lit(1)).alias("n")
    )
    out = binned.select(
        *by, "feature", "bin", (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
        "n", "_width",
    )
    if density:
        size = binned.groupBy(*by, "feature").agg(F.sum("n").alias("_size"))
        out = join_null_safe(out, size, [*by, "feature"]).withColumn(
            "density", F.try_divide(F.col("n"), F.col("_size") * F.col("_width"))
        ).drop("_size")
    return out.drop("_width")


def profile(df, label=S.TARGET):
    """Overview in long form: section, item, measure, value."""

    def part(frame, section, item, measures):
        rows = F.array(
            *[
                F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
                for m in measures
            ]
        )
        return frame.select(
            F.lit(section).alias("section"), F.col(item).alias("item"), F.inline(rows)
        )

    size = df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("table").alias("item"), "rows", F.lit(len(df.columns)).alias("columns")
    )
    return (
        part(size, "overview", "item", ["rows", "columns"])
        .unionByName(part(label_distribution(df, label), "label", "label", ["n", "share"]))
        .unionByName(part(missingness(df), "missing", "column_name", ["share"]))
        .unionByName(
            part(numeric_summary(df), "numeric", "feature", ["mean", "std", "min", "median", "max"])
        )
        .unionByName(part(cardinality(df), "cardinality", "feature", ["n_unique"]))
    )
