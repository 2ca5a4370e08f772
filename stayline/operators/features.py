"""Feature engineering: derived columns, imputation, scaling, one-hot, catalogue."""

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import features as X
from stayline.operators.quantiles import exact_quantiles
from stayline.operators.profile import unpivot_numeric, unpivot_text

ENGINEERED_NUMERIC = [
    "service_count", "charges_ratio", "avg_monthly_charge",
    "charge_increase_flag", "clv_approximation",
]
NUMERIC_FEATURES = S.NUMERIC + ENGINEERED_NUMERIC
CATEGORICAL_FEATURES = S.CATEGORICAL + ["tenure_bucket"]
REQUIRED = ["tenure", "MonthlyCharges", "TotalCharges"]


def engineer(df, default_months=12):
    """Add the derived columns in one projection step each way they depend on each other."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}; available: {df.columns}")
    monthly, total, tenure = F.col("MonthlyCharges"), F.col("TotalCharges"), F.col("tenure")
    average = X.avg_monthly_charge(total, tenure)
    return df.select(
        "*",
        X.tenure_bucket(tenure).alias("tenure_bucket"),
        X.service_count().alias("service_count"),
        X.charges_ratio(monthly, total).alias("charges_ratio"),
        average.alias("avg_monthly_charge"),
        X.charge_increase_flag(monthly, average).alias("charge_increase_flag"),
        X.clv_proxy(total, monthly, F.col("Contract"), default_months).alias("clv_approximation"),
    )


@dataclass(frozen=True)
class FeatureModel:
    """Fitted statistics; `transform` is a pure projection.

    `fills`, `means` and `deviations` hold one number per numeric column, `categories`
    the sorted values per categorical column (None stands for a missing value).
    """

    fills: dict
    means: dict
    deviations: dict
    categories: dict
    handle_unknown: str = "error"
    column_names: list = field(default_factory=list)

    def numeric(self, name):
        filled = F.coalesce(F.col(name).cast("double"), F.lit(self.fills[name]))
        return (filled - self.means[name]) / (self.deviations[name] or 1.0)

    def indicator(self, name, category):
        return F.col(name).eqNullSafe(F.lit(category)).cast("double")

    def checked(self, name):
        """The column itself, raising on a value that fitting never saw."""
        known = [c for c in self.categories[name] if c is not None]
        seen = F.col(name).isin(known)
        if None in self.categories[name]:
            seen = seen | F.col(name).isNull()
        return F.when(F.coalesce(seen, F.lit(False)), F.col(name)).otherwise(
            F.raise_error(
                F.concat(F.lit(f"unknown category in {name}: "), F.coalesce(name, F.lit("null")))
            )
        )

    def transform(self, df, keep=(S.ID, S.TARGET)):
        """(keep..., num__*, cat__*_*) with the target as 1/0 `label`."""
        kept = [c for c in keep if c in df.columns and c != S.TARGET]
        label = []
        if S.TARGET in keep and S.TARGET in df.columns:
            label = [
                F.when(F.col(S.TARGET) == "Yes", 1).when(F.col(S.TARGET) == "No", 0).alias("label")
            ]
        rows = engineer(df)
        if self.handle_unknown == "error":
            rows = rows.withColumns({c: self.checked(c) for c in self.categories})
        numeric = [self.numeric(c).alias(f"num__{c}") for c in self.means]
        dummies = [
            self.indicator(c, value).alias(f"cat__{c}_{value}")
            for c, values in self.categories.items()
            for value in values[1:]
        ]
        return rows.select(*kept, *label, *numeric, *dummies)

    @property
    def features(self):
        numeric = [f"num__{c}" for c in self.means]
        return numeric + [f"cat__{c}_{v}" for c, vs in self.categories.items() for v in vs[1:]]


def numeric_statistics(engineered, columns=NUMERIC_FEATURES, strategy="mean"):
    """Fill value, mean and population deviation after filling, one row per column.

    Filling with the mean keeps the mean and shrinks the deviation by the known share,
    so one pass is enough: no second scan over filled rows.
    """
    long = unpivot_numeric(engineered, columns)
    stats = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("value").alias("_known"),
        F.avg("value").alias("_mean"),
        F.var_pop("value").alias("_var"),
    )
    if strategy == "median":
        medians = exact_quantiles(long, "value", {"_fill": 0.5}, ["feature"])
        stats = stats.join(medians, "feature", "left")
    else:
        stats = stats.withColumn("_fill", F.col("_mean"))
    share = F.col("_known") / F.col("_n")
    fill = F.coalesce("_fill", F.lit(0.0))
    known_mean = F.coalesce("_mean", F.lit(0.0))
    mean = share * known_mean + (1 - share) * fill
    second = share * (F.coalesce("_var", F.lit(0.0)) + F.pow(known_mean - mean, 2)) + (
        1 - share
    ) * F.pow(fill - mean, 2)
    return stats.select(
        "feature", fill.alias("fill"), mean.alias("mean"), F.sqrt(second).alias("deviation")
    )


def category_values(engineered, columns=CATEGORICAL_FEATURES):
    """Distinct (feature, value) of the categorical columns, a missing value included."""
    return unpivot_text(engineered, columns).distinct()


def fit_features(
    df,
    numeric=NUMERIC_FEATURES,
    categorical=CATEGORICAL_FEATURES,
    strategy="mean",
    handle_unknown="error",
    max_categories=1000,
):
    """Fit on customers. Only one row per column and per category reaches the driver."""
    if handle_unknown not in ("error", "ignore"):
        raise ValueError("handle_unknown is 'error' or 'ignore'")
    engineered = engineer(df)
    stats, found = {}, []
    if numeric:
        rows = numeric_statistics(engineered, list(numeric), strategy).collect()
        stats = {r.feature: r for r in rows}
    if categorical:
        bound = max_categories * len(categorical)
        found = category_values(engineered, list(categorical)).limit(bound + 1).collect()
        if len(found) > bound:
            raise ValueError(f"more than {max_categories} categories per column: not one-hot data")
    # Known values in ascending order, a missing value last.
    categories = {
        c: sorted((r.value for r in found if r.feature == c), key=lambda v: (v is None, v or ""))
        for c in categorical
    }
    return FeatureModel(
        fills={c: stats[c].fill for c in numeric},
        means={c: stats[c].mean for c in numeric},
        deviations={c: stats[c].deviation for c in numeric},
        categories=categories,
        handle_unknown=handle_unknown,
    )


def fill_missing(df, columns):
    """Replace remaining nulls: the median for number columns, 0 where a column is all null."""
    medians = {
        r.feature: r.fill
        for r in exact_quantiles(
            unpivot_numeric(df, columns), "value", {"fill": 0.5}, ["feature"]
        ).collect()
    }
    return df.fillna({c: medians.get(c, 0.0) for c in columns})


def feature_catalogue(
    snapshots, numeric, categorical, metadata=None, version="snapshot_ts", transformer_config=None
):
    """Per (version, feature): type, null share, mean, extremes, distinct values, metadata."""
    types = dict(snapshots.dtypes)
    numbers = (
        unpivot_numeric(snapshots, numeric, [version])
        .groupBy(version, "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(version, "feature")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            (
                F.sum(F.col("value") * F.col("n"))
                / F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
            ).alias("mean"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count("value").alias("n_distinct"),
        )
    )
    texts = (
        unpivot_text(snapshots, categorical, [version])
        .groupBy(version, "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(version, "feature")
        .agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
            F.lit(None).cast("double").alias("mean"),
            F.lit(None).cast("double").alias("min"),
            F.lit(None).cast("double").alias("max"),
            F.count("value").alias("n_distinct"),
        )
    )
    dtype = F.create_map(
        *[F.lit(x) for c in [*numeric, *categorical] for x in (c, types[c])]
    )[F.col("feature")]
    order = F.array(*[F.lit(c) for c in [*numeric, *categorical]])
    config = F.create_map(
        *[F.lit(str(x)) for kv in (transformer_config or {}).items() for x in kv]
    ).cast("map<string,string>")
    catalogue = numbers.unionByName(texts).select(
        F.col(version).alias("version"),
        "feature",
        dtype.alias("dtype"),
        (F.col("nulls") / F.col("rows")).alias("null_share"),
        "mean", "min", "max", "n_distinct",
        order.alias("column_order"),
        config.alias("transformer_config"),
    )
    if metadata is not None:
        # At most one row per feature; left join keeps undescribed features.
        return catalogue.join(metadata, "feature", "left")
    return catalogue.select(
        "*",
        F.concat(F.lit("Feature: "), "feature").alias("description"),
        F.lit(None).cast("string").alias("owner"),
        F.array().cast("array<string>").alias("tags"),
    )


def latest_version(catalogue):
    newest = catalogue.agg(F.max("version")).scalar()
    return catalogue.where(F.col("version") == newest)


def list_features(catalogue):
    return catalogue.select("feature").distinct().orderBy("feature")
