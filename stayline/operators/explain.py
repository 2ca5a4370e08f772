"""Contributions of features to a score, per row and overall."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window, functions as F

from stayline import schema as S
from stayline.operators.splits import sample_customers

TOP = 10


def linear_contributions(rows, weights, key=S.ID, scale=1.0, top=None):
    """Exact contributions w * (x - mean of x) as rows (key, feature, contribution, value).

    The means are one scalar subquery over the same rows. With `top`, only the largest per
    row are kept and numbered: they are sorted inside the row, so nothing is shuffled.
    """
    names = list(weights)
    means = rows.agg(F.struct(*[F.avg(c).alias(c) for c in names]))

    def part(c):
        return (F.col(c) - F.col(f"_mean.{c}")) * float(weights[c]) * scale

    entries = F.array(
        *[
            F.struct(
                # Rounded for order only: equal sizes then go by name.
                (-F.round(F.abs(part(c)), 12)).alias("_size"),
                F.lit(c).alias("feature"),
                part(c).alias("contribution"),
                F.col(c).cast("double").alias("value"),
            )
            for c in names
        ]
    )
    filled = rows.withColumn("_mean", means.scalar())
    if top is None:
        return filled.select(key, F.inline(entries)).drop("_size")
    kept = F.slice(F.array_sort(entries), 1, top)
    return (
        filled.select(key, F.posexplode(kept).alias("_at", "_entry"))
        .select(key, "_entry.*", (F.col("_at") + 1).alias("rank_no"))
        .drop("_size")
    )


def top_contributions(contributions, n=TOP, key=S.ID):
    """The n largest absolute contributions per key of a long table, numbered from 1."""
    # One row per feature in each window.
    order = Window.partitionBy(key).orderBy(F.desc(F.abs("contribution")), "feature")
    return contributions.withColumn("rank_no", F.row_number().over(order)).where(
        F.col("rank_no") <= n
    )


def global_importance(contributions, top=None):
    """Mean absolute and mean contribution per feature, most important first."""
    out = contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"),
        F.avg("contribution").alias("mean_contribution"),
    )
    if top is None:
        return out
    return out.orderBy(F.desc("mean_abs_contribution"), "feature").limit(top)


def sampled_contributions(
    model, rows, features, vector="features", key=S.ID, background=100, permutations=8, seed=42
):
    """Shapley values of any classifier by sampled permutations.

    Every row meets `permutations` seeded feature orders, each with one background row.
    Features switch from the background to the row one by one in that order; the change of
    the score at each switch, averaged, is the contribution.
    """
    values = vector_to_array(F.col(vector))
    base = sample_customers(rows, background, seed, key).select(
        F.col(key).alias("_bkey"), values.alias("_z")
    )
    # At most `background` rows, bounded by the limit above.
    numbered = base.withColumn(
        "_slot", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_bkey")) - 1
    ).drop("_bkey")
    size = base.agg(F.count(F.lit(1))).scalar()
    d = len(features)
    digest = F.concat_ws("|", F.col(key), F.col("_perm").cast("string"), F.lit(str(seed)))
    order = F.transform(
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.lit(d - 1)),
                lambda i: F.struct(F.md5(F.concat_ws("|", digest, i.cast("string"))), i.alias("i")),
            )
        ),
        lambda s: s["i"],
    )
    # The step at which each feature is switched: the order, inverted by a sort.
    place = F.transform(
        F.array_sort(F.transform("_order", lambda i, step: F.struct(i.alias("i"), step.alias("step")))),
        lambda s: s["step"],
    )
    planned = (
        rows.select(key, values.alias("_x"))
        .withColumn("_perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_order", order)
        .withColumn("_place", place)
        .withColumn("_slot", F.pmod(F.xxhash64(key, "_perm"), size))
        .join(F.broadcast(numbered), "_slot")
    )
    stepped = planned.select(
        key, "_order", F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(d)),
                lambda step: F.transform(
                    "_x",
                    lambda x, i: F.when(F.get("_place", i) < step, x).otherwise(F.get("_z", i)),
                ),
            )
        ).alias("_step", "_mix"),
    ).withColumn(vector, array_to_vector("_mix"))
    scored = model.transform(stepped).select(
        key, "_order", "_step", vector_to_array("probability")[1].alias("_score")
    )
    # A score adds to the feature switched just before it and takes from the one after it, so
    # the changes are sums that combine before the shuffle, without a window.
    gains = F.array(
        F.struct(F.get("_order", F.col("_step") - 1).alias("_i"), F.col("_score").alias("_gain")),
        F.struct(F.get("_order", F.col("_step")).alias("_i"), (-F.col("_score")).alias("_gain")),
    )
    names = F.array(*[F.lit(f) for f in features])
    return (
        scored.select(key, F.inline(gains)).where("_i IS NOT NULL")
        .groupBy(key, "_i").agg((F.sum("_gain") / permutations).alias("contribution"))
        .select(key, F.element_at(names, F.col("_i") + 1).alias("feature"), "contribution")
    )


def coefficient_importance(spark, model, features):
    """Coefficients of a linear model, by absolute size. One row per feature."""
    rows = [(f, float(c), abs(float(c))) for f, c in zip(features, model.coefficients.toArray())]
    return spark.createDataFrame(
        rows, "feature string, coefficient double, importance double"
    ).orderBy(F.desc("importance"), "feature")


def tree_importance(spark, model, features):
    """Importances of a tree ensemble, largest first. One row per feature."""
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def highest_score(scored, key=S.ID, score="churn_probability"):
    """The row with the highest score; ties by key."""
    return scored.orderBy(F.desc(score), key).limit(1)
