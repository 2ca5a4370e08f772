"""Customer lifetime value: per customer, percentile, tiers, portfolio."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.features import predicted_clv
from stayline.operators.prefix import join_by_value, prefix_counts
from stayline.operators.quantiles import exact_quantiles

LIFETIME_MONTHS = 24
BUDGET_RATIO = 0.15


def customer_clv(
    scored, lifetime_months=LIFETIME_MONTHS, discount_rate=0.10, budget_ratio=BUDGET_RATIO,
    monthly_growth=0.0,
):
    """Predicted value and what follows from it, a pure projection."""
    p, tenure, revenue = F.col("churn_probability"), F.col("tenure"), F.col("MonthlyCharges")
    valued = scored.withColumn(
        "predicted_clv",
        predicted_clv(revenue, tenure, p, lifetime_months, discount_rate, monthly_growth),
    )
    return valued.select(
        S.ID,
        revenue.alias("current_monthly_revenue"),
        (tenure + (1 - p) * lifetime_months).alias("predicted_tenure_months"),
        "predicted_clv",
        (F.col("predicted_clv") * (1 - p)).alias("risk_adjusted_clv"),
        (1 - p).alias("retention_probability"),
        "churn_probability",
        (F.col("predicted_clv") * budget_ratio).alias("retention_budget"),
    )


def value_prefix(clv):
    return prefix_counts(clv, "predicted_clv", {"n": F.count(F.lit(1))})


def clv_percentile(clv):
    """Add the percentage of customers with a strictly smaller value; null for a null value.

    Distinct values are ranked, then joined back by value. Many customers share the value
    0, so frequent values are spread over several tasks.
    """
    prefix = value_prefix(clv)
    # Nulls come first in the order; they have no percentile and count for none.
    unknown = F.coalesce(F.sum(F.when(F.col("predicted_clv").isNull(), F.col("n"))), F.lit(0))
    sizes = prefix.agg(F.struct(F.sum("n").alias("all"), unknown.alias("unknown"))).scalar()
    below = F.col("n_cum") - F.col("n") - sizes["unknown"]
    share = F.try_divide(below, sizes["all"] - sizes["unknown"]) * 100
    ranks = prefix.select(
        "predicted_clv", "n",
        F.when(F.col("predicted_clv").isNotNull(), share).alias("clv_percentile"),
    )
    return join_by_value(clv, ranks, "predicted_clv", key=S.ID)


def clv_tiers(clv):
    """Add high, medium or low value by the quartiles of the predicted value."""
    cuts = exact_quantiles(clv, "predicted_clv", {"p25": 0.25, "p75": 0.75}).select(
        F.struct("p25", "p75"))
    value = F.col("predicted_clv")
    return clv.withColumn("_cuts", cuts.scalar()).withColumn(
        "clv_tier",
        F.when(value >= F.col("_cuts.p75"), "high_value")
        .when(value >= F.col("_cuts.p25"), "medium_value")
        .otherwise("low_value"),
    ).drop("_cuts")


def clv_portfolio(clv):
    """Portfolio totals in one row; zeros for an empty portfolio."""
    median = exact_quantiles(clv, "predicted_clv", {"median_clv": 0.5})
    zero = F.lit(0.0)
    return clv.agg(
        F.coalesce(F.sum("predicted_clv"), zero).alias("total_clv"),
        F.coalesce(F.avg("predicted_clv"), zero).alias("avg_clv"),
        F.coalesce(F.sum("risk_adjusted_clv"), zero).alias("total_risk_adjusted_clv"),
        F.coalesce(F.sum("retention_budget"), zero).alias("total_retention_budget"),
        F.count(F.lit(1)).alias("customer_count"),
    ).withColumn("median_clv", F.coalesce(median.scalar(), zero))
