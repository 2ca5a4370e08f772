"""Return on retention spending: overall, per cohort, per scenario."""

from pyspark.sql import functions as F

COST_PER_CUSTOMER = 50.0
EFFECTIVENESS = 0.3
LIFETIME_MONTHS = 24
SCENARIO_CHURN = 0.5


def with_return(
    df, customers, revenue, churn_rate, cost=COST_PER_CUSTOMER, effectiveness=EFFECTIVENESS,
    lifetime_months=LIFETIME_MONTHS,
):
    """Add the return columns, given columns for customers, average revenue and churn rate."""
    cost = cost if not isinstance(cost, (int, float)) else F.lit(float(cost))
    if isinstance(effectiveness, (int, float)):
        effectiveness = F.lit(float(effectiveness))
    churn, prevented = F.col("churn_without_intervention"), F.col("churn_prevented")
    spent, saved, net = F.col("intervention_cost"), F.col("revenue_saved"), F.col("net_benefit")
    zero = F.lit(0.0)
    return (
        df.withColumn("churn_without_intervention", (customers * churn_rate).cast("bigint"))
        .withColumn("revenue_lost_without_intervention", churn * revenue * lifetime_months)
        .withColumn("intervention_cost", customers * cost)
        .withColumn("churn_prevented", (churn * effectiveness).cast("bigint"))
        .withColumn("revenue_saved", prevented * revenue * lifetime_months)
        .withColumn("net_benefit", saved - spent)
        .withColumn(
            "roi_percentage", F.when(spent > 0, F.try_divide(net, spent) * 100).otherwise(zero)
        )
        .withColumn(
            "payback_period_months",
            F.when(saved > 0, F.try_divide(spent, saved / 12)).otherwise(zero),
        )
        .withColumn(
            "cost_per_customer_retained",
            F.when(prevented > 0, F.try_divide(spent, prevented)).otherwise(zero),
        )
    )


def roi(scored, threshold=0.5, **options):
    """One row for all customers at or above the threshold; zeros when there are none."""
    sums = scored.where(F.col("churn_probability") >= threshold).agg(
        F.count(F.lit(1)).alias("customers_at_risk"),
        F.coalesce(F.sum("MonthlyCharges"), F.lit(0.0)).alias("monthly_revenue_at_risk"),
        F.coalesce(F.avg("churn_probability"), F.lit(0.0)).alias("_rate"),
        F.coalesce(F.avg("MonthlyCharges"), F.lit(0.0)).alias("_revenue"),
    ).withColumn("annual_revenue_at_risk", F.col("monthly_revenue_at_risk") * 12)
    return with_return(
        sums, F.col("customers_at_risk"), F.col("_revenue"), F.col("_rate"), **options
    ).drop("_rate", "_revenue")


def cohort_roi(cohorts, **options):
    """The same figures for every cohort, from the cohort averages."""
    revenue = F.col("customer_count") * F.col("avg_monthly_revenue")
    base = cohorts.select(
        "cohort_id", F.col("customer_count").alias("customers_at_risk"),
        revenue.alias("monthly_revenue_at_risk"), (revenue * 12).alias("annual_revenue_at_risk"),
        F.col("avg_churn_probability").alias("_rate"), F.col("avg_monthly_revenue").alias("_revenue"),
    )
    return with_return(
        base, F.col("customers_at_risk"), F.col("_revenue"), F.col("_rate"), **options
    ).drop("_rate", "_revenue")


def scenario_roi(cohorts, scenarios):
    """Every cohort under every scenario (name, cost per customer, effectiveness or None)."""
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario_name"),
                F.lit(float(cost)).alias("_cost"),
                F.lit(float(EFFECTIVENESS if effect is None else effect)).alias("_effect"),
            )
            for name, cost, effect in scenarios
        ]
    )
    base = cohorts.select(
        "cohort_id", F.col("customer_count").alias("customers_at_risk"),
        F.col("avg_monthly_revenue").alias("_revenue"), F.inline(listed),
    ).withColumn(
        "total_revenue_at_risk", F.col("customers_at_risk") * F.col("_revenue") * 12
    )
    return with_return(
        base, F.col("customers_at_risk"), F.col("_revenue"), F.lit(SCENARIO_CHURN),
        cost=F.col("_cost"), effectiveness=F.col("_effect"),
    ).select(
        "scenario_name", "cohort_id", "customers_at_risk", "total_revenue_at_risk",
        F.col("churn_without_intervention").alias("estimated_churn"),
        F.col("churn_prevented").alias("estimated_churn_prevented"),
        "revenue_saved", "intervention_cost", "net_benefit", "roi_percentage",
    )
