"""Key figures and their trend."""

from pyspark.sql import Window, functions as F

from stayline.functions import rules as R
from stayline.operators.prefix import join_null_safe
from stayline.operators.quantiles import exact_quantiles

CHURN_FACTOR = 0.8
LIFETIME_MONTHS = 24


def kpi_table(
    scored, by=(), critical=R.CRITICAL, high=R.HIGH, medium=R.MEDIUM,
    churn_factor=CHURN_FACTOR, lifetime_months=LIFETIME_MONTHS, model_metrics=None,
):
    """One row of key figures per group (one row in all without groups)."""
    by = list(by)
    p, revenue = F.col("churn_probability"), F.col("MonthlyCharges")
    top_quarter = exact_quantiles(scored, "MonthlyCharges", {"_p75": 0.75}, by)
    if by:
        rows = join_null_safe(scored, top_quarter, by, "left")
    else:
        rows = scored.withColumn("_p75", top_quarter.scalar())

    def number(condition):
        return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))

    at_risk = p >= medium
    sums = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_customers"),
        number(at_risk).alias("customers_at_risk"),
        F.coalesce(F.sum(revenue), F.lit(0.0)).alias("total_monthly_revenue"),
        F.coalesce(F.sum(F.when(at_risk, revenue)), F.lit(0.0)).alias("revenue_at_risk"),
        F.avg(p).alias("avg_churn_probability"),
        F.avg(revenue).alias("_avg_revenue"),
        number(p >= critical).alias("critical_risk_customers"),
        number((p >= high) & (p < critical)).alias("high_risk_customers"),
        number((p >= medium) & (p < high)).alias("medium_risk_customers"),
        number(p < medium).alias("low_risk_customers"),
        number(at_risk & (revenue >= F.col("_p75"))).alias("_valuable"),
    )
    n, risky = F.col("total_customers"), F.col("customers_at_risk")
    churn = F.coalesce((n * F.col("avg_churn_probability") * churn_factor).cast("bigint"), F.lit(0))
    percent = lambda a, b: F.coalesce(F.try_divide(a, b) * 100, F.lit(0.0))
    model_metrics = model_metrics or {}
    return sums.withColumn("estimated_monthly_churn", churn).select(
        *by, "total_customers", "customers_at_risk",
        percent(risky, n).alias("at_risk_percentage"),
        "total_monthly_revenue", "revenue_at_risk",
        percent(F.col("revenue_at_risk"), F.col("total_monthly_revenue")).alias(
            "revenue_at_risk_percentage"
        ),
        "avg_churn_probability", "critical_risk_customers", "high_risk_customers",
        "medium_risk_customers", "low_risk_customers", "estimated_monthly_churn",
        (F.col("estimated_monthly_churn") * 12).alias("estimated_annual_churn"),
        (F.col("estimated_monthly_churn") * F.col("_avg_revenue") * lifetime_months).alias(
            "estimated_revenue_loss"
        ),
        F.lit(model_metrics.get("roc_auc")).cast("double").alias("model_roc_auc"),
        F.lit(model_metrics.get("f1")).cast("double").alias("model_f1"),
        percent(F.col("_valuable"), risky).alias("intervention_readiness_score"),
    )


def kpi_trend(history, order):
    """Latest key figures against the previous ones, in one row.

    `history` has one row per point in time. Fewer than two points give the status
    `insufficient_data` and null changes.
    """
    last_two = history.orderBy(F.desc(order)).limit(2)
    window = Window.partitionBy(F.lit(0)).orderBy(order)

    def before(c):
        return F.lag(c).over(window)

    def change(c):
        return F.col(c) - before(c)

    def change_pct(c):
        return F.when(before(c) > 0, change(c) / before(c) * 100).when(
            before(c).isNotNull(), 0.0
        )

    p = F.col("avg_churn_probability")
    return (
        last_two.select(
            F.col(order).alias("latest"),
            F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))).alias("_n"),
            change("customers_at_risk").alias("customers_at_risk_change"),
            change_pct("customers_at_risk").alias("customers_at_risk_change_pct"),
            change("revenue_at_risk").alias("revenue_at_risk_change"),
            change_pct("revenue_at_risk").alias("revenue_at_risk_change_pct"),
            change("avg_churn_probability").alias("avg_churn_probability_change"),
            F.when(p < before("avg_churn_probability"), "improving")
            .when(before("avg_churn_probability").isNotNull(), "worsening")
            .alias("trend_direction"),
        )
        .orderBy(F.desc("latest"))
        .limit(1)
        .select(
            "*", F.when(F.col("_n") < 2, "insufficient_data").otherwise("success").alias("status")
        )
        .drop("_n")
    )
