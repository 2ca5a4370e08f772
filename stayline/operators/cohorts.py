"""Scored customers and risk-by-segment cohorts."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import rules as R
from stayline.functions.features import service_count

# Fixed texts.
RISK_TEXT = {
    "critical": "Immediate intervention required",
    "high": "High priority retention efforts needed",
    "medium": "Proactive engagement recommended",
    "low": "Maintain current service levels",
}
SEGMENT_TEXT = {
    "vip": "High-value, long-term customers",
    "loyal": "Established, reliable customers",
    "growing": "New customers with high potential",
    "at_risk": "Customers showing churn signals",
    "new": "Recently acquired customers",
    "disengaged": "Low-engagement customers",
}
RISK_ACTIONS = {
    "critical": [
        "Immediate retention call from retention specialist",
        "Offer personalized discount (15-25% off for 6 months)",
        "Contract upgrade incentive (month-to-month → annual)",
        "Priority customer service support",
    ],
    "high": [
        "Proactive outreach from account manager",
        "Targeted retention offer (10-15% discount)",
        "Service enhancement recommendations",
        "Payment method optimization (switch to auto-pay)",
    ],
    "medium": [
        "Engagement campaign via email/SMS",
        "Loyalty program enrollment",
        "Service usage optimization tips",
    ],
}
SEGMENT_ACTIONS = {
    "vip": [
        "Dedicated account manager assignment",
        "VIP customer appreciation program",
        "Early access to new services",
    ],
    "growing": [
        "Onboarding completion program",
        "Service bundle recommendations",
        "Referral program invitation",
    ],
    "new": [
        "Welcome series completion",
        "First-month satisfaction check",
        "Service setup assistance",
    ],
    "disengaged": [
        "Re-engagement campaign",
        "Service discovery recommendations",
        "Usage analytics and tips",
    ],
}
CONTRACT_ACTION = "Contract upgrade incentive (stability discount)"
PAYMENT_ACTION = "Auto-pay enrollment incentive ($5/month discount)"

COHORT = ["risk_level", "segment"]
COHORT_ATTRIBUTES = ["Contract", "PaymentMethod", "InternetService"]


def scored_customers(customers, predictions, **thresholds):
    """Customers with a prediction, and every rule column the business views share."""
    joined = customers.join(predictions, S.ID)
    p, tenure, revenue = F.col("churn_probability"), F.col("tenure"), F.col("MonthlyCharges")
    counted = joined.withColumn(
        "service_count",
        service_count() if set(S.SERVICES) <= set(joined.columns) else F.lit(0),
    )
    return counted.select(
        "*",
        R.risk_level(p, **thresholds).alias("risk_level"),
        R.segment(revenue, tenure, p, F.col("service_count")).alias("segment"),
        R.journey_stage(tenure, p).alias("journey_stage"),
    )


def cohort_id():
    return F.concat_ws("_", *COHORT)


def cohort_table(scored):
    """One row per occurring (risk level, segment), riskiest first."""
    measured = scored.groupBy(*COHORT).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg("churn_probability").alias("avg_churn_probability"),
        F.avg("MonthlyCharges").alias("avg_monthly_revenue"),
        (F.sum("MonthlyCharges") * 12).alias("total_annual_revenue"),
        F.avg("tenure").alias("avg_tenure"),
    )
    return measured.select(
        cohort_id().alias("cohort_id"),
        F.concat(R.title_case(F.col("risk_level")), F.lit(" Risk - "), R.title_case(F.col("segment"))).alias("name"),
        F.concat(
            R.text_table(RISK_TEXT)[F.col("risk_level")], F.lit(". "),
            R.text_table(SEGMENT_TEXT)[F.col("segment")], F.lit("."),
        ).alias("description"),
        *measured.columns,
    ).orderBy(F.desc("avg_churn_probability"), "total_annual_revenue")


def distribution(scored, keys, attributes):
    """Counts of each attribute value per group."""
    wide = scored.select(*keys, *attributes)
    long = wide.unpivot(list(keys), list(attributes), "attribute", "value")
    return (
        long.where("value IS NOT NULL")
        .groupBy(*keys, "attribute", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cohort_distributions(scored):
    return distribution(scored, COHORT, COHORT_ATTRIBUTES).select(
        cohort_id().alias("cohort_id"), "attribute", "value", "n"
    )


def cohort_characteristics(scored):
    """The distributions as one map per cohort and attribute."""
    return cohort_distributions(scored).groupBy("cohort_id", "attribute").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias("counts")
    )


def _texts(level, table):
    options = F.create_map(
        *[x for k, v in table.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))]
    )
    return F.coalesce(options[level], F.array().cast("array<string>"))


def cohort_actions(scored, share_based=False):
    """Recommended actions per cohort as an array in rule order.

    The contract and payment rules compare plain counts with 0.5 and 0.3, so one customer
    is enough; `share_based` compares shares instead.
    """
    per = scored.groupBy(*COHORT).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum((F.col("Contract") == "Month-to-month").cast("int")).alias("_monthly"),
        F.sum((F.col("PaymentMethod") == "Electronic check").cast("int")).alias("_check"),
    )
    base = F.col("_n") if share_based else F.lit(1)
    by_contract = F.coalesce(F.col("_monthly") / base > 0.5, F.lit(False))
    by_payment = F.coalesce(F.col("_check") / base > 0.3, F.lit(False))
    empty = F.array().cast("array<string>")
    actions = F.array_distinct(
        F.concat(
            _texts(F.col("risk_level"), RISK_ACTIONS),
            _texts(F.col("segment"), SEGMENT_ACTIONS),
            F.when(by_contract, F.array(F.lit(CONTRACT_ACTION))).otherwise(empty),
            F.when(by_payment, F.array(F.lit(PAYMENT_ACTION))).otherwise(empty),
        )
    )
    return per.select(cohort_id().alias("cohort_id"), *COHORT, actions.alias("actions"))


def cohort_action_rows(actions):
    """One row per action with its 1-based position."""
    return actions.select(
        "cohort_id", F.posexplode("actions").alias("_at", "action")
    ).select("cohort_id", (F.col("_at") + 1).alias("rule_no"), "action")
