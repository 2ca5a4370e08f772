"""Journey stages: metrics, distributions, transitions, insights."""

from pyspark.sql import functions as F

from stayline.functions import rules as R
from stayline.operators.cohorts import distribution

# Fixed texts.
STAGE_ACTIONS = {
    "acquisition": [
        "Welcome series completion",
        "First-month satisfaction check",
        "Service setup assistance",
        "Onboarding completion program",
    ],
    "onboarding": [
        "Feature discovery campaigns",
        "Usage optimization tips",
        "Service bundle recommendations",
        "Referral program invitation",
    ],
    "growth": [
        "Upsell opportunities",
        "Service enhancement recommendations",
        "Loyalty program enrollment",
        "Contract upgrade incentives",
    ],
    "maturity": [
        "VIP program enrollment",
        "Account manager assignment",
        "Early access to new services",
        "Customer appreciation programs",
    ],
    "retention": [
        "Dedicated account manager",
        "VIP customer benefits",
        "Long-term contract incentives",
        "Exclusive offers",
    ],
    "at_risk": [
        "Immediate retention call",
        "Personalized discount offers",
        "Contract upgrade incentives",
        "Priority customer service",
    ],
}
URGENT_TEXT = "URGENT: Deploy immediate retention interventions for at-risk customers"
ONBOARDING_TEXT = (
    "Improve onboarding process: High churn in acquisition stage indicates onboarding issues"
)


def stage_actions(stage):
    return F.create_map(
        *[x for k, v in STAGE_ACTIONS.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v]))]
    )[stage]


def stage_metrics(scored):
    """One row per occurring stage, largest first, with its list of actions."""
    return (
        scored.groupBy("journey_stage")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.avg("churn_probability").alias("avg_churn_probability"),
            F.avg("MonthlyCharges").alias("avg_monthly_revenue"),
            F.avg("tenure").alias("avg_tenure"),
            (F.sum("MonthlyCharges") * 12).alias("total_annual_revenue"),
            F.avg("service_count").alias("avg_service_count"),
        )
        .withColumn("actions", stage_actions(F.col("journey_stage")))
        .orderBy(F.desc("customer_count"), "journey_stage")
    )


def stage_distributions(scored, attributes=("Contract", "PaymentMethod")):
    """Share of each attribute value within its stage. Totals come from the counts."""
    counts = distribution(scored, ["journey_stage"], attributes)
    totals = counts.groupBy("journey_stage", "attribute").agg(F.sum("n").alias("_total"))
    # One row per stage and attribute.
    return counts.join(F.broadcast(totals), ["journey_stage", "attribute"]).select(
        "journey_stage", "attribute", "value", (F.col("n") / F.col("_total")).alias("share")
    )


def transitions(metrics):
    """Chances to stay, advance or become at risk, by average churn probability."""
    p = F.col("avg_churn_probability")

    def pick(low, middle, high):
        return F.when(p < 0.3, low).when(p < 0.5, middle).otherwise(high)

    return metrics.select(
        "journey_stage",
        pick(0.7, 0.5, 0.3).alias("stay"),
        pick(0.25, 0.2, 0.1).alias("advance"),
        pick(0.05, 0.3, 0.6).alias("at_risk"),
    )


def journey_insights(metrics):
    """Totals, share per stage, findings and recommendations as (section, item, value, text).

    `metrics` has one row per stage.
    """
    p, n = F.col("avg_churn_probability"), F.col("customer_count")
    stage = F.col("journey_stage")
    at_risk, elsewhere = stage == "at_risk", stage != "at_risk"
    facts = metrics.agg(
        F.sum(n).alias("total"),
        F.sum("total_annual_revenue").alias("revenue"),
        F.sum(F.when(at_risk, n)).alias("risk_n"),
        F.max(F.when(at_risk, p)).alias("risk_p"),
        F.max_by(F.when(elsewhere, stage), F.when(elsewhere, F.struct(p, stage))).alias("worst"),
        F.max(F.when(elsewhere, p)).alias("worst_p"),
        F.max(F.when(stage == "acquisition", p)).alias("new_p"),
        F.collect_list(F.struct(stage, n)).alias("stages"),
    )

    def item(section, name, value, text=None):
        return F.struct(
            F.lit(section).alias("section"),
            (name if not isinstance(name, str) else F.lit(name)).alias("item"),
            value.cast("double").alias("value"),
            (F.lit(None).cast("string") if text is None else text).alias("text"),
        )

    share = F.try_divide(F.col("risk_n"), F.col("total")) * 100
    fixed = F.array_compact(
        F.array(
            item("total", "customers", F.coalesce("total", F.lit(0))),
            item("total", "annual_revenue", F.coalesce("revenue", F.lit(0.0))),
            F.when(
                F.col("risk_n") > 0,
                item(
                    "finding", "at_risk", share,
                    F.format_string(
                        "%d customers (%.1f%%) are at risk with %.1f%% average churn probability",
                        "risk_n", share, F.col("risk_p") * 100,
                    ),
                ),
            ),
            F.when(
                F.col("worst").isNotNull(),
                item(
                    "finding", "highest_risk_stage", F.col("worst_p"),
                    F.format_string(
                        "%s stage has highest churn risk (%.1f%%)",
                        R.title_case(F.col("worst")), F.col("worst_p") * 100,
                    ),
                ),
            ),
            F.when(
                F.col("risk_n") > F.col("total") * 0.1,
                item("recommendation", "urgent", F.col("risk_n"), F.lit(URGENT_TEXT)),
            ),
            F.when(
                F.col("new_p") > 0.4,
                item("recommendation", "onboarding", F.col("new_p"), F.lit(ONBOARDING_TEXT)),
            ),
        )
    )
    per_stage = F.transform(
        "stages",
        lambda s: item(
            "stage_pct", s["journey_stage"], s["customer_count"] / F.col("total") * 100
        ),
    )
    return facts.select(F.inline(F.concat(fixed, per_stage)))
