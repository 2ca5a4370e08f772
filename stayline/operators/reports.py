"""Executive rollups over cohorts, key figures, returns and playbooks."""

from pyspark.sql import functions as F

from stayline.operators.cohorts import COHORT


# Fixed texts; amounts stand between the two parts of a pair.
MANY_AT_RISK = "URGENT: %d customers (%.1f%%) are at risk. Immediate intervention required."
REVENUE_AT_RISK = "CRITICAL: ", " in monthly revenue (%.1f%%) is at risk."
STRONG_ROI = "STRONG ROI: Retention initiatives show %.1f%% ROI. Scale intervention programs."
CRITICAL_COHORTS = "Focus on %d critical-risk cohorts with ", " in annual revenue."
RETRAIN = "Consider model retraining: Current model performance may be degrading."


def _dollars(col, digits=2):
    return F.concat(F.lit("$"), F.format_number(col, digits))


def _percent(col):
    return F.format_string("%.1f%%", col)


def cohort_rollup(cohorts):
    """Totals overall, by risk level and by cohort, told apart by `level`.

    Rolls up the cohort table, so customers are not expanded per level.
    """
    rolled = cohorts.rollup(*COHORT).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("cohorts"),
        F.sum("customer_count").alias("customers"),
        F.sum("total_annual_revenue").alias("annual_revenue"),
    )
    level = F.when(F.col("_g") == 3, "all").when(F.col("_g") == 1, "risk").otherwise("cohort")
    return rolled.select(level.alias("level"), *COHORT, "cohorts", "customers", "annual_revenue")


def action_effectiveness(actions):
    """Count, totals and averages per kind of action; the kind is the title up to a colon."""
    return actions.groupBy(F.split("title", ":")[0].alias("action_type")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cost").alias("total_cost"),
        F.sum("effectiveness").alias("total_effectiveness"),
        F.sum("expected_roi").alias("total_roi"),
        F.avg("cost").alias("avg_cost"),
        F.avg("effectiveness").alias("avg_effectiveness"),
        F.avg("expected_roi").alias("avg_roi"),
    )


def recommendations(kpis, returns, cohorts, min_auc=0.80):
    """Triggered recommendations as (rule_no, rule, value, text). One-row inputs."""
    critical = cohorts.where(F.col("risk_level") == "critical").agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("total_annual_revenue"), F.lit(0.0)).alias("revenue"),
        )
    )
    facts = kpis.withColumns(
        {"_roi": returns.select("roi_percentage").scalar(), "_critical": critical.scalar()}
    )
    risky, total = F.col("customers_at_risk"), F.col("total_customers")
    share = F.col("revenue_at_risk_percentage")

    def rule(no, name, value, text):
        return F.struct(
            F.lit(no).alias("rule_no"), F.lit(name).alias("rule"),
            value.cast("double").alias("value"), text.alias("text"),
        )

    rows = F.array_compact(
        F.array(
            F.when(
                risky > total * 0.3,
                rule(1, "customers_at_risk", risky, F.format_string(
                    MANY_AT_RISK,
                    risky, F.col("at_risk_percentage"))),
            ),
            F.when(
                share > 30,
                rule(2, "revenue_at_risk", share, F.concat(
                    F.lit(REVENUE_AT_RISK[0]), _dollars("revenue_at_risk", 0),
                    F.format_string(REVENUE_AT_RISK[1], share))),
            ),
            F.when(
                F.col("_roi") > 200,
                rule(3, "strong_roi", F.col("_roi"), F.format_string(
                    STRONG_ROI,
                    F.col("_roi"))),
            ),
            F.when(
                F.col("_critical.n") > 0,
                rule(4, "critical_cohorts", F.col("_critical.n"), F.concat(
                    F.format_string(CRITICAL_COHORTS[0], F.col("_critical.n")),
                    _dollars("_critical.revenue", 0), F.lit(CRITICAL_COHORTS[1]))),
            ),
            F.when(
                (F.col("model_roc_auc") != 0) & (F.col("model_roc_auc") < min_auc),
                rule(5, "model_quality", F.col("model_roc_auc"), F.lit(
                    RETRAIN)),
            ),
        )
    )
    return facts.select(F.inline(rows))


def executive_summary(kpis, returns, cohorts, playbooks, min_auc=0.80):
    """Formatted findings as (section, item, text); top five cohorts and playbooks."""

    def lines(frame, section, item, pairs):
        entries = F.array(
            *[F.struct(F.lit(k).alias("measure"), v.cast("string").alias("text")) for k, v in pairs]
        )
        return frame.select(F.lit(section).alias("section"), item.alias("item"), F.inline(entries))

    c = F.col
    findings = lines(kpis, "key_findings", F.lit("all"), [
        ("customers_at_risk", c("customers_at_risk")),
        ("revenue_at_risk", _dollars("revenue_at_risk")),
        ("revenue_at_risk_percentage", _percent(c("revenue_at_risk_percentage"))),
        ("estimated_annual_churn", c("estimated_annual_churn")),
        ("estimated_revenue_loss", _dollars("estimated_revenue_loss")),
    ])
    returned = lines(returns, "roi_analysis", F.lit("all"), [
        ("intervention_cost", _dollars("intervention_cost")),
        ("estimated_revenue_saved", _dollars("revenue_saved")),
        ("net_benefit", _dollars("net_benefit")),
        ("roi_percentage", _percent(c("roi_percentage"))),
        ("payback_period_months", F.format_string("%.1f", c("payback_period_months"))),
    ])
    top_cohorts = lines(
        cohorts.orderBy(F.desc("avg_churn_probability"), "total_annual_revenue").limit(5),
        "critical_cohorts", c("name"), [
            ("customer_count", c("customer_count")),
            ("total_annual_revenue", _dollars("total_annual_revenue")),
            ("avg_churn_probability", _percent(c("avg_churn_probability") * 100)),
        ],
    )
    top_playbooks = lines(
        playbooks.orderBy(F.desc("churn_probability"), "playbook_id").limit(5),
        "high_impact_playbooks", c("playbook_id"), [
            ("churn_probability", _percent(c("churn_probability") * 100)),
            ("monthly_revenue", _dollars("monthly_revenue")),
            ("net_roi", F.format_string("%.1fx", c("net_roi"))),
        ],
    )
    advice = recommendations(kpis, returns, cohorts, min_auc).select(
        F.lit("recommendations").alias("section"), F.col("rule").alias("item"),
        F.lit("text").alias("measure"), "text",
    )
    return (
        findings.unionByName(returned).unionByName(top_cohorts)
        .unionByName(top_playbooks).unionByName(advice)
    )


def retention_strategy(cohorts, cohort_actions, playbooks):
    """Overview counts of the strategy report in one row."""
    books = playbooks.agg(
        F.struct(
            F.count(F.lit(1)).alias("books"),
            F.coalesce(F.sum("n_actions"), F.lit(0)).alias("actions"),
        )
    )
    return (
        cohorts.agg(F.count(F.lit(1)).alias("total_cohorts"))
        .withColumn("_books", books.scalar())
        .select(
            "total_cohorts",
            F.col("_books.books").alias("total_playbooks"),
            F.col("_books.actions").alias("total_actions"),
            F.lit(cohort_actions.agg(F.sum(F.size("actions"))).scalar()).alias(
                "recommended_actions"
            ),
        )
    )


def chart_data(kpis, returns, cohorts, top=10):
    """What the four business charts show, as (chart, item, value)."""

    def bars(frame, chart, pairs):
        entries = F.array(
            *[F.struct(F.lit(k).alias("item"), F.col(v).cast("double").alias("value") if isinstance(v, str) else v.cast("double").alias("value")) for k, v in pairs]
        )
        return frame.select(F.lit(chart).alias("chart"), F.inline(entries))

    return (
        bars(kpis, "risk_distribution", [
            (level.title(), f"{level}_risk_customers") for level in ["critical", "high", "medium", "low"]
        ])
        .unionByName(bars(kpis, "revenue_at_risk", [
            ("At Risk", "revenue_at_risk"),
            ("Safe", F.col("total_monthly_revenue") - F.col("revenue_at_risk")),
        ]))
        .unionByName(bars(kpis, "estimated_churn", [
            ("Monthly", "estimated_monthly_churn"), ("Annual", "estimated_annual_churn"),
        ]))
        .unionByName(bars(kpis, "readiness", [("Readiness Score", "intervention_readiness_score")]))
        .unionByName(bars(returns, "roi_breakdown", [
            ("Revenue Saved", "revenue_saved"), ("Intervention Cost", "intervention_cost"),
            ("Net Benefit", "net_benefit"), ("ROI", "roi_percentage"),
        ]))
        .unionByName(
            cohorts.orderBy(F.desc("total_annual_revenue"), "cohort_id").limit(top).select(
                F.lit("cohort_revenue").alias("chart"), F.col("name").alias("item"),
                F.col("total_annual_revenue").alias("value"),
            )
        )
    )
