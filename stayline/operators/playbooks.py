"""Retention playbooks for customers and cohorts."""

from pyspark.sql import functions as F

from stayline import schema as S

PRIORITIES = ["critical", "high", "medium", "low"]
SPECIALIST_COST = 50.0
MANAGER_COST = 25.0
KEPT = 5

# Fixed texts.
STRATEGIES = [
    (0.75, "Immediate intervention required - deploy all available retention tools"),
    (0.5, "Proactive retention - targeted offers and engagement"),
    (0.3, "Preventive engagement - maintain satisfaction and address concerns early"),
]
DEFAULT_STRATEGY = "Maintain current service levels - focus on value delivery"

# Rule, then id, title, description, priority, effectiveness and time of its action.
ACTIONS = {
    1: ("retention_call_critical", "Immediate Retention Specialist Call",
        "Priority call from retention specialist to understand concerns and offer personalized solution",
        "critical", 0.35, "immediate"),
    2: ("personalized_discount", "Personalized 20% Discount (6 months)",
        "Offer 20% discount on monthly charges for 6 months to retain customer", "critical", 0.45, "1-2 days"),
    3: ("proactive_outreach", "Proactive Account Manager Outreach",
        "Proactive call/email from account manager to check satisfaction and offer improvements",
        "high", 0.25, "1-2 days"),
    4: ("targeted_discount", "Targeted 15% Discount (3 months)", "Offer 15% discount for 3 months",
        "high", 0.30, "1-2 days"),
    5: ("contract_upgrade", "Contract Upgrade Incentive",
        "Offer 10% annual discount to switch from month-to-month to annual contract", "high", 0.40, "1 week"),
    6: ("auto_pay_incentive", "Auto-Pay Enrollment Incentive",
        "Offer $5/month discount for switching to automatic payment", "medium", 0.20, "1-2 days"),
    7: ("service_enhancement_{feature}", "Service Enhancement: {feature}",
        "Offer complimentary {feature} service to improve satisfaction", "medium", 0.15, "1 week"),
}


def _action(rule, cost, priority=None, rule_no=None, feature=None):
    """One action with its fixed texts; `priority` and `rule_no` override those of the table."""
    action_id, title, description, usual, effect, timing = ACTIONS[rule]
    text = lambda x: F.lit(x) if feature is None else F.replace(F.lit(x), F.lit("{feature}"), feature)
    priority = F.lit(usual) if priority is None else priority
    gain = F.try_divide(F.col("MonthlyCharges") * 12 * effect - cost, cost)
    return F.struct(
        # Sort order: priority, then return, then rule.
        F.array_position(F.array(*[F.lit(x) for x in PRIORITIES]), priority).alias("_level"),
        (-gain).alias("_gain"),
        (F.lit(rule) if rule_no is None else rule_no).cast("int").alias("rule_no"),
        text(action_id).alias("action_id"),
        text(title).alias("title"),
        text(description).alias("description"),
        priority.alias("priority"),
        cost.alias("cost"),
        F.lit(effect).alias("effectiveness"),
        gain.alias("expected_roi"),
        F.lit(timing).alias("implementation_time"),
    )


def with_actions(scored, explanations=None, keep=KEPT):
    """Add `actions`: up to five per customer, by priority, then return, then rule order.

    They are sorted inside the row, so nothing is shuffled for them. `explanations` is an
    optional table (customerID, rank_no, feature, contribution); its first three entries per
    customer may add a service offer.
    """
    p, revenue = F.col("churn_probability"), F.col("MonthlyCharges")
    money = lambda x: F.lit(float(x))
    near = (p >= 0.5) & (p < 0.75)
    upgrade = F.when(p < 0.5, "medium").otherwise("high")
    rules = [
        F.when(p >= 0.75, _action(1, money(SPECIALIST_COST))),
        F.when(p >= 0.75, _action(2, revenue * 0.20 * 6)),
        F.when(near, _action(3, money(MANAGER_COST))),
        F.when(near, _action(4, revenue * 0.15 * 3)),
        F.when((F.col("Contract") == "Month-to-month") & (p >= 0.4), _action(5, revenue * 0.10 * 12, upgrade)),
        F.when((F.col("PaymentMethod") == "Electronic check") & (p >= 0.3), _action(6, money(60))),
    ]
    found = F.array_compact(F.array(*rules))
    if explanations is not None:
        scored = scored.join(_service_features(explanations), S.ID, "left")
        offers = F.transform(F.coalesce("_offers", F.array()), lambda o: _service_offer(o))
        found = F.concat(found, offers)
    return scored.withColumn("actions", F.slice(F.array_sort(found), 1, keep)).drop("_offers")


def customer_actions(scored, explanations=None, keep=KEPT):
    """The actions as rows with their position."""
    return (
        with_actions(scored, explanations, keep)
        .select(S.ID, "MonthlyCharges", F.posexplode("actions").alias("_at", "_action"))
        .select(S.ID, "MonthlyCharges", (F.col("_at") + 1).alias("position"), "_action.*")
        .drop("_level", "_gain")
    )


def _service_features(explanations):
    """At most three (rank, feature) entries per customer that call for a service offer."""
    feature = F.col("feature")
    wanted = explanations.where(
        (F.col("rank_no") <= 3)
        & (F.col("contribution") > 0.1)
        & (feature.contains("OnlineSecurity") | feature.contains("TechSupport"))
        & ~(feature.contains("Contract") & feature.contains("Month-to-month"))
    )
    return wanted.groupBy(S.ID).agg(
        F.collect_list(F.struct("rank_no", "feature")).alias("_offers")
    )


def _service_offer(entry):
    """The offer of a service; its texts name the feature in place of {feature}."""
    return _action(7, F.lit(60.0), rule_no=entry["rank_no"] + 6, feature=entry["feature"])


def strategy(p):
    chain = F.when(p >= STRATEGIES[0][0], STRATEGIES[0][1])
    for bound, text in STRATEGIES[1:]:
        chain = chain.when(p >= bound, text)
    return chain.otherwise(DEFAULT_STRATEGY)


def customer_playbooks(rows):
    """One row per customer of `with_actions`, a pure projection."""
    p, revenue, actions = F.col("churn_probability"), F.col("MonthlyCharges"), F.col("actions")

    def total(of):
        return F.aggregate(actions, F.lit(0.0), lambda sum_, a: sum_ + of(a))

    months = F.greatest(F.lit(12.0), F.col("tenure") + (1 - p) * 24)
    cost, savings = F.col("total_cost"), F.col("total_savings")
    return rows.select(
        F.concat(F.lit("playbook_"), F.col(S.ID)).alias("playbook_id"),
        S.ID,
        "churn_probability",
        revenue.alias("monthly_revenue"),
        (revenue * months).alias("lifetime_value_estimate"),
        F.size(actions).cast("bigint").alias("n_actions"),
        total(lambda a: a["cost"]).alias("total_cost"),
        total(lambda a: a["cost"] * a["effectiveness"] * revenue * 12).alias("total_savings"),
        strategy(p).alias("strategy"),
    ).withColumn("net_roi", F.when(cost > 0, F.try_divide(savings - cost, cost)).otherwise(0.0))


def cohort_playbook_actions(cohorts, actions):
    """The first five actions of each cohort with their cost, by keyword."""
    low = F.lower("title")
    n, revenue = F.col("customer_count"), F.col("avg_monthly_revenue")
    cost = (
        F.when(low.contains("discount"), revenue * 0.15 * n * 3)
        .when(low.contains("call") | low.contains("outreach"), SPECIALIST_COST * n * 0.5)
        .otherwise(10.0 * n)
    )
    rows = actions.select(
        "cohort_id", F.posexplode(F.slice("actions", 1, KEPT)).alias("rule_no", "title")
    )
    # One row per cohort on either side.
    return rows.join(cohorts, "cohort_id").select(
        "cohort_id", "rule_no", F.format_string("cohort_action_%d", "rule_no").alias("action_id"),
        "title", F.col("risk_level").alias("priority"), cost.alias("cost"),
        F.lit(0.25).alias("effectiveness"), F.lit(2.0).alias("expected_roi"),
        F.lit("1-2 days").alias("implementation_time"),
    )


def cohort_playbooks(cohorts, actions):
    costed = cohort_playbook_actions(cohorts, actions)
    totals = costed.groupBy("cohort_id").agg(
        F.count(F.lit(1)).alias("n_actions"),
        F.sum("cost").alias("total_cost"),
        F.sum(F.col("cost") * F.col("effectiveness")).alias("_effect"),
    )
    n, revenue = F.col("customer_count"), F.col("avg_monthly_revenue")
    total_cost = F.coalesce("total_cost", F.lit(0.0))
    savings = F.coalesce("_effect", F.lit(0.0)) * revenue * 12 * n
    return cohorts.join(totals, "cohort_id", "left").select(
        F.concat(F.lit("cohort_playbook_"), "cohort_id").alias("playbook_id"),
        "cohort_id",
        F.col("avg_churn_probability").alias("churn_probability"),
        (revenue * n).alias("monthly_revenue"),
        (revenue * n * 24).alias("lifetime_value_estimate"),
        F.coalesce("n_actions", F.lit(0)).alias("n_actions"),
        total_cost.alias("total_cost"),
        savings.alias("total_savings"),
        F.when(total_cost > 0, F.try_divide(savings - total_cost, total_cost)).otherwise(0.0).alias(
            "net_roi"
        ),
        F.format_string("Cohort-level intervention for %d customers", "customer_count").alias(
            "strategy"
        ),
    )


def top_at_risk(scored, threshold=0.5, n=10):
    """The n highest probabilities at or above the threshold; ties by id."""
    return (
        scored.where(F.col("churn_probability") >= threshold)
        .orderBy(F.desc("churn_probability"), S.ID)
        .limit(n)
    )
