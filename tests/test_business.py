import math

import pytest
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import rules as R
from stayline.functions.features import predicted_clv
from stayline.functions.stats import two_tailed_p
from stayline.operators import (
    clv, cohorts, experiments, journey, kpis, playbooks, reports, roi,
)
from tests.helpers import plan_text


@pytest.mark.parametrize("p, level", [(0.75, "critical"), (0.74, "high"), (0.5, "high"), (0.3, "medium"), (0.29, "low")])
def test_risk_levels(spark, p, level):
    assert spark.range(1).select(R.risk_level(F.lit(p))).first()[0] == level


@pytest.mark.parametrize(
    "revenue, tenure, p, services, expected",
    [
        (100.0, 36, 0.9, 0, "vip"), (50.0, 24, 0.9, 0, "loyal"), (80.0, 11, 0.1, 0, "growing"),
        (50.0, 12, 0.5, 0, "at_risk"), (20.0, 5, 0.1, 0, "new"), (20.0, 12, 0.6, 2, "disengaged"),
        (20.0, 12, 0.6, 3, "at_risk"), (20.0, 12, 0.1, 3, "loyal"),
    ],
)
def test_segments(spark, revenue, tenure, p, services, expected):
    column = R.segment(F.lit(revenue), F.lit(tenure), F.lit(p), F.lit(services))
    assert spark.range(1).select(column).first()[0] == expected


@pytest.mark.parametrize("tenure, p, stage", [(0, 0.1, "acquisition"), (3, 0.1, "onboarding"), (6, 0.1, "growth"),
                                              (12, 0.1, "maturity"), (24, 0.1, "retention"), (0, 0.75, "at_risk")])
def test_journey_stages(spark, tenure, p, stage):
    assert spark.range(1).select(R.journey_stage(F.lit(tenure), F.lit(p))).first()[0] == stage


def test_cohorts_cover_the_joined_rows_once(scored):
    table = cohorts.cohort_table(scored).collect()
    assert sum(r.customer_count for r in table) == scored.count()
    averages = [r.avg_churn_probability for r in table]
    assert averages == sorted(averages, reverse=True)
    sample = next(r for r in table if r.risk_level == "critical")
    assert sample.name.startswith("Critical Risk - ") and sample.description.startswith("Immediate")


def test_only_customers_with_predictions_count(spark, customers):
    few = customers.limit(3).select(S.ID, F.lit(0.9).alias("churn_probability"))
    assert cohorts.scored_customers(customers, few).count() == 3


def test_cohort_actions_literal_and_by_share(scored):
    literal = {r.cohort_id: r.actions for r in cohorts.cohort_actions(scored).collect()}
    shared = {r.cohort_id: r.actions for r in cohorts.cohort_actions(scored, share_based=True).collect()}
    assert literal.keys() == shared.keys()
    assert all(set(shared[c]) <= set(literal[c]) and len(set(a)) == len(a) for c, a in literal.items())
    assert any(cohorts.CONTRACT_ACTION in a for a in literal.values())


@pytest.mark.parametrize("revenue, tenure, p, growth", [(70.0, 3, 0.2, 0.0), (70.0, 3, 0.2, 0.01), (70.0, 30, 0.2, 0.0), (70.0, 0, 1.0, 0.0)])
def test_clv_equals_the_loop(spark, revenue, tenure, p, growth):
    step = 1.1 ** (1 / 12)
    months = int(max(0, (1 - p) * (24 - tenure)))
    expected = sum(revenue * (1 + growth) ** m / step**m for m in range(months))
    column = predicted_clv(F.lit(revenue), F.lit(tenure), F.lit(p), monthly_growth=growth)
    assert spark.range(1).select(column).first()[0] == pytest.approx(expected)


def test_clv_without_discount_is_a_product(spark):
    column = predicted_clv(F.lit(10.0), F.lit(4), F.lit(0.5), discount_rate=0.0)
    assert spark.range(1).select(column).first()[0] == 100.0


def test_clv_percentile_by_brute_force(scored):
    values = clv.customer_clv(scored).cache()
    rows = clv.clv_percentile(values).collect()
    assert len(rows) == values.count()
    known = [r.predicted_clv for r in rows]
    for r in rows:
        assert r.clv_percentile == pytest.approx(sum(v < r.predicted_clv for v in known) / len(known) * 100)


def test_clv_tiers(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 10)], "predicted_clv double")
    tiers = {r.predicted_clv: r.clv_tier for r in clv.clv_tiers(df).collect()}
    assert [tiers[float(v)] for v in range(1, 10)] == ["low_value"] * 2 + ["medium_value"] * 4 + ["high_value"] * 3


def test_percentile_with_one_dominating_value(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("c"), "id").alias("customerID"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("predicted_clv"),
    )
    out = clv.clv_percentile(df)
    assert out.count() == 3000
    assert out.where("predicted_clv = 0").select("clv_percentile").distinct().collect()[0][0] == 0.0


def test_empty_portfolio_is_zero(scored):
    row = clv.clv_portfolio(clv.customer_clv(scored.limit(0))).first()
    assert (row.total_clv, row.avg_clv, row.median_clv, row.customer_count) == (0.0, 0.0, 0.0, 0)


def test_kpis_on_four_customers(spark):
    df = spark.createDataFrame(
        [("a", 0.8, 100.0), ("b", 0.5, 50.0), ("c", 0.3, 30.0), ("d", 0.1, 20.0)],
        "customerID string, churn_probability double, MonthlyCharges double",
    )
    row = kpis.kpi_table(df).first()
    assert (row.customers_at_risk, row.revenue_at_risk, row.estimated_monthly_churn) == (3, 180.0, 1)
    assert row.estimated_annual_churn == 12 and row.estimated_revenue_loss == pytest.approx(50.0 * 24)
    assert row.intervention_readiness_score == pytest.approx(100 / 3)
    none = kpis.kpi_table(df.where("churn_probability < 0.2")).first()
    assert none.intervention_readiness_score == 0 and none.at_risk_percentage == 0


def test_kpi_trend(spark):
    schema = "day int, customers_at_risk bigint, revenue_at_risk double, avg_churn_probability double"
    history = spark.createDataFrame([(1, 10, 100.0, 0.4), (2, 20, 100.0, 0.5), (3, 15, 50.0, 0.5)], schema)
    row = kpis.kpi_trend(history, "day").first()
    assert (row.latest, row.customers_at_risk_change, row.customers_at_risk_change_pct) == (3, -5, -25.0)
    assert row.revenue_at_risk_change_pct == -50.0 and row.trend_direction == "worsening"
    short = kpis.kpi_trend(history.limit(1), "day").first()
    assert short.status == "insufficient_data" and short.trend_direction is None


def test_roi_arithmetic_and_zero(spark):
    df = spark.createDataFrame([("c", 0.8, 100.0)] * 10, "customerID string, churn_probability double, MonthlyCharges double")
    row = roi.roi(df).first()
    assert (row.churn_without_intervention, row.churn_prevented, row.intervention_cost) == (8, 2, 500.0)
    assert row.revenue_saved == 4800.0 and row.roi_percentage == pytest.approx(860.0)
    assert row.payback_period_months == pytest.approx(1.25) and row.cost_per_customer_retained == 250.0
    assert set(roi.roi(df, threshold=0.9).first()) == {0}


def test_actions_order_and_limit(spark):
    columns = "customerID string, churn_probability double, MonthlyCharges double, tenure int, Contract string, PaymentMethod string"
    df = spark.createDataFrame(
        [("a", 0.8, 100.0, 5, "Month-to-month", "Electronic check"), ("b", 0.1, 10.0, 5, "One year", "Mailed check")],
        columns,
    )
    found = playbooks.customer_actions(df).orderBy("position").collect()
    assert [r.action_id for r in found] == [
        "retention_call_critical", "personalized_discount", "contract_upgrade", "auto_pay_incentive"]
    offers = spark.createDataFrame(
        [("a", 1, "OnlineSecurity_No", 0.3), ("a", 2, "TechSupport_No", 0.2), ("a", 3, "tenure", 0.9), ("a", 4, "TechSupport_Yes", 0.9)],
        "customerID string, rank_no int, feature string, contribution double",
    )
    more = playbooks.customer_actions(df, offers).orderBy("position").collect()
    assert [r.action_id for r in more][-2:] == ["auto_pay_incentive", "service_enhancement_OnlineSecurity_No"]
    every = playbooks.customer_actions(df, offers, keep=9).orderBy("position").collect()
    assert [r.action_id for r in every][-1] == "service_enhancement_TechSupport_No"
    books = {r.customerID: r for r in playbooks.customer_playbooks(playbooks.with_actions(df)).collect()}
    assert books["b"].n_actions == 0 and books["b"].net_roi == 0.0
    assert books["a"].total_cost == pytest.approx(50 + 120 + 120 + 60)
    assert books["a"].lifetime_value_estimate == pytest.approx(100 * max(12, 5 + 0.2 * 24))


def test_playbooks_shuffle_nothing(scored):
    books = playbooks.customer_playbooks(playbooks.with_actions(scored))
    assert "Exchange" not in plan_text(books).split("InMemoryTableScan")[0]


def test_sample_size(spark):
    df = spark.createDataFrame([(0.5,), (0.0,), (0.9,)], "p double")
    rows = [r[0] for r in df.select(experiments.required_sample(F.col("p"), F.lit(0.15))).collect()]
    p1, p2 = 0.5, 0.425
    pooled = (p1 + p2) / 2
    z1, z2 = 1.959963984540054, 0.8416212335729143
    top = (z1 * math.sqrt(p1 * (1 - p1) + p2 * (1 - p2)) + z2 * math.sqrt(2 * pooled * (1 - pooled))) ** 2
    assert rows[0] == math.ceil(top / (p1 - p2) ** 2) and rows[1] == 1000 and rows[2] >= 30


def test_two_tailed_p_without_python(spark):
    z = [0.0, 1e-9, -0.5, 1.0, 1.96, -2.8, 2.83, 4.0, 8.0, -25.0, 60.0, None]
    df = spark.createDataFrame([(v,) for v in z], "z double").withColumn("p", two_tailed_p(F.col("z")))
    assert "Python" not in plan_text(df)
    for row in df.collect():
        expected = None if row.z is None else math.erfc(abs(row.z) / math.sqrt(2))
        assert row.p == (None if expected is None else pytest.approx(expected, rel=1e-9, abs=1e-300))


def test_ab_analysis(spark):
    rows = [("e", 0, int(i < 50)) for i in range(100)] + [("e", 1, int(i < 20)) for i in range(100)]
    rows += [("one-armed", 0, 1)]
    df = spark.createDataFrame(rows, "experiment_id string, arm int, churned int")
    by = {r.experiment_id: r for r in experiments.with_p_value(experiments.analyse(df)).collect()}
    row = by["e"]
    z = -0.3 / math.sqrt(0.35 * 0.65 * 0.02)
    assert row.z_score == pytest.approx(z) and row.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    assert row.is_significant and row.interpretation.startswith("Statistically significant improvement: 60.0%")
    assert by["one-armed"].p_value == 1.0 and not by["one-armed"].is_significant


def test_arms_are_stable_and_even(customers):
    arms = experiments.assign_arms(customers, "exp").groupBy("arm").count().collect()
    assert {r.arm for r in arms} == {0, 1}


def test_rollup_levels_add_up(scored):
    rows = reports.cohort_rollup(cohorts.cohort_table(scored)).collect()
    total = {lvl: sum(r.customers for r in rows if r.level == lvl) for lvl in ("all", "risk", "cohort")}
    assert len(set(total.values())) == 1 and total["all"] == scored.count()


def test_journey_on_no_customers(scored):
    rows = journey.journey_insights(journey.stage_metrics(scored.limit(0))).collect()
    assert {r.item: r.value for r in rows} == {"customers": 0.0, "annual_revenue": 0.0}


def test_summary_and_recommendations(scored):
    table = cohorts.cohort_table(scored)
    figures = kpis.kpi_table(scored, model_metrics={"roc_auc": 0.7})
    advice = {r.rule for r in reports.recommendations(figures, roi.roi(scored), table).collect()}
    assert "model_quality" in advice and "critical_cohorts" in advice
    books = playbooks.customer_playbooks(playbooks.with_actions(scored))
    rows = reports.executive_summary(figures, roi.roi(scored), table, books).collect()
    assert sum(r.section == "high_impact_playbooks" for r in rows) == 15
    assert any(r.measure == "revenue_at_risk" and r.text.startswith("$") for r in rows)
