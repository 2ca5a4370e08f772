"""Queries of the business views over scored customers."""

from statistics import NormalDist

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import (
    clv, cohorts, experiments, explain, journey, kpis, playbooks, reports, roi,
)
from stayline.plans.common import scored, sql, tidy, unpivot_sql

from stayline.session import checkpointed, scratch_path
from stayline.sources import derived
from stayline.sources.customers import write_json

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


def text_case(column, table):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


@query("risk_levels", sql('SELECT "customerID", churn_probability, risk_level FROM scored',
                          ["churn_probability"]))
def risk_levels(spark, folder):
    return tidy(scored(spark, folder).select(S.ID, "churn_probability", "risk_level"))


@query("segments", sql('SELECT "customerID", service_count, segment FROM scored'))
def segments(spark, folder):
    return scored(spark, folder).select(S.ID, "service_count", "segment")


@query("journey_stages", sql('SELECT "customerID", tenure, journey_stage FROM scored'))
def journey_stages(spark, folder):
    return scored(spark, folder).select(S.ID, "tenure", "journey_stage")


def _title(column):
    names = {v: v.replace("_", " ").title() for v in [*S.RISK_LEVELS, *S.SEGMENTS, *S.JOURNEY_STAGES]}
    return text_case(column, names)


COHORTS = f"""
cohorts AS (SELECT risk_level || '_' || segment AS cohort_id,
    {_title("risk_level")} || ' Risk - ' || {_title("segment")} AS name,
    {text_case("risk_level", cohorts.RISK_TEXT)} || '. '
      || {text_case("segment", cohorts.SEGMENT_TEXT)} || '.' AS description,
    risk_level, segment, count(*) AS customer_count, sum(bp) / count(*) / 10000 AS avg_churn_probability,
    sum(mc) / count(*) / 100 AS avg_monthly_revenue, sum(mc) * 12 / 100 AS total_annual_revenue,
    avg(tenure) AS avg_tenure
  FROM scored GROUP BY risk_level, segment)"""
_COHORT_FLOATS = ["avg_churn_probability", "avg_monthly_revenue", "total_annual_revenue", "avg_tenure"]


@query("cohorts", sql("SELECT * FROM cohorts", _COHORT_FLOATS, COHORTS))
def cohort_query(spark, folder):
    return tidy(cohorts.cohort_table(scored(spark, folder)))


@query("cohort_distributions", sql(f"""
    SELECT cohort_id, attribute, value, count(*) AS n FROM (
      {" UNION ALL ".join(f'''SELECT risk_level || '_' || segment AS cohort_id, '{c}' AS attribute,
          "{c}" AS value FROM scored''' for c in cohorts.COHORT_ATTRIBUTES)}) GROUP BY ALL"""))
def cohort_distributions(spark, folder):
    return cohorts.cohort_distributions(scored(spark, folder))


@query("cohort_characteristics", sql(f"""
    SELECT cohort_id, attribute, count(DISTINCT value) AS n_values, count(*) AS customers FROM (
      {" UNION ALL ".join(f'''SELECT risk_level || '_' || segment AS cohort_id, '{c}' AS attribute,
          "{c}" AS value FROM scored''' for c in cohorts.COHORT_ATTRIBUTES)}) GROUP BY ALL"""))
def cohort_characteristics(spark, folder):
    maps = cohorts.cohort_characteristics(scored(spark, folder))
    return maps.select(
        "cohort_id", "attribute",
        F.size("counts").cast("bigint").alias("n_values"),
        F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias(
            "customers"
        ),
    )


def _rows(pairs):
    return ", ".join(
        "(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")"
        for row in pairs
    )


def _actions_cte(share):
    by_risk = [(r, i, a) for r, xs in cohorts.RISK_ACTIONS.items() for i, a in enumerate(xs)]
    by_segment = [(s, 10 + i, a) for s, xs in cohorts.SEGMENT_ACTIONS.items() for i, a in enumerate(xs)]
    return f"""
rules AS (SELECT c.cohort_id, pos, action FROM cohorts c, (VALUES {_rows(by_risk)}) t(r, pos, action)
        WHERE r = risk_level
    UNION ALL SELECT c.cohort_id, pos, action FROM cohorts c, (VALUES {_rows(by_segment)}) t(s, pos, action)
        WHERE s = segment
    UNION ALL SELECT risk_level || '_' || segment, 20, '{cohorts.CONTRACT_ACTION}' FROM scored
        GROUP BY risk_level, segment
        HAVING count(*) FILTER ("Contract" = 'Month-to-month') {"/ count(*)" if share else ""} > 0.5
    UNION ALL SELECT risk_level || '_' || segment, 21, '{cohorts.PAYMENT_ACTION}' FROM scored
        GROUP BY risk_level, segment
        HAVING count(*) FILTER ("PaymentMethod" = 'Electronic check') {"/ count(*)" if share else ""} > 0.3),
action_rows AS (SELECT cohort_id, CAST(row_number() OVER (PARTITION BY cohort_id ORDER BY pos) AS INT)
    AS rule_no, action FROM (SELECT cohort_id, action, min(pos) AS pos FROM rules GROUP BY 1, 2))"""


@query("cohort_actions", sql("SELECT * FROM action_rows", ctes=f"{COHORTS}, {_actions_cte(False)}"))
def cohort_actions(spark, folder):
    return cohorts.cohort_action_rows(cohorts.cohort_actions(scored(spark, folder)))


@query("cohort_actions_by_share", sql(
    "SELECT * FROM action_rows", ctes=f"{COHORTS}, {_actions_cte(True)}"))
def cohort_actions_by_share(spark, folder):
    return cohorts.cohort_action_rows(cohorts.cohort_actions(scored(spark, folder), share_based=True))


# --- journey -----------------------------------------------------------------------------

STAGES = """
stages AS (SELECT journey_stage, count(*) AS customer_count,
    sum(bp) / count(*) / 10000 AS avg_churn_probability, sum(mc) / count(*) / 100 AS avg_monthly_revenue,
    avg(tenure) AS avg_tenure, sum(mc) * 12 / 100 AS total_annual_revenue,
    avg(service_count) AS avg_service_count FROM scored GROUP BY 1)"""


@query("journey_metrics", sql("SELECT * FROM stages", [
    "avg_churn_probability", "avg_monthly_revenue", "avg_tenure", "total_annual_revenue",
    "avg_service_count"], STAGES))
def journey_metrics(spark, folder):
    return tidy(journey.stage_metrics(scored(spark, folder)).drop("actions"))


@query("journey_actions", sql(f"""
    SELECT journey_stage, action FROM stages,
        (VALUES {_rows([(s, a) for s, xs in journey.STAGE_ACTIONS.items() for a in xs])}) t(stage, action)
    WHERE stage = journey_stage""", ctes=STAGES))
def journey_actions(spark, folder):
    return journey.stage_metrics(scored(spark, folder)).select(
        "journey_stage", F.explode("actions").alias("action")
    )


@query("journey_distributions", sql("""
    SELECT journey_stage, attribute, value,
        n / sum(n) OVER (PARTITION BY journey_stage, attribute) AS share
    FROM (SELECT journey_stage, attribute, value, count(*) AS n FROM (
      SELECT journey_stage, 'Contract' AS attribute, "Contract" AS value FROM scored
      UNION ALL SELECT journey_stage, 'PaymentMethod', "PaymentMethod" FROM scored)
      GROUP BY ALL)""", ["share"]))
def journey_distributions(spark, folder):
    return tidy(journey.stage_distributions(scored(spark, folder)))


@query("journey_transitions", sql("""
    SELECT journey_stage, CASE WHEN p < 0.3 THEN 0.7e0 WHEN p < 0.5 THEN 0.5e0 ELSE 0.3e0 END AS stay,
        CASE WHEN p < 0.3 THEN 0.25e0 WHEN p < 0.5 THEN 0.2e0 ELSE 0.1e0 END AS advance,
        CASE WHEN p < 0.3 THEN 0.05e0 WHEN p < 0.5 THEN 0.3e0 ELSE 0.6e0 END AS at_risk
    FROM (SELECT journey_stage, avg_churn_probability AS p FROM stages)""",
    ["stay", "advance", "at_risk"], STAGES))
def journey_transitions(spark, folder):
    return tidy(journey.transitions(journey.stage_metrics(scored(spark, folder))))


@query("journey_insights", sql(f"""
    SELECT 'total' AS section, 'customers' AS item, sum(customer_count)::DOUBLE AS value, NULL AS text FROM stages
    UNION ALL SELECT 'total', 'annual_revenue', sum(total_annual_revenue), NULL FROM stages
    UNION ALL SELECT 'stage_pct', journey_stage, customer_count / total * 100, NULL FROM stages, t
    UNION ALL SELECT 'finding', 'at_risk', customer_count / total * 100,
        printf('%d customers (%.1f%%) are at risk with %.1f%% average churn probability',
            customer_count, customer_count / total * 100, avg_churn_probability * 100) FROM stages, t
        WHERE journey_stage = 'at_risk'
    UNION ALL (SELECT 'finding', 'highest_risk_stage', avg_churn_probability,
        upper(journey_stage[1]) || journey_stage[2:] || printf(' stage has highest churn risk (%.1f%%)', avg_churn_probability * 100)
        FROM stages WHERE journey_stage <> 'at_risk' ORDER BY avg_churn_probability DESC LIMIT 1)
    UNION ALL SELECT 'recommendation', 'urgent', customer_count, '{journey.URGENT_TEXT}' FROM stages, t
        WHERE journey_stage = 'at_risk' AND customer_count > total * 0.1
    UNION ALL SELECT 'recommendation', 'onboarding', avg_churn_probability, '{journey.ONBOARDING_TEXT}' FROM stages
        WHERE journey_stage = 'acquisition' AND avg_churn_probability > 0.4""", ["value"],
    f"{STAGES}, t AS (SELECT sum(customer_count) AS total FROM stages)"))
def journey_insights(spark, folder):
    metrics = journey.stage_metrics(scored(spark, folder))
    return tidy(journey.journey_insights(metrics))


# --- lifetime value ----------------------------------------------------------------------

CLV = """
clv0 AS (SELECT *, greatest(0, trunc((1 - p) * (24 - tenure))) AS months,
    1 / pow(1.1e0, 1 / 12e0) AS q FROM scored),
clv AS (SELECT "customerID", rev AS current_monthly_revenue, tenure + (1 - p) * 24 AS predicted_tenure_months,
    rev * (1 - pow(q, months)) / (1 - q) AS predicted_clv,
    rev * (1 - pow(q, months)) / (1 - q) * (1 - p) AS risk_adjusted_clv,
    1 - p AS retention_probability, p AS churn_probability,
    rev * (1 - pow(q, months)) / (1 - q) * 0.15e0 AS retention_budget FROM clv0)"""
_CLV_FLOATS = ["current_monthly_revenue", "predicted_tenure_months", "predicted_clv",
               "risk_adjusted_clv", "retention_probability", "churn_probability", "retention_budget"]


def _clv(spark, folder):
    return clv.customer_clv(scored(spark, folder))


@query("clv", sql("SELECT * FROM clv", _CLV_FLOATS, CLV))
def clv_query(spark, folder):
    return tidy(_clv(spark, folder))


# Values are rounded to cents of a cent first: engines differ in the last bit of pow().
_ROUNDED_CLV = f"{CLV}, cents AS (SELECT \"customerID\", round(predicted_clv, 4) AS v FROM clv)"


def _rounded_clv(spark, folder):
    return _clv(spark, folder).withColumn("predicted_clv", F.round("predicted_clv", 4))


@query("clv_percentile", sql("""
    SELECT "customerID", (rank() OVER (ORDER BY v) - 1) / (SELECT count(*) FROM cents) * 100
        AS clv_percentile FROM cents""", ["clv_percentile"], _ROUNDED_CLV))
def clv_percentile(spark, folder):
    return tidy(clv.clv_percentile(_rounded_clv(spark, folder)).select(S.ID, "clv_percentile"))


@query("clv_tiers", sql("""
    SELECT "customerID", CASE WHEN v >= p75 THEN 'high_value' WHEN v >= p25 THEN 'medium_value'
        ELSE 'low_value' END AS clv_tier
    FROM cents, (SELECT quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.75) AS p75 FROM cents)""",
    ctes=_ROUNDED_CLV))
def clv_tiers(spark, folder):
    return clv.clv_tiers(_rounded_clv(spark, folder)).select(S.ID, "clv_tier")


@query("clv_portfolio", sql("""
    SELECT sum(predicted_clv) AS total_clv, avg(predicted_clv) AS avg_clv,
        median(predicted_clv) AS median_clv, sum(risk_adjusted_clv) AS total_risk_adjusted_clv,
        sum(retention_budget) AS total_retention_budget, count(*) AS customer_count FROM clv""",
    ["total_clv", "avg_clv", "median_clv", "total_risk_adjusted_clv", "total_retention_budget"],
    CLV, digits=4))
def clv_portfolio(spark, folder):
    return tidy(clv.clv_portfolio(_clv(spark, folder)), 4)


# --- key figures -------------------------------------------------------------------------

def kpi_ctes(source="scored", by="", name="kpi"):
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    top = (f"{name}_top AS (SELECT {by}quantile_cont(mc, 0.75) AS p75 FROM {source} {group})")
    join = f"{source} JOIN {name}_top USING ({by.rstrip(', ')})" if by else f"{source}, {name}_top"
    return f"""{top},
{name}_sums AS (SELECT {by}count(*) AS n, count(*) FILTER (bp >= 3000) AS risky, sum(mc) AS total,
    coalesce(sum(mc) FILTER (bp >= 3000), 0) AS risk_mc, sum(bp) / count(*) / 10000 AS p,
    count(*) FILTER (bp >= 7500) AS c1, count(*) FILTER (bp >= 5000 AND bp < 7500) AS c2,
    count(*) FILTER (bp >= 3000 AND bp < 5000) AS c3, count(*) FILTER (bp < 3000) AS c4,
    CAST(trunc(sum(bp) / 10000 * 0.8e0) AS BIGINT) AS churn,
    count(*) FILTER (bp >= 3000 AND mc >= p75) AS valuable
  FROM {join} {group}),
{name} AS (SELECT {by}n AS total_customers, risky AS customers_at_risk, risky / n * 100 AS at_risk_percentage,
    total / 100 AS total_monthly_revenue, risk_mc / 100 AS revenue_at_risk,
    risk_mc / total * 100 AS revenue_at_risk_percentage, p AS avg_churn_probability,
    c1 AS critical_risk_customers, c2 AS high_risk_customers, c3 AS medium_risk_customers,
    c4 AS low_risk_customers, churn AS estimated_monthly_churn, churn * 12 AS estimated_annual_churn,
    churn * (total / n / 100) * 24 AS estimated_revenue_loss, 0.85e0 AS model_roc_auc, 0.63e0 AS model_f1,
    coalesce(valuable / nullif(risky, 0) * 100, 0) AS intervention_readiness_score FROM {name}_sums)"""


MODEL_METRICS = {"roc_auc": 0.85, "f1": 0.63}
_KPI_FLOATS = ["at_risk_percentage", "total_monthly_revenue", "revenue_at_risk",
               "revenue_at_risk_percentage", "avg_churn_probability", "estimated_revenue_loss",
               "model_roc_auc", "model_f1", "intervention_readiness_score"]


@query("kpis", sql("SELECT * FROM kpi", _KPI_FLOATS, kpi_ctes()))
def kpi_query(spark, folder):
    return tidy(kpis.kpi_table(scored(spark, folder), model_metrics=MODEL_METRICS))


_YEARS = f"""years AS (SELECT DISTINCT o_custkey AS k, year(o_orderdate) AS year FROM orders),
yearly AS (SELECT year, scored.* FROM scored JOIN years USING (k)),
{kpi_ctes("yearly", "year, ", "kpi_y")}"""


def _yearly(spark, folder):
    return kpis.kpi_table(
        derived.customer_years(spark, folder), ["year"], model_metrics=MODEL_METRICS
    )


@query("kpi_history", sql("SELECT * REPLACE (CAST(year AS INT) AS year) FROM kpi_y", _KPI_FLOATS, _YEARS))
def kpi_history(spark, folder):
    return tidy(_yearly(spark, folder))


@query("kpi_trend", sql("""
    SELECT CAST(a.year AS INT) AS latest, a.customers_at_risk - b.customers_at_risk AS customers_at_risk_change,
        (a.customers_at_risk - b.customers_at_risk) / b.customers_at_risk * 100 AS customers_at_risk_change_pct,
        a.revenue_at_risk - b.revenue_at_risk AS revenue_at_risk_change,
        (a.revenue_at_risk - b.revenue_at_risk) / b.revenue_at_risk * 100 AS revenue_at_risk_change_pct,
        a.avg_churn_probability - b.avg_churn_probability AS avg_churn_probability_change,
        CASE WHEN a.avg_churn_probability < b.avg_churn_probability THEN 'improving' ELSE 'worsening' END
            AS trend_direction, 'success' AS status
    FROM kpi_y a, kpi_y b WHERE a.year = (SELECT max(year) FROM kpi_y)
        AND b.year = (SELECT max(year) FROM kpi_y WHERE year < a.year)""",
    ["customers_at_risk_change_pct", "revenue_at_risk_change", "revenue_at_risk_change_pct",
     "avg_churn_probability_change"], _YEARS))
def kpi_trend(spark, folder):
    return tidy(kpis.kpi_trend(_yearly(spark, folder), "year"))


# --- returns -----------------------------------------------------------------------------

def roi_sql(n, revenue, churn, cost="50e0", effect="0.3e0"):
    """The return columns over a source with these expressions."""
    prevented = f"trunc({churn} * {effect})"
    saved, spent = f"({prevented} * {revenue} * 24)", f"({n} * {cost})"
    return f"""CAST({churn} AS BIGINT) AS churn_without_intervention,
    {churn} * {revenue} * 24 AS revenue_lost_without_intervention, {spent} AS intervention_cost,
    CAST({prevented} AS BIGINT) AS churn_prevented, {saved} AS revenue_saved,
    {saved} - {spent} AS net_benefit,
    coalesce(({saved} - {spent}) / nullif({spent}, 0) * 100, 0) AS roi_percentage,
    coalesce({spent} / nullif({saved} / 12, 0), 0) AS payback_period_months,
    coalesce({spent} / nullif({prevented}, 0), 0) AS cost_per_customer_retained"""


_ROI_FLOATS = ["monthly_revenue_at_risk", "annual_revenue_at_risk", "revenue_lost_without_intervention",
               "intervention_cost", "revenue_saved", "net_benefit", "roi_percentage",
               "payback_period_months", "cost_per_customer_retained"]
ROI = f"""
roi AS (SELECT n AS customers_at_risk, mc / 100 AS monthly_revenue_at_risk, mc * 12 / 100 AS annual_revenue_at_risk,
    {roi_sql("n", "(mc / n / 100)", "trunc(bp / 10000)")}
  FROM (SELECT count(*) AS n, sum(mc) AS mc, sum(bp) AS bp FROM scored WHERE bp >= 5000))"""


@query("roi", sql("SELECT * FROM roi", _ROI_FLOATS, ROI))
def roi_query(spark, folder):
    return tidy(roi.roi(scored(spark, folder)))


@query("cohort_roi", sql(f"""
    SELECT risk_level || '_' || segment AS cohort_id, n AS customers_at_risk, mc / 100 AS monthly_revenue_at_risk,
        mc * 12 / 100 AS annual_revenue_at_risk, {roi_sql("n", "(mc / n / 100)", "trunc(bp / 10000)")}
    FROM (SELECT risk_level, segment, count(*) AS n, sum(mc) AS mc, sum(bp) AS bp FROM scored
          GROUP BY 1, 2)""", _ROI_FLOATS))
def cohort_roi(spark, folder):
    return tidy(roi.cohort_roi(cohorts.cohort_table(scored(spark, folder))))


SCENARIOS = [("cheap", 20, 0.15), ("standard", 50, None), ("intensive", 120, 0.5)]


@query("scenario_roi", sql(f"""
    SELECT scenario_name, cohort_id, n AS customers_at_risk, n * r * 12 AS total_revenue_at_risk,
        churn_without_intervention AS estimated_churn, churn_prevented AS estimated_churn_prevented,
        revenue_saved, intervention_cost, net_benefit, roi_percentage
    FROM (SELECT *, {roi_sql("n", "r", "trunc(n * 0.5e0)", "cost", "effect")} FROM (
        SELECT cohort_id, customer_count AS n, avg_monthly_revenue AS r, scenario_name, cost, effect FROM cohorts,
        (VALUES ('cheap', 20e0, 0.15e0), ('standard', 50e0, 0.3e0), ('intensive', 120e0, 0.5e0))
            t(scenario_name, cost, effect)))""",
    ["total_revenue_at_risk", "revenue_saved", "intervention_cost", "net_benefit", "roi_percentage"],
    COHORTS))
def scenario_roi(spark, folder):
    return tidy(roi.scenario_roi(cohorts.cohort_table(scored(spark, folder)), SCENARIOS))


# --- playbooks ---------------------------------------------------------------------------

_RULES = [
    (1, "retention_call_critical", "p >= 0.75", "'critical'", "50e0", 0.35, "Immediate Retention Specialist Call"),
    (2, "personalized_discount", "p >= 0.75", "'critical'", "rev * 0.2e0 * 6", 0.45,
     "Personalized 20% Discount (6 months)"),
    (3, "proactive_outreach", "p >= 0.5 AND p < 0.75", "'high'", "25e0", 0.25,
     "Proactive Account Manager Outreach"),
    (4, "targeted_discount", "p >= 0.5 AND p < 0.75", "'high'", "rev * 0.15e0 * 3", 0.3,
     "Targeted 15% Discount (3 months)"),
    (5, "contract_upgrade", "\"Contract\" = 'Month-to-month' AND p >= 0.4",
     "CASE WHEN p < 0.5 THEN 'medium' ELSE 'high' END", "rev * 0.1e0 * 12", 0.4, "Contract Upgrade Incentive"),
    (6, "auto_pay_incentive", "\"PaymentMethod\" = 'Electronic check' AND p >= 0.3", "'medium'", "60e0",
     0.2, "Auto-Pay Enrollment Incentive"),
]
_CANDIDATES = " UNION ALL ".join(
    f"""SELECT "customerID", rev, {no} AS rule_no, '{action}' AS action_id, '{title}' AS title,
        {priority} AS priority, {cost} AS cost, {effect}e0 AS effectiveness,
        (rev * 12 * {effect}e0 - {cost}) / ({cost}) AS expected_roi FROM scored WHERE {when}"""
    for no, action, when, priority, cost, effect, title in _RULES
)
_OFFERS = """ UNION ALL SELECT s."customerID", rev, CAST(6 + rank_no AS INT),
        'service_enhancement_' || feature, 'Service Enhancement: ' || feature, 'medium', 60e0, 0.15e0,
        (rev * 12 * 0.15e0 - 60) / 60
    FROM scored s JOIN explained e ON e."customerID" = s."customerID"
    WHERE rank_no <= 3 AND contribution > 0.1 AND (contains(feature, 'OnlineSecurity') OR contains(feature, 'TechSupport'))"""


def _actions(extra=""):
    return f"""candidates AS ({_CANDIDATES}{extra}),
actions AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "customerID" ORDER BY
    CASE priority WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END,
    round(expected_roi, 9) DESC, rule_no) AS INT) AS position FROM candidates) WHERE position <= 5)"""


# One contribution per service flag: the customer's gap to the mean, scaled to be visible.
_EXPLAINED = f"""flags AS ({unpivot_sql(S.SERVICES, 'customers', ['customerID'], 'VARCHAR')}),
gaps AS (SELECT "customerID", 'cat__' || feature AS feature,
    0.5e0 * (avg((value = 'Yes')::INT) OVER (PARTITION BY feature) - (value = 'Yes')::INT) AS contribution FROM flags),
explained AS (SELECT *, row_number() OVER (PARTITION BY "customerID"
    ORDER BY round(abs(contribution), 9) DESC, feature) AS rank_no FROM gaps)"""


def _service_explanations(rows):
    flags = rows.select(
        S.ID, *[(F.col(c) == "Yes").cast("double").alias(f"cat__{c}") for c in S.SERVICES]
    )
    weights = {f"cat__{c}": -0.5 for c in S.SERVICES}
    return explain.linear_contributions(flags, weights, top=3)


@query("playbook_actions", sql("""
    SELECT "customerID", position, rule_no, action_id, priority, cost, effectiveness, expected_roi FROM actions""",
    ["cost", "effectiveness", "expected_roi"], f"{_EXPLAINED}, {_actions(_OFFERS)}"))
def playbook_actions(spark, folder):
    rows = scored(spark, folder)
    found = playbooks.customer_actions(rows, _service_explanations(rows))
    return tidy(found.select(
        S.ID, "position", "rule_no", "action_id", "priority", "cost", "effectiveness", "expected_roi"
    ))


PLAYBOOKS = f"""{_actions()},
playbooks AS (SELECT 'playbook_' || s."customerID" AS playbook_id, s."customerID", churn_probability,
    rev AS monthly_revenue, rev * greatest(12, tenure + (1 - p) * 24) AS lifetime_value_estimate,
    coalesce(n, 0) AS n_actions, coalesce(c, 0) AS total_cost, coalesce(v, 0) AS total_savings,
    coalesce((v - c) / nullif(c, 0), 0) AS net_roi,
    CASE WHEN p >= 0.75 THEN '{playbooks.STRATEGIES[0][1]}' WHEN p >= 0.5 THEN '{playbooks.STRATEGIES[1][1]}'
         WHEN p >= 0.3 THEN '{playbooks.STRATEGIES[2][1]}' ELSE '{playbooks.DEFAULT_STRATEGY}' END AS strategy
  FROM scored s LEFT JOIN (SELECT "customerID", count(*) AS n, sum(cost) AS c,
      sum(cost * effectiveness * rev * 12) AS v FROM actions GROUP BY 1) a ON a."customerID" = s."customerID")"""
_BOOK_FLOATS = ["churn_probability", "monthly_revenue", "lifetime_value_estimate", "total_cost",
                "total_savings", "net_roi"]


def _playbooks(rows):
    return playbooks.customer_playbooks(playbooks.with_actions(rows))


@query("playbooks", sql("SELECT * FROM playbooks", _BOOK_FLOATS, PLAYBOOKS, total_savings=8))
def playbook_query(spark, folder):
    return tidy(_playbooks(scored(spark, folder)), total_savings=8)


@query("cohort_playbooks", sql("""
    SELECT 'cohort_playbook_' || cohort_id AS playbook_id, cohort_id, avg_churn_probability AS churn_probability,
        avg_monthly_revenue * customer_count AS monthly_revenue,
        avg_monthly_revenue * customer_count * 24 AS lifetime_value_estimate,
        coalesce(n, 0) AS n_actions, coalesce(c, 0) AS total_cost,
        coalesce(c, 0) * 0.25e0 * avg_monthly_revenue * 12 * customer_count AS total_savings,
        coalesce((c * 0.25e0 * avg_monthly_revenue * 12 * customer_count - c) / nullif(c, 0), 0) AS net_roi,
        'Cohort-level intervention for ' || customer_count || ' customers' AS strategy
    FROM cohorts LEFT JOIN (SELECT cohort_id, count(*) AS n, sum(CASE
          WHEN contains(lower(action), 'discount') THEN avg_monthly_revenue * 0.15e0 * customer_count * 3
          WHEN contains(lower(action), 'call') OR contains(lower(action), 'outreach') THEN 50e0 * customer_count * 0.5e0
          ELSE 10e0 * customer_count END) AS c
        FROM action_rows JOIN cohorts USING (cohort_id) WHERE rule_no <= 5 GROUP BY 1) USING (cohort_id)""",
    ["churn_probability", "monthly_revenue", "lifetime_value_estimate", "total_cost", "total_savings", "net_roi"],
    f"{COHORTS}, {_actions_cte(False)}", total_savings=0))
def cohort_playbooks(spark, folder):
    rows = scored(spark, folder)
    table = cohorts.cohort_table(rows)
    return tidy(playbooks.cohort_playbooks(table, cohorts.cohort_actions(rows)), total_savings=0)


@query("top_at_risk", sql("""
    SELECT "customerID", churn_probability, "MonthlyCharges" FROM scored WHERE bp >= 5000
    ORDER BY bp DESC, "customerID" LIMIT 10""", ["churn_probability", "MonthlyCharges"]))
def top_at_risk(spark, folder):
    top = playbooks.top_at_risk(scored(spark, folder))
    return tidy(top.select(S.ID, "churn_probability", "MonthlyCharges"))


# --- experiments -------------------------------------------------------------------------

Z = {p: NormalDist().inv_cdf(p) for p in (0.975, 0.8)}


def sample_size_sql(p, lift):
    p2 = f"({p} * (1 - {lift}))"
    pooled = f"(({p} + {p2}) / 2)"
    return f"""CAST(greatest(30, coalesce(ceil(
        pow({Z[0.975]!r} * sqrt({p} * (1 - {p}) + {p2} * (1 - {p2}))
            + {Z[0.8]!r} * sqrt({pooled} * (1 - {pooled}) * 2), 2)
        / nullif(({p} - {p2}) * ({p} - {p2}), 0)), 1000)) AS BIGINT)"""


@query("sample_size", sql(f"""
    SELECT cohort_id, p AS avg_churn_probability, lift AS expected_reduction,
        {sample_size_sql("p", "lift")} AS sample_size
    FROM (SELECT cohort_id, avg_churn_probability AS p FROM cohorts),
        (VALUES (0.05e0), (0.1e0), (0.15e0)) t(lift)""",
    ["avg_churn_probability", "expected_reduction"], COHORTS))
def sample_size(spark, folder):
    return tidy(experiments.sample_sizes(cohorts.cohort_table(scored(spark, folder))))


@query("experiment_design", sql(f"""
    SELECT 'exp_critical_risk_retention_intervention' AS experiment_id,
        'Critical Risk Retention Intervention' AS name, cohort_id AS target_cohort,
        'A personal offer against the usual letter' AS description,
        'A personal offer lowers churn by 15%' AS hypothesis, 'offer' AS intervention_type,
        0.15e0 AS expected_effect_size,
        {sample_size_sql("avg_churn_probability", "0.15e0")} AS sample_size_control,
        {sample_size_sql("avg_churn_probability", "0.15e0")} AS sample_size_treatment,
        4 AS duration_weeks, 'churn_rate' AS success_metric, 0.8e0 AS statistical_power,
        0.05e0 AS significance_level
    FROM cohorts WHERE risk_level = 'critical'""", ["statistical_power", "significance_level"], COHORTS))
def experiment_design(spark, folder):
    return tidy(experiments.design(
        cohorts.cohort_table(scored(spark, folder)), "Critical Risk Retention Intervention",
        "A personal offer against the usual letter", "A personal offer lowers churn by 15%", "offer"))


_ARM = """CAST(CAST('0x' || substr(md5(concat("customerID", '|exp_discount')), 1, 8) AS BIGINT)
    % 10000 % 2 AS INT)"""


@query("ab_assign", sql(f'SELECT "customerID", {_ARM} AS arm FROM customers'))
def ab_assign(spark, folder):
    rows = derived.customers(spark, folder).select(S.ID)
    return experiments.assign_arms(rows, "exp_discount")


_AB = f"""arms AS (SELECT "Contract" AS experiment_id, CAST(k % 2 AS INT) AS arm, ("Churn" = 'Yes')::INT AS churned FROM base),
ab0 AS (SELECT experiment_id, count(*) FILTER (arm = 0) AS n1, count(*) FILTER (arm = 1) AS n2,
    avg(churned) FILTER (arm = 0) AS p1, avg(churned) FILTER (arm = 1) AS p2 FROM arms GROUP BY 1),
ab AS (SELECT experiment_id, n1 AS control_size, n2 AS treatment_size, p1 AS control_metric,
    p2 AS treatment_metric, p2 - p1 AS absolute_lift, (p2 - p1) / p1 * 100 AS relative_lift_pct,
    (p2 - p1) / sqrt((p1 * n1 + p2 * n2) / (n1 + n2) * (1 - (p1 * n1 + p2 * n2) / (n1 + n2))
      * (1 / n1 + 1 / n2)) AS z_score,
    p2 - p1 - 1.96e0 * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS ci_lower,
    p2 - p1 + 1.96e0 * sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS ci_upper,
    2 * (asin(sqrt(p2)) - asin(sqrt(p1))) AS effect_size FROM ab0)"""
_AB_FLOATS = ["control_metric", "treatment_metric", "absolute_lift", "relative_lift_pct", "z_score",
              "ci_lower", "ci_upper", "effect_size"]


def _arms(spark, folder):
    return derived.customer_base(spark, folder).select(
        F.col("Contract").alias("experiment_id"), (F.col("k") % 2).cast("int").alias("arm"),
        (F.col("Churn") == "Yes").cast("int").alias("churned"),
    )


@query("ab_test", sql(
    f"SELECT *, abs(z_score) > {Z[0.975]!r} AS is_significant FROM ab", _AB_FLOATS, _AB))
def ab_test(spark, folder):
    return tidy(experiments.analyse(_arms(spark, folder)))


def erfc_sql(x):
    """The complementary error function in SQL: series up to 2, continued fraction beyond."""
    near, far = "1e0", x
    for k in range(60, 0, -1):
        near = f"(1e0 + 2e0 * {x} * {x} / {2 * k + 1}e0 * {near})"
    for k in range(80, 0, -1):
        far = f"({x} + {k / 2}e0 / {far})"
    scale = f"(exp(-{x} * {x}) / sqrt(pi()))"
    return f"CASE WHEN {x} < 2 THEN 1e0 - 2e0 * {x} * {scale} * {near} ELSE {scale} / {far} END"


@query("ab_p_value", sql(f"""
    SELECT experiment_id, p_value, is_significant,
        CASE WHEN is_significant AND absolute_lift < 0
          THEN printf('Statistically significant improvement: %.1f%% reduction in churned (p=%.4f)', abs(relative_lift_pct), p_value)
        WHEN is_significant
          THEN printf('Statistically significant increase: %.1f%% increase in churned (p=%.4f)', relative_lift_pct, p_value)
        ELSE printf('No statistically significant difference (p=%.4f). Lift: %.1f%%', p_value, relative_lift_pct)
        END AS interpretation
    FROM (SELECT *, {erfc_sql("x")} AS p_value, abs(z_score) > {Z[0.975]!r} AS is_significant
          FROM (SELECT *, abs(z_score) / sqrt(2) AS x FROM ab))""", ["p_value"], _AB))
def ab_p_value(spark, folder):
    tested = experiments.with_p_value(experiments.analyse(_arms(spark, folder)))
    return tidy(tested.select("experiment_id", "p_value", "is_significant", "interpretation"))


# --- reports -----------------------------------------------------------------------------

@query("cohort_rollup", sql("""
    SELECT 'all' AS level, NULL AS risk_level, NULL AS segment, count(*) AS cohorts,
        CAST(sum(customer_count) AS BIGINT) AS customers, sum(total_annual_revenue) AS annual_revenue FROM cohorts
    UNION ALL SELECT 'risk', risk_level, NULL, count(*), CAST(sum(customer_count) AS BIGINT),
        sum(total_annual_revenue) FROM cohorts GROUP BY risk_level
    UNION ALL SELECT 'cohort', risk_level, segment, 1, customer_count, total_annual_revenue FROM cohorts""",
    ["annual_revenue"], COHORTS))
def cohort_rollup(spark, folder):
    return tidy(reports.cohort_rollup(cohorts.cohort_table(scored(spark, folder))))


@query("action_effectiveness", sql("""
    SELECT split_part(title, ':', 1) AS action_type, count(*) AS n, sum(cost) AS total_cost,
        sum(effectiveness) AS total_effectiveness, sum(expected_roi) AS total_roi, avg(cost) AS avg_cost,
        avg(effectiveness) AS avg_effectiveness, avg(expected_roi) AS avg_roi FROM actions GROUP BY 1""",
    ["total_cost", "total_effectiveness", "total_roi", "avg_cost", "avg_effectiveness", "avg_roi"],
    f"{_EXPLAINED}, {_actions(_OFFERS)}", digits=4))
def action_effectiveness(spark, folder):
    rows = scored(spark, folder)
    return tidy(reports.action_effectiveness(
        playbooks.customer_actions(rows, _service_explanations(rows))
    ), 4)


def _report_inputs(spark, folder):
    """(key figures, returns, cohorts), each written once: every report reads them again."""
    rows = scored(spark, folder)
    return (
        checkpointed(kpis.kpi_table(rows, model_metrics=MODEL_METRICS)),
        checkpointed(roi.roi(rows)),
        checkpointed(cohorts.cohort_table(rows)),
    )


ADVICE = """advice AS (
    SELECT 1 AS rule_no, 'customers_at_risk' AS rule, customers_at_risk::DOUBLE AS value,
        printf('URGENT: %d customers (%.1f%%) are at risk. Immediate intervention required.',
            customers_at_risk, at_risk_percentage) AS text FROM kpi
        WHERE customers_at_risk > total_customers * 0.3
    UNION ALL SELECT 2, 'revenue_at_risk', revenue_at_risk_percentage,
        'CRITICAL: $' || format('{:,.0f}', revenue_at_risk)
            || printf(' in monthly revenue (%.1f%%) is at risk.', revenue_at_risk_percentage)
        FROM kpi WHERE revenue_at_risk_percentage > 30
    UNION ALL SELECT 3, 'strong_roi', roi_percentage,
        printf('STRONG ROI: Retention initiatives show %.1f%% ROI. Scale intervention programs.', roi_percentage)
        FROM roi WHERE roi_percentage > 200
    UNION ALL SELECT 4, 'critical_cohorts', count(*), printf('Focus on %d critical-risk cohorts with ', count(*))
            || '$' || format('{:,.0f}', sum(total_annual_revenue)) || ' in annual revenue.'
        FROM cohorts WHERE risk_level = 'critical' HAVING count(*) > 0
    UNION ALL SELECT 5, 'model_quality', model_roc_auc,
        'Consider model retraining: Current model performance may be degrading.' FROM kpi WHERE model_roc_auc < 0.8)"""


@query("recommendations", sql("SELECT * FROM advice", ["value"], f"{kpi_ctes()}, {ROI}, {COHORTS}, {ADVICE}"))
def recommendations(spark, folder):
    return tidy(reports.recommendations(*_report_inputs(spark, folder)))


def _lines(section, item, source, **texts):
    """SQL rows (section, item, measure, text) of one source, one for each text."""
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{name}' AS measure, {text} AS text FROM {source}"
        for name, text in texts.items())


def _money(column):
    return f"'$' || format('{{:,.2f}}', {column})"


@query("exec_summary", sql(" UNION ALL ".join([
    _lines("key_findings", "'all'", "kpi", customers_at_risk="CAST(customers_at_risk AS VARCHAR)",
           revenue_at_risk=_money("revenue_at_risk"),
           revenue_at_risk_percentage="printf('%.1f%%', revenue_at_risk_percentage)",
           estimated_annual_churn="CAST(estimated_annual_churn AS VARCHAR)",
           estimated_revenue_loss=_money("estimated_revenue_loss")),
    _lines("roi_analysis", "'all'", "roi", intervention_cost=_money("intervention_cost"),
           estimated_revenue_saved=_money("revenue_saved"), net_benefit=_money("net_benefit"),
           roi_percentage="printf('%.1f%%', roi_percentage)",
           payback_period_months="printf('%.1f', payback_period_months)"),
    _lines("critical_cohorts", "name",
           "(SELECT * FROM cohorts ORDER BY avg_churn_probability DESC, total_annual_revenue LIMIT 5)",
           customer_count="CAST(customer_count AS VARCHAR)", total_annual_revenue=_money("total_annual_revenue"),
           avg_churn_probability="printf('%.1f%%', avg_churn_probability * 100)"),
    _lines("high_impact_playbooks", "playbook_id",
           "(SELECT * FROM playbooks ORDER BY churn_probability DESC, playbook_id LIMIT 5)",
           churn_probability="printf('%.1f%%', churn_probability * 100)", monthly_revenue=_money("monthly_revenue"),
           net_roi="printf('%.1fx', net_roi)"),
    "SELECT 'recommendations', rule, 'text', text FROM advice",
]), ctes=f"{kpi_ctes()}, {ROI}, {COHORTS}, {ADVICE}, {PLAYBOOKS}"))
def exec_summary(spark, folder):
    rows = scored(spark, folder)
    return reports.executive_summary(*_report_inputs(spark, folder), _playbooks(rows))


@query("retention_strategy", sql("""
    SELECT (SELECT count(*) FROM cohorts) AS total_cohorts, (SELECT count(*) FROM scored) AS total_playbooks,
        (SELECT count(*) FROM actions) AS total_actions, (SELECT count(*) FROM action_rows) AS recommended_actions""",
    ctes=f"{COHORTS}, {_actions_cte(False)}, {_actions()}"))
def retention_strategy(spark, folder):
    rows = scored(spark, folder)
    return reports.retention_strategy(
        cohorts.cohort_table(rows), cohorts.cohort_actions(rows),
        playbooks.customer_playbooks(playbooks.with_actions(rows)),
    )


@query("chart_data", sql("""
    SELECT 'risk_distribution' AS chart, item, value::DOUBLE AS value FROM kpi, LATERAL (VALUES
        ('Critical', critical_risk_customers), ('High', high_risk_customers),
        ('Medium', medium_risk_customers), ('Low', low_risk_customers)) t(item, value)
    UNION ALL SELECT 'revenue_at_risk', item, value FROM kpi, LATERAL (VALUES
        ('At Risk', revenue_at_risk), ('Safe', total_monthly_revenue - revenue_at_risk)) t(item, value)
    UNION ALL SELECT 'estimated_churn', item, value FROM kpi, LATERAL (VALUES
        ('Monthly', estimated_monthly_churn), ('Annual', estimated_annual_churn)) t(item, value)
    UNION ALL SELECT 'readiness', 'Readiness Score', intervention_readiness_score FROM kpi
    UNION ALL SELECT 'roi_breakdown', item, value FROM roi, LATERAL (VALUES
        ('Revenue Saved', revenue_saved), ('Intervention Cost', intervention_cost),
        ('Net Benefit', net_benefit), ('ROI', roi_percentage)) t(item, value)
    UNION ALL (SELECT 'cohort_revenue', name, total_annual_revenue FROM cohorts
        ORDER BY total_annual_revenue DESC, cohort_id LIMIT 10)""", ["value"],
    f"{kpi_ctes()}, {ROI}, {COHORTS}"))
def chart_data(spark, folder):
    return tidy(reports.chart_data(*_report_inputs(spark, folder)))


@query("json_report", sql("SELECT * FROM cohorts", _COHORT_FLOATS, COHORTS))
def json_report(spark, folder):
    table = cohorts.cohort_table(scored(spark, folder))
    path = write_json(table, scratch_path(spark, "cohort-report"))
    return tidy(spark.read.schema(table.schema).json(path))
