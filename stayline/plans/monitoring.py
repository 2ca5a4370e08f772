"""Queries of drift, performance and alerts."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import alerts, drift, performance, profile
from stayline.plans.common import COLUMNS, sql, tidy, unpivot_sql
from stayline.plans.evaluation import evaluation_ctes
from stayline.plans.featuring import _CATALOGUE, CATALOGUED, _described
from stayline.plans.intake import histogram_sql
from stayline.sources import derived

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


NUMBERS = S.NUMERIC
TEXTS = [c for c in S.CUSTOMER_COLUMNS if c not in NUMBERS and c != S.ID]


def drift_ctes(numbers=NUMBERS, texts=TEXTS, prefix=""):
    """Tables {prefix}psi_n, _ks, _psi_c and _verdict over the two sides."""
    x = prefix
    longs = unpivot_sql(numbers, "sides", ["ref"]) if numbers else (
        "SELECT 1 AS ref, NULL AS feature, 0e0 AS value WHERE false")
    words = unpivot_sql(texts, "sides", ["ref"], "VARCHAR") if texts else (
        "SELECT 1 AS ref, NULL AS feature, NULL AS value WHERE false")
    term = """sum((CASE a WHEN 0 THEN 1e-6 ELSE a END - CASE e WHEN 0 THEN 1e-6 ELSE e END)
        * ln(CASE a WHEN 0 THEN 1e-6 ELSE a END / CASE e WHEN 0 THEN 1e-6 ELSE e END))"""
    edges = " + ".join(f"(value >= low + {i} * ((high - low) / 10))::INT" for i in range(1, 10))
    return f"""
{x}longs AS (SELECT * FROM ({longs}) WHERE value IS NOT NULL),
{x}sizes AS (SELECT feature, sum(ref) AS n_ref, sum(1 - ref) AS n_cur, min(value) AS low,
    max(value) AS high FROM {x}longs GROUP BY 1),
{x}bins AS (SELECT feature, {edges} AS bin, sum(ref) / any_value(n_ref) AS e,
    sum(1 - ref) / any_value(n_cur) AS a FROM {x}longs JOIN {x}sizes USING (feature) GROUP BY 1, 2),
{x}psi_n AS (SELECT feature, {term} AS psi FROM {x}bins GROUP BY 1),
{x}steps AS (SELECT feature, value, sum(ref) AS r, sum(1 - ref) AS c FROM {x}longs GROUP BY 1, 2),
{x}gaps AS (SELECT feature, abs(sum(r) OVER w / n_ref - sum(c) OVER w / n_cur) AS gap, n_ref, n_cur
    FROM {x}steps JOIN {x}sizes USING (feature)
    WINDOW w AS (PARTITION BY feature ORDER BY value)),
{x}ks0 AS (SELECT feature, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
    max(gap) AS ks_statistic FROM {x}gaps GROUP BY ALL),
{x}ks AS (SELECT *, CASE WHEN lam < 0.2 THEN 1e0 ELSE least(1e0, greatest(0e0,
      list_sum(list_transform(range(1, 101),
        lambda i: (CASE WHEN i % 2 = 1 THEN 2e0 ELSE -2e0 END) * exp(-2e0 * i * i * lam * lam))))) END
      AS ks_pvalue
    FROM (SELECT *, sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * ks_statistic AS lam FROM {x}ks0)),
{x}words AS (SELECT * FROM ({words}) WHERE value IS NOT NULL),
{x}shares AS (SELECT feature, value, sum(ref) / any_value(n_ref) AS e,
    sum(1 - ref) / any_value(n_cur) AS a FROM {x}words JOIN (SELECT feature, sum(ref) AS n_ref,
      sum(1 - ref) AS n_cur FROM {x}words GROUP BY 1) USING (feature) GROUP BY 1, 2),
{x}psi_c AS (SELECT feature, {term} AS psi FROM {x}shares GROUP BY 1),
{x}metrics AS (
    SELECT feature, 'numeric' AS feature_type, psi, ks_statistic, ks_pvalue
    FROM {x}psi_n JOIN {x}ks USING (feature)
    UNION ALL SELECT feature, 'categorical', psi, NULL, NULL FROM {x}psi_c),
{x}verdict AS (SELECT *, drift_severity <> 'none' AS drift_detected,
    CASE WHEN feature_type = 'numeric' AND ks_statistic > 0 THEN 0.7e0 * least(psi, 1e0) + 0.3e0 *
        least(ks_statistic * (1 + (1 - least(ks_pvalue / 0.05e0, 1e0))), 1e0)
      ELSE least(psi, 1e0) END AS importance
  FROM (SELECT *, CASE WHEN psi >= 0.25 THEN 'high' WHEN psi >= 0.1 THEN 'low'
      WHEN ks_pvalue < 0.05 THEN 'low' ELSE 'none' END AS drift_severity FROM {x}metrics))"""


_SIDES = f"""sides AS (
    SELECT 1 AS ref, {COLUMNS}, churn_probability AS predictions, "Churn" AS labels
    FROM base WHERE k % 2 = 0
    UNION ALL
    SELECT 0, {COLUMNS.replace('"MonthlyCharges"', 'CAST(mc * 11 AS DOUBLE) / 1000')},
        churn_probability, "Churn" FROM base WHERE k % 2 = 1)"""
_DRIFT = f"{_SIDES}, {drift_ctes()}"
_FLOATS = ["psi", "ks_statistic", "ks_pvalue", "importance"]


def _sides(spark, folder):
    reference, current = derived.drift_sides(spark, folder)
    return reference.select(S.CUSTOMER_COLUMNS), current.select(S.CUSTOMER_COLUMNS)


@query("psi_numeric", sql("SELECT * FROM psi_n", ["psi"], _DRIFT))
def psi_numeric(spark, folder):
    return tidy(drift.psi_by_bins(*_sides(spark, folder), NUMBERS))


@query("psi_categorical", sql("SELECT * FROM psi_c", ["psi"], _DRIFT))
def psi_categorical(spark, folder):
    return tidy(drift.psi_categorical(*_sides(spark, folder), TEXTS))


@query("ks_two_sample", sql(
    "SELECT feature, n_ref, n_cur, ks_statistic, ks_pvalue FROM ks",
    ["ks_statistic", "ks_pvalue"], _DRIFT))
def ks_two_sample(spark, folder):
    return tidy(drift.ks_two_sample(drift.value_counts(*_sides(spark, folder), NUMBERS)))


# Lattice paths from (0, 0) to (n_ref, n_cur) that keep their distance below the statistic,
# one step of the reference at a time, scaled by their peak so that no count overflows.
_LATTICE = f"""{_DRIFT},
lattice AS (SELECT feature, n_ref AS n, n_cur AS m, lcm(n_ref, n_cur) AS common,
    round(ks_statistic * lcm(n_ref, n_cur)) AS bound FROM ks),
walks AS (
  SELECT feature, 0 AS i, j, (j * (common // m) < bound)::INT::DOUBLE AS paths, 0e0 AS log_scale
  FROM lattice, LATERAL (SELECT unnest(range(0, m + 1)) AS j)
  UNION ALL
  SELECT feature, i, j, paths / peak, log_scale + ln(peak) FROM (
    SELECT *, max(paths) OVER (PARTITION BY feature) AS peak FROM (
      SELECT feature, i, j, log_scale, inside * sum(paths * inside) OVER (PARTITION BY feature ORDER BY j) AS paths
      FROM (SELECT w.feature, w.i + 1 AS i, w.j, w.paths, w.log_scale,
                (abs(w.j * (l.common // l.m) - (w.i + 1) * (l.common // l.n)) < l.bound)::INT AS inside
            FROM walks w JOIN lattice l ON l.feature = w.feature WHERE w.i < l.n)))
  WHERE peak > 0),
stayed AS (SELECT l.feature, l.n, l.m, l.bound, w.paths, w.log_scale
  FROM lattice l LEFT JOIN walks w ON w.feature = l.feature AND w.i = l.n AND w.j = l.m)"""


@query("ks_exact", sql("""
    SELECT feature, n_ref, n_cur, ks_statistic, 'exact' AS ks_distribution,
        CASE WHEN bound <= 0 OR coalesce(paths, 0) = 0 THEN 1e0
          ELSE 1 - exp(ln(paths) + log_scale - (lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1))) END AS ks_pvalue
    FROM ks JOIN stayed USING (feature)""", ["ks_statistic", "ks_pvalue"], _LATTICE).replace("WITH", "WITH RECURSIVE", 1))
def ks_exact(spark, folder):
    counts = drift.value_counts(*_sides(spark, folder), NUMBERS)
    return tidy(drift.ks_two_sample(counts, method="auto"))


def _data_drift(spark, folder):
    return drift.drift_features(*_sides(spark, folder), NUMBERS, TEXTS)


@query("drift_features", sql("SELECT * FROM verdict", _FLOATS, _DRIFT))
def drift_features(spark, folder):
    return tidy(_data_drift(spark, folder))


_PREDICTION = f"{_SIDES}, {drift_ctes(['predictions'], [])}"
_LABEL = f"{_SIDES}, {drift_ctes([], ['labels'])}"


@query("drift_predictions", sql("SELECT * FROM verdict", _FLOATS, _PREDICTION))
def drift_predictions(spark, folder):
    return tidy(drift.drift_predictions(*derived.drift_sides(spark, folder)))


@query("drift_labels", sql("SELECT * FROM verdict", _FLOATS, _LABEL))
def drift_labels(spark, folder):
    return tidy(drift.drift_labels(*derived.drift_sides(spark, folder)))


@query("drift_ranking", sql(
    """SELECT feature, drift_severity, importance FROM verdict
       ORDER BY importance DESC NULLS LAST, feature LIMIT 5""", ["importance"], _DRIFT))
def drift_ranking(spark, folder):
    ranked = drift.rank_features(_data_drift(spark, folder), 5)
    return tidy(ranked.select("feature", "drift_severity", "importance"))


@query("drift_top", sql(
    "SELECT feature, psi, drift_severity FROM verdict ORDER BY psi DESC, feature LIMIT 20",
    ["psi"], _DRIFT))
def drift_top(spark, folder):
    return tidy(drift.top_psi(_data_drift(spark, folder)).select("feature", "psi", "drift_severity"))


@query("drift_enriched", sql(
    """SELECT feature, psi, drift_severity,
       CASE WHEN feature = 'tenure' THEN 'Months with the company' END AS description,
       CASE WHEN feature = 'tenure' THEN 'retention' END AS owner FROM verdict""",
    ["psi"], f"{_DRIFT}, {_CATALOGUE}"))
def drift_enriched(spark, folder):
    from stayline.operators.features import feature_catalogue, latest_version

    catalogue = feature_catalogue(
        derived.snapshots(spark, folder), *CATALOGUED, metadata=_described(spark)
    )
    enriched = drift.enrich(_data_drift(spark, folder), latest_version(catalogue))
    return tidy(enriched.select("feature", "psi", "drift_severity", "description", "owner"))


_SUMMARY = f"""{_SIDES}, {drift_ctes()}, {drift_ctes(['predictions'], [], 'p_')},
{drift_ctes([], ['labels'], 'l_')},
kinds AS (SELECT 'data' AS kind, drift_detected AS d, drift_severity AS s FROM verdict
    UNION ALL SELECT 'prediction', drift_detected, drift_severity FROM p_verdict
    UNION ALL SELECT 'label', drift_detected, drift_severity FROM l_verdict),
summary AS (SELECT count(*) FILTER (kind = 'data') AS features_checked,
    count(*) FILTER (kind = 'data' AND d) AS features_with_drift,
    {", ".join(f"count(*) FILTER ((kind = 'data' OR d) AND s = '{v}') AS severity_{v}" for v in S.SEVERITIES)},
    bool_or(d) AS overall_drift,
    coalesce(bool_or(d) FILTER (kind = 'prediction'), false) AS prediction_drift,
    coalesce(bool_or(d) FILTER (kind = 'label'), false) AS label_drift,
    CASE max(CASE s WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END)
      WHEN 3 THEN 'high' WHEN 2 THEN 'medium' WHEN 1 THEN 'low' ELSE 'none' END AS max_severity
  FROM kinds)"""


def _summary(spark, folder):
    sides = derived.drift_sides(spark, folder)
    return drift.drift_summary(drift.drift_report(
        *sides, predictions=sides, labels=sides, numeric=NUMBERS, categorical=TEXTS
    ))


@query("drift_summary", sql("SELECT * FROM summary", ctes=_SUMMARY))
def drift_summary(spark, folder):
    return _summary(spark, folder)


@query("drift_top_drifted", sql(
    """SELECT feature, importance FROM (SELECT * FROM verdict
       ORDER BY importance DESC NULLS LAST, feature LIMIT 10) WHERE drift_detected""",
    ["importance"], _DRIFT))
def drift_top_drifted(spark, folder):
    return tidy(drift.top_drifted(_data_drift(spark, folder)).select("feature", "importance"))


@query("score_histogram", sql(
    histogram_sql(30, "side, ", density=True), ["bin_start", "density"],
    f"""{_SIDES}, long AS (SELECT CASE ref WHEN 1 THEN 'reference' ELSE 'current' END AS side,
        'predictions' AS feature, predictions AS value FROM sides)"""))
def score_histogram(spark, folder):
    reference, current = derived.drift_sides(spark, folder)
    both = reference.select(
        F.lit("reference").alias("side"), F.col("churn_probability").alias("predictions")
    ).unionByName(
        current.select(
            F.lit("current").alias("side"), F.col("churn_probability").alias("predictions")
        )
    )
    return tidy(profile.histogram(both, ["predictions"], 30, ["side"], density=True))


# --- performance -------------------------------------------------------------------------

_PERIODS = f"""
periods AS (SELECT CAST(k % 12 AS INT) AS period, ("Churn" = 'Yes')::INT AS label,
    churn_probability AS score FROM base),
{evaluation_ctes("period", "periods")},
history AS (SELECT basic.*, roc_auc, 0.5e0 AS prediction_threshold,
    printf('2024%02d01T000000Z', period + 1) AS timestamp
  FROM basic JOIN areas USING (period)),
baseline AS (SELECT * FROM history WHERE period = 0),
compared AS (SELECT h.period, h.sample_size, h.roc_auc, h.accuracy, h.f1, h.precision, h.recall,
    b.roc_auc AS baseline_roc_auc, b.accuracy AS baseline_accuracy, b.f1 AS baseline_f1,
    b.precision AS baseline_precision, b.recall AS baseline_recall,
    b.roc_auc - h.roc_auc AS roc_auc_drop, b.accuracy - h.accuracy AS accuracy_drop,
    b.f1 - h.f1 AS f1_drop FROM history h, baseline b),
judged AS (SELECT * EXCLUDE (worst), worst IS NOT NULL AS degraded,
    CASE WHEN worst IS NULL THEN 'none' WHEN worst < 0.05 THEN 'low' WHEN worst < 0.15 THEN 'medium'
         ELSE 'high' END AS severity
  FROM (SELECT *, greatest(CASE WHEN roc_auc_drop > 0.05e0 THEN roc_auc_drop END,
      CASE WHEN accuracy_drop > 0.05e0 THEN accuracy_drop END,
      CASE WHEN f1_drop > 0.05e0 THEN f1_drop END) AS worst FROM compared))"""
_METRICS = ["roc_auc", "accuracy", "f1", "precision", "recall"]
_ROUNDED = [*_METRICS, *[f"baseline_{m}" for m in _METRICS], "roc_auc_drop", "accuracy_drop", "f1_drop"]


def _perf(spark, folder):
    base = derived.customer_base(spark, folder)
    scores = base.select(
        S.ID, F.col("churn_probability").alias("score"), (F.col("k") % 12).cast("int").alias("period")
    )
    labels = derived.customers(spark, folder).select(
        S.ID, (F.col(S.TARGET) == "Yes").cast("int").alias("label")
    )
    return performance.perf_metrics(performance.aligned(scores, labels), ["period"])


@query("perf_metrics", sql(
    "SELECT * EXCLUDE (timestamp) FROM history", [*_METRICS, "prediction_threshold"], _PERIODS))
def perf_metrics(spark, folder):
    return tidy(_perf(spark, folder))


def _compared(spark, folder):
    """Every period against the first one."""
    metrics = _perf(spark, folder)
    return performance.compare(metrics, metrics.where("period = 0"), keep=["period"])


@query("perf_degradation", sql("SELECT * FROM judged", _ROUNDED, _PERIODS))
def perf_degradation(spark, folder):
    return tidy(_compared(spark, folder))


@query("perf_compare", sql(f"""
    SELECT * FROM ({" UNION ALL ".join(
        f"SELECT period, '{m}' AS metric, baseline_{m} AS baseline, {m} AS current FROM judged"
        for m in _METRICS)}) WHERE baseline IS NOT NULL AND current IS NOT NULL""",
    ["baseline", "current"], _PERIODS))
def perf_compare(spark, folder):
    return tidy(performance.compare_long(_compared(spark, folder), ["period"]))


def _history(spark, folder):
    stamp = F.format_string("2024%02d01T000000Z", F.col("period") + 1)
    return _perf(spark, folder).withColumn("timestamp", stamp).drop("period")


@query("perf_history", sql(
    "SELECT * EXCLUDE (period) FROM history ORDER BY timestamp DESC LIMIT 6",
    [*_METRICS, "prediction_threshold"], _PERIODS))
def perf_history(spark, folder):
    rows = _history(spark, folder)
    old = rows.where("timestamp < '20241001T000000Z'")
    return tidy(performance.append_history(old, rows.where("timestamp >= '20241001T000000Z'"), n=6))


@query("perf_trend", sql(f"""
    SELECT timestamp, strptime(timestamp, '%Y%m%dT%H%M%SZ')::DATE::VARCHAR AS day, {", ".join(_METRICS)},
        {", ".join(f"{m} - lag({m}) OVER (ORDER BY timestamp) AS {m}_change" for m in _METRICS)}
    FROM history""", [*_METRICS, *[f"{m}_change" for m in _METRICS]], _PERIODS))
def perf_trend(spark, folder):
    trend = performance.perf_trend(_history(spark, folder))
    return tidy(trend.withColumn("day", F.col("at").cast("date").cast("string")).drop("at"))


@query("promotion", sql("""
    SELECT model_version, roc_auc, CASE WHEN roc_auc < 0.7 OR roc_auc IS NULL THEN 'skipped'
        WHEN model_version = max(CASE WHEN roc_auc >= 0.7 THEN model_version END) OVER ()
        THEN 'production' ELSE 'archived' END AS status
    FROM (SELECT period AS model_version, roc_auc FROM history)""", ["roc_auc"], _PERIODS))
def promotion(spark, folder):
    versions = derived.customer_base(spark, folder).select(
        (F.col("k") % 12).cast("int").alias("model_version"),
        (F.col(S.TARGET) == "Yes").cast("int").alias("label"),
        F.col("churn_probability").alias("score"),
    )
    return tidy(performance.promotion(versions, min_auc=0.7))


# --- alerts ------------------------------------------------------------------------------

@query("alerts_drift", sql("""
    SELECT 'Data Drift Detected' AS title, 'Drift detected with severity: ' || max_severity
        || chr(10) || 'Features with drift: ' || features_with_drift || '/' || features_checked || chr(10)
        || CASE WHEN prediction_drift THEN 'Prediction drift detected' || chr(10) ELSE '' END
        || CASE WHEN label_drift THEN 'Label drift detected' || chr(10) ELSE '' END AS message,
        CASE max_severity WHEN 'high' THEN 'high' ELSE 'medium' END AS severity
    FROM summary WHERE overall_drift AND max_severity <> 'none'""", ctes=_SUMMARY))
def alerts_drift(spark, folder):
    return alerts.drift_alerts(_summary(spark, folder)).drop("metadata")


_ALERTS = """SELECT period, 'Model Performance Degradation Detected' AS title, severity
    FROM judged WHERE degraded AND severity IN ('medium', 'high')"""


@query("alerts_perf", sql(_ALERTS, ctes=_PERIODS))
def alerts_perf(spark, folder):
    found = alerts.performance_alerts(_compared(spark, folder), "medium", ["period"])
    return found.select("period", "title", "severity")


@query("alert_log", sql(f"SELECT * FROM ({_ALERTS}) ORDER BY period DESC LIMIT 3", ctes=_PERIODS))
def alert_log(spark, folder):
    found = alerts.performance_alerts(_compared(spark, folder), "medium", ["period"])
    return alerts.alert_log(found, [F.desc("period")], 3).select("period", "title", "severity")
