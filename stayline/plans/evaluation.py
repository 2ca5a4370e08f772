"""Queries of model evaluation over the scores of three models."""

from pyspark.sql import functions as F

from stayline.operators import metrics, splits
from stayline.plans.common import sql, tidy
from stayline.sources import derived

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


MODELS = """
models AS (
    SELECT 'scorecard' AS model, "customerID", ("Churn" = 'Yes')::INT AS label,
        churn_probability AS score FROM base
    UNION ALL SELECT 'tenure_rule', "customerID", ("Churn" = 'Yes')::INT,
        CAST(72 - tenure AS DOUBLE) / 72 FROM base
    UNION ALL SELECT 'charge_rule', "customerID", ("Churn" = 'Yes')::INT,
        "MonthlyCharges" / 120 FROM base)
"""


def evaluation_ctes(by="model", source="models", threshold=0.5):
    """Common tables `basic`, `points`, `areas` per group of a (by, label, score) source."""
    return f"""
counts AS (SELECT {by}, count(*) AS n,
    count(*) FILTER (score >= {threshold} AND label = 1) AS tp,
    count(*) FILTER (score >= {threshold} AND label = 0) AS fp,
    count(*) FILTER (score < {threshold} AND label = 0) AS tn,
    count(*) FILTER (score < {threshold} AND label = 1) AS fn FROM {source} GROUP BY ALL),
basic AS (SELECT {by}, n AS sample_size, (tp + tn) / n AS accuracy,
    coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM counts),
per_score AS (SELECT {by}, score, count(*) FILTER (label = 1) AS pos,
    count(*) FILTER (label = 0) AS neg FROM {source} GROUP BY ALL),
points AS (SELECT *,
    sum(pos) OVER (PARTITION BY {by} ORDER BY score DESC) AS tp,
    sum(neg) OVER (PARTITION BY {by} ORDER BY score DESC) AS fp,
    sum(pos) OVER (PARTITION BY {by}) AS p, sum(neg) OVER (PARTITION BY {by}) AS q FROM per_score),
areas AS (SELECT {by},
    sum(pos * (q - fp + neg / 2)) / nullif(max(p) * max(q), 0) AS roc_auc,
    sum(pos / p * (tp / (tp + fp) + coalesce((tp - pos) / nullif(tp + fp - pos - neg, 0), 1)) / 2)
        AS pr_auc FROM points GROUP BY ALL)"""


_EVAL = f"{MODELS}, {evaluation_ctes()}"


@query("classification_metrics", sql(
    "SELECT * FROM basic", ["accuracy", "precision", "recall", "f1"], _EVAL))
def classification_metrics(spark, folder):
    return tidy(metrics.classification_metrics(derived.model_scores(spark, folder), ["model"]))


@query("roc_auc", sql("SELECT model, roc_auc FROM areas", ["roc_auc"], _EVAL))
def roc_auc(spark, folder):
    return tidy(metrics.roc_auc(derived.model_scores(spark, folder), ["model"]))


@query("pr_auc", sql("SELECT model, pr_auc FROM areas", ["pr_auc"], _EVAL))
def pr_auc(spark, folder):
    return tidy(metrics.pr_auc(derived.model_scores(spark, folder), ["model"]))


@query("roc_curve", sql(
    "SELECT model, score AS threshold, fp / q AS fpr, tp / p AS tpr FROM points",
    ["threshold", "fpr", "tpr"], _EVAL))
def roc_curve(spark, folder):
    return tidy(metrics.roc_curve(derived.model_scores(spark, folder), ["model"]))


@query("pr_curve", sql(
    "SELECT model, score AS threshold, tp / p AS recall, tp / (tp + fp) AS precision FROM points",
    ["threshold", "recall", "precision"], _EVAL))
def pr_curve(spark, folder):
    return tidy(metrics.pr_curve(derived.model_scores(spark, folder), ["model"]))


_RANKED = f"""{MODELS}, ranked AS (SELECT *, count(*) OVER (PARTITION BY model) AS size,
    sum(label) OVER (PARTITION BY model) AS positives,
    row_number() OVER (PARTITION BY model ORDER BY score DESC, "customerID") AS r FROM models)"""


@query("topk_metrics", sql("""
    SELECT model, percent, CAST(any_value(size * percent // 100) AS BIGINT) AS k,
        count(*) FILTER (r <= size * percent // 100 AND label = 1) / any_value(size * percent // 100)
            AS precision_at_k,
        count(*) FILTER (r <= size * percent // 100 AND label = 1) / any_value(positives)
            AS recall_at_k
    FROM ranked, (VALUES (10), (20), (30)) t(percent) GROUP BY ALL""",
    ["precision_at_k", "recall_at_k"], _RANKED))
def topk_metrics(spark, folder):
    return tidy(metrics.topk_metrics(
        derived.model_scores(spark, folder), "customerID", ["model"]
    ))


@query("lift_deciles", sql("""
    SELECT model, CAST((r - 1) * 10 // size + 1 AS INT) AS decile, count(*) AS n,
        CAST(sum(label) AS BIGINT) AS positives, sum(label) / count(*) AS rate,
        sum(label) / count(*) / (any_value(positives) / any_value(size)) AS lift
    FROM ranked GROUP BY 1, 2""", ["rate", "lift"], _RANKED))
def lift_deciles(spark, folder):
    return tidy(metrics.lift_deciles(
        derived.model_scores(spark, folder), "customerID", ["model"]
    ))


@query("calibration_curve", sql(f"""
    SELECT model, CAST({" + ".join(f"(score > {i / 10}e0)::INT" for i in range(1, 10))} AS INT) AS bin,
        count(*) AS n, avg(score) AS mean_score, avg(label) AS positive_rate
    FROM models GROUP BY 1, 2""", ["mean_score", "positive_rate"], _EVAL))
def calibration_curve(spark, folder):
    return tidy(metrics.calibration_curve(derived.model_scores(spark, folder), ["model"]))


@query("confusion_matrix", sql("""
    SELECT model, 0 AS label, 0 AS predicted, tn AS n FROM counts
    UNION ALL SELECT model, 0, 1, fp FROM counts UNION ALL SELECT model, 1, 0, fn FROM counts
    UNION ALL SELECT model, 1, 1, tp FROM counts""", ctes=_EVAL))
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(derived.model_scores(spark, folder), ["model"])


@query("classification_report", sql("""
    SELECT model, t.* FROM r, LATERAL (VALUES ('0', p0, r0, f0, s0), ('1', p1, r1, f1, s1),
        ('accuracy', acc, acc, acc, n),
        ('macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ('weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n))
        t(class, precision, recall, f1, support)""", ["precision", "recall", "f1"], f"""{_EVAL},
    r AS (SELECT model, n, tn + fp AS s0, tp + fn AS s1, (tp + tn) / n AS acc,
        coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
        coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
        coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM counts)"""))
def classification_report(spark, folder):
    return tidy(metrics.classification_report(derived.model_scores(spark, folder), ["model"]))


_BY_SPLIT = f"""
split_scores AS (SELECT ("Churn" = 'Yes')::INT AS label, churn_probability AS score,
    CASE WHEN CAST('0x' || substr(md5(concat("customerID", '|42')), 1, 8) AS BIGINT) % 10000 < 2000
         THEN 'test' WHEN CAST('0x' || substr(md5(concat("customerID", '|42')), 1, 8) AS BIGINT)
         % 10000 < 3600 THEN 'validation' ELSE 'train' END AS split FROM base),
{evaluation_ctes("split", "split_scores")}"""
_ALL = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


@query("eval_by_split", sql(
    "SELECT * FROM basic JOIN areas USING (split)", _ALL, _BY_SPLIT))
def eval_by_split(spark, folder):
    rows = derived.model_scores(spark, folder).where("model = 'scorecard'")
    return tidy(metrics.evaluate(splits.stratified_split(rows, label="label"), ["split"]))


@query("best_model", sql(
    "SELECT * FROM basic JOIN areas USING (model) ORDER BY roc_auc DESC, model DESC LIMIT 1",
    _ALL, _EVAL))
def best_model(spark, folder):
    return tidy(metrics.best_model(derived.model_scores(spark, folder)))
