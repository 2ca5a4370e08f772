"""Churn scoring of whole tables, with a scorecard and with fitted models."""

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.features import service_count
from stayline.operators.quality import split_valid, with_errors

THRESHOLD = 0.5


@dataclass(frozen=True)
class LinearScore:
    """Clamped weighted sum of number columns."""

    weights: dict
    intercept: float = 0.0
    low: float = 0.0
    high: float = 1.0

    def column(self):
        total = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            total = total + F.col(name) * float(weight)
        return F.greatest(F.lit(self.low), F.least(F.lit(self.high), total))


# Points per term, in basis points of probability.
CONTRACT_POINTS = {"Month-to-month": 5500, "One year": 2500, "Two year": 1000}
SCORECARD = LinearScore(
    weights={"contract_points": 1, "tenure": -83, "charge_points": 1, "service_count": -200},
    intercept=788, low=200, high=9800,
)


def scorecard_terms(customers, keep=()):
    """The four number columns the scorecard weighs, next to the id and the kept columns."""
    points = F.create_map(*[F.lit(x) for kv in CONTRACT_POINTS.items() for x in kv])
    cents = F.round(F.col("MonthlyCharges") * 100).cast("bigint")
    return customers.select(
        *keep,
        S.ID,
        points[F.col("Contract")].cast("double").alias("contract_points"),
        F.col("tenure").cast("double").alias("tenure"),
        F.floor(cents * 2 / 5).cast("double").alias("charge_points"),
        service_count().cast("double").alias("service_count"),
    )


def scorecard_probability():
    return SCORECARD.column() / 10000


def decided(df, threshold=THRESHOLD):
    """customerID, churn_probability, churn_prediction, threshold."""
    return df.select(
        S.ID, "churn_probability",
        (F.col("churn_probability") >= threshold).alias("churn_prediction"),
        F.lit(float(threshold)).alias("threshold"),
    )


def score_scorecard(customers, threshold=THRESHOLD):
    scored = scorecard_terms(customers).withColumn("churn_probability", scorecard_probability())
    return decided(scored, threshold)


def score_model(model, rows, threshold=THRESHOLD):
    """Score feature rows with a fitted model; the whole table in one pass."""
    probability = vector_to_array("probability")[1]
    scored = model.transform(rows).withColumn("churn_probability", probability)
    return decided(scored, threshold)


def score_with_rejects(customers, score=score_scorecard):
    """(scored, rejected): rows that break the contract are set aside, not dropped silently."""
    valid, broken = split_valid(customers)
    return score(valid), broken.select(S.ID, F.array_join("errors", "; ").alias("error"))


def score_totals(customers):
    """All rows, scored rows and rejected rows in one pass."""
    bad = F.sum((F.size("errors") > 0).cast("bigint"))
    n = F.count(F.lit(1))
    return with_errors(customers).agg(
        n.alias("total_customers"),
        F.coalesce(n - bad, F.lit(0)).alias("scored"),
        F.coalesce(bad, F.lit(0)).alias("rejected"),
    )


def require_some_scored(totals):
    row = totals.first()
    if row.total_customers and not row.scored:
        raise ValueError(f"all {row.total_customers} rows failed validation")
