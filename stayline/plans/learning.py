"""Queries that fit models on the feature table. Only their rows can be checked."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import explain, features, isotonic, learn, metrics, scoring, splits
from stayline.plans.common import SLOT, sql, tidy
from stayline.session import checkpointed
from stayline.sources import derived

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


def _parts(spark, folder):
    """(train, test, feature names): fitted on the training customers only, written once."""
    split = splits.stratified_split(derived.customers(spark, folder))
    model = features.fit_features(
        split.where(F.col("split") != "test"), handle_unknown="ignore"
    )
    matrix = model.transform(split, keep=[S.ID, S.TARGET, "split"])
    rows = checkpointed(
        learn.VectorAssembler(inputCols=model.features, outputCol="features")
        .transform(matrix)
        .select(S.ID, "label", "split", "features")
    )
    return rows.where("split <> 'test'").drop("split"), rows.where("split = 'test'").drop("split"), model.features


def _evaluated(scores):
    return tidy(metrics.evaluate(scores, ["model"]))


@query("train_baseline")
def train_baseline(spark, folder):
    train, test, _ = _parts(spark, folder)
    return _evaluated(learn.scores(learn.fit_baseline(train), test, "baseline"))


_TESTED = f"""SELECT count(*) FROM customers WHERE "Churn" IS NOT NULL AND {SLOT} < 2000"""


@query("baseline_facts", sql(f"""
    SELECT ({_TESTED}) AS scored, 0 AS outside, true AS converged, true AS better_than_chance"""))
def baseline_facts(spark, folder):
    """What must hold for the baseline's fit and its scores of the test rows."""
    train, test, _ = _parts(spark, folder)
    model = learn.fit_baseline(train)
    scores = checkpointed(learn.scores(model, test, "baseline"))
    wrong = F.col("score").isNull() | ~F.col("score").between(0, 1)
    auc = metrics.roc_auc(scores).scalar()
    return scores.agg(F.count(F.lit(1)).alias("scored"), F.sum(wrong.cast("int")).cast("int").alias("outside")).select(
        "scored", "outside", F.lit(learn.gradient_size(model, train) < 1e-4).alias("converged"),
        (auc > 0.5).alias("better_than_chance"))


@query("importance_facts", sql("""
    SELECT 'forest' AS model, 1e0 AS total, 0 AS negative, 0 AS differs
    UNION ALL SELECT 'baseline', 1e0, 0, 0"""))
def importance_facts(spark, folder):
    """Importances of the forest sum to 1; those of the baseline, as shares, are its coefficients' sizes."""
    train, _, names = _parts(spark, folder)
    forest = explain.tree_importance(spark, learn.fit(learn.random_forest(), train), names)
    linear = explain.coefficient_importance(spark, learn.fit_baseline(train), names)
    rows = forest.select(F.lit("forest").alias("model"), "importance", F.lit(0).alias("off")).unionByName(linear.select(
        F.lit("baseline").alias("model"), (F.col("importance") / linear.agg(F.sum("importance")).scalar()).alias("importance"),
        (F.abs("coefficient") != F.col("importance")).cast("int").alias("off")))
    return tidy(rows.groupBy("model").agg(
        F.sum("importance").alias("total"), F.sum((F.col("importance") < 0).cast("int")).cast("int").alias("negative"),
        F.sum("off").cast("int").alias("differs")))


@query("isotonic_curve", sql("""
    SELECT bp / 10000 AS raw, max(lowest) AS fitted FROM (
      SELECT b.bp, min((b.t1 - a.t1 + a.t) / (b.w1 - a.w1 + a.w)) OVER (PARTITION BY a.bp ORDER BY b.bp DESC) AS lowest
      FROM sums a JOIN sums b ON a.bp <= b.bp) GROUP BY bp""", ["raw", "fitted"], """
    sums AS (SELECT bp, w, t, sum(w) OVER (ORDER BY bp) AS w1, sum(t) OVER (ORDER BY bp) AS t1
      FROM (SELECT bp, count(*) AS w, sum(("Churn" = 'Yes')::INT) AS t FROM base GROUP BY bp))"""))
def isotonic_curve(spark, folder):
    """The rising curve through the outcomes over the scorecard's probabilities."""
    rows = derived.customer_base(spark, folder).select(
        F.col("churn_probability").alias("raw"), (F.col(S.TARGET) == "Yes").cast("int").alias("label"))
    curve = isotonic.blocks(rows)
    return tidy(isotonic.apply_curve(rows.select("raw").distinct(), curve, name="fitted"))


@query("calibrate")
def calibrate(spark, folder):
    train, test, _ = _parts(spark, folder)
    scores = learn.calibrated_scores(train, test)
    return tidy(metrics.calibration_curve(scores))


@query("train_gbt")
def train_gbt(spark, folder):
    """Up to 1,000 rounds; `rounds` says after how many the loss on held rows was lowest."""
    train, test, _ = _parts(spark, folder)
    model, rounds = learn.fit_boosted(train)
    # Scored once: the metrics read the scores several times.
    scores = checkpointed(learn.scores(model, test, "boosted"))
    return _evaluated(scores).withColumn("rounds", F.lit(rounds))


@query("cross_validation")
def cross_validation(spark, folder):
    train, _, _ = _parts(spark, folder)
    estimator = learn.baseline(train)
    return tidy(learn.fold_summary(learn.cross_validated(estimator, train, name="baseline")))


@query("rf_importance")
def rf_importance(spark, folder):
    train, _, names = _parts(spark, folder)
    return tidy(explain.tree_importance(spark, learn.fit(learn.random_forest(), train), names))


@query("train_mlp")
def train_mlp(spark, folder):
    train, test, names = _parts(spark, folder)
    # The perceptron knows no weights, so the smaller class is repeated instead.
    even = checkpointed(splits.oversample(train, [], method="duplicate").drop("synthetic"))
    model = learn.perceptron(len(names)).fit(even)
    return _evaluated(learn.scores(model, test, "perceptron"))


@query("tune")
def tune(spark, folder):
    """Boosted trees by successive halving: what every trial reached, and why it ended."""
    train, _, _ = _parts(spark, folder)
    trials, _ = learn.halving_search(
        learn.boosted_trees(), train,
        {"maxDepth": [3, 4, 5, 6], "maxIter": [10, 20, 40], "stepSize": (0.01, 0.3),
         "subsamplingRate": [0.6, 0.8, 1.0], "minInstancesPerNode": [1, 3, 10]},
    )
    return tidy(spark.createDataFrame(trials, learn.TRIAL_COLUMNS).drop("params"))


@query("coef_importance")
def coef_importance(spark, folder):
    train, _, names = _parts(spark, folder)
    return tidy(explain.coefficient_importance(spark, learn.fit_baseline(train), names))


@query("score_batch")
def score_batch(spark, folder):
    train, test, _ = _parts(spark, folder)
    return tidy(scoring.score_model(learn.fit_baseline(train), test))


@query("explain_model")
def explain_model(spark, folder):
    train, test, names = _parts(spark, folder)
    model = learn.fit_baseline(train)
    found = explain.sampled_contributions(model, test, names)
    return tidy(explain.global_importance(found, top=20))
