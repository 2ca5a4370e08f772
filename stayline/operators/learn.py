"""Model training on the feature table with Spark ML estimators."""

import random
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import isotonic, metrics
from stayline.operators.splits import class_weights, hash_number, kfold

# Fixed values.
MAX_ITER = 1000
TRIALS = 20
ROUNDS = 1000
SEARCH_SECONDS = 1800
TASK_ROWS = 500_000
SPREAD_ROWS = 20_000
FOLD_ROUNDS = 10

#: Shares of the training rows that the rounds of a search use.
FRACTIONS = (1 / 9, 1 / 3, 1.0)


def assemble(matrix, features):
    """id, label and one vector of all features."""
    return VectorAssembler(inputCols=features, outputCol="features").transform(matrix).select(
        S.ID, "label", "features"
    )


def with_balance(rows, label="label"):
    """Add the weight n / (2 * n_class); two rows of weights are read on the driver."""
    weights = {r.label: r.weight for r in class_weights(rows, label).collect()}
    chain = F.lit(1.0)
    for value, weight in weights.items():
        chain = F.when(F.col(label) == value, weight).otherwise(chain)
    return rows.withColumn("class_weight", chain)


def baseline(rows, weight="class_weight", max_iter=MAX_ITER):
    """Class-balanced logistic regression.

    The balanced weights sum to the row count, so 1/n is the penalty of a unit inverse
    regularisation strength.
    """
    return LogisticRegression(
        weightCol=weight, maxIter=max_iter, regParam=1.0 / rows.count(), standardization=False
    )


def fit_baseline(rows, max_iter=MAX_ITER):
    weighted = with_balance(rows).cache()
    try:
        return baseline(weighted, max_iter=max_iter).fit(weighted)
    finally:
        weighted.unpersist()


def gradient_size(model, rows):
    """Largest absolute derivative of the baseline's loss at its fit; near 0 where it converged.

    The loss is the weighted mean log loss plus the penalty, as in `baseline`.
    """
    weighted = with_balance(rows)
    error = (vector_to_array("probability")[1] - F.col("label")) * F.col("class_weight")
    # The constant feature 1 stands for the intercept, which has no penalty.
    entries = F.posexplode(F.concat(F.array(F.lit(1.0)), vector_to_array("features"))).alias("i", "x")
    scored = model.transform(weighted).select(error.alias("error"), "class_weight", entries)
    sums = scored.groupBy("i").agg((F.sum(F.col("error") * F.col("x")) / F.sum("class_weight")).alias("slope"))
    # One row per feature.
    penalty = [0.0, *(model.getRegParam() * float(c) for c in model.coefficients)]
    return max(abs(r.slope + penalty[r.i]) for r in sums.collect())


def boosted_trees(seed=42, **params):
    options = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, **params}
    return GBTClassifier(seed=seed, weightCol="class_weight", **options)


def held_share(rows, share, name, key=S.ID):
    """Add `held`: whether a row belongs to a share of the rows set by a named hash of its key."""
    return rows.withColumn("held", hash_number(F.col(key), F.lit(name)) < int(10000 * share))


def in_few_tasks(rows):
    """`rows` in at most two partitions a core, and more only beyond `TASK_ROWS` rows in each.

    Boosting runs a job for each level of each round; many short tasks would take longer to
    start than to run. Rows that lie in fewer partitions than cores, or most of them in a few, are
    dealt out again once a partition has more than `SPREAD_ROWS` and twice its share.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # One row per partition.
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    total = sum(sizes)
    if max(sizes, default=0) > max(SPREAD_ROWS, 2 * total / cores):
        return rows.repartition(max(min(cores, -(-total // SPREAD_ROWS)), -(-total // TASK_ROWS)))
    return rows.coalesce(max(2 * cores, -(-total // TASK_ROWS)))


def chosen_rounds(losses, rounds, patience):
    """Rounds up to the lowest loss, or None where more losses are needed to tell.

    Looks at the first 2 * `patience` losses, then at twice as many each time, until the lowest
    of them lies `patience` rounds back or all `rounds` are looked at.
    """
    tried = min(rounds, 2 * patience)
    while tried <= len(losses):
        best = 1 + min(range(tried), key=losses.__getitem__)
        if best + patience <= tried or tried == rounds:
            return best
        tried = min(rounds, 2 * tried)
    return None


def _tree_arrays(trees, weights):
    """Java arrays of fitted trees and their weights, from which a boosted model is made."""
    context = SparkContext._active_spark_context
    kind, number = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, context._jvm.double
    arrays = [context._gateway.new_array(x, len(trees)) for x in (kind, number)]
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        arrays[0][i], arrays[1][i] = tree._java_obj, weight
    return arrays


def with_trees(model, trees, weights):
    """The boosted model `model` with other trees."""
    kind = SparkContext._active_spark_context._jvm.org.apache.spark.ml.classification.GBTClassificationModel
    made = GBTClassificationModel(kind(model.uid, *_tree_arrays(trees, weights)))
    model._copyValues(made, {model.maxIter: len(trees)})
    made._transfer_params_to_java()
    return made


def first_rounds(model, rounds):
    """The boosted model of the first `rounds` trees of `model`, as a fit of so many rounds gives."""
    return with_trees(model, model.trees[:rounds], model.treeWeights[:rounds])


def margin_of(trees, weights, rows, features):
    """Add `prediction`: the weighted sum of what the trees predict."""
    kind = SparkContext._active_spark_context._jvm.org.apache.spark.ml.regression.GBTRegressionModel
    return GBTRegressionModel(kind("margin", *_tree_arrays(trees, weights))).setFeaturesCol(features).transform(rows)


def draws(estimator):
    """Whether trees draw rows or features, by seeds that only Spark's own loop knows."""
    return estimator.getSubsamplingRate() < 1 or estimator.getFeatureSubsetStrategy() != "all"


def more_rounds(model, estimator, rows, rounds):
    """`model`, fitted by `estimator` with fewer rounds on `rows`, boosted on to `rounds` rounds.

    A round fits a regression tree to the slope 4y / (1 + exp(2yF)) of the log loss, for a class y
    of -1 or 1 and the margin F of the trees so far, and adds it with the step size: what
    `GBTClassifier` does where its trees draw neither rows nor features (`draws`), with the same
    seed and so the same candidates for splits. The margins of all but the last `FOLD_ROUNDS`
    trees are kept with the rows.
    """
    features, weight = estimator.getFeaturesCol(), estimator.getWeightCol()
    learner = estimator._copyValues(DecisionTreeRegressor()).setLabelCol("slope")
    trees, weights = list(model.trees), list(model.treeWeights)
    sign, margin = F.col("sign"), F.col("margin")
    slope = (4 * sign / (1 + F.exp(2 * sign * margin))).alias("slope")
    base = rows.select(features, weight, (2.0 * F.col(estimator.getLabelCol()) - 1).alias("sign"), F.lit(0.0).alias("margin"))
    folded, kept = 0, []
    try:
        while len(trees) < rounds:
            now = margin_of(trees[folded:], weights[folded:], base, features).select(
                features, weight, sign, (margin + F.col("prediction")).alias("margin")) if folded < len(trees) else base
            if not folded or len(trees) - folded == FOLD_ROUNDS:
                base, folded = now.cache(), len(trees)
                kept.append(base)
                now = base
            trees.append(learner.fit(now.select(features, weight, slope)))
            weights.append(estimator.getStepSize())
            # The fit has filled the newest; it is made from the one before.
            while len(kept) > 1:
                kept.pop(0).unpersist()
    finally:
        for part in kept:
            part.unpersist()
    return with_trees(model, trees, weights)


def fit_boosted(rows, rounds=ROUNDS, held=0.15, patience=50, seed=42, **params):
    """Boosted trees whose rounds are chosen by the loss on held rows: (model, rounds).

    A share `held` of the rows trains nothing; the loss on it is measured after each round, and
    `chosen_rounds` decides. 2 * `patience` rounds are fitted first and, until these decide, as
    many more after them (`more_rounds`). A round costs about twice as much there, so beyond
    8 * `patience` rounds, and where trees draw, all `rounds` are fitted at once. Trees depend on
    the earlier ones only, so the model of the chosen rounds is the start of the longer one.
    """
    parts = in_few_tasks(held_share(with_balance(rows), held, f"boosting-{seed}")).cache()
    train, test = parts.where("not held"), parts.where("held")
    step = min(rounds, 2 * patience)
    try:
        model = boosted_trees(seed, maxIter=step, **params).fit(train)
        best = chosen_rounds(model.evaluateEachIteration(test), rounds, patience)
        longest = None if best else boosted_trees(seed, maxIter=rounds, **params)
        while not best:
            tried = model.getNumTrees
            if tried < 8 * patience and not draws(longest):
                model = more_rounds(model, longest, train, min(rounds, tried + step))
            else:
                model = longest.fit(train)
            best = chosen_rounds(model.evaluateEachIteration(test), rounds, patience)
        return first_rounds(model, best), best
    finally:
        parts.unpersist()


def random_forest(seed=42, trees=100, depth=10):
    return RandomForestClassifier(seed=seed, numTrees=trees, maxDepth=depth)


def perceptron(n_features, hidden=(64, 32), seed=42, max_iter=100):
    return MultilayerPerceptronClassifier(
        layers=[n_features, *hidden, 2], seed=seed, maxIter=max_iter
    )


def fit(estimator, rows):
    """Fit any estimator on balanced rows."""
    weighted = with_balance(rows).cache()
    try:
        return estimator.fit(weighted)
    finally:
        weighted.unpersist()


def scores(model, rows, name="model"):
    """customerID, label and score of a fitted model, labelled with its name."""
    return model.transform(rows).select(
        F.lit(name).alias("model"), S.ID, "label",
        vector_to_array("probability")[1].alias("score"),
    )


def calibrated_scores(rows, to_score, folds=5, seed=42, max_iter=MAX_ITER):
    """Average of the isotonic curves of the folds.

    Each fold trains on the others, balanced among themselves, and fits its curve on
    itself. Folds are stratified; curves are fitted and applied as Spark jobs.
    """
    folded = kfold(rows, folds, seed=seed, label="label").cache()
    out = to_score.withColumn("_sum", F.lit(0.0))
    try:
        for i in range(folds):
            train = with_balance(folded.where(F.col("fold") != i))
            model = baseline(train, max_iter=max_iter).fit(train)
            held = model.transform(folded.where(F.col("fold") == i)).select(
                F.col("label").cast("double"), vector_to_array("probability")[1].alias("raw")
            )
            curve = isotonic.blocks(held)
            raw = (
                model.transform(out)
                .withColumn("raw", vector_to_array("probability")[1])
                .drop("rawPrediction", "probability", "prediction")
            )
            out = (
                isotonic.apply_curve(raw, curve, name="_curve")
                .withColumn("_sum", F.col("_sum") + F.col("_curve"))
                .drop("raw", "_curve")
            )
    finally:
        folded.unpersist()
    return out.select(S.ID, "label", (F.col("_sum") / folds).alias("score"))


def random_grid(estimator, space, trials=TRIALS, seed=42):
    """Seeded draws: a (low, high) pair is log-uniform, a list is a choice."""
    draw = random.Random(seed)
    grid = []
    for _ in range(trials):
        builder = ParamGridBuilder()
        for name, domain in space.items():
            if isinstance(domain, tuple):
                low, high = domain
                value = low * (high / low) ** draw.random()
            else:
                value = draw.choice(domain)
            builder.addGrid(estimator.getParam(name), [value])
        grid += builder.build()
    return grid


def tune(estimator, rows, space, trials=TRIALS, folds=None, seed=42, parallelism=4):
    """Search for the highest area under the curve; folds are stratified."""
    weighted = kfold(with_balance(rows), folds or 5, seed=seed, label="label").cache()
    common = {
        "estimator": estimator,
        "estimatorParamMaps": random_grid(estimator, space, trials, seed),
        "evaluator": BinaryClassificationEvaluator(metricName="areaUnderROC"),
        "parallelism": parallelism,
        "seed": seed,
    }
    try:
        if folds:
            return CrossValidator(numFolds=folds, foldCol="fold", **common).fit(weighted)
        return TrainValidationSplit(trainRatio=0.8, **common).fit(weighted)
    finally:
        weighted.unpersist()


def cross_validated(estimator, rows, folds=5, seed=42, name="model"):
    """Area under the curve of each stratified fold: model, fold, roc_auc.

    Each fold is scored by a model of the others, whose classes are balanced among themselves.
    """
    folded = kfold(rows, folds, seed=seed, label="label").cache()
    try:
        parts = []
        for i in range(folds):
            model = fit(estimator, folded.where(F.col("fold") != i))
            part = scores(model, folded.where(F.col("fold") == i), name)
            parts.append(metrics.roc_auc(part).select(
                F.lit(name).alias("model"), F.lit(i).alias("fold"), "roc_auc").first())
        return rows.sparkSession.createDataFrame(parts, "model string, fold int, roc_auc double")
    finally:
        folded.unpersist()


def fold_summary(folds):
    """Mean and deviation of the folds' areas: model, folds, mean_auc, std_auc."""
    return folds.groupBy("model").agg(
        F.count("roc_auc").alias("folds"), F.avg("roc_auc").alias("mean_auc"),
        F.stddev_pop("roc_auc").alias("std_auc"))


TRIAL_COLUMNS = ("trial int, params map<string,string>, rung int, fraction double, roc_auc double, outcome string")


def halving_search(
    estimator, rows, space, trials=TRIALS, fractions=FRACTIONS, keep=1 / 3, seconds=SEARCH_SECONDS,
    held=0.2, seed=42, parallelism=4, clock=time.monotonic,
):
    """Random search by successive halving: (rows of trials, best setting or None).

    All settings start on the first fraction of the training rows; the best share `keep` of
    them goes on to the next, larger one. Fractions are nested, and all trials are measured
    on the same held rows. After `seconds` nothing new is started, and what has been measured
    decides. Outcome: `kept`, `dropped` (others were better), `best`, or `time` (not run).
    """
    start = clock()
    parts = held_share(with_balance(rows), held, f"search-{seed}").withColumn(
        "_share", hash_number(F.col(S.ID), F.lit(f"rung-{seed}")) / 10000).cache()
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC")
    test, train = parts.where("held"), parts.where("not held")

    def run(setting, fraction):
        if clock() - start > seconds:
            return None
        model = estimator.copy(setting).fit(train.where(F.col("_share") < fraction))
        return evaluator.evaluate(model.transform(test))

    found, best = [], None
    alive = list(enumerate(random_grid(estimator, space, trials, seed)))
    try:
        for rung, fraction in enumerate(fractions):
            with ThreadPoolExecutor(parallelism) as pool:
                areas = list(pool.map(lambda t: run(t[1], fraction), alive))
            ranked = sorted(((a, t) for a, t in zip(areas, alive) if a is not None), key=lambda x: (-x[0], x[1][0]))
            last = rung + 1 == len(fractions)
            stay = [t for _, t in ranked[:1 if last else max(1, round(len(alive) * keep))]]
            best = stay[0] if stay else best
            for area, (number, setting) in zip(areas, alive):
                kept = any(number == n for n, _ in stay)
                outcome = "time" if area is None else "dropped" if not kept else "best" if last else "kept"
                found.append((number, {p.name: str(v) for p, v in setting.items()}, rung, float(fraction), area, outcome))
            if not stay:
                break
            alive = stay
    finally:
        parts.unpersist()
    return found, best and best[1]


def trial_table(spark, tuned):
    """Mean metric of every tried setting. One row per trial."""
    metrics = getattr(tuned, "avgMetrics", None) or tuned.validationMetrics
    rows = [
        (i, {p.name: str(v) for p, v in setting.items()}, float(m))
        for i, (setting, m) in enumerate(zip(tuned.getEstimatorParamMaps(), metrics))
    ]
    return spark.createDataFrame(rows, "trial int, params map<string,string>, roc_auc double")
