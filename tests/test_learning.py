import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import explain, features, learn, metrics, scoring
from stayline.sources import derived
from tests.helpers import plan_text


@pytest.fixture(scope="module")
def rows(spark, customers):
    model = features.fit_features(customers, handle_unknown="ignore")
    return learn.assemble(model.transform(customers), model.features).cache(), model.features


def test_baseline_learns_and_ranks_coefficients(spark, rows):
    data, names = rows
    model = learn.fit_baseline(data, max_iter=50)
    scores = learn.scores(model, data)
    assert metrics.roc_auc(scores).first().roc_auc > 0.7
    table = explain.coefficient_importance(spark, model, names).collect()
    assert len(table) == len(names) and table[0].importance >= table[-1].importance


def test_balanced_weights_sum_to_the_rows(rows):
    weighted = learn.with_balance(rows[0])
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(weighted.count())


def test_calibrated_scores_are_probabilities(rows):
    out = learn.calibrated_scores(rows[0], rows[0], folds=2, max_iter=20)
    assert out.count() == rows[0].count()
    assert out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_trees_and_search(spark, rows):
    data, names = rows
    forest = learn.fit(learn.random_forest(trees=5, depth=3), data)
    assert explain.tree_importance(spark, forest, names).agg(F.sum("importance")).first()[0] == pytest.approx(1)
    tuned = learn.tune(
        LogisticRegression(weightCol="class_weight", maxIter=10), data, {"regParam": (0.001, 1.0)}, trials=2, folds=2)
    trials = learn.trial_table(spark, tuned).collect()
    assert len(trials) == 2 and all(0.5 < t.roc_auc <= 1 for t in trials)


def test_random_grid_is_seeded_and_in_range(spark):
    lr = LogisticRegression()
    space = {"regParam": (0.001, 1.0), "maxIter": [5, 10]}
    one, two = (learn.random_grid(lr, space, trials=4, seed=3) for _ in range(2))
    values = [[s[lr.regParam] for s in grid] for grid in (one, two)]
    assert values[0] == values[1] and all(0.001 <= v <= 1.0 for v in values[0])


def test_scorecard_equals_the_stored_probability(spark, folder):
    base = derived.customer_base(spark, folder)
    scored = scoring.score_scorecard(base).join(
        base.select(S.ID, F.col("churn_probability").alias("expected")), S.ID)
    assert scored.where("churn_probability <> expected").count() == 0


def test_linear_contributions_add_up(spark, customers):
    terms = scoring.scorecard_terms(customers)
    parts = explain.linear_contributions(terms, scoring.SCORECARD.weights)
    means = parts.groupBy("feature").agg(F.avg("contribution").alias("m"))
    assert means.where("abs(m) > 1e-6").count() == 0
    top = explain.linear_contributions(terms, scoring.SCORECARD.weights, top=2)
    again = explain.top_contributions(parts, 2)
    assert top.select(S.ID, "feature").exceptAll(again.select(S.ID, "feature")).count() == 0


def test_sampled_contributions_explain_the_score(spark, rows):
    """They add up to the score minus the mean background score of the drawn rows."""
    data, names = rows
    model = learn.fit_baseline(data, max_iter=20)
    few = data.limit(5)
    found = explain.sampled_contributions(model, few, names, background=1, permutations=3)
    base = explain.sample_customers(few, 1)
    base_score = learn.scores(model, base).first().score
    sums = {r.customerID: r.s for r in found.groupBy(S.ID).agg(F.sum("contribution").alias("s")).collect()}
    for row in learn.scores(model, few).collect():
        assert sums[row.customerID] == pytest.approx(row.score - base_score)


def test_all_rejected_is_an_error(spark, customers):
    broken = customers.limit(3).withColumn("gender", F.lit("X"))
    with pytest.raises(ValueError):
        scoring.require_some_scored(scoring.score_totals(broken))
    scoring.require_some_scored(scoring.score_totals(customers))


def test_the_explanation_query_uses_the_defaults(monkeypatch):
    from stayline.plans import learning

    seen = {}

    def record(*_, **named):
        seen.update(named)
        raise InterruptedError

    monkeypatch.setattr(learning, "_parts", lambda *_: (None, None, []))
    monkeypatch.setattr(learning.learn, "fit_baseline", lambda *_: None)
    monkeypatch.setattr(learning.explain, "sampled_contributions", record)
    with pytest.raises(InterruptedError):
        learning.explain_model(None, None)
    assert seen.get("permutations", 8) == 8


def test_contributions_need_no_window(spark, rows):
    data, names = rows
    plan = plan_text(explain.sampled_contributions(learn.fit_baseline(data, max_iter=5), data, names))
    # The only window numbers the background rows.
    assert plan.count("Window ") <= 1 and "array_position" not in plan


def test_boosting_keeps_the_rounds_of_the_lowest_loss(spark, rows, monkeypatch):
    data, _ = rows
    model, rounds = learn.fit_boosted(data, rounds=24, patience=6, maxDepth=6, stepSize=0.6)
    assert model.getNumTrees == rounds < 24
    held = learn.held_share(learn.with_balance(data), 0.15, "boosting-42")
    more = learn.boosted_trees(maxIter=rounds + 6, maxDepth=6, stepSize=0.6).fit(held.where("not held"))
    losses = more.evaluateEachIteration(held.where("held"))
    # More rounds are worse, and the first rounds of a longer run are those of the shorter one.
    assert min(losses) == losses[rounds - 1] and losses[-1] > losses[rounds - 1]
    assert model.evaluateEachIteration(held.where("held")) == pytest.approx(losses[:rounds])
    capped, rounds = learn.fit_boosted(data, rounds=2, patience=50)
    assert capped.getNumTrees == rounds <= 2


def test_search_halves_and_keeps_to_its_time(spark, rows):
    data, _ = rows
    estimator, space = learn.baseline(data, max_iter=5), {"regParam": (0.001, 1.0)}
    found, best = learn.halving_search(estimator, data, space, trials=6, fractions=(0.3, 1.0), parallelism=2)
    table = spark.createDataFrame(found, learn.TRIAL_COLUMNS).collect()
    by = {rung: [r for r in table if r.rung == rung] for rung in (0, 1)}
    assert len(by[0]) == 6 and len(by[1]) == 2
    kept = sorted((r.roc_auc for r in by[0] if r.outcome == "kept"), reverse=True)
    assert len(kept) == 2 and kept[-1] >= max(r.roc_auc for r in by[0] if r.outcome == "dropped")
    first = max(by[1], key=lambda r: r.roc_auc)
    assert first.outcome == "best" and float(first.params["regParam"]) == best[estimator.regParam]

    ticks = iter(range(100))
    found, best = learn.halving_search(
        estimator, data, space, trials=4, fractions=(0.3, 1.0), seconds=2, parallelism=1, clock=lambda: next(ticks))
    assert [x[5] for x in found if x[4] is None] == ["time"] * sum(x[4] is None for x in found) and best is not None
    assert any(x[4] is None for x in found)
    none, best = learn.halving_search(estimator, data, space, trials=2, seconds=-1, parallelism=1)
    assert best is None and {x[5] for x in none} == {"time"}


def test_areas_of_the_folds(spark, rows):
    data, _ = rows
    folds = learn.cross_validated(learn.baseline(data, max_iter=10), data, folds=3)
    areas = [r.roc_auc for r in folds.collect()]
    row = learn.fold_summary(folds).first()
    assert len(areas) == row.folds == 3 and all(0.6 < a < 1 for a in areas)
    assert row.mean_auc == pytest.approx(sum(areas) / 3)


def test_the_fit_has_no_slope_left(rows):
    data, _ = rows
    assert learn.gradient_size(learn.fit_baseline(data), data) < 1e-4
    assert learn.gradient_size(learn.fit_baseline(data, max_iter=1), data) > 1e-3


def test_boosting_fits_no_more_than_a_short_run_and_all_rounds(spark, rows, monkeypatch):
    data, _ = rows
    fitted, trees = [], learn.boosted_trees
    monkeypatch.setattr(learn, "boosted_trees", lambda *a, **p: fitted.append(p["maxIter"]) or trees(*a, **p))
    model, rounds = learn.fit_boosted(data, rounds=20, patience=2, maxDepth=2, stepSize=0.01)
    # Small steps lower the loss for long: neither 4, 8 and 16 rounds in turn nor a last fit.
    assert fitted == [4, 20] and model.getNumTrees == model.getMaxIter() == rounds
    assert "customerID" in model.transform(data).columns


def test_the_start_of_a_boosted_model_is_the_shorter_fit(spark, rows):
    data = learn.with_balance(rows[0])
    short, long = (learn.boosted_trees(maxIter=n, maxDepth=3).fit(data) for n in (4, 9))
    kept = learn.first_rounds(long, 4)
    assert kept.getNumTrees == kept.getMaxIter() == 4 and kept.treeWeights == short.treeWeights
    assert learn.scores(kept, data).exceptAll(learn.scores(short, data)).count() == 0


def test_rounds_are_chosen_as_by_runs_of_twice_as_many():
    def runs(losses, rounds, patience):
        tried = min(rounds, 2 * patience)
        while True:
            best = min(range(tried), key=losses.__getitem__) + 1
            if best + patience <= tried or tried == rounds:
                return best
            tried = min(rounds, 2 * tried)

    for low in range(1, 41):
        # A dip at `low` before losses that end below it.
        losses = [abs(i - low) / 10 if i < low + 8 else 5 - i / 8 for i in range(1, 41)]
        assert learn.chosen_rounds(losses, 40, 3) == runs(losses, 40, 3)
        first = learn.chosen_rounds(losses[:6], 40, 3)
        assert first is None or first == runs(losses, 40, 3)


def test_fits_get_few_tasks(spark, rows, monkeypatch):
    data, cores = rows[0], spark.sparkContext.defaultParallelism
    few = learn.in_few_tasks(data.repartition(50))
    assert few.rdd.getNumPartitions() == 2 * cores and few.count() == data.count()
    assert learn.in_few_tasks(data.coalesce(1)).rdd.getNumPartitions() == 1
    monkeypatch.setattr(learn, "TASK_ROWS", -(-data.count() // 20))
    assert 2 * cores < learn.in_few_tasks(data.repartition(50)).rdd.getNumPartitions() <= 20


def test_boosting_goes_on_from_the_rounds_it_has(spark, rows, monkeypatch):
    data, _ = rows
    fitted, grown, whole, tree = [], [], learn.GBTClassifier.fit, learn.DecisionTreeRegressor.fit
    monkeypatch.setattr(learn.GBTClassifier, "fit", lambda s, d: fitted.append(s.getMaxIter()) or whole(s, d))
    monkeypatch.setattr(learn.DecisionTreeRegressor, "fit", lambda s, d: grown.append(1) or tree(s, d))
    monkeypatch.setattr(learn, "chosen_rounds", lambda losses, *_: 5 if len(losses) >= 8 else None)
    model, rounds = learn.fit_boosted(data, rounds=200, patience=2, maxDepth=2)
    # Eight rounds decide: neither the first four nor any of the 200 are fitted for nothing.
    assert fitted == [4] and len(grown) == 4 and model.getNumTrees == model.getMaxIter() == rounds == 5
    fitted.clear(), grown.clear()
    # Trees that draw rows go by Spark's own seeds, and so does what many rounds do not decide.
    model, _ = learn.fit_boosted(data, rounds=9, patience=2, maxDepth=2, subsamplingRate=0.5)
    assert fitted == [4, 9] and not grown and model.getNumTrees == 5
    fitted.clear()
    monkeypatch.setattr(learn, "chosen_rounds", lambda losses, *_: 3 if len(losses) == 11 else None)
    learn.fit_boosted(data, rounds=11, patience=1, maxDepth=2)
    assert fitted == [2, 11] and len(grown) == 6


def test_more_rounds_are_those_of_one_fit(spark, rows, monkeypatch):
    monkeypatch.setattr(learn, "FOLD_ROUNDS", 3)
    data = learn.with_balance(rows[0])
    short, long = (learn.boosted_trees(maxIter=n, maxDepth=3, stepSize=0.3) for n in (2, 10))
    whole, more = long.fit(data), learn.more_rounds(short.fit(data), long, data, 10)
    assert more.getNumTrees == more.getMaxIter() == 10 and more.treeWeights == whole.treeWeights
    both = learn.scores(whole, data).select(S.ID, F.col("score").alias("one")).join(learn.scores(more, data), S.ID)
    assert both.count() == data.count() and both.where("abs(one - score) > 1e-9").count() == 0
    assert more.evaluateEachIteration(data) == pytest.approx(whole.evaluateEachIteration(data))


def test_rows_in_few_partitions_are_dealt_out(spark, rows, monkeypatch):
    data, cores = rows[0], spark.sparkContext.defaultParallelism
    monkeypatch.setattr(learn, "SPREAD_ROWS", -(-data.count() // 3))
    spread = learn.in_few_tasks(data.coalesce(1))
    assert spread.rdd.getNumPartitions() == min(cores, 3) and spread.exceptAll(data).count() == 0
    assert spread.count() == data.count()
    even = data.repartition(3)
    assert learn.in_few_tasks(even).rdd.getNumPartitions() == 3
