"""Isotonic curves fitted by ranges."""

import random

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from stayline.operators import isotonic


def plain(rows):
    """Fitted value of every distinct input, by the max-min formula."""
    xs = sorted({x for x, _, w in rows if w > 0})
    weight = np.array([sum(w for x, _, w in rows if x == v) for v in xs])
    total = np.array([sum(y * w for x, y, w in rows if x == v) for v in xs])
    w, t = np.concatenate([[0], np.cumsum(weight)]), np.concatenate([[0], np.cumsum(total)])
    mean = lambda a, b: (t[b + 1] - t[a]) / (w[b + 1] - w[a])
    return {v: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, v in enumerate(xs)}


def sample(seed, n=400):
    draw = random.Random(seed)
    xs = [round(draw.random(), draw.choice([1, 2, 6])) for _ in range(n)]
    return [(x, float(draw.random() < (x if seed else 1 - x)), draw.choice([1.0, 1.0, 2.5])) for x in xs]


@pytest.fixture(params=[0, 1, 2])
def rows(request):
    return sample(request.param)


def test_equal_to_the_formula_and_to_spark(spark, rows):
    df = spark.createDataFrame(rows, "raw double, label double, w double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        curve = isotonic.blocks(df.repartition(7), weight="w").cache()
        found = {r.raw: r.v for r in isotonic.apply_curve(df.select("raw").distinct(), curve, name="v").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = plain(rows)
    assert found == pytest.approx(expected)
    values = [r.value for r in curve.orderBy("low").collect()]
    assert values == sorted(set(values))
    model = IsotonicRegression(featuresCol="raw", weightCol="w").fit(df)
    grid = spark.createDataFrame([(x / 333,) for x in range(-20, 360)], "raw double")
    theirs = {r.raw: r.prediction for r in model.transform(grid).collect()}
    for most in (10**6, 0):
        ours = {r.raw: r.v for r in isotonic.apply_curve(grid, curve, name="v", most=most).collect()}
        assert ours == pytest.approx(theirs, abs=1e-9)


def test_pooling_is_associative():
    rows = sorted((x, y) for x, y, _ in sample(3, 200))
    whole = isotonic.Pool()
    for x, y in rows:
        whole.add(x, x, 1.0, y)
    for cut in (1, 50, 111, 199):
        parts = []
        for part in (rows[:cut], rows[cut:]):
            pool = isotonic.Pool()
            for x, y in part:
                pool.add(x, x, 1.0, y)
            parts += list(zip(pool.low, pool.high, pool.weight, pool.total))
        again = isotonic.Pool()
        for block in parts:
            again.add(*block)
        assert (again.low, again.weight) == (whole.low, whole.weight) and again.total == pytest.approx(whole.total)


def test_odd_rows(spark):
    schema = "raw double, label double"
    one = isotonic.blocks(spark.createDataFrame([(None, 1.0), (0.5, None), (0.3, 1.0), (float("nan"), 0.0)], schema))
    assert [tuple(r) for r in one.collect()] == [(0.3, 0.3, 1.0, 1.0)]
    df = spark.createDataFrame([(None,), (0.1,), (0.9,)], "raw double")
    for most in (10, 0):
        found = isotonic.apply_curve(df, one, most=most).orderBy("raw").collect()
        assert [r.calibrated for r in found] == [None, 1.0, 1.0]
    none = isotonic.blocks(spark.createDataFrame([], schema))
    assert none.count() == 0


def test_no_row_reaches_the_driver(spark):
    df = spark.range(5000).select(F.rand(3).alias("raw"), (F.rand(4) < 0.5).cast("double").alias("label"))
    assert isotonic.blocks(df).count() < 5000 ** (2 / 3)
