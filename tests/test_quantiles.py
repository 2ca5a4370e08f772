"""Quantiles by narrowing bins."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import profile
from stayline.operators.quantiles import bin_counts, exact_quantiles, first_bin
from tests.helpers import plan_text

PROBS = {"low": 0.0, "q1": 0.25, "q2": 0.5, "odd": 0.637, "high": 1.0}


def hard_values(draw, n):
    """Values of all sizes and signs, many ties, neighbours that differ in the last bit."""
    near = [1.0]
    for _ in range(40):
        near.append(math.nextafter(near[-1], 2))
    kinds = [
        lambda: draw.choice(near), lambda: float(draw.randrange(5)), lambda: -draw.random() * 1e-300,
        lambda: draw.gauss(0, 1e6), lambda: draw.uniform(-1e307, 1e307), lambda: 5e-324, lambda: -0.0,
    ]
    return [draw.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_numpy_by_group(spark, seed):
    draw = random.Random(seed)
    rows = [(draw.choice(["a", "b", None]), v) for v in hard_values(draw, 400)] + [("c", 7.0), ("d", None), ("a", None)]
    found = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", PROBS, ["g"]).collect()}
    assert found.keys() == {"a", "b", None, "c"}
    for g, row in found.items():
        values = sorted(v for k, v in rows if k == g and v is not None)
        for name, p in PROBS.items():
            at = p * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert row[name] == pytest.approx(low + (high - low) * (at - math.floor(at)), rel=1e-15, abs=0)


def test_infinite_values_and_nan(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,), (0.0,), (math.nan,), (3.0,)], "v double")
    row = exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}).first()
    assert row[:4] == (-math.inf, 0.0, 3.0, math.inf) and math.isnan(row.e)


def test_bins_follow_the_order(spark):
    draw = random.Random(1)
    df = spark.createDataFrame([(v,) for v in sorted(hard_values(draw, 500))], "v double")
    bins = [r.b for r in df.select(first_bin(F.col("v")).alias("b")).collect()]
    assert sorted(bins) == bins


def test_nothing_but_bins_is_shuffled(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("g"), (F.col("id") * 0.37).alias("v"))
    plan = plan_text(bin_counts(df, "v", ["g"]))
    assert plan.count("Exchange") == 1 and "partial_var_pop" in plan and "rangepartitioning" not in plan
    whole = plan_text(profile.describe(df, ["v"], ["g"]))
    assert "rangepartitioning" not in whole and "Range (0, 10000" not in whole


def test_describe_keeps_the_null_group(spark):
    draw = np.random.default_rng(3)
    rows = [(g, float(x)) for g in ("x", None) for x in draw.normal(5, 2, 50)]
    found = {r.g: r for r in profile.describe(spark.createDataFrame(rows, "g string, x double"), ["x"], ["g"]).collect()}
    assert found.keys() == {"x", None}
    for g, row in found.items():
        values = [v for k, v in rows if k == g]
        assert (row.rows, row.min, row.max) == (50, min(values), max(values))
        assert row["mean"] == pytest.approx(np.mean(values)) and row["std"] == pytest.approx(np.std(values, ddof=1))
        assert row["median"] == pytest.approx(np.median(values))


def test_no_values_no_rows(spark):
    empty = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(empty, "v", PROBS, ["g"]).count() == 0
    assert set(exact_quantiles(empty, "v", PROBS).first()) == {None}
