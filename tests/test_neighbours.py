"""Nearest neighbours by hash tables, and the rows made from them."""

import numpy as np
import pytest

from stayline.operators import splits
from stayline.operators.neighbours import buckets, nearest
from pyspark.sql import functions as F

DRAW = np.random.default_rng(8)
CLUSTERED = np.concatenate([DRAW.normal(c, 0.05 + 0.4 * i, (160, 6)) for i, c in enumerate((0, 3, 3.5, -4, 9))])
SHAPES = {
    "even": DRAW.uniform(0, 1, (900, 8)),
    "clusters": CLUSTERED,
    "copies": np.concatenate([np.ones((500, 3)), DRAW.normal(0, 1, (300, 3))]),
    "scales": DRAW.normal(0, 1, (700, 4)) * [100, 1, 1, 0.1],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_recall_against_brute_force(spark, shape):
    points, k = SHAPES[shape], 5
    names = [f"f.{i}" for i in range(points.shape[1])]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], f"id long, {', '.join(f'`{n}` double' for n in names)}")
    found = {r.key: r.near for r in nearest(df, "id", names, k, leaf=64).collect()}
    hits = 0
    for i, p in enumerate(points):
        apart = np.sqrt(((points - p) ** 2).sum(axis=1))
        apart[i] = np.inf
        limit = np.sort(apart)[k - 1]
        near = found.get(i, [])
        assert [n.distance for n in near] == sorted(n.distance for n in near) and len(near) <= k
        for n in near:
            assert n.distance == pytest.approx(apart[n.key], abs=1e-9) and np.allclose(n.point, points[n.key])
        hits += sum(n.distance <= limit + 1e-9 for n in near)
    assert hits >= 0.9 * k * len(points)


def test_no_bucket_is_large(spark):
    """Half of the rows are one point, which no direction can split."""
    rows = [(i, [1.0, 2.0] if i % 2 else [float(i), float(-i)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "key long, point array<double>")
    found = buckets(df, 2, tables=3, depth=6, leaf=50).groupBy("bucket").count()
    assert found.agg(F.max("count")).first()[0] < 120 and found.agg(F.sum("count")).first()[0] == 6000


def test_new_rows_lie_between_true_neighbours(spark):
    points = SHAPES["clusters"][:120]
    rows = [(f"s{i}", 1, float(a), float(b)) for i, (a, b) in enumerate(points[:, :2])]
    rows += [(f"l{i}", 0, 50.0, 50.0) for i in range(400)]
    df = spark.createDataFrame(rows, f"{splits.S.ID} string, label int, a double, b double")
    new = splits.oversample(df, ["a", "b"], k=3).where("synthetic").collect()
    assert len(new) == 280 and {r.label for r in new} == {1}
    plane = points[:, :2]
    for r in new:
        own = plane[int(r[0][1:])]
        apart = np.sqrt(((plane - own) ** 2).sum(axis=1))
        near = plane[np.argsort(apart)[:12]]
        step = np.array([r.a, r.b]) - own
        between = [abs(np.cross([*step, 0], [*(n - own), 0])[2]) < 1e-9 and np.linalg.norm(step) <= np.linalg.norm(n - own) + 1e-9 for n in near]
        assert any(between)


def test_odd_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", 1.0), ("b", float("nan"))], "id string, x double")
    found = {r.key: [n.key for n in r.near] for r in nearest(df, "id", ["x"], 2).collect()}
    assert found["b"][0] == "a" and found["a"] == ["b"]
    assert nearest(df.limit(0), "id", ["x"], 2).count() == 0
    alone = spark.createDataFrame([("a", 1, 1.0), ("b", 0, 2.0), ("c", 0, 3.0)], f"{splits.S.ID} string, label int, x double")
    assert {r.x for r in splits.oversample(alone, ["x"]).where("synthetic").collect()} == {1.0}
