"""Isotonic regression as a distributed job: pool adjacent violators per range, then merge.

Equal inputs are summed first. Each range of the inputs is pooled on its own; pooling is
associative, so neighbouring results are put side by side and pooled again, two by two.
For 0/1 targets a range of n rows leaves no more than about n^(2/3) blocks, however large
the input is; other targets may leave as many blocks as there are inputs.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window, functions as F

from stayline.operators.prefix import RANGE, ranged
from stayline.session import checkpointed

#: Most curve points that are broadcast to apply a curve; beyond it, rows meet it in ranges.
BROADCAST_POINTS = 1_000_000

BLOCKS = pa.schema([
    (RANGE, pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("weight", pa.float64()), ("total", pa.float64())])
COLUMNS = f"{RANGE} int, low double, high double, weight double, total double"


class Pool:
    """Stack of blocks with rising means. Blocks come in the order of their inputs."""

    def __init__(self):
        self.low, self.high, self.weight, self.total = [], [], [], []

    def add(self, low, high, weight, total):
        while self.weight and self.total[-1] * weight >= total * self.weight[-1]:
            low = self.low.pop()
            self.high.pop()
            weight += self.weight.pop()
            total += self.total.pop()
        self.low.append(low)
        self.high.append(high)
        self.weight.append(weight)
        self.total.append(total)

    def batch(self, number):
        return pa.RecordBatch.from_arrays(
            [pa.array([number] * len(self.low), pa.int32()),
             *[pa.array(x, pa.float64()) for x in (self.low, self.high, self.weight, self.total)]], schema=BLOCKS)


def _pooled(batches):
    """Blocks of one partition, whose rows are in order."""
    pool, number = Pool(), None
    for batch in batches:
        for number, *row in zip(*(batch.column(c).to_pylist() for c in BLOCKS.names)):
            pool.add(*row)
    if number is not None:
        yield pool.batch(number)


def _merged(group):
    order = [("low", "ascending")]
    return pa.Table.from_batches(list(_pooled(group.sort_by(order).to_batches())), BLOCKS)


def blocks(df, raw="raw", label="label", weight=None):
    """low, high, weight and value of the blocks of the rising curve through `label` over `raw`.

    Rows without a raw value or a label are left out. Ties in `raw` count as one input.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    known = df.where(F.col(raw).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(raw).cast("double")))
    inputs = known.groupBy(F.col(raw).cast("double").alias("low")).agg(
        F.sum(w).alias("weight"), F.sum(w * F.col(label).cast("double")).alias("total")).where("weight > 0")
    rows = ranged(inputs.withColumn("high", F.col("low")), [F.col("low")]).select(*BLOCKS.names)
    # The ranges are written, so each is read back as partitions of its own rows only.
    table = checkpointed(
        rows.repartition(RANGE).sortWithinPartitions(RANGE, "low").groupBy(RANGE).applyInArrow(_merged, COLUMNS))
    while table.agg(F.max(RANGE)).first()[0]:
        halved = table.withColumn(RANGE, F.floor(F.col(RANGE) / 2).cast("int"))
        table = checkpointed(halved.groupBy(RANGE).applyInArrow(_merged, COLUMNS))
    return table.select("low", "high", "weight", (F.col("total") / F.col("weight")).alias("value"))


def points(found):
    """The corners of the curve: x and y at both ends of each block."""
    ends = F.array(F.struct(F.col("low").alias("x"), F.col("value").alias("y")),
                   F.struct(F.col("high").alias("x"), F.col("value").alias("y")))
    return found.select(F.inline(F.array_distinct(ends)))


def _between(x, left, right):
    """Value at x between two corners, either of which may be missing."""
    step = (x - left["x"]) / (right["x"] - left["x"])
    inside = F.when(left["x"] == right["x"], left["y"]).otherwise(left["y"] + (right["y"] - left["y"]) * step)
    return F.when(left.isNull(), right["y"]).when(right.isNull(), left["y"]).otherwise(inside)


def apply_curve(df, found, raw="raw", name="calibrated", most=BROADCAST_POINTS):
    """Add the curve's value at `raw`: linear between blocks, flat beyond the ends; null stays null."""
    corners = points(found)
    if corners.count() <= most:
        table = corners.orderBy("x", "y").toArrow()
        shared = df.sparkSession.sparkContext.broadcast(
            (table.column("x").to_numpy(), table.column("y").to_numpy()))

        @F.pandas_udf("double")
        def at(x: pd.Series) -> pd.Series:
            xs, ys = shared.value
            return x.where(x.isna(), np.interp(x, xs, ys) if len(xs) else np.nan)

        return df.withColumn(name, at(F.col(raw).cast("double")))
    # Rows and corners in one order; a range takes the corners next to it from the others.
    x = F.col("_x")
    rows = df.withColumn("_x", F.col(raw).cast("double")).withColumn("_corner", F.lit(None).cast("struct<x: double, y: double>"))
    marks = corners.select(F.col("x").alias("_x"), F.struct("x", "y").alias("_corner"))
    both = ranged(rows.unionByName(marks, allowMissingColumns=True), [x])
    edges = both.groupBy(RANGE).agg(F.min("_corner").alias("_first"), F.max("_corner").alias("_last"))
    over = Window.orderBy(RANGE)
    edges = edges.select(
        F.col(RANGE).alias("_edge"),
        F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    inside = Window.partitionBy(RANGE).orderBy(x)
    left = F.max("_corner").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    right = F.min("_corner").over(inside.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    placed = both.withColumns({"_left": left, "_right": right}).join(edges, F.col(RANGE) == F.col("_edge"))
    value = _between(x, F.coalesce("_left", "_before"), F.coalesce("_right", "_after"))
    return placed.where("_corner is null").withColumn(name, F.when(x.isNotNull(), value)).select(*df.columns, name)
