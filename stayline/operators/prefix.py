"""Running totals and ranks in a global order.

An unpartitioned window would put every row on one task. Here rows are ranged
over the cluster by the order itself, each range is numbered, and only the range
totals (one row per key and range) are summed ahead of the per-range windows. The
ranged rows are written to the checkpoint folder, so a lost executor cannot change
a range number between the two passes.
"""

from functools import reduce

from pyspark.sql import Window, functions as F

from stayline.session import checkpointed

RANGE = "_range"


def join_null_safe(left, right, by, how="inner"):
    """Join on the columns `by`, a null key meeting a null key; `left` keeps its own keys."""
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"_right_{c}") if c in by else F.col(f"`{c}`") for c in right.columns]
    )
    same = reduce(
        lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_right_{c}`")) for c in by]
    )
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in by])


def ranged(df, order, by=()):
    """Rows spread by (by, order), with the number of the range each one landed in."""
    spread = df.repartitionByRange(*[F.col(c) for c in by], *order)
    return checkpointed(spread.withColumn(RANGE, F.spark_partition_id()))


def _with_offsets(rows, order, by, measures):
    totals = rows.groupBy(*by, RANGE).agg(*[F.sum(m).alias(m) for m in measures])
    # One row per key and range: bounded by keys plus partitions.
    before = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy(RANGE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *by, RANGE, *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_{m}") for m in measures]
    )
    inside = (
        Window.partitionBy(*by, RANGE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = rows.select("*", *[F.sum(m).over(inside).alias(f"{m}_cum") for m in measures])
    joined = join_null_safe(running, offsets, [*by, RANGE])
    return joined.withColumns(
        {f"{m}_cum": F.col(f"{m}_cum") + F.col(f"_{m}") for m in measures}
    ).drop(RANGE, *[f"_{m}" for m in measures])


def prefix_counts(df, value, measures, by=()):
    """Totals per distinct (by, value) and, as `<measure>_cum`, up to and including it.

    `measures` maps output names to aggregate columns, e.g. {"n": F.count("*")}.
    """
    by = list(by)
    collapsed = df.groupBy(*by, value).agg(*[c.alias(name) for name, c in measures.items()])
    rows = ranged(collapsed, [F.col(value)], by)
    return _with_offsets(rows, [F.col(value)], by, list(measures))


def global_rank(df, order, by=(), name="rank_no"):
    """1-based position of every row in `order` within `by`; `order` must end in a unique key."""
    by = list(by)
    rows = ranged(df.withColumn("_one", F.lit(1).cast("bigint")), order, by)
    return _with_offsets(rows, order, by, ["_one"]).withColumnRenamed("_one_cum", name).drop("_one")


def join_by_value(df, per_value, value, n="n", key=None, hot_share=0.001):
    """Join rows to a table with one row per distinct value, safe for frequent values.

    `n` is the count of each value. Values above `hot_share` of all rows (so fewer than
    1/hot_share of them) are spread over as many parts as they have shares.
    """
    total = per_value.agg(F.sum(n)).scalar()
    parts = F.greatest(F.lit(1), F.floor(F.col(n) / (total * hot_share))).cast("int")
    # Fewer than 1/hot_share rows.
    hot = per_value.select(value, parts.alias("_parts")).where("_parts > 1")
    spread = per_value.select(
        "*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    ).drop(n)
    marked = join_null_safe(df, F.broadcast(hot), [value], "left").withColumn(
        "_part",
        F.pmod(F.xxhash64(*([key] if key else df.columns)), F.coalesce("_parts", F.lit(1))).cast("int"),
    )
    return join_null_safe(marked.drop("_parts"), spread, [value, "_part"]).drop("_part")
