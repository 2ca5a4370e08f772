"""Exact quantiles by narrowing bins: distributed selection without an order of the values.

The first pass counts values in a few thousand bins on a logarithmic scale, with the
moments and extremes of each bin in the same aggregate. Every further pass divides only the
bins that hold a wanted rank. Bins are combined before each shuffle, so what is shuffled is
bounded by keys, bins and tasks, never by rows, and no value is sorted or written.

A bin ends the search once its smallest and largest value are equal. Each pass puts these
two into different bins, and divides the range by `REFINE`, so a few passes suffice for any
doubles.
"""

from pyspark.sql import Window, functions as F

from stayline.operators.prefix import join_null_safe
from stayline.session import checkpointed

#: Bins of the first pass for each doubling of the absolute value.
PER_OCTAVE = 2
#: Bins into which a pass divides a bin that holds a wanted rank.
REFINE = 4096
#: Most rows of bins or keys that may be broadcast; beyond it Spark joins by shuffling.
BROADCAST_ROWS = 100_000

# Smallest and largest exponent of a double, and places for what is beyond them.
_LOWEST, _HIGHEST = -1075, 1025
_INFINITE, _NAN = (_HIGHEST - _LOWEST + 1) * PER_OCTAVE, (_HIGHEST - _LOWEST + 2) * PER_OCTAVE


def first_bin(value):
    """Number of the bin of a double; bins follow the order of the values, NaN last."""
    size = F.abs(value)
    exponent = F.floor((F.log2(size) - _LOWEST) * PER_OCTAVE) + 1
    return (
        F.when(F.isnan(value), _NAN)
        .when(value == 0, 0)
        .when(size == float("inf"), F.signum(value) * _INFINITE)
        .otherwise(F.signum(value) * exponent)
        .cast("int")
    )


def bin_counts(long, value, by=()):
    """Rows of the first pass: by, bin, n, low, high, mean and squared deviations of each bin."""
    known = long.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    v = F.col("_v")
    return known.groupBy(*by, first_bin(v).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high"),
        F.avg(v).alias("_mean"), (F.var_pop(v) * F.count(F.lit(1))).alias("_ss"),
    )


def moments(bins, by=()):
    """rows, mean, std (of a sample), min and max of each key, from `bin_counts`."""
    by = list(by)
    totals = bins.groupBy(*by).agg(
        F.sum("_n").alias("rows"), (F.sum(F.col("_mean") * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.min("_low").alias("min"), F.max("_high").alias("max"),
    )
    centre = totals.select(*by, F.col("mean").alias("_centre"))
    apart = join_null_safe(bins, centre, by) if by else bins.crossJoin(F.broadcast(centre))
    spread = apart.groupBy(*by).agg(
        F.sum(F.col("_ss") + F.col("_n") * F.pow(F.col("_mean") - F.col("_centre"), 2)).alias("_ss"),
        F.sum("_n").alias("_n"),
    ).select(*by, F.sqrt(F.try_divide("_ss", F.col("_n") - 1)).alias("std"))
    return join_null_safe(totals, spread, by) if by else totals.crossJoin(F.broadcast(spread))


def _running(bins, keys, order):
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _ends(bins, probs, by):
    """One row per key and wanted rank: the bin that holds it, and how many values lie before."""
    counted = _running(bins, by, "_bin")
    sizes = bins.groupBy(*by).agg(F.sum("_n").alias("_size"))
    ranks = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(F.lit(float(p)) * (F.col("_size") - 1)), F.ceil(F.lit(float(p)) * (F.col("_size") - 1)))
        for p in probs.values()])))
    wanted = sizes.select(*by, "_size", F.explode(ranks).alias("_rank"))
    met = join_null_safe(counted, wanted, by) if by else counted.crossJoin(F.broadcast(wanted))
    held = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    return met.where(held).select(*by, "_size", "_rank", "_low", "_high", "_before")


def _narrowed(known, ends, by, few):
    """The wanted ranks that are still open, each in a bin of the next pass."""
    targets = ends.select(*by, "_low", "_high").distinct()
    placed = join_null_safe(known, F.broadcast(targets) if few else targets, by) if by else known.crossJoin(F.broadcast(targets))
    placed = placed.where(F.col("_v").between(F.col("_low"), F.col("_high")))
    share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    part = F.least(F.lit(REFINE - 1), F.floor(share * REFINE)).cast("int")
    keys = [*by, "_low", "_high"]
    bins = placed.groupBy(*keys, part.alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    inside = _running(bins, keys, "_bin").withColumnRenamed("_before", "_inside")
    met = join_null_safe(inside, ends, keys)
    rank = F.col("_rank") - F.col("_before")
    return met.where((rank >= F.col("_inside")) & (rank < F.col("_inside") + F.col("_n"))).select(
        *by, "_size", "_rank", F.col("_least").alias("_low"), F.col("_most").alias("_high"),
        (F.col("_before") + F.col("_inside")).alias("_before"))


def quantiles_from_bins(long, bins, value, probs, by=()):
    """Exact, linearly interpolated quantiles: one row per key of `bins` (of `bin_counts`).

    Reads `long` again once a pass; keys of null are kept. `bins` should be a written table,
    as every step starts from it.
    """
    by = list(by)
    known = long.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    ends = checkpointed(_ends(bins, probs, by))
    closed = F.col("_low").eqNullSafe(F.col("_high"))
    done, still = ends.where(closed), ends.where(~closed)
    while left := still.count():
        step = checkpointed(_narrowed(known, still, by, left <= BROADCAST_ROWS))
        done, still = done.unionByName(step.where(closed)), step.where(~closed)
    values = done.groupBy(*by).agg(
        F.max("_size").alias("_size"), F.map_from_entries(F.collect_list(F.struct("_rank", "_low"))).alias("_at"))
    out = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_size") - 1)
        low, high = F.element_at("_at", F.floor(at)), F.element_at("_at", F.ceil(at))
        # Equal ends need no sum, so that infinite values stay what they are.
        out.append(F.when(low.eqNullSafe(high), low).otherwise(low + (high - low) * (at - F.floor(at))).alias(name))
    return values.select(*by, *out)


def exact_quantiles(df, value, probs, by=()):
    """Exact quantiles of each key, without an order of the values and without a hot task.

    `probs` maps output names to probabilities. Nulls are left out; a key without other
    values gives no row, but without keys there is always one. NaN counts as the largest value.
    """
    bins = checkpointed(bin_counts(df, value, by))
    return quantiles_from_bins(df, bins, value, probs, by)
