"""Nearest neighbours by several hash tables of random projections.

Every table files a row under its hashes along a sequence of random directions. A bucket
with more than `leaf` rows is split by the next direction, and again, so buckets stay small
where rows lie dense; rows that no direction separates are dealt out evenly, as any of them
is as near as the others. Rows that share a bucket in some table are candidates, and the
candidates of a row are ranked by their true distance.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayline.session import checkpointed


def _hashed(rows, n_features, tables, depth, width, seed):
    """One row for each row and table: its key, point and hashes along `depth` directions."""
    spread = rows.agg(*[F.var_pop(F.col("point")[i]) for i in range(n_features)]).first()
    scale = math.sqrt(sum(v or 0.0 for v in spread) / n_features) or 1.0
    model = BucketedRandomProjectionLSH(
        inputCol="_vector", outputCol="_hashes", bucketLength=width * scale,
        numHashTables=tables * depth, seed=seed,
    ).fit(rows.withColumn("_vector", array_to_vector("point")))
    found = model.transform(rows.withColumn("_vector", array_to_vector("point")))
    numbers = F.transform("_hashes", lambda v: vector_to_array(v)[0].cast("long"))
    parts = F.array(*[
        F.struct(F.lit(t).alias("table"), F.slice("_numbers", t * depth + 1, depth).alias("hashes")) for t in range(tables)])
    return found.select("key", "point", numbers.alias("_numbers")).select(
        "key", "point", F.inline(parts))


def buckets(rows, n_features, tables=16, depth=12, leaf=128, width=1.0, seed=42):
    """Rows (key, point) with a bucket of about `leaf` rows at most, once for each table."""
    size = rows.count()
    # With buckets as wide as the deviation, a direction splits a bucket into about four.
    level = min(depth, max(1, int(math.log(max(1.0, size / leaf), 4))))
    still = checkpointed(_hashed(rows, n_features, tables, depth, width, seed))
    done = None
    while True:
        bucket = F.xxhash64("table", F.slice("hashes", 1, level))
        placed = still.withColumn("bucket", bucket)
        large = checkpointed(placed.groupBy("bucket").count().where(F.col("count") > leaf))
        if not large.head(1):
            ready, still = placed, None
        elif level == depth:
            parts = F.ceil(F.coalesce("count", F.lit(1)) / leaf)
            ready = placed.join(large, "bucket", "left").withColumn(
                "bucket", F.xxhash64("bucket", F.pmod(F.xxhash64("key"), parts)))
            still = None
        else:
            marked = checkpointed(placed.join(large, "bucket", "left"))
            ready, still = marked.where("count is null"), marked.where("count is not null").select("table", "hashes", "key", "point")
        ready = ready.select("bucket", "key", "point")
        done = ready if done is None else done.unionByName(ready)
        if still is None:
            return done
        level += 1


def _ranked(k):
    """Arrow function over rows sorted by bucket: for every row the k nearest of its bucket."""

    def group(keys, points):
        apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
        names = keys.to_pylist()
        codes = np.unique(np.array([str(x) for x in names]), return_inverse=True)[1]
        apart[codes[:, None] == codes[None]] = np.inf
        near = np.argsort(apart, axis=1, kind="stable")[:, :k]
        row = np.repeat(np.arange(len(points)), near.shape[1])
        near = near.reshape(-1)
        real = np.isfinite(apart[row, near])
        row, near = row[real], near[real]
        flat = points[near]
        return pa.RecordBatch.from_arrays([
            keys.take(pa.array(row)), keys.take(pa.array(near)), pa.array(apart[row, near]),
            pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * points.shape[1], pa.int32()), pa.array(flat.reshape(-1)))],
            ["key", "near", "distance", "point"])

    def work(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            bucket = table.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            # The last bucket may go on in the next batch.
            for start, end in zip([0, *cuts[:-1]], cuts):
                yield from _group(table.slice(start, end - start), group)
            held = table.slice(cuts[-1] if len(cuts) else 0)
        if held is not None and held.num_rows:
            yield from _group(held, group)

    return work


def _group(table, rank):
    table = table.combine_chunks()
    if table.num_rows > 1:
        keys = table.column("key").chunk(0)
        lists = table.column("point").chunk(0)
        points = lists.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        yield rank(keys, points)


def nearest(df, key, features, k=5, tables=16, depth=12, leaf=128, width=1.0, seed=42):
    """For every row its k nearest others: key, near (array of distance, key, point).

    Approximate: a near row is missed if no table files it with the row; all distances are
    true. Nulls and NaN count as 0. Rows with equal keys are no neighbours of each other. A
    row alone in every bucket has no row here.
    """
    point = F.array(*[F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features])
    rows = checkpointed(df.select(F.col(f"`{key}`").alias("key"), point.alias("point")))
    kind = rows.schema["key"].dataType.simpleString()
    if not rows.head(1):
        return df.sparkSession.createDataFrame(
            [], f"key {kind}, near array<struct<distance: double, key: {kind}, point: array<double>>>")
    found = buckets(rows, len(features), tables, depth, leaf, width, seed)
    pairs = found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _ranked(k), f"key {kind}, near {kind}, distance double, point array<double>")
    # At most k rows a table and key.
    best = F.collect_set(F.struct("distance", F.col("near").alias("key"), "point"))
    return pairs.groupBy("key").agg(F.slice(F.array_sort(best), 1, k).alias("near"))
