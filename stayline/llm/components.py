"""Connected components of a distributed list of links."""

from pyspark.sql import functions as F

from stayline.session import checkpointed


def _state(links):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def _star(pairs, keep):
    """Each vertex u links its neighbours chosen by `keep` to the least of them and itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("u2"), F.least("u2", "m").alias("m"))
    return pairs.join(least, F.col("u") == F.col("u2")).where(keep)


def components(links):
    """id and label (the least id reachable) of every id in `links` (a, b).

    Alternates large-star and small-star rounds: all neighbours above a vertex, then
    all below it, are linked to the least one, until nothing changes. A vertex with many
    links costs one aggregation and a join that adaptive execution splits; nothing is
    gathered. Nulls and links from an id to itself are left out; an empty list gives an
    empty result.
    """
    links = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = checkpointed(links)
    before, now = None, _state(links)
    while now != before:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        kept = _star(large, "true")
        small = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            kept.select("u", F.col("m").alias("v")))
        links = checkpointed(small.where("u <> v").distinct())
        before, now = now, _state(links)
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)
