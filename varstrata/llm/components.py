"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.plans.runtime import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, component) for each node that has a link; component is the smallest node reachable.

    Every round moves links to the smallest neighbour of their end points, first for the larger neighbours of each
    node, then for the smaller ones. Neighbour lists are never gathered: a round is a minimum per node and an equi-join,
    whose skewed partitions Spark can split, so a component may hold most of the nodes. Each round is written to the
    shared folder. Links with a null end and self links are left out; an empty table gives an empty result.
    """
    pairs = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        # large star: neighbours above a node move to the node's minimum
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: a node and its neighbours below move to the minimum of those
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u != v")
            .distinct()
        )
        pairs = written(small, "links")
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    star = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(star.select("component", "component").distinct())
