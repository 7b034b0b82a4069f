"""The lowest ``s`` rows of every group, where ``s`` differs by group and groups may be huge."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varstrata.plans.runtime import conf_int, materialize

GROUP_LIMIT_KEY = "spark.sql.optimizer.windowGroupLimitThreshold"
ROWS_PER_TASK = 4_000_000
MAX_SALTS = 4096


def group_limit(spark: SparkSession) -> int:
    """The greatest position for which the planner trims groups before a shuffle."""
    return conf_int(spark, GROUP_LIMIT_KEY, 1000)


def keep_lowest(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    limit: str,
    largest: int,
    rows: int,
    *,
    largest_group: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Keep the rows whose position in ``group`` by ``order`` is at most the column ``limit``.

    ``largest`` is the greatest limit, ``rows`` about the number of rows of ``df`` and ``largest_group`` that of its largest group, if known.
    Up to the planner's group-limit threshold every task first trims its own rows to ``largest`` per group,
    before the shuffle. Above it, groups that fit a task are ranked by a plain window; larger ones are cut into ranges, so
    that no task sees a whole group.
    """
    if largest <= group_limit(df.sparkSession):
        return _trimmed(df, group, order, limit, largest, min(MAX_SALTS, math.ceil(rows / rows_per_task)))
    if largest_group is not None and largest_group <= rows_per_task:
        placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
        return placed.filter(F.col("__place") <= F.col(limit)).drop("__place")
    return _ranged(df, group, order, limit)


def _trimmed(df, group, order, limit, largest, salts) -> DataFrame:
    if salts > 1:
        # a level in between: many tasks may each send a full quota of one group
        salted = Window.partitionBy(group, "__salt").orderBy(*order)
        df = (
            df.withColumn("__salt", F.spark_partition_id() % salts)
            .withColumn("__place", F.row_number().over(salted))
            .filter(F.col("__place") <= largest)
            .drop("__salt", "__place")
        )
    placed = df.withColumn("__place", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    # the literal bound is what lets the planner trim before the shuffle
    return placed.filter((F.col("__place") <= largest) & (F.col("__place") <= F.col(limit))).drop("__place")


def _ranged(df, group, order, limit) -> DataFrame:
    names = [f"__order{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.alias(name) for o, name in zip(order, names, strict=True)])
    # range bounds are sampled from the rows, so these are written first; the last column spreads copies
    keyed = materialize(keyed.withColumn("__spread", F.monotonically_increasing_id()))
    full_order = [*names, "__spread"]
    placed = materialize(
        keyed.repartitionByRange(group, *full_order).withColumn("__part", F.spark_partition_id())
    )

    before = (
        Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = (
        placed.groupBy(group, "__part")
        .agg(F.count(F.lit(1)).alias("__size"), F.first(limit).alias("__limit"))
        .withColumn("__end", F.sum("__size").over(before))
        .withColumn("__need", F.col("__limit") - (F.col("__end") - F.col("__size")))
        .filter(F.col("__need") > 0)
        .select(F.col(group).alias("__piece_of"), F.col("__part").alias("__piece"), "__size", "__need")
    )
    pieces = materialize(pieces)
    here = (F.col(group) == F.col("__piece_of")) & (F.col("__part") == F.col("__piece"))
    added = [*full_order, "__part", "__piece_of", "__piece", "__size", "__need"]

    whole = placed.join(pieces.filter(F.col("__size") <= F.col("__need")), here)
    within = Window.partitionBy(group, "__part").orderBy(*full_order)
    cut = (
        placed.join(pieces.filter(F.col("__size") > F.col("__need")), here)
        .withColumn("__place", F.row_number().over(within))
        .filter(F.col("__place") <= F.col("__need"))
        .drop("__place")
    )
    return whole.unionByName(cut).drop(*added)
