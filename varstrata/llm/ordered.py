"""Places of rows in an order, within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varstrata.plans.runtime import written

_TASK = 33  # the bits of monotonically_increasing_id that count within a task


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str], label: str = "ranked") -> DataFrame:
    """Adds __rank, a row's place from 0 within its group, and __n, the group's rows. Nulls come first; null groups are one group.

    Rows are dealt by ranges of group and order, sorted and written; a place is the place in its range plus the group's rows in earlier ranges,
    which are prefix sums over one row for each range and group. So no task holds a group. Rows equal in group and order are placed as they were read;
    they too may go over several ranges.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(*keys, F.col("__row")).sortWithinPartitions(*keys, F.col("__row")).drop("__row")
    placed = written(dealt.withColumn("__at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("__range", F.shiftright("__at", _TASK))

    counted = placed.groupBy("__range", *group).agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
    by_group = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = by_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select(
        F.col("__range").alias("__of"), *[F.col(c).alias(f"__of_{c}") for c in group],
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first")).alias("__base"), F.sum("__rows").over(by_group).alias("__n"),
    )
    same = F.col("__range") == F.col("__of")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    joined = placed.join(bases, same)
    return joined.withColumn("__rank", F.col("__at") + F.col("__base")).drop("__at", "__range", "__base", "__of", *[f"__of_{c}" for c in group])
