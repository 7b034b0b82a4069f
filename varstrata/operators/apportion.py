"""A sampling budget divided so that the quotas add up and none exceeds its stratum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.functions.columns import col, resolve
from varstrata.operators.allocate import stratum_key
from varstrata.operators.lowest import keep_lowest
from varstrata.operators.stats import strata_stats, with_total
from varstrata.plans.runtime import materialize

EVEN = 1e-9  # shares this close to a whole number are that number: sums in another order differ by less


def apportioned(stats: DataFrame, keys: str | Sequence[str], m: float) -> DataFrame:
    """Add ``s`` to statistics with ``n`` and ``gamma``, so that the quotas add up to ``min(m, all rows)`` and ``s <= n`` in each stratum.

    Quotas are in proportion to ``gamma`` as far as the strata reach: what a small stratum cannot take goes to the others in proportion (water-filling:
    ``s = min(n, level * gamma)``). If all strata with variation are taken whole, the rest goes to those without (``gamma`` of 0 or below, null, or not
    finite) in proportion to ``n``. Shares are rounded down, and the rows that are left go one each to the largest remainders, ties to the lower key.

    A null key is a stratum; ``m`` is rounded down and counts as 0 if negative; no strata give no rows. The strata are written once and never all in one
    task: the level is found by aggregates over them, the remainders by the ranked cut of the sample itself. Runs jobs when called.
    """
    key_names = resolve(stats.columns, keys)
    varies = (F.col("gamma") > 0) & (F.col("gamma") < float("inf"))
    stats = materialize(stats.withColumn("__w", F.when(varies, F.col("gamma")).otherwise(0.0)))
    sums = stats.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("__w") > 0, F.col("n"))), F.lit(0)).alias("varied"),
    ).first()
    budget = min(max(int(m), 0), sums.rows)

    whole = F.col("n").cast("double")
    if sums.varied < budget:
        share = F.when(F.col("__w") > 0, whole).otherwise(whole * (budget - sums.varied) / max(sums.rows - sums.varied, 1))
    else:
        share = F.least(whole, F.col("__w") * _level(stats, budget))
    base = F.floor(share + EVEN)
    shares = materialize(
        stats.withColumns({"s": base, "__left": F.round(share - base, 9), "__all": F.lit(0)}).drop("__w")
    )
    given = shares.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("given"), F.count(F.lit(1)).alias("strata")).first()
    spare = budget - given.given
    if spare <= 0:
        return shares.drop("__left", "__all")

    room = shares.filter(F.col("s") < F.col("n")).withColumn("__spare", F.lit(spare))
    by_rank = room.select(*[col(k) for k in key_names], "__all", "__spare", (-F.col("__left")).alias("__rank"))
    order = [F.col("__rank"), *[col(k) for k in key_names]]
    more = keep_lowest(by_rank, "__all", order, "__spare", spare, given.strata, largest_group=given.strata)
    more = more.select(stratum_key(key_names).alias("__of"), F.lit(1).alias("__more"))
    joined = shares.join(more, stratum_key(key_names) == F.col("__of"), "left")
    return joined.withColumn("s", F.col("s") + F.coalesce("__more", F.lit(0))).drop("__left", "__all", "__of", "__more")


def _level(stats: DataFrame, budget: int) -> float:
    """The number by which ``sum(min(n, level * w))`` is ``budget``, which all strata with ``w > 0`` together can take.

    The level rises while strata are full: each round takes the full ones out and divides what is left among the others. A round is one
    aggregate; none comes back, and the rounds end when no further stratum is full.
    """
    level, full = 0.0, -1
    while True:
        filled = F.col("n") <= F.col("__w") * level
        now = stats.filter("__w > 0").agg(
            F.count_if(filled).alias("full"),
            F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~filled, F.col("__w"))), F.lit(0.0)).alias("open"),
        ).first()
        if now.full == full or not now.open:
            return level
        level, full = max(level, (budget - now.taken) / now.open), now.full


def apportioned_allocation(df: DataFrame, keys: str | Sequence[str], measure: str, m: float = 20.0, **options) -> DataFrame:
    """:func:`allocation` with quotas that add up to the budget; ``options`` are those of :func:`strata_stats`."""
    return apportioned(with_total(strata_stats(df, keys, measure, **options)), resolve(df.columns, keys), m)
