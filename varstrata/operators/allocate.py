"""Division of the sampling budget among the strata, and its join to the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.functions.columns import col, quota, resolve
from varstrata.operators.stats import strata_stats, windowed_stats, windowed_total, with_total

# A table of strata is broadcast only if its size, from counted rows and measured keys, is below this.
BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 96  # bytes of a broadcast row besides its key: counts, quota, cut-off, hash entry


def with_quota(
    stats: DataFrame, m: float = 20.0, *, degenerate: str = "zero", min_per_stratum: int = 0
) -> DataFrame:
    """Add ``s``, the rows to draw per stratum, to statistics that carry ``total_gamma``.

    ``s`` is rounded per stratum, so the quotas need not add up to ``m``, and may exceed ``n``.
    """
    s = quota(F.col("gamma"), F.col("total_gamma"), m, degenerate=degenerate)
    if min_per_stratum:
        s = F.greatest(s, F.lit(min_per_stratum).cast("bigint"))
    return stats.withColumn("s", s)


def allocation(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    m: float = 20.0,
    *,
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    bad_measure: str = "zero",
    min_per_stratum: int = 0,
) -> DataFrame:
    """Allocation table: keys, ``n, mean, sd, gamma, total_gamma, s``, one row per stratum.

    Runs a job when called: the statistics are written once, their total is read back.
    """
    stats = strata_stats(
        df, keys, measure, weight=weight, degenerate=degenerate, abs_mean=abs_mean, bad_measure=bad_measure
    )
    return with_quota(with_total(stats), m, degenerate=degenerate, min_per_stratum=min_per_stratum)


def windowed_allocation(
    df: DataFrame, keys: str | Sequence[str], measure: str, ts: str, width: str, m: float = 20.0, *, min_per_stratum: int = 0,
    degenerate: str = "zero", **options,
) -> DataFrame:
    """Allocation of ``m`` rows in each tumbling window of ``ts``: ``window``, keys, ``n``, ``s`` and the statistics behind them.

    The statistics are written once; the total of each window is read from there.
    """
    stats = windowed_total(windowed_stats(df, keys, measure, ts, width, degenerate=degenerate, **options))
    return with_quota(stats, m, degenerate=degenerate, min_per_stratum=min_per_stratum)


def stratum_key(keys: Sequence[str]):
    """The key columns as one struct: equal structs may hold nulls, so a null key is a stratum too."""
    return F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)])


@dataclass(frozen=True)
class Bounds:
    """Sizes read from an allocation table in one small job; they decide the plan of pass two."""

    strata: int  # all strata
    drawn: int  # strata with s > 0
    rows: int  # rows of the table
    largest_quota: int
    sample_rows: int  # sum of min(s, n)
    row_bytes: int  # widest key plus overhead
    widest_cut: float = 1.0  # the greatest cut-off of a drawn stratum
    quota_rows: int = 0  # sum of s
    candidates: int = 0  # rows that pass the cut-offs, about
    largest_group: int = 0  # the most of them in one stratum

    def all_bytes(self) -> int:
        return self.strata * self.row_bytes

    def drawn_bytes(self) -> int:
        return self.drawn * self.row_bytes


def measure_bounds(alloc: DataFrame, keys: Sequence[str], cut: Column | None = None) -> Bounds:
    """``cut`` is the expression of a stratum's cut-off, as a fraction of its rows."""
    drawn = F.col("s") > 0
    cut = F.lit(1.0) if cut is None else cut
    key_bytes = sum((F.coalesce(F.octet_length(col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))
    row = alloc.agg(
        F.count(F.lit(1)).alias("strata"),
        F.count_if(drawn).alias("drawn"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("s"), F.lit(0)).alias("largest_quota"),
        F.coalesce(F.sum(F.when(drawn, F.least("s", "n"))), F.lit(0)).alias("sample_rows"),
        F.coalesce(F.max(key_bytes), F.lit(0)).alias("key_bytes"),
        F.coalesce(F.max(F.when(drawn, cut)), F.lit(1.0)).alias("widest_cut"),
        F.coalesce(F.sum(F.when(drawn, F.col("s"))), F.lit(0)).alias("quota_rows"),
        F.coalesce(F.sum(F.when(drawn, F.col("n") * cut)), F.lit(0.0)).alias("candidates"),
        F.coalesce(F.max(F.when(drawn, F.col("n") * cut)), F.lit(0.0)).alias("largest_group"),
    ).first()
    return Bounds(
        int(row.strata), int(row.drawn), int(row.rows), int(row.largest_quota), int(row.sample_rows),
        int(row.key_bytes) + ROW_OVERHEAD, float(row.widest_cut), int(row.quota_rows), math.ceil(row.candidates),
        math.ceil(row.largest_group),
    )


def rows_with_allocation(
    df: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    *,
    columns: Sequence[str] = ("n", "total_gamma", "s"),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach the allocation to every row of its stratum; rows of unknown strata are dropped.

    The table of strata is broadcast if its counted size allows it. Otherwise rows are joined by a
    shuffle on the keys, where the adaptive planner splits the partitions of hot strata.
    ``df`` may be a stream, ``alloc`` is a batch table.
    """
    alloc_keys = resolve(alloc.columns, resolve(df.columns, keys))
    fits = measure_bounds(alloc, alloc_keys).all_bytes() <= broadcast_bytes
    return attach(df, alloc, keys, columns, broadcast=fits)


def attach(
    df: DataFrame, alloc: DataFrame, keys: str | Sequence[str], columns: Sequence[str], *, broadcast: bool
) -> DataFrame:
    """The join of :func:`rows_with_allocation` for a table of known size."""
    key_names = resolve(df.columns, keys)
    taken = [c for c in columns if c in df.columns]
    if taken:
        raise ValueError(f"columns {taken} exist already; rename them first")
    side = alloc.select(
        stratum_key(resolve(alloc.columns, key_names)).alias("__of"), *[F.col(c) for c in columns]
    )
    side = F.broadcast(side) if broadcast else side.hint("merge")
    return df.join(side, stratum_key(key_names) == F.col("__of")).drop("__of")
