"""First pass: statistics of every stratum, their total, and running statistics over windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varstrata.functions.columns import col, measure_value, resolve_roles, variation
from varstrata.plans.runtime import materialize


def _measured(df: DataFrame, keys, measure: str, bad_measure: str) -> tuple[DataFrame, list[str], Column]:
    roles = resolve_roles(df.columns, keys, measure)
    value = measure_value(df, roles.measure, bad_measure)
    if bad_measure == "drop":
        df = df.filter(value.isNotNull())
    return df, list(roles.keys), value


def _summaries(value: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        # a one-pass moment merge: exactly 0 for constant data and never NaN for finite data
        F.stddev_pop(value).alias("sd"),
    ]


def strata_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    *,
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    bad_measure: str = "zero",
) -> DataFrame:
    """Per stratum: ``n``, ``mean``, population ``sd`` and ``gamma = sqrt(weight) * sd / mean``.

    One partial and one final hash aggregate: a stratum of any size sends one row per map task.
    Only key and measure columns are read.
    """
    df, key_names, value = _measured(df, keys, measure, bad_measure)
    grouped = df.groupBy(*[col(k) for k in key_names]).agg(*_summaries(value))
    return grouped.withColumn(
        "gamma", variation(F.col("mean"), F.col("sd"), weight=weight, degenerate=degenerate, abs_mean=abs_mean)
    )


def total_gamma(stats: DataFrame) -> DataFrame:
    """One row: the sum of ``gamma`` over all strata."""
    return stats.agg(F.sum("gamma").alias("total_gamma"))


def with_total(stats: DataFrame) -> DataFrame:
    """Attach the total of ``gamma`` to every stratum.

    The statistics are written once and read twice, the first time for the total, which is one
    number; so the table itself is scanned once.
    """
    stats = materialize(stats)
    total = total_gamma(stats).first().total_gamma
    return stats.withColumn("total_gamma", F.lit(total).cast("double"))


def windowed_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    ts: str,
    width: str = "30 seconds",
    *,
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    bad_measure: str = "zero",
) -> DataFrame:
    """:func:`strata_stats` per tumbling window of ``ts``; adds a ``window`` struct column.

    Batch and streaming frames alike; a stream needs a watermark on ``ts``. ``low`` and ``high`` are
    the extremes of the measure, which :func:`cumulative_stats` needs.
    """
    df, key_names, value = _measured(df, keys, measure, bad_measure)
    grouped = df.groupBy(F.window(col(ts), width).alias("window"), *[col(k) for k in key_names]).agg(
        *_summaries(value), F.min(value).alias("low"), F.max(value).alias("high")
    )
    return grouped.withColumn(
        "gamma", variation(F.col("mean"), F.col("sd"), weight=weight, degenerate=degenerate, abs_mean=abs_mean)
    )


def windowed_total(windowed: DataFrame) -> DataFrame:
    """Attach to every (window, stratum) row the sum of ``gamma`` over its window; runs a job when called.

    An aggregate of one row per window and task, then an equi-join on the window. The windowed
    statistics are written once, so the table is scanned once; the join's strategy is left to the
    runtime statistics, which also split a window that holds very many strata.
    """
    return join_totals(materialize(windowed))


def join_totals(windowed: DataFrame) -> DataFrame:
    """The join of :func:`windowed_total`, for statistics that are cheap to read twice."""
    totals = windowed.groupBy("window").agg(F.sum("gamma").alias("total_gamma"))
    return windowed.join(totals, "window")


def cumulative_stats(
    windowed: DataFrame,
    keys: str | Sequence[str],
    *,
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
) -> DataFrame:
    """Running statistics: each window's row covers this and all earlier windows of its stratum.

    Takes the output of :func:`windowed_stats`. The frames run over one row per window, not over
    data rows. Window means are taken relative to the stratum's first one, so that squares do not
    cancel, and a stratum whose extremes agree has deviation 0.
    """
    key_names = list(resolve_roles(windowed.columns, keys).keys)
    running = running_moments(windowed, key_names)
    gamma = variation(F.col("mean"), F.col("sd"), weight=weight, degenerate=degenerate, abs_mean=abs_mean)
    return running.select("window", *[col(k) for k in key_names], "n", "mean", "sd", gamma.alias("gamma"))


def running_moments(windowed: DataFrame, key_names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``n``, ``mean``, ``sd``, ``low`` and ``high`` of each window and all earlier ones of its stratum; columns in ``keep`` stay.

    A row may itself cover many windows, as long as it comes first: what was carried forward goes on from there.
    """
    by_key = Window.partitionBy(*[col(k) for k in key_names]).orderBy(F.col("window.start"))
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    moved = F.col("mean") - F.first("mean").over(so_far)
    shifted = windowed.withColumn("__origin", F.first("mean").over(so_far)).withColumn("__moved", moved)
    running = shifted.select(
        "window",
        *[col(k) for k in [*key_names, *keep]],
        F.sum("n").over(so_far).alias("n"),
        F.col("__origin"),
        F.sum(F.col("n") * F.col("__moved")).over(so_far).alias("__s1"),
        F.sum(F.col("n") * (F.col("sd") * F.col("sd") + F.col("__moved") * F.col("__moved")))
        .over(so_far)
        .alias("__s2"),
        F.min("low").over(so_far).alias("low"),
        F.max("high").over(so_far).alias("high"),
    )
    drift = F.col("__s1") / F.col("n")
    variance = F.greatest(F.lit(0.0), F.col("__s2") / F.col("n") - drift * drift)
    return (
        running.withColumn("mean", F.col("__origin") + drift)
        .withColumn("sd", F.when(F.col("low") == F.col("high"), F.lit(0.0)).otherwise(F.sqrt(variance)))
        .drop("__origin", "__s1", "__s2")
    )
