"""Second pass: the rows of the sample."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.functions import ranks
from varstrata.functions.columns import as_names, col, measure_value, resolve, resolve_roles
from varstrata.operators.allocate import (
    BROADCAST_BYTES,
    Bounds,
    allocation,
    measure_bounds,
    stratum_key,
    windowed_allocation,
)
from varstrata.operators.lowest import ROWS_PER_TASK, keep_lowest
from varstrata.plans.runtime import materialize

GROUP, OF, RANK, CUT, SIZE, QUOTA = "__stratum", "__of", "__rank", "__cut", "__n", "__s"


def stratified_sample(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    m: float = 20.0,
    *,
    id: str | Sequence[str] | None = None,
    seed: int = 42,
    hash: str = "xxhash64",
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    bad_measure: str = "zero",
    min_per_stratum: int = 0,
    with_quota: bool = False,
) -> DataFrame:
    """Draw ``min(s_i, n_i)`` rows uniformly without replacement from every stratum.

    The table is read twice: once for the statistics that fix the quotas ``s_i``, once for the rows.
    ``id`` names columns that identify a row; with it the same seed gives the same sample whatever
    the partitioning. The sample is written to the shared checkpoint folder and returned from there.
    """
    df = _readable(df, keys, measure, bad_measure)
    alloc = allocation(
        df, keys, measure, m, weight=weight, degenerate=degenerate, abs_mean=abs_mean,
        bad_measure=bad_measure, min_per_stratum=min_per_stratum,
    )
    return sample_allocated(df, alloc, keys, id=id, seed=seed, hash=hash, with_quota=with_quota)


def _readable(df: DataFrame, keys, measure: str, bad_measure: str) -> DataFrame:
    if bad_measure != "drop":
        return df
    roles = resolve_roles(df.columns, keys, measure)
    return df.filter(measure_value(df, roles.measure, bad_measure).isNotNull())


def sample_allocated(
    df: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    *,
    id: str | Sequence[str] | None = None,
    seed: int = 42,
    hash: str = "xxhash64",
    with_quota: bool = False,
    slack: float = 30.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The second pass alone, for an allocation table with columns ``n`` and ``s`` per stratum.

    Each row gets a uniform rank, and a cut-off per stratum drops nearly all rows during the scan.
    Should a cut-off turn out too low for some stratum (ids that are not unique, counts that do not
    belong to this table), those strata are drawn again without one, so sizes are always exact.
    """
    drawn = draw_rows(
        df, alloc, keys, id=id, seed=seed, hash=hash, slack=slack, broadcast_bytes=broadcast_bytes,
        rows_per_task=rows_per_task,
    )
    return _shape(drawn, df.columns, with_quota)


def draw_rows(
    df: DataFrame, alloc: DataFrame, keys: str | Sequence[str], *, id, seed: int, hash: str, slack: float = 30.0,
    broadcast_bytes: int = BROADCAST_BYTES, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """:func:`sample_allocated` with the stratum, rank, size and quota of each row as extra columns."""
    key_names = resolve(df.columns, keys)
    ids = resolve(df.columns, id) if id is not None else None
    alloc_keys = resolve(alloc.columns, key_names)
    fraction = ranks.cut_fraction(F.col("s"), F.col("n"), slack)
    bounds = measure_bounds(alloc, alloc_keys, fraction)

    # taken before any shuffle, where a random rank is the same again if a task is repeated
    ranked = df.withColumn(RANK, ranks.rank(None, seed)) if ids is None else df

    def add_rank(frame: DataFrame) -> DataFrame:
        return frame if RANK in frame.columns else frame.withColumn(RANK, ranks.rank(ids, seed, hash))

    if bounds.drawn == 0:
        return add_rank(_empty(df).withColumn(GROUP, stratum_key(key_names)))
    quotas = alloc.select(
        stratum_key(alloc_keys).alias(OF),
        F.col("n").alias(SIZE),
        F.col("s").alias(QUOTA),
        ranks.cut_off(fraction, ids, hash).alias(CUT),
    )

    # what lies above every stratum's cut-off need not be joined at all
    near = ranked
    if bounds.widest_cut < 0.5:
        widest = ranks.cut_off(F.lit(bounds.widest_cut), ids, hash)
        near = ranked.filter((F.col(RANK) if ids is None else ranks.rank(ids, seed, hash)) <= widest)
    candidates = _below_cut(near, quotas, key_names, bounds, add_rank, broadcast_bytes)
    order = [F.col(RANK), *[col(i) for i in ids or []]]

    def draw(frame: DataFrame, rows: int, largest_group: int) -> DataFrame:
        return keep_lowest(
            frame, GROUP, order, QUOTA, bounds.largest_quota, rows, largest_group=largest_group, rows_per_task=rows_per_task
        )

    drawn = materialize(draw(candidates, bounds.candidates, bounds.largest_group))
    # stratum by stratum: one with more rows than its count says must not make up for one with fewer
    got = drawn.groupBy(GROUP).agg(F.count(F.lit(1)).alias("__got"))
    short = (
        quotas.filter(F.col(QUOTA) > 0)
        .join(got, F.col(OF) == F.col(GROUP), "left")
        .filter(F.coalesce("__got", F.lit(0)) < F.least(QUOTA, SIZE))
        .select(OF, SIZE, QUOTA)
    )
    if short.isEmpty():
        return drawn
    short = materialize(short)
    full = drawn.join(short.select(F.col(OF).alias("__short")), F.col(GROUP) == F.col("__short"), "left_anti")
    again = ranked.withColumn(GROUP, stratum_key(key_names))
    again = again.join(_side(short, bounds.drawn_bytes(), broadcast_bytes), F.col(GROUP) == F.col(OF)).drop(OF)
    redrawn = materialize(draw(add_rank(again), bounds.rows, bounds.rows))
    return full.select(*redrawn.columns).unionByName(redrawn)


def with_window(df: DataFrame, ts: str, width: str) -> DataFrame:
    """Add ``window``, the tumbling window of ``ts`` that a row lies in; rows without a time have none and are left out."""
    return df.filter(col(ts).isNotNull()).withColumn("window", F.window(col(ts), width))


def windowed_sample(
    df: DataFrame, keys: str | Sequence[str], measure: str, ts: str, width: str, m: float = 20.0, *,
    id: str | Sequence[str] | None = None, seed: int = 42, hash: str = "xxhash64", with_quota: bool = False,
    alloc: DataFrame | None = None, bad_measure: str = "zero", **options,
) -> DataFrame:
    """A sample of ``m`` rows of every window, allotted to the strata by their variation within that window.

    Every row is joined to the allocation of its own window (``alloc``, or made from ``df``), and ``min(s, n)`` rows of
    each window and stratum are drawn. The sample has the column ``window``.
    """
    df = _readable(df, keys, measure, bad_measure)
    key_names = resolve(df.columns, keys)
    if alloc is None:
        alloc = materialize(windowed_allocation(df, key_names, measure, ts, width, m, bad_measure=bad_measure, **options))
    rows = with_window(df, resolve(df.columns, ts)[0], width)
    return sample_allocated(rows, alloc, ["window", *key_names], id=id, seed=seed, hash=hash, with_quota=with_quota)


def _side(table: DataFrame, size: int, broadcast_bytes: int) -> DataFrame:
    return F.broadcast(table) if size <= broadcast_bytes else table.hint("merge")


def _below_cut(ranked, quotas, key_names, bounds: Bounds, add_rank, broadcast_bytes: int) -> DataFrame:
    """Rows of the drawn strata whose rank is below their stratum's cut-off."""
    rows = ranked.withColumn(GROUP, stratum_key(key_names))
    wanted = quotas.filter(F.col(QUOTA) > 0)
    if bounds.drawn_bytes() > broadcast_bytes:
        # At most `slots` strata can hold a `slots`-th of the rows each: that table is small by
        # count, and cuts the hot strata down before the shuffle join brings each stratum together.
        slots = max(1, broadcast_bytes // bounds.row_bytes)
        hot = quotas.filter(F.col(SIZE) * slots >= bounds.rows).select(
            F.col(OF).alias("__hot"), F.col(QUOTA).alias("__hot_s"), F.col(CUT).alias("__hot_cut")
        )
        rows = add_rank(rows.join(F.broadcast(hot), F.col(GROUP) == F.col("__hot"), "left"))
        rows = rows.filter(
            F.col("__hot_s").isNull() | ((F.col("__hot_s") > 0) & (F.col(RANK) <= F.col("__hot_cut")))
        ).drop("__hot", "__hot_s", "__hot_cut")
    rows = rows.join(_side(wanted, bounds.drawn_bytes(), broadcast_bytes), F.col(GROUP) == F.col(OF))
    return add_rank(rows).filter(F.col(RANK) <= F.col(CUT)).drop(OF, CUT)


def _empty(df: DataFrame) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return df.filter(F.lit(False)).withColumn(SIZE, none).withColumn(QUOTA, none)


def _shape(sample: DataFrame, columns: Sequence[str], with_quota: bool) -> DataFrame:
    kept = [col(c) for c in columns]
    if with_quota:
        taken = [c for c in ("n", "s") if c in columns]
        if taken:
            raise ValueError(f"columns {taken} exist already; rename them first")
        kept += [F.col(SIZE).alias("n"), F.col(QUOTA).alias("s")]
    return sample.select(*kept)


def first_fill_sample(
    df: DataFrame,
    keys: str | Sequence[str],
    measure: str,
    m: float = 20.0,
    *,
    arrival: str | Sequence[str],
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    bad_measure: str = "zero",
    with_quota: bool = False,
) -> DataFrame:
    """The first ``s_i`` rows in arrival order of every stratum that has at least ``s_i`` rows.

    This is what a reservoir that reports once, at the moment it first fills, gives out. Strata
    with fewer rows than their quota give nothing. Runs jobs when called.
    """
    df = _readable(df, keys, measure, bad_measure)
    alloc = allocation(
        df, keys, measure, m, weight=weight, degenerate=degenerate, abs_mean=abs_mean, bad_measure=bad_measure
    )
    return first_fill_allocated(df, alloc, keys, arrival=arrival, with_quota=with_quota)


def first_fill_allocated(
    df: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    *,
    arrival: str | Sequence[str],
    with_quota: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """:func:`first_fill_sample` for a given allocation table.

    Rows are counted by stratum and slice of the arrival time; running sums over the slices give the one in which each
    quota fills. Only rows up to there are ranked, whatever the quota.
    """
    key_names = resolve(df.columns, keys)
    times = resolve(df.columns, as_names(arrival))
    order = [col(c) for c in times]
    alloc_keys = resolve(alloc.columns, key_names)
    fills = F.when(F.col("n") >= F.col("s"), F.col("s")).otherwise(F.lit(0).cast("bigint"))
    chosen = alloc.withColumn("s", fills)
    bounds = measure_bounds(chosen, alloc_keys)
    if bounds.drawn == 0:
        return _shape(_empty(df), df.columns, with_quota)
    quotas = chosen.select(stratum_key(alloc_keys).alias(OF), F.col("n").alias(SIZE), F.col("s").alias(QUOTA))

    slices = _slice(df, times[0])
    rows = df.withColumn(GROUP, stratum_key(key_names)).withColumn("__slice", slices)
    counts = rows.groupBy(F.col(GROUP).alias("__counted"), "__slice").agg(F.count(F.lit(1)).alias("__size"))
    so_far = Window.partitionBy("__counted").orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        counts.join(quotas.filter(F.col(QUOTA) > 0), F.col("__counted") == F.col(OF))
        .withColumn("__end", F.sum("__size").over(so_far))
        .groupBy(OF, SIZE, QUOTA)
        .agg(
            F.min(F.when(F.col("__end") >= F.col(QUOTA), F.col("__slice"))).alias("__until"),
            F.min(F.when(F.col("__end") >= F.col(QUOTA), F.col("__end"))).alias("__early"),
        )
    )
    ends = materialize(ends)
    sizes = ends.select(F.coalesce("__early", SIZE).alias("rows")).agg(F.sum("rows").alias("all"), F.max("rows").alias("most")).first()
    early = [
        frame.filter(F.col("__until").isNull() | (F.col("__slice") <= F.col("__until"))).drop("__slice", "__until", "__early")
        for frame in _quoted(rows, ends, bounds, broadcast_bytes)
    ]
    drawn = [
        keep_lowest(
            frame, GROUP, order, QUOTA, bounds.largest_quota, sizes["all"] or 0, largest_group=sizes["most"] or 0,
            rows_per_task=rows_per_task,
        )
        for frame in early
    ]
    return _shape(reduce(DataFrame.unionByName, drawn), df.columns, with_quota)


SLICES = 4096


def _slice(df: DataFrame, time: str) -> Column:
    """A number that never falls as ``time`` rises: equal slices between its least and greatest value; one slice if it is no number."""
    kind, value = df.schema[time].dataType, col(time)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        number = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("double") * 86_400 + seconds
    elif isinstance(kind, T.DateType):
        number = F.datediff(value, F.lit("1970-01-01").cast("date")).cast("double")
    elif isinstance(kind, (T.NumericType, T.TimestampType)):
        number = value.cast("double")
    else:
        return F.lit(0)
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    ends = df.agg(F.min(finite).alias("low"), F.max(finite).alias("high")).first()
    low, width = ends["low"] or 0.0, (ends["high"] or 0.0) - (ends["low"] or 0.0)
    inside = F.floor((number - low) * (SLICES / width)).cast("int") if 0 < width < float("inf") else F.lit(0)
    # nulls come first in arrival order, NaN last
    return (
        F.when(number.isNull(), -1).when(F.isnan(number) | (number > low + width), SLICES + 1).when(number < low, 0)
        .otherwise(F.least(F.greatest(inside, F.lit(0)), F.lit(SLICES)))
    )


def _quoted(rows: DataFrame, quotas: DataFrame, bounds: Bounds, broadcast_bytes: int) -> list[DataFrame]:
    """Rows with their quotas, in frames none of which shuffles a hot stratum to join it."""
    wanted = quotas.filter(F.col(QUOTA) > 0)
    if bounds.drawn_bytes() <= broadcast_bytes:
        return [rows.join(F.broadcast(wanted), F.col(GROUP) == F.col(OF)).drop(OF)]
    slots = max(1, broadcast_bytes // bounds.row_bytes)
    is_hot = F.col(SIZE) * slots >= bounds.rows
    hot = rows.join(F.broadcast(wanted.filter(is_hot)), F.col(GROUP) == F.col(OF)).drop(OF)
    hot_keys = quotas.filter(is_hot).select(F.col(OF).alias("__hot"))
    cold = rows.join(F.broadcast(hot_keys), F.col(GROUP) == F.col("__hot"), "left_anti")
    return [hot, cold.join(wanted.filter(~is_hot).hint("merge"), F.col(GROUP) == F.col(OF)).drop(OF)]
