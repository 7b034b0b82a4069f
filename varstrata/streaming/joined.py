"""Joins of two running streams: rows with the statistics of their window, while both go on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from varstrata.functions.columns import as_names, col, resolve
from varstrata.operators.allocate import with_quota
from varstrata.operators.sample import sample_allocated
from varstrata.operators.stats import join_totals
from varstrata.plans.runtime import materialize
from varstrata.streaming.runner import read_batches, run_batches, write_batch

JOINED = ["n", "mean", "sd", "gamma"]
SALTS = 8
WATERMARK = "spark.watermarkDelayMs"  # fixed name, in the metadata of a column with a watermark


def joined_stream(
    rows: DataFrame, stats: DataFrame, keys: str | Sequence[str], *, spread: str | Sequence[str] | None = None, salts: int = SALTS
) -> DataFrame:
    """Rows of one stream with ``n``, ``mean``, ``sd`` and ``gamma`` of their window and stratum, which another stream gives out as windows close.

    rows: a stream with a ``window`` column made from a time with a watermark (:func:`with_window` of :func:`with_event_time`); stats: a streaming
    :func:`windowed_stats` of the same width. An inner join in append mode: rows wait in the state until their window's statistics come and leave it as the
    watermark passes the window's end, so the state holds the windows that are open, on both sides.

    A stratum may have most rows of a window. So each is dealt over ``salts`` keys by a hash of ``spread`` (columns that differ between its rows, such as the id),
    and the statistics, one row for each window and stratum, are repeated for each of them.

    Null keys are a stratum and join. Rows without a time have no window and are left out. A column of rows named like a statistic is an error.
    """
    key_names = resolve(rows.columns, keys)
    taken = [c for c in JOINED if c in rows.columns]
    if taken:
        raise ValueError(f"columns {taken} exist already; rename them first")
    salts = salts if spread is not None else 1
    of = resolve(stats.columns, key_names)
    side = stats.select(
        F.col("window").alias("__window"), *[col(k).alias(f"__of_{i}") for i, k in enumerate(of)], *JOINED,
        F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("__of_salt"),
    )
    salt = F.pmod(F.xxhash64(*[col(c) for c in as_names(spread)]), F.lit(salts)) if spread is not None else F.lit(0).cast("bigint")
    same = (F.col("window") == F.col("__window")) & (F.col("__salt") == F.col("__of_salt"))
    for i, k in enumerate(key_names):
        same = same & col(k).eqNullSafe(F.col(f"__of_{i}"))
    joined = _by_window_only(rows).withColumn("__salt", salt).join(side, same)
    return joined.select(*[col(c) for c in rows.columns], *JOINED)


def _by_window_only(rows: DataFrame) -> DataFrame:
    """The same rows, with no watermark but that of ``window``: Spark allows one event time in a stateful operator."""
    timed = [f.name for f in rows.schema.fields if WATERMARK in (f.metadata or {}) and f.name != "window"]
    return rows.withColumns({c: F.timestamp_micros(F.unix_micros(col(c))) for c in timed})


def stream_sample_to(
    rows: DataFrame,
    stats: DataFrame,
    keys: str | Sequence[str],
    m: float,
    path: str,
    checkpoint: str,
    *,
    id: str | Sequence[str],
    seed: int = 42,
    hash: str = "xxhash64",
    salts: int = SALTS,
    partitions: int | None = None,
) -> tuple[DataFrame, StreamingQuery]:
    """Both passes over running streams: a sample of ``m`` rows of each window as it closes; returns the table, and the ended query with its progress.

    The second pass does not wait for a finished first one: rows meet the statistics of their own window through :func:`joined_stream`. All strata and rows of a window come out
    in the micro-batch in which it closes, so the quotas and the exact sample of that window are made there, by the operators that batches use. The sample has
    ``window``, the rows' columns, ``n`` and ``s``; it equals :func:`windowed_sample` over the closed windows.
    """
    key_names = resolve(rows.columns, keys)
    met = joined_stream(rows, stats, key_names, spread=id, salts=salts)
    by_window = ["window", *key_names]

    def draw(batch: DataFrame, batch_id: int) -> None:
        batch = materialize(batch)  # read for the quotas and for the rows
        strata = batch.groupBy(*[col(k) for k in by_window]).agg(*[F.first(c).alias(c) for c in JOINED])
        alloc = materialize(with_quota(join_totals(materialize(strata)), m))
        plain = batch.select(*[col(c) for c in rows.columns])
        write_batch(sample_allocated(plain, alloc, by_window, id=id, seed=seed, hash=hash, with_quota=True), path, batch_id)

    query = run_batches(met, draw, checkpoint, mode="append", partitions=partitions)
    added = [T.StructField(c, T.LongType()) for c in ("n", "s")]
    return read_batches(rows.sparkSession, path, T.StructType([*rows.schema.fields, *added])), query
