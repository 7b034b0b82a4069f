"""Tumbling-window statistics of streams and their per-window totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.functions.columns import col, resolve
from varstrata.operators.stats import cumulative_stats, join_totals, windowed_total
from varstrata.streaming.runner import append_to, batches_to, read_batches, run_batches, write_batch


def windows_to(
    stats: DataFrame, keys: str | Sequence[str], path: str, checkpoint: str, *, closed_only: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """A streaming :func:`windowed_stats` as a table of windows, with the column ``closed``.

    Every micro-batch writes the windows it changes; of each window and stratum the newest row counts. So the table also
    holds the windows of the latest events, which no watermark has passed yet: ``closed`` tells whether the latest event
    lies past a window's end. With ``closed_only`` windows come once, as they close, and the open ones not at all.

    An open window is written once for each micro-batch that changes it.
    """
    key_names = resolve(stats.columns, keys)
    if closed_only:
        return append_to(stats, path, checkpoint, partitions=partitions).withColumn("closed", F.lit(True))
    changes = batches_to(stats, path, checkpoint, mode="update", partitions=partitions)
    values = [c for c in stats.columns if c != "window" and c not in key_names]
    newest = changes.groupBy("window", *[col(k) for k in key_names]).agg(
        F.max_by(F.struct(*[col(v) for v in values]), "batch_id").alias("__newest")
    )
    table = newest.select("window", *[col(k) for k in key_names], *[F.col("__newest").getField(v).alias(v) for v in values])
    latest = table.agg(F.max("window.end").alias("latest")).first().latest
    # windows are whole in time order: all but the last one have events after them
    return table.select(*[col(c) for c in stats.columns], (F.col("window.end") < F.lit(latest)).alias("closed"))


def window_gamma(stats: DataFrame, width: str = "30 seconds") -> DataFrame:
    """Sum of ``gamma`` per window of :func:`windowed_stats`: a window over windows.

    ``width`` is the width those statistics were made with. Only strata with rows in the window
    count. On a stream, results come as windows close (append mode); on a table of windows, for all of them.
    """
    by = F.window(F.col("window"), width).alias("window") if stats.isStreaming else F.col("window")
    return stats.groupBy(by).agg(F.count(F.lit(1)).alias("strata"), F.sum("gamma").alias("total_gamma"))


def totals_to(
    stats: DataFrame, path: str, checkpoint: str, *, keys: str | Sequence[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Attach each window's total of ``gamma`` to its strata, into a table at ``path``.

    With ``keys``, of all windows (:func:`windows_to`). Without, of windows as they close: in append mode all strata of a
    window arrive in one micro-batch, when the watermark passes its end; so the total over the batch is the total over
    the window, and the join needs no state.
    """
    if keys is not None:
        return windowed_total(windows_to(stats, keys, path, checkpoint, partitions=partitions))
    schema = T.StructType([*stats.schema.fields, T.StructField("total_gamma", T.DoubleType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        # read twice, for the total and for the rows; a lost part is computed again from the same state
        batch = batch.persist()
        try:
            write_batch(join_totals(batch), path, batch_id)
        finally:
            batch.unpersist()

    run_batches(stats, write, checkpoint, mode="append", partitions=partitions)
    return read_batches(stats.sparkSession, path, schema)


def cumulative_to(
    stats: DataFrame, keys: str | Sequence[str], path: str, checkpoint: str, *, weight: float = 1.0,
    degenerate: str = "zero", abs_mean: bool = False, closed_only: bool = False, partitions: int | None = None,
) -> DataFrame:
    """Streaming form of :func:`cumulative_stats`: each window's row covers this and all earlier windows.

    The stream keeps the table of windows (:func:`windows_to`), the running statistics are frames over it: one row for each
    window and stratum, built-in columns throughout. The result has the ``window`` column, so that totals and quotas
    attach to it.
    """
    windows = windows_to(stats, keys, path, checkpoint, closed_only=closed_only, partitions=partitions)
    return cumulative_stats(windows, keys, weight=weight, degenerate=degenerate, abs_mean=abs_mean)
