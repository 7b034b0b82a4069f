"""Running statistics of a stream that are carried forward from micro-batch to micro-batch, and forgotten when idle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.functions.columns import col, resolve, variation
from varstrata.operators.stats import running_moments
from varstrata.plans.runtime import materialize
from varstrata.streaming.runner import read_batches, run_batches, table_at, write_batch

MOMENTS = ["n", "mean", "sd", "low", "high"]
HELD = "__held"
LIFE = "__life"


def carried_to(
    stats: DataFrame,
    keys: str | Sequence[str],
    path: str,
    checkpoint: str,
    *,
    expire: str | None = None,
    weight: float = 1.0,
    degenerate: str = "zero",
    abs_mean: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Running statistics of a streaming :func:`windowed_stats`, window by window as they close; returns the table of them.

    One row of moments for each live stratum is kept beside the results, under ``{path}/held``, in two slots written in turn, so that a repeated
    micro-batch finds its predecessor whole. A micro-batch reads that row and its own closed windows, never the windows before, so its cost
    follows the live strata and the change, however long the stream has run. The results are those of :func:`cumulative_stats` over all closed windows.

    expire: an interval such as ``"7 days"``. A stratum that has no events for longer than that, from the end of its last window to the start of the next one,
    begins anew. Its row of moments is dropped as soon as every later window must lie beyond that, so that the state holds live strata only. Without ``expire``
    strata are kept for ever.

    Null keys are a stratum. Windows must be of one width. An empty micro-batch changes nothing.
    """
    key_names = resolve(stats.columns, keys)
    spark = stats.sparkSession
    parts = ["window", *key_names, *MOMENTS]
    held_schema = T.StructType([*stats.select(*[col(c) for c in parts]).schema.fields, T.StructField("__batch", T.LongType())])
    gamma = variation(F.col("mean"), F.col("sd"), weight=weight, degenerate=degenerate, abs_mean=abs_mean)
    result = ["window", *key_names, "n", "mean", "sd"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*[col(c) for c in parts], F.lit(False).alias(HELD))
        if batch_id > 0:
            held = table_at(spark, f"{path}/held/slot={(batch_id - 1) % 2}", held_schema)
            rows = rows.unionByName(held.select(*[col(c) for c in parts], F.lit(True).alias(HELD)))
        rows = _lives(rows, key_names, expire)
        running = materialize(running_moments(rows, [*key_names, LIFE], [HELD]))
        done = running.filter(~F.col(HELD))
        write_batch(done.select(*[col(c) for c in result], gamma.alias("gamma")), f"{path}/rows", batch_id)

        last = F.max_by(F.struct("window", *MOMENTS), F.col("window.start"))
        kept = running.groupBy(*[col(k) for k in key_names]).agg(last.alias("__last"))
        kept = kept.select("__last.window", *[col(k) for k in key_names], *[f"__last.{m}" for m in MOMENTS])
        if expire is not None:
            newest = running.agg(F.max("window.start").alias("start")).first().start
            kept = kept.filter(~_idle(F.col("window.end"), F.lit(newest), expire))
        kept = kept.withColumn("__batch", F.lit(batch_id).cast("bigint"))
        kept.select(*held_schema.names).write.mode("overwrite").parquet(f"{path}/held/slot={batch_id % 2}")

    run_batches(stats, merge, checkpoint, mode="append", partitions=partitions)
    schema = T.StructType([*stats.select(*[col(c) for c in result]).schema.fields, T.StructField("gamma", T.DoubleType())])
    return read_batches(spark, f"{path}/rows", schema)


def held_strata(spark, path: str) -> DataFrame:
    """The rows of moments that :func:`carried_to` holds at ``path``: one for each live stratum."""
    slots = spark.read.parquet(f"{path}/held")
    last = slots.agg(F.max("__batch").alias("last")).first().last
    return slots.filter(F.col("__batch") == F.lit(last)).drop("__batch", "slot")


def _idle(end: Column, start: Column, expire: str) -> Column:
    """Whether a window that begins at ``start`` comes too late for one that ended at ``end``."""
    return start > end + F.expr(f"interval {expire}")


def _lives(rows: DataFrame, key_names: Sequence[str], expire: str | None) -> DataFrame:
    """Number the lives of each stratum: a new one begins after every gap that is too long."""
    if expire is None:
        return rows.withColumn(LIFE, F.lit(0).cast("bigint"))
    by_key = Window.partitionBy(*[col(k) for k in key_names]).orderBy(F.col("window.start"))
    gap = _idle(F.lag("window.end").over(by_key), F.col("window.start"), expire)
    anew = rows.withColumn("__anew", F.coalesce(gap, F.lit(False)).cast("bigint"))
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return anew.withColumn(LIFE, F.sum("__anew").over(so_far)).drop("__anew")
