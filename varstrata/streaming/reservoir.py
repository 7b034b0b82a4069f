"""Reservoirs over a stream: the rows of lowest random rank in every stratum so far.

:func:`reservoir_to` keeps the reservoirs' rows in a table, :func:`admitted_to` also keeps each row ever admitted, for consumers
that want rows as they come. Both draw from each micro-batch with the batch operators and merge what is drawn with the rows
held, so no more than twice the quotas is ever ranked; rows stay in Spark's own columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.functions.columns import as_names, col, resolve
from varstrata.operators.allocate import BROADCAST_BYTES, measure_bounds, stratum_key
from varstrata.operators.lowest import ROWS_PER_TASK, keep_lowest
from varstrata.operators.sample import GROUP, QUOTA, RANK, draw_rows, sample_allocated
from varstrata.plans.runtime import materialize
from varstrata.streaming.runner import read_batches, run_batches, table_at


def reservoir_sample(
    admitted: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    *,
    id: str | Sequence[str],
    seed: int = 42,
    hash: str = "xxhash64",
    with_quota: bool = False,
) -> DataFrame:
    """The reservoirs' content from the table of admitted rows: the lowest ranks per stratum.

    At the end of the stream this is the batch sample with the same seed.
    """
    return sample_allocated(admitted, alloc, keys, id=id, seed=seed, hash=hash, with_quota=with_quota)


def reservoir_to(
    stream: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    path: str,
    checkpoint: str,
    *,
    id: str | Sequence[str],
    seed: int = 42,
    hash: str = "xxhash64",
    with_quota: bool = False,
    partitions: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Process what is there into reservoirs in a table at ``path``; return the reservoirs' rows.

    The table has two slots, written in turn, so that a repeated micro-batch finds its predecessor whole.
    """
    spark = stream.sparkSession
    schema = _keep(
        stream, alloc, keys, path, checkpoint, None, id=id, seed=seed, hash=hash, partitions=partitions,
        broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task,
    )
    slots = table_at(spark, path, schema)
    last = slots.agg(F.max("__batch").alias("last")).first().last
    sample = slots.filter(F.col("__batch") == F.lit(last))
    kept = [col(c) for c in stream.columns]
    return sample.select(*kept, *([F.col(QUOTA).alias("s")] if with_quota else []))


def admitted_to(
    stream: DataFrame,
    alloc: DataFrame,
    keys: str | Sequence[str],
    path: str,
    checkpoint: str,
    *,
    id: str | Sequence[str],
    seed: int = 42,
    hash: str = "xxhash64",
    partitions: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The rows of ``stream`` that entered their stratum's reservoir, append-only, with their ``batch_id``.

    What was admitted may be displaced by later rows; :func:`reservoir_sample` tells those apart by rank, so nothing is ever
    taken back. The reservoirs are kept beside the rows, under ``path``.
    """
    _keep(
        stream, alloc, keys, f"{path}/held", checkpoint, f"{path}/admitted", id=id, seed=seed, hash=hash,
        partitions=partitions, broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task,
    )
    return read_batches(stream.sparkSession, f"{path}/admitted", stream.schema)


def _keep(
    stream: DataFrame, alloc: DataFrame, keys, held_path: str, checkpoint: str, admitted_path: str | None, *,
    id, seed: int, hash: str, partitions: int | None, broadcast_bytes: int, rows_per_task: int,
) -> T.StructType:
    """Run the stream into the two slots at ``held_path``; return their schema."""
    key_names = resolve(stream.columns, keys)
    ids = resolve(stream.columns, as_names(id))
    alloc_keys = resolve(alloc.columns, key_names)
    wanted = alloc.filter(F.col("s") > 0)
    bounds = measure_bounds(wanted, alloc_keys)
    side = wanted.select(stratum_key(alloc_keys).alias("__of"), F.col("s").alias("__of_s"))
    side = F.broadcast(side) if bounds.all_bytes() <= broadcast_bytes else side.hint("merge")
    order = [F.col(RANK), *[col(i) for i in ids]]
    rank_type = T.StringType() if hash == "md5" else T.LongType()
    schema = T.StructType(
        [
            *stream.schema.fields,
            T.StructField(GROUP, stream.select(stratum_key(key_names).alias(GROUP)).schema[GROUP].dataType),
            T.StructField(QUOTA, T.LongType()),
            T.StructField(RANK, rank_type),
            T.StructField("__batch", T.LongType()),
        ]
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        # the quotas with this batch's own counts: a cut-off for each stratum, and sizes that are checked
        counts = batch.groupBy(*[col(k) for k in key_names]).agg(F.count(F.lit(1)).alias("n"))
        own = counts.join(side, stratum_key(key_names) == F.col("__of")).select(
            *[col(k) for k in key_names], "n", F.col("__of_s").alias("s")
        )
        own = materialize(own)
        fresh = draw_rows(
            batch, own, key_names, id=ids, seed=seed, hash=hash, broadcast_bytes=broadcast_bytes, rows_per_task=rows_per_task
        )
        rows = fresh.select(*[col(c) for c in stream.columns], GROUP, QUOTA, RANK, F.lit(True).alias("__fresh"))
        if batch_id > 0:
            held = table_at(batch.sparkSession, f"{held_path}/slot={(batch_id - 1) % 2}", schema).drop("__batch")
            rows = rows.unionByName(held.withColumn("__fresh", F.lit(False)))
        kept = keep_lowest(
            rows, GROUP, order, QUOTA, bounds.largest_quota, 2 * bounds.quota_rows, largest_group=2 * bounds.largest_quota,
            rows_per_task=rows_per_task,
        )
        if admitted_path is not None:
            kept = materialize(kept)
            new = kept.filter("__fresh").select(*[col(c) for c in stream.columns])
            new.write.mode("overwrite").parquet(f"{admitted_path}/batch_id={batch_id}")
        kept = kept.withColumn("__batch", F.lit(batch_id).cast("bigint"))
        kept.select(*schema.names).write.mode("overwrite").parquet(f"{held_path}/slot={batch_id % 2}")

    run_batches(stream, merge, checkpoint, mode="append", partitions=partitions)
    return schema
