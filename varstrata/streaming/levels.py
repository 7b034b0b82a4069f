"""Running aggregates of a stream in runs that are merged level by level, so that what is written follows what came in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.operators.words import word_count
from varstrata.plans.runtime import delete_path
from varstrata.streaming.runner import run_batches, table_at

FANOUT = 4
MARK = T.StructType([T.StructField("batch", T.LongType()), T.StructField("fanout", T.IntegerType())])

Run = tuple[int, int]  # level and number: run i of level l covers the micro-batches from i * fanout^l, fanout^l of them
Merge = Callable[[DataFrame], DataFrame]


def live_runs(batches: int, fanout: int) -> list[Run]:
    """The runs that hold the first ``batches`` micro-batches, oldest first: fewer than ``fanout`` of each level."""
    level = 0
    while fanout ** (level + 1) <= batches:
        level += 1
    runs, at = [], 0
    for size in (fanout**i for i in range(level, -1, -1)):
        while at + size <= batches:
            runs.append((level, at // size))
            at += size
        level -= 1
    return runs


def next_run(batch_id: int, fanout: int) -> tuple[Run, list[Run]]:
    """The one run that a micro-batch writes, and the earlier runs that go into it: none, or those that now fill a level."""
    level = 0
    while (batch_id + 1) % fanout ** (level + 1) == 0:
        level += 1
    run = (level, (batch_id + 1) // fanout**level - 1)
    first = run[1] * fanout**level
    return run, [(below, i) for below, i in live_runs(batch_id, fanout) if i * fanout**below >= first]


def add_batch(rows: DataFrame, path: str, batch_id: int, merge: Merge, schema: T.StructType, fanout: int = FANOUT) -> None:
    """Add a micro-batch's aggregates to the store; doing it again gives the same store.

    The runs that went into an earlier one are deleted only when the next micro-batch begins, as only then it is certain
    that theirs will not be repeated. The mark is written last, into two slots in turn: what it does not cover yet, readers pass over.
    """
    spark = rows.sparkSession
    if batch_id > 0:
        before = table_at(spark, f"{path}/mark/slot={(batch_id - 1) % 2}", MARK).first()
        if before is not None and before.fanout != fanout:
            raise ValueError(f"the store at {path} was begun with fanout={before.fanout}")
        for run in next_run(batch_id - 1, fanout)[1]:
            delete_path(spark, _place(path, run))
    run, parts = next_run(batch_id, fanout)
    if parts:
        rows = merge(rows.unionByName(_read(spark, path, parts, schema)))
    _write(rows, _place(path, run))
    mark = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(fanout).alias("fanout")).coalesce(1)
    mark.write.mode("overwrite").parquet(f"{path}/mark/slot={batch_id % 2}")


def read_levels(spark: SparkSession, path: str, merge: Merge, schema: T.StructType) -> DataFrame:
    """The aggregates of all marked micro-batches, from at most ``fanout - 1`` runs of each level; empty if there are none."""
    marked = table_at(spark, f"{path}/mark", MARK).orderBy(F.desc("batch")).first()
    if marked is None:
        return spark.createDataFrame([], schema)
    return merge(_read(spark, path, live_runs(marked.batch + 1, marked.fanout), schema))


def levels_to(
    stream: DataFrame, path: str, checkpoint: str, aggregate: Merge, merge: Merge, *, fanout: int = FANOUT, partitions: int | None = None,
) -> DataFrame:
    """Running aggregates of a stream in a store at ``path``; return them.

    ``aggregate`` makes the partial aggregates of a micro-batch's rows, ``merge`` adds up partial aggregates of the same columns. Each micro-batch writes
    one run. Every ``fanout``-th run of a level is written together with the others of that level as one run of the next, so a row is written at
    most once a level: in ``b`` micro-batches ``log b`` times (to the base ``fanout``), however much the store holds. The stream keeps no state of its own.

    An empty micro-batch is an empty run. A micro-batch that is repeated after a crash finds the runs it needs and overwrites its own.
    """
    spark, schema = stream.sparkSession, aggregate(stream).schema
    run_batches(
        stream, lambda batch, batch_id: add_batch(aggregate(batch), path, batch_id, merge, schema, fanout), checkpoint,
        mode="append", partitions=partitions,
    )
    return read_levels(spark, path, merge, schema)


def level_counts_to(
    stream: DataFrame, path: str, checkpoint: str, *, text: str = "text", fanout: int = FANOUT, partitions: int | None = None,
) -> DataFrame:
    """Running counts of a stream's words, as :func:`counts_to`, without writing the whole vocabulary for each micro-batch."""
    return levels_to(
        stream, path, checkpoint, lambda batch: word_count(batch, text),
        lambda counts: counts.groupBy("word").agg(F.sum("n").alias("n")), fanout=fanout, partitions=partitions,
    )


def _place(path: str, run: Run) -> str:
    return f"{path}/runs/level={run[0]}/run={run[1]}"


def _read(spark: SparkSession, path: str, runs: list[Run], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[_place(path, run) for run in runs])


def _write(rows: DataFrame, place: str) -> None:
    rows.write.mode("overwrite").parquet(place)
