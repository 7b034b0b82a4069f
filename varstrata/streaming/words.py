"""Running word counts of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.operators.words import word_count
from varstrata.streaming.runner import run_batches, table_at

COUNTS = "word string, n bigint, batch bigint"


def counts_to(
    stream: DataFrame, path: str, checkpoint: str, *, text: str = "text", partitions: int | None = None
) -> DataFrame:
    """Running counts of a stream's words in a table at ``path``; return it.

    Each micro-batch is counted by itself and added to the counts so far, in two slots written in turn, so that a repeated
    micro-batch finds its predecessor whole. The table stays as large as the vocabulary, and the stream keeps no state.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        counts = word_count(batch, text)
        if batch_id > 0:
            held = table_at(batch.sparkSession, f"{path}/slot={(batch_id - 1) % 2}", _schema(spark))
            counts = counts.unionByName(held.select("word", "n")).groupBy("word").agg(F.sum("n").alias("n"))
        counts.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    run_batches(stream, merge, checkpoint, mode="append", partitions=partitions)
    slots = table_at(spark, path, _schema(spark))
    last = slots.agg(F.max("batch").alias("last")).first().last
    return slots.filter(F.col("batch") == F.lit(last)).select("word", "n")


def _schema(spark):
    return spark.createDataFrame([], COUNTS).schema
