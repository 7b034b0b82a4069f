"""Message topics as sources and sinks of text records.

Needs Spark's Kafka connector package on the cluster's class path; the same operators run on file
streams and tables without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default addresses and names that existing topics and consumers go by.
ADDRESS = "localhost:9092"
GROUP = "KafkaCsvProducer"
INPUT_TOPIC = "input-topic-job1"
STATS_TOPIC = "output-topic-job1"
SAMPLE_TOPIC = "output-topic-job2"


def rows_topic(input_topic: str = INPUT_TOPIC) -> str:
    """The topic the transformed rows of an input topic go to."""
    return "_" + input_topic


def source_options(topic: str, address: str = ADDRESS, group: str = GROUP) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": address,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "groupIdPrefix": group,
    }


def sink_options(topic: str, address: str = ADDRESS) -> dict[str, str]:
    return {"kafka.bootstrap.servers": address, "topic": topic}


def read_topic(
    spark: SparkSession,
    topic: str = INPUT_TOPIC,
    address: str = ADDRESS,
    group: str = GROUP,
    *,
    streaming: bool = True,
    rebalance: int | None = None,
) -> DataFrame:
    """A topic's records from the earliest offset as column ``value``.

    ``rebalance`` spreads the rows over that many tasks where the topic has fewer partitions.
    """
    reader = spark.readStream if streaming else spark.read
    options = source_options(topic, address, group)
    lines = reader.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))
    return rebalanced(lines, rebalance)


def rebalanced(df: DataFrame, n: int | None) -> DataFrame:
    """Deal rows out evenly over ``n`` tasks; ``None`` leaves them where they are."""
    return df.repartition(n) if n else df


def write_topic(records: DataFrame, topic: str, address: str = ADDRESS, *, checkpoint: str | None = None):
    """Write a ``value`` column to a topic: at once for a table, as a started query for a stream.

    Streams are written at least once.
    """
    if not records.isStreaming:
        records.write.format("kafka").options(**sink_options(topic, address)).save()
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    writer = records.writeStream.format("kafka").options(**sink_options(topic, address))
    return writer.option("checkpointLocation", checkpoint).start()
