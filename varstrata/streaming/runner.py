"""Running streaming queries over the data at hand, into tables in a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from varstrata.functions.columns import col
from varstrata.plans.runtime import settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession, path: str, schema, *, format: str = "parquet", glob: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of files as a stream."""
    reader = spark.readStream.format(format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of part files."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(place).isDirectory():
        return file_stream(spark, path, schema, **options)
    return file_stream(spark, path.rsplit("/", 1)[0], schema, glob=path.rsplit("/", 1)[1], **options)


def table_at(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``; an empty frame if a stream without any rows has not made one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Cast ``ts`` to an instant, as watermarks need, and set the watermark."""
    return df.withColumn(ts, col(ts).cast("timestamp")).withWatermark(ts, delay)


def with_arrival_time(df: DataFrame, name: str = "arrived") -> DataFrame:
    """Stamp rows with the time of their micro-batch, for windows on ingestion time."""
    return df.withColumn(name, F.current_timestamp())


def start(writer: DataStreamWriter, spark: SparkSession, partitions: int | None = None) -> StreamingQuery:
    """Start a query with its state in RocksDB; ``partitions`` is fixed for the query's lifetime."""
    options = {"spark__sql__streaming__stateStore__providerClass": ROCKSDB}
    if partitions:
        options["spark__sql__shuffle__partitions"] = str(partitions)
    with settings(spark, **options):
        return writer.start()


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def append_to(
    stream: DataFrame, path: str, checkpoint: str, *, partitions: int | None = None
) -> DataFrame:
    """Process what is there in append mode into a table at ``path``; return the table.

    The file sink and the checkpoint together write every row exactly once.
    """
    spark = stream.sparkSession
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    _finish(start(writer, spark, partitions))
    return table_at(spark, path, stream.schema)


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str,
    partitions: int | None = None,
) -> StreamingQuery:
    """Process what is there, handing each micro-batch and its number to ``write``; return the ended query."""
    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return _finish(start(writer, stream.sparkSession, partitions))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch to its own folder; a batch that is repeated overwrites its folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table of all micro-batches, with the extra column ``batch_id``."""
    fields = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return table_at(spark, path, fields)


def batches_to(
    stream: DataFrame, path: str, checkpoint: str, *, mode: str, partitions: int | None = None
) -> DataFrame:
    """Process what is there in any output mode into a table at ``path``, by micro-batch; return it."""
    run_batches(
        stream, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint, mode=mode, partitions=partitions
    )
    return read_batches(stream.sparkSession, path, stream.schema)
