"""Session settings, the shared folder and cutting of lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_made: dict[str, list[str]] = {}


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a fresh local folder is made for the session, but only with a local master: executors on
    other machines could not read it.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="varstrata-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; ``cleanup`` removes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """The frame as Parquet in the shared folder, read again: columns are pruned, executors may be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame once to the shared folder and go on from there.

    The result survives the loss of executors and is never recomputed from its source.
    """
    return written(df, "rows")


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cleanup(spark: SparkSession) -> int:
    """Delete what this session's operators wrote to the shared folder; frames built on it can't be read any more.

    Call it when the results have been written elsewhere. Returns the number of paths removed.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Set session options (dots written as ``__``) and put the old values back afterwards."""
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
