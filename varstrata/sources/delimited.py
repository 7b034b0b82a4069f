"""Delimited text: files with quoted fields, and lines split as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varstrata.functions.columns import (
    as_names,
    col,
    lenient_double,
    payload_text,
    resolve_roles,
    split_quoted,
    stratum_label,
)


def read_delimited(
    spark: SparkSession, path: str, columns: str | Sequence[str], *, header: bool = True
) -> DataFrame:
    """Read delimited files as text columns, named by position; by default the first line is dropped.

    A doubled quote inside a quoted field is one quote; a record ends at its line's end.
    """
    names = as_names(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        # names come from the caller, not from the file
        .option("enforceSchema", True)
        .option("escape", '"')
        .csv(path)
    )
    # empty and missing fields are empty text, which is an ordinary key
    return rows.select(*[F.coalesce(col(c), F.lit("")).alias(c) for c in names])


def read_lines(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """Read text files as whole lines in column ``value``, dropping each file's header line.

    Goes through the delimited reader, as only that one knows where files begin. A line that holds its separator has
    more fields than the schema, and then comes whole in the column for such lines. Lines of blanks and control
    characters only are left out.
    """
    rows = (
        spark.read.schema("value string, __whole string")
        .option("header", header)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "__whole")
        .csv(path)
    )
    return rows.select(F.coalesce("__whole", "value").alias("value"))


def split_lines(lines: DataFrame, columns: str | Sequence[str], value: str = "value") -> DataFrame:
    """Split lines (from files or a topic) into text columns; fields a line lacks are empty."""
    fields = lines.select(split_quoted(col(value)).alias("fields"))
    return fields.select(
        *[
            F.coalesce(F.get(F.col("fields"), i), F.lit("")).alias(name)
            for i, name in enumerate(as_names(columns))
        ]
    )


def transform_rows(
    df: DataFrame, keys: str | Sequence[str], measure: str, *, payload: str = "once"
) -> DataFrame:
    """Columns ``key``, ``measure`` and ``payload`` of every row.

    For record formats; operators group by the key columns themselves, where ``("a,b", "c")`` and
    ``("a", "b,c")`` stay apart.
    """
    roles = resolve_roles(df.columns, keys, measure, payload=payload)
    text = df.schema[roles.measure].dataType == T.StringType()
    value = lenient_double(col(roles.measure)) if text else F.coalesce(
        col(roles.measure).cast("double"), F.lit(0.0)
    )
    return df.select(
        stratum_label(roles.keys).alias("key"), value.alias("measure"), payload_text(roles.payload).alias("payload")
    )
