"""Nested air-quality documents and their flat measurement rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = """
results array<struct<
  location string, city string, country string, distance double,
  measurements array<struct<
    parameter string, value double, lastUpdated string, unit string, sourceName string,
    averagingPeriod struct<value bigint, unit string>>>,
  coordinates struct<latitude double, longitude double>>>
"""


BAD = "__bad"


def read_documents(spark: SparkSession, path: str, *, bad: str = "fail") -> DataFrame:
    """Read JSON files of one document each; files are read in parallel, a file by one task.

    ``bad``: ``"fail"`` raises an error for a document that cannot be read, ``"keep"`` puts its text in the column ``bad``,
    which is null for the others, ``"drop"`` leaves it out.
    """
    if _way(bad) == "keep":
        return parse_documents(spark.read.option("wholetext", True).text(path), bad="keep")
    mode = "FAILFAST" if bad == "fail" else "DROPMALFORMED"
    return spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", mode).json(path)


def parse_documents(df: DataFrame, text: str = "value", *, bad: str = "fail") -> DataFrame:
    """Documents from a text column, such as one document per line or per message; ``bad`` as in :func:`read_documents`.

    A null text is no document and gives no row.
    """
    there = df.filter(F.col(text).isNotNull())
    if _way(bad) == "fail":
        return there.select(F.from_json(F.col(text), DOCUMENT, {"mode": "FAILFAST"}).alias("document")).select("document.results")
    parsed = there.select(
        F.from_json(F.col(text), f"{DOCUMENT}, {BAD} string", {"columnNameOfCorruptRecord": BAD}).alias("document")
    )
    rows = parsed.select("document.results", F.col(f"document.{BAD}").alias("bad"))
    return rows if bad == "keep" else rows.filter("bad is null").drop("bad")


def _way(bad: str) -> str:
    if bad not in ("fail", "keep", "drop"):
        raise ValueError("bad must be 'fail', 'keep' or 'drop'")
    return bad


def flatten_measurements(documents: DataFrame) -> DataFrame:
    """One row per measurement, with its location's columns; locations without any give no row.

    ``local`` is null, as documents hold only the UTC time.
    """
    # A bare column would make the planner add a filter on its size, and so parse each text twice.
    results = F.coalesce(F.col("results"), F.array())
    place = documents.select(F.inline(results))
    reading = place.select(
        "location",
        "city",
        "country",
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        F.inline("measurements"),
    )
    return reading.select(
        "location",
        "city",
        "country",
        F.col("lastUpdated").alias("utc"),
        F.lit(None).cast("string").alias("local"),
        "parameter",
        "value",
        "unit",
        "latitude",
        "longitude",
        F.col("sourceName").alias("attribution"),
    )
