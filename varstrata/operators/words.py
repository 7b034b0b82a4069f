"""Word counts over a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.functions.columns import col
from varstrata.functions.text import tokens


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per token, in column ``word``."""
    return df.select(F.explode(tokens(col(text))).alias("word"))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences ``n`` of every word; batch and streaming frames alike.

    Counts are summed within each task before the shuffle, so frequent words do not skew it.
    """
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
