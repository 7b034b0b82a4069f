"""Tokens of free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-case words: split at runs of characters other than ASCII letters, digits and ``_``."""
    return F.array_remove(F.split(F.lower(text), r"\W+"), "")
