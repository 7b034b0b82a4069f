"""Text records handed from stage to stage, one ``value`` column each.

Rows are ``key;measure;payload``, statistics ``key;mean;sd;n;gamma;total_gamma`` and samples
``key,payload``. The formats do not escape: a separator inside a field shifts what follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.functions.columns import col, payload_text, quota, resolve, resolve_roles, stratum_label


def encode_rows(rows: DataFrame) -> DataFrame:
    """Rows with ``key``, ``measure`` and ``payload`` as text records."""
    return rows.select(F.concat_ws(";", "key", F.col("measure").cast("string"), "payload").alias("value"))


def decode_rows(records: DataFrame, value: str = "value") -> DataFrame:
    """``key`` and ``payload`` of row records; the second pass does not need the measure."""
    return records.select(_field(value, 0).alias("key"), _field(value, 2).alias("payload"))


def encode_stats(stats: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Statistics of strata, with their total, as text records; ``n`` is written as a double."""
    names = resolve(stats.columns, keys)
    numbers = [F.col(c).cast("double").cast("string") for c in ("mean", "sd", "n", "gamma", "total_gamma")]
    return stats.select(F.concat_ws(";", stratum_label(names), *numbers).alias("value"))


def decode_stats(records: DataFrame, value: str = "value") -> DataFrame:
    """``key``, ``n``, ``gamma`` and ``total_gamma`` of statistics records; bad numbers become null."""
    return records.select(
        _field(value, 0).alias("key"),
        *[
            _field(value, i).try_cast("double").alias(name)
            for i, name in ((3, "n"), (4, "gamma"), (5, "total_gamma"))
        ],
    )


def decode_allocation(records: DataFrame, m: float = 20.0, value: str = "value") -> DataFrame:
    """Allocation (``key, n, total_gamma, s``) from statistics records, for a budget of ``m`` rows."""
    stats = decode_stats(records, value)
    return stats.select(
        "key",
        F.col("n").cast("bigint").alias("n"),
        "total_gamma",
        quota(F.col("gamma"), F.col("total_gamma"), m).alias("s"),
    )


def encode_sample(sample: DataFrame, keys: str | Sequence[str], *, payload: str = "once") -> DataFrame:
    """Sample rows as ``key,payload``."""
    roles = resolve_roles(sample.columns, keys, payload=payload)
    return sample.select(
        F.concat_ws(",", stratum_label(roles.keys), payload_text(roles.payload)).alias("value")
    )


def _field(value: str, i: int) -> Column:
    return F.get(F.split(col(value), ";", -1), i)


# fixed values: the wording of reports
MEAN, DEVIATION, QUOTA = "Mean= ", "Standard deviation= ", "si= "


def mean_report(stats: DataFrame, keys: str | Sequence[str], *, decimals: int | None = None) -> DataFrame:
    """One line per stratum for people to read: mean and standard deviation."""
    names = resolve(stats.columns, keys)
    return stats.select(
        stratum_label(names).alias("key"),
        F.concat(F.lit(MEAN), _shown("mean", decimals)).alias("mean"),
        F.concat(F.lit(DEVIATION), _shown("sd", decimals)).alias("sd"),
    )


def quota_report(alloc: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One line per stratum for people to read: rows to draw."""
    names = resolve(alloc.columns, keys)
    return alloc.select(
        stratum_label(names).alias("key"), F.concat(F.lit(QUOTA), F.col("s").cast("string")).alias("si")
    )


def _shown(name: str, decimals: int | None) -> Column:
    if decimals is None:
        return F.col(name).cast("string")
    number = F.round(F.col(name), decimals)
    return (number.cast("bigint") if decimals == 0 else number).cast("string")
