"""Variance-driven stratified sampling for group-by queries on Spark."""

from varstrata.functions.columns import Roles, resolve_roles
from varstrata.operators.allocate import allocation, rows_with_allocation, windowed_allocation, with_quota
from varstrata.operators.apportion import apportioned, apportioned_allocation
from varstrata.operators.sample import (
    first_fill_allocated,
    first_fill_sample,
    sample_allocated,
    stratified_sample,
    windowed_sample,
)
from varstrata.operators.stats import (
    cumulative_stats,
    strata_stats,
    total_gamma,
    windowed_stats,
    windowed_total,
    with_total,
)
from varstrata.operators.words import word_count

__all__ = [
    "Roles",
    "allocation",
    "apportioned",
    "apportioned_allocation",
    "cumulative_stats",
    "first_fill_allocated",
    "first_fill_sample",
    "resolve_roles",
    "rows_with_allocation",
    "sample_allocated",
    "strata_stats",
    "stratified_sample",
    "total_gamma",
    "windowed_allocation",
    "windowed_sample",
    "windowed_stats",
    "windowed_total",
    "with_quota",
    "with_total",
    "word_count",
]
