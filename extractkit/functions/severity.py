"""Severity from the number of true flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from extractkit.schema import DAMAGE_FIELDS, LOW_MAX_FLAGS, MODERATE_MAX_FLAGS, SEVERITIES


def true_count(flags: list[Column] | None = None) -> Column:
    """How many flags are true in this row."""
    flags = flags or [F.col(f) for f in DAMAGE_FIELDS]
    return reduce(lambda a, b: a + b, [f.cast("bigint") for f in flags])


def severity_bucket(count: Column) -> Column:
    low, moderate, high = SEVERITIES
    return (
        F.when(count <= LOW_MAX_FLAGS, low).when(count <= MODERATE_MAX_FLAGS, moderate).otherwise(high)
    )
