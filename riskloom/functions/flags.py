"""Presence and match flags as doubles, ready for an assembled vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def equal_flag(left: Column, right: Column) -> Column:
    """1.0 where both sides are present and equal, else 0.0."""
    return F.when(left == right, F.lit(1.0)).otherwise(F.lit(0.0))


def any_present(columns: Sequence[Column]) -> Column:
    """1.0 where at least one column is present; a matched row without values counts as 0.0."""
    if not columns:
        return F.lit(0.0)
    first = F.coalesce(*[column.cast("string") for column in columns])
    return F.when(first.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))
