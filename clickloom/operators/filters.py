"""Session predicates.  Each returns a condition, or None when its parameter is blank."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.params import TaskParams


def between(column: Column, low, high) -> Column | None:
    """Inclusive range; applies only when both bounds are given."""
    if low is None or high is None:
        return None
    return column.between(low, high)


def member(column: Column, allowed: Iterable) -> Column | None:
    """The value is one of ``allowed``; null and -1 never match."""
    allowed = list(allowed)
    if not allowed:
        return None
    wanted = [value for value in allowed if str(value) != "-1"]
    return column.isin(wanted) if wanted else F.lit(False)


def overlaps(items: Column, allowed: Iterable) -> Column | None:
    """An array column shares at least one item with ``allowed``."""
    allowed = list(allowed)
    if not allowed:
        return None
    return F.arrays_overlap(items, F.array(*[F.lit(value) for value in allowed]))


def equals(column: Column, value) -> Column | None:
    return None if value in (None, "") else column == F.lit(value)


def keep(df: DataFrame, *conditions: Column | None) -> DataFrame:
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def profile_conditions(params: TaskParams) -> list[Column | None]:
    """Conditions on user columns only, so they can be applied before any join."""
    return [
        between(F.col("age"), params.start_age, params.end_age),
        member(F.col("professional"), params.professionals),
        member(F.col("city"), params.cities),
        equals(F.col("sex"), params.sex),
    ]
