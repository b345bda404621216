"""Merging a batch of result rows into stored ones: pure ``(old, new) -> merged``.

``old`` and ``new`` share their columns and are unique by key.  The key joins carry no
hint: a small batch is broadcast by its measured size and the stored side is then not
shuffled, a large one is sort-merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows stay; rows with an unseen key are added."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def add_counts(old: DataFrame, new: DataFrame, keys: Sequence[str],
               value: str = "click_count") -> DataFrame:
    """Counts of equal keys add up."""
    return (old.unionByName(new).groupBy(*keys).agg(F.sum(value).alias(value)))


def overwrite(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new row of a key wins."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)


def replace_group(old: DataFrame, new: DataFrame, group: Sequence[str]) -> DataFrame:
    """All stored rows of every group present in ``new`` are replaced by its rows."""
    kept = old.join(new.select(*group).distinct(), list(group), "left_anti")
    return kept.unionByName(new)
