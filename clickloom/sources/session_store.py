"""Actions stored by session, so that work per session needs no shuffle of the log.

The log is written once, dealt into buckets by ``session_id`` and sorted in them.  A
roll-up, a semi-join or a window by session then reads each bucket where it lies.  One
bucket is one task's work, so sessions above a number of rows go to a second table that
is not bucketed; there the usual partial aggregates and skew joins spread them.  Every
session is wholly in one of the two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sinks import outputs
from clickloom.sources import tables

KEY = "session_id"


def write(actions: DataFrame, name: str, buckets: int, hot_rows: int = 1_000_000,
          path: str | None = None) -> None:
    """Store ``actions`` as ``name`` (bucketed) and ``name_hot`` (sessions of more than
    ``hot_rows`` actions).  Take ``buckets`` for the log's size: one is read by one task.

    The hot list has at most rows / ``hot_rows`` ids; a null session is in neither list
    and is kept with the buckets.
    """
    hot = (actions.groupBy(KEY).count().where(F.col("count") > hot_rows)
           .where(F.col(KEY).isNotNull()).select(KEY))
    order = [c for c in ("action_time", "event_id") if c in actions.columns]
    # Dealt as the table is, each bucket is one file.
    cold = actions.join(hot, KEY, "left_anti").repartition(buckets, KEY)
    outputs.overwrite_table(cold, name, path and f"{path}/buckets",
                            bucket_by=(buckets, KEY), sort_by=(KEY, *order))
    outputs.overwrite_table(actions.join(hot, KEY, "left_semi"), f"{name}_hot",
                            path and f"{path}/hot")


@dataclass(frozen=True)
class SessionStore:
    buckets: DataFrame
    hot: DataFrame

    @classmethod
    def open(cls, spark: SparkSession, name: str, start: str | None = None,
             end: str | None = None) -> SessionStore:
        return cls(tables.read_actions(spark, name, start, end),
                   tables.read_actions(spark, f"{name}_hot", start, end))

    def per_session(self, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` on both parts.  Right for all that treats sessions one by one."""
        return work(self.buckets).unionByName(work(self.hot))
