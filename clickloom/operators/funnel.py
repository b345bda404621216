"""Page-to-page conversion along a target flow.

A session is not sorted as one group.  It is cut into time chunks; neighbours inside
a chunk come from a window per (session, chunk), and the step from one chunk to the
next from the first and last action of each chunk.  That is exact, keeps a session
holding a third of the log spread over as many tasks as it has chunks, and leaves at
most two rows per chunk for the window over the session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK_SECONDS = 600


def flow_steps(flow: Sequence[int]) -> list[tuple[int, int]]:
    """Adjacent pairs of the flow, in order."""
    return list(zip(flow, flow[1:]))


def flow_table(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """(step, from_page, to_page), one row per step; size set by the parameter."""
    rows = [(i, a, b) for i, (a, b) in enumerate(flow_steps(flow), start=1)]
    return spark.createDataFrame(rows, "step int, from_page bigint, to_page bigint")


def _placed(actions: DataFrame, chunk_seconds: int) -> DataFrame:
    """Actions with the page after them in their chunk; ``is_last`` and ``is_first`` mark
    the ends of the chunk.

    The explicit repartition is the one shuffle of the log.
    """
    visits = actions.select(
        "session_id", "page_id", "action_ts", "event_id",
        F.floor(F.unix_seconds("action_ts") / chunk_seconds).alias("chunk")
    ).repartition("session_id", "chunk")
    chunk = Window.partitionBy("session_id", "chunk").orderBy("action_ts", "event_id")
    one = F.lit(1)
    return visits.select("*", F.lead("page_id").over(chunk).alias("next_page"),
                         F.lead(one).over(chunk).isNull().alias("is_last"),
                         F.lag(one).over(chunk).isNull().alias("is_first"))


def transitions(actions: DataFrame, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """(session_id, from_page, to_page) of neighbouring actions, by time then id."""
    placed = _placed(actions, chunk_seconds)
    inside = placed.where("NOT is_last").select(
        "session_id", F.col("page_id").alias("from_page"), F.col("next_page").alias("to_page"))

    # First and last action of every chunk.  In time order the one after a last action
    # is the first of the next chunk.  The shuffle below is reused, not run again.
    ends = placed.where("is_last OR is_first")
    session = Window.partitionBy("session_id").orderBy("action_ts", "event_id")
    across = (ends.select("session_id", "page_id", "is_last",
                          F.lead("page_id").over(session).alias("to_page"),
                          F.lead(F.lit(1)).over(session).isNotNull().alias("has_next"))
              .where("is_last AND has_next")
              .select("session_id", F.col("page_id").alias("from_page"), "to_page"))
    return inside.unionByName(across)


def _totals(actions: DataFrame, flow: Sequence[int], chunk_seconds: int) -> DataFrame:
    """One row: ``step_0``, visits to the start page, and ``step_i``, moves of step i.

    The log is read and sorted once: each chunk is reduced, where it lies, to a counter
    per step and its first and last page, and the moves between chunks are read off
    these.
    """
    steps = list(enumerate(flow_steps(flow), start=1))

    def counters(from_page: str, to_page: str, prefix: str) -> list[Column]:
        return [F.expr(f"count_if({from_page} = {int(a)} AND {to_page} = {int(b)}) "
                       f"AS {prefix}{i}") for i, (a, b) in steps]

    page = F.col("page_id")
    chunks = _placed(actions, chunk_seconds).groupBy("session_id", "chunk").agg(
        F.count_if(page == flow[0]).alias("starts"),
        *counters("page_id", "next_page", "inside_"),
        F.max(F.when(F.col("is_first"), page)).alias("first_page"),
        F.max(F.when(F.col("is_last"), page)).alias("last_page"))
    session = Window.partitionBy("session_id").orderBy("chunk")
    linked = chunks.select("*", F.lead("first_page").over(session).alias("following_page"))
    across = counters("last_page", "following_page", "across_")
    inside = [F.expr(f"coalesce(sum(inside_{i}), 0) AS inside_{i}") for i, _ in steps]
    return linked.agg(F.expr("coalesce(sum(starts), 0) AS step_0"), *across, *inside).selectExpr(
        "step_0", *[f"inside_{i} + across_{i} AS step_{i}" for i, _ in steps])


def pair_counts(actions: DataFrame, flow: Sequence[int],
                chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Moves per step of the flow, a step nobody took as 0."""
    if len(flow) < 2:
        return actions.sparkSession.createDataFrame([], "step int, from_page bigint, to_page bigint, pair_count bigint")
    rows = ", ".join(f"struct({i} AS step, {int(a)}L AS from_page, {int(b)}L AS to_page, "
                     f"step_{i} AS pair_count)"
                     for i, (a, b) in enumerate(flow_steps(flow), start=1))
    return _totals(actions, flow, chunk_seconds).selectExpr(f"inline(array({rows}))")


def start_count(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Visits to the first page of the flow, as one row."""
    return actions.where(F.col("page_id") == flow[0]).agg(
        F.count(F.lit(1)).alias("start_count"))


def convert_rates(actions: DataFrame, flow: Sequence[int],
                  chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Count and rate of every step; the rate is taken over the step before, the first
    one over visits to the start page, and is null over a zero."""
    if len(flow) < 2:
        return actions.sparkSession.createDataFrame([], "step int, page_pair string, pair_count bigint, rate double")
    rows = ", ".join(f"struct({i} AS step, '{int(a)}_{int(b)}' AS page_pair, "
                     f"step_{i} AS pair_count, step_{i} / nullif(step_{i - 1}, 0) AS rate)"
                     for i, (a, b) in enumerate(flow_steps(flow), start=1))
    return _totals(actions, flow, chunk_seconds).selectExpr(f"inline(array({rows}))")


def rate_string(rates: DataFrame, scale: int | None = None) -> DataFrame:
    """``1_2=r|2_3=r`` in flow order, as one row; ``scale`` fixes the decimals."""
    value = F.col("rate").cast("string") if scale is None else F.format_string(
        f"%.{scale}f", F.col("rate"))
    item = F.concat(F.col("page_pair"), F.lit("="),
                    F.when(F.col("rate").isNotNull(), value).otherwise("NULL"))
    ordered = F.array_sort(F.collect_list(F.struct("step", item.alias("item"))))
    return rates.agg(F.array_join(F.transform(ordered, lambda s: s["item"]), "|")
                     .alias("convert_rate"))
