"""Stratified random sample of sessions by day and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators import sessions as S
from clickloom.operators.ranking import top_per_group

# Draws up to this many session ids (a few MB) are broadcast.
BROADCAST_SESSIONS = 100_000


def with_hour(sessions: DataFrame) -> DataFrame:
    return sessions.select("*", F.date_format("start_ts", "yyyy-MM-dd").alias("date"),
                           F.date_format("start_ts", "HH").alias("hour"))


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start: at most 24 rows per calendar day."""
    return (with_hour(sessions).groupBy("date", "hour")
            .agg(F.count(F.lit(1)).alias("session_count")))


def quotas(counts: DataFrame, sample_size: int = 100) -> DataFrame:
    """How many sessions each hour gives.

    A day gives ``sample_size div number of days``; an hour its share of that, cut to a
    whole number and never above its count.  The two windows run over the hour table,
    whose size is bounded by the calendar.
    """
    day = Window.partitionBy("date")
    everything = Window.partitionBy(F.lit(1))
    first_hour = F.row_number().over(day.orderBy("hour")) == 1
    shared = (counts.select("*", F.sum("session_count").over(day).alias("day_count"),
                            first_hour.alias("first_hour"))
              .select("*", F.count_if("first_hour").over(everything).alias("n_days")))
    per_day = F.floor(F.lit(sample_size) / F.col("n_days"))
    share = F.col("session_count") / F.col("day_count").cast("double") * per_day
    return shared.select("date", "hour", "session_count", "day_count", "n_days",
                         F.least(F.floor(share), F.col("session_count")).alias("quota"))


def draw(sessions: DataFrame, sample_size: int = 100, seed: str = "0") -> DataFrame:
    """Sampled (session_id, start_ts, date, hour), without replacement.

    Sessions are put in a seeded pseudo-random order within their hour.  No quota
    exceeds ``sample_size``, so the hour is first cut to that many, which happens before
    the shuffle, however full the hour is.  The exact quota is joined on afterwards.
    """
    slim = with_hour(sessions.select("session_id", "start_ts"))
    order = [F.md5(F.concat(F.lit(seed), F.col("session_id"))), F.col("session_id")]
    ranked = top_per_group(slim, ["date", "hour"], order, sample_size, "session_id", "pick")
    quota = quotas(hour_counts(sessions), sample_size).select("date", "hour", "quota")
    return (ranked.join(quota, ["date", "hour"]).where(F.col("pick") <= F.col("quota"))
            .select("session_id", "start_ts", "date", "hour"))


def of_sample(actions: DataFrame, drawn: DataFrame, sample_size: int) -> DataFrame:
    """Actions of the drawn sessions.

    A draw never holds more than ``sample_size`` sessions (day quota times days), so it
    is broadcast while that number is small and left to the planner beyond.
    """
    ids = drawn.select("session_id")
    if sample_size <= BROADCAST_SESSIONS:
        ids = F.broadcast(ids)
    return actions.join(ids, "session_id", "left_semi")


DETAIL = ("user_id", "session_id", "page_id", "action_time", "search_keyword",
          "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
          "pay_category_ids", "pay_product_ids")


def summaries(sampled: DataFrame) -> DataFrame:
    """Start time, keyword list and category list of every session in ``sampled``."""
    return S.output_columns(S.rollup(sampled)).select(
        "session_id", "start_time", "search_keywords", "click_category_ids")


def extract(actions: DataFrame, drawn: DataFrame, sample_size: int = 100) -> DataFrame:
    """The summaries of the drawn sessions; lists are gathered for these only."""
    return summaries(of_sample(actions, drawn, sample_size))


def detail(actions: DataFrame, drawn: DataFrame, sample_size: int = 100) -> DataFrame:
    """Every action of the drawn sessions."""
    return of_sample(actions, drawn, sample_size).select(*DETAIL)
