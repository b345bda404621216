"""Session roll-up, profile join, session filter and length distributions.

Shape of the work at scale: actions are reduced to one row per session with partial
aggregates, so even a session holding a third of the log reaches its reducer as one
row per map task.  Keyword and category filters are boolean aggregates of the same
pass, not tests on gathered lists; lists are built only for callers that read them
(an unused ``collect_set`` is pruned from the aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import dates, text
from clickloom.operators import filters
from clickloom.params import TaskParams
from clickloom.schemas import STEP_BUCKETS, VISIT_BUCKETS

# Inclusive bounds of the whole-second and whole-step buckets (fixed values).
VISIT_BOUNDS = ((1, 3), (4, 6), (7, 9), (10, 30), (31, 60), (61, 180), (181, 600),
                (601, 1800), (1801, None))
STEP_BOUNDS = ((1, 3), (4, 6), (7, 9), (10, 30), (31, 60), (61, None))


def _seconds(clock: str) -> Column:
    column = F.col(clock)
    return F.unix_seconds(column) if clock == "action_ts" else column


def rollup(actions: DataFrame, *, clock: str = "action_ts",
           params: TaskParams = TaskParams()) -> DataFrame:
    """One row per session.  ``clock`` is the timestamp, or a column in whole seconds,
    from which the visit length is taken."""
    second = _seconds(clock)
    keyword, category = F.col("search_keyword"), F.col("click_category_id")
    word_hit = filters.member(keyword, params.keywords)
    category_hit = filters.member(category, params.category_ids)
    always = F.lit(True)
    return actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("start_ts"),
        (F.max(second) - F.min(second)).alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set(F.when(text.is_not_empty(keyword), keyword)))
        .alias("search_keywords"),
        F.array_sort(F.collect_set(F.when(category != -1, category)))
        .alias("click_category_ids"),
        (always if word_hit is None else F.coalesce(F.bool_or(word_hit), F.lit(False)))
        .alias("keyword_hit"),
        (always if category_hit is None else F.coalesce(F.bool_or(category_hit), F.lit(False)))
        .alias("category_hit"),
    )


def full_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's profile; sessions of unknown users drop.

    No broadcast hint: the planner broadcasts the profile side when its measured size
    is under the threshold, and otherwise sort-merges, where a user owning most
    sessions is split by the adaptive skew join.
    """
    profile = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(profile, "user_id")


def filtered(actions: DataFrame, users: DataFrame, params: TaskParams,
             clock: str = "action_ts") -> DataFrame:
    """Sessions passing every given predicate; a blank predicate passes all."""
    sessions = rollup(actions, clock=clock, params=params)
    eligible = filters.keep(users, *filters.profile_conditions(params))
    hits = [F.col("keyword_hit") if params.keywords else None,
            F.col("category_hit") if params.category_ids else None]
    return full_info(filters.keep(sessions, *hits), eligible)


def actions_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions (existence only).

    The session side is unique by key, so an oversized session shows up on the action
    side alone, where the adaptive skew join can split it.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def output_columns(sessions: DataFrame) -> DataFrame:
    """Lists and times as text, the form result tables use."""
    return sessions.select(
        "session_id", "user_id",
        dates.format_time(F.col("start_ts")).alias("start_time"),
        "visit_length", "step_length",
        text.csv_or_null(F.col("search_keywords")).alias("search_keywords"),
        text.csv_or_null(F.col("click_category_ids")).alias("click_category_ids"),
        *[c for c in ("age", "professional", "city", "sex") if c in sessions.columns])


def _bucket_counts(length: str, names, bounds) -> list[Column]:
    def inside(low, high):
        return f"{length} >= {low}" if high is None else f"{length} BETWEEN {low} AND {high}"
    return [F.expr(f"count_if({inside(low, high)}) AS {length}_{name}")
            for name, (low, high) in zip(names, bounds)]


def visit_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per visit-length bucket; a visit of 0 seconds is in none of them."""
    return sessions.agg(*_bucket_counts("visit_length", VISIT_BUCKETS, VISIT_BOUNDS))


def step_histogram(sessions: DataFrame) -> DataFrame:
    return sessions.agg(*_bucket_counts("step_length", STEP_BUCKETS, STEP_BOUNDS))


def stat_ratio(sessions: DataFrame) -> DataFrame:
    """Session count and the share of each bucket, rounded half-up to two places.

    Both distributions come from one aggregate; a task sends one row of counters.
    """
    counted = sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *_bucket_counts("visit_length", VISIT_BUCKETS, VISIT_BOUNDS),
        *_bucket_counts("step_length", STEP_BUCKETS, STEP_BOUNDS))
    # round() is half-up on the decimal form of the number.
    return counted.selectExpr(
        "session_count", *[f"round({name} / greatest(session_count, 1), 2) AS {name}_ratio"
                           for name in counted.columns[1:]])
