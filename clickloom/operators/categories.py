"""Category popularity and the most active sessions of the popular categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_per_group


def touches(actions: DataFrame) -> DataFrame:
    """(session_id, kind, category_id), one row per click, ordered id and paid id.

    One pass in place of three scans of the log: every action gives its three id lists
    as text, and the lists it has are exploded.  No lambda runs per row, so the whole
    chain stays in generated code.
    """
    click = F.col("click_category_id")
    order, pay = F.col("order_category_ids"), F.col("pay_category_ids")
    clicked = click.isNotNull() & (click != -1)
    lists = F.array(*[
        F.struct(F.lit(kind).alias("kind"), ids.alias("ids"))
        for kind, ids in (("click", F.when(clicked, click.cast("string"))),
                          ("order", order), ("pay", pay))])
    return (actions.where(clicked | order.isNotNull() | pay.isNotNull())
            .select("session_id", F.inline(lists)).where(F.col("ids").isNotNull())
            .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("id"))
            .select("session_id", "kind", _category(F.col("id")))
            .where(F.col("category_id").isNotNull()))


def _category(item: Column) -> Column:
    return F.trim(item).try_cast("bigint").alias("category_id")


def click_count(actions: DataFrame) -> DataFrame:
    click = F.col("click_category_id")
    return (actions.where(click.isNotNull() & (click != -1))
            .groupBy(click.alias("category_id")).agg(F.count(F.lit(1)).alias("click_count")))


def _listed_count(actions: DataFrame, column: str, name: str) -> DataFrame:
    items = F.explode(F.split(F.col(column), ",")).alias("id")
    return (actions.where(F.col(column).isNotNull()).select(items)
            .select(_category(F.col("id"))).where(F.col("category_id").isNotNull())
            .groupBy("category_id").agg(F.count(F.lit(1)).alias(name)))


def order_count(actions: DataFrame) -> DataFrame:
    return _listed_count(actions, "order_category_ids", "order_count")


def pay_count(actions: DataFrame) -> DataFrame:
    return _listed_count(actions, "pay_category_ids", "pay_count")


def universe(actions: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid for."""
    return touches(actions).select("category_id").distinct()


def full_counts(actions: DataFrame) -> DataFrame:
    """Click, order and pay count of every touched category, absent ones as 0."""
    kind = F.col("kind")
    return touches(actions).groupBy("category_id").agg(
        F.count_if(kind == "click").alias("click_count"),
        F.count_if(kind == "order").alias("order_count"),
        F.count_if(kind == "pay").alias("pay_count"))


def touch_counts(actions: DataFrame) -> DataFrame:
    """(session_id, kind, category_id, n): what both top lists are made of.

    Touches are counted per session where they are read, so a join with the kept sessions
    sees a row per session, kind and category.
    """
    return (touches(actions).groupBy("session_id", "kind", "category_id")
            .agg(F.count(F.lit(1)).alias("n")))


def totals(counts: DataFrame) -> DataFrame:
    """The ``full_counts`` of what ``touch_counts`` has counted."""
    return counts.groupBy("category_id").agg(*[
        F.expr(f"coalesce(sum(n) FILTER (WHERE kind = '{kind}'), 0)").alias(f"{kind}_count")
        for kind in ("click", "order", "pay")])


def session_clicks_on(counts: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per category of ``top`` and session, from ``touch_counts``."""
    clicks = counts.where("kind = 'click'").join(top.select("category_id"), "category_id", "left_semi")
    return clicks.select("category_id", "session_id", F.col("n").alias("click_count"))


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """By clicks, then orders, then payments; the id settles ties."""
    return counts.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                          F.asc("category_id")).limit(k)


def clicks_on(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Click actions on the categories of ``top``.

    A top list carries its limit in its plan, so the planner knows its size and
    broadcasts it; anything larger is joined by shuffle.
    """
    wanted = top.select(F.col("category_id").alias("click_category_id"))
    return actions.join(wanted, "click_category_id", "left_semi")


def session_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per category and session."""
    click = F.col("click_category_id")
    return (actions.where(click.isNotNull() & (click != -1))
            .groupBy(click.alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k sessions with most clicks in each category; the id settles ties."""
    ranked = top_per_group(counts, ["category_id"],
                           [F.desc("click_count"), F.asc("session_id")], k, "session_id")
    return ranked.select("category_id", "session_id", "click_count")
