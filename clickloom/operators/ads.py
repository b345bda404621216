"""Ad click results on a set of clicks, shared by batch queries and micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import dates
from clickloom.operators.ranking import top_per_group

USER_DAY = ["date", "userid", "adid"]
STAT = ["date", "province", "city", "adid"]
TREND = ["date", "hour", "minute", "adid"]


def clicks_total() -> Column:
    return F.count(F.lit(1)).alias("click_count")


def user_day_count(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*USER_DAY).agg(clicks_total())


def abusive_users(user_day_totals: DataFrame, threshold: int = 100) -> DataFrame:
    """Users who clicked one ad at least ``threshold`` times in a day."""
    return (user_day_totals.where(F.col("click_count") >= threshold)
            .select("userid").distinct())


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not on the list.  The list is unique by user, so a heavy user
    weighs on the click side only and is split by the adaptive skew join."""
    return clicks.join(blacklist, "userid", "left_anti")


def stat(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return clicks.groupBy(*STAT).agg(clicks_total())


def province_count(stats: DataFrame) -> DataFrame:
    """City totals rolled up to the province."""
    return (stats.groupBy("date", "province", "adid")
            .agg(F.sum("click_count").alias("click_count")))


def province_top(totals: DataFrame, k: int = 3) -> DataFrame:
    """Top ads of each province and day; the ad id settles ties."""
    ranked = top_per_group(totals, ["date", "province"],
                           [F.desc("click_count"), F.asc("adid")], k, "adid")
    return ranked.select("date", "province", "adid", "click_count")


def next_top(old: DataFrame, touched: DataFrame, k: int = 3) -> DataFrame:
    """Top ads after some totals have grown: ``old`` is the top list so far and
    ``touched`` holds the new province totals of the changed ads alone.

    Counts never fall, so an ad that is neither in the old list nor touched cannot pass
    the k that were above it.  ``old`` must have been made with the same ``k``.
    """
    still = old.join(touched, ["date", "province", "adid"], "left_anti")
    return province_top(still.unionByName(touched), k)


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per event-time minute and ad."""
    minute = F.date_trunc("minute", F.col("ts"))
    return clicks.groupBy(minute.alias("minute_ts"), "adid").agg(clicks_total())


def trend(counts: DataFrame) -> DataFrame:
    """Minute counts under the date, hour and minute keys of the trend table."""
    ts = F.col("minute_ts")
    return counts.select(dates.date_key(ts).alias("date"), F.date_format(ts, "HH").alias("hour"),
                         F.date_format(ts, "mm").alias("minute"), "adid", "click_count")
