"""Sliding windows over minute counts by adding on entry and taking away on exit.

A minute enters all windows that hold it at one place of the grid of window starts and
leaves them at another, so a minute count is two events, whatever the length of the
window.  The count of a window is the running sum of the events up to its start, and
stays the same until the next event; only the result has a row per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import dates

DAY_MINUTES = 24 * 60


def window_counts(counts: DataFrame, length: int = 60, slide: int = 1) -> DataFrame:
    """Clicks per ad in every window of ``length`` minutes, one starting each ``slide``.

    ``counts`` has ``minute_ts``, ``adid`` and ``click_count``; windows without a click
    have no row.  Sums are made at two levels, inside a day (or a window, if longer) of
    an ad and over its days, so that no task takes an ad's whole history.
    """
    if not 0 < slide <= length:
        raise ValueError("slide must be between one minute and the length")
    # Positions count slides since 1970; an event of a span leaves in it or the next.
    span = -(-max(DAY_MINUTES, length) // slide)
    minute = F.expr("unix_seconds(minute_ts) div 60")

    def floor_div(value, by):
        return F.floor(value / F.lit(by)).cast("bigint")

    events = (counts.select("adid", "click_count", F.explode(F.array(
        F.struct((floor_div(minute - length, slide) + 1).alias("at"), F.lit(1).alias("sign")),
        F.struct((floor_div(minute, slide) + 1).alias("at"), F.lit(-1).alias("sign"))))
        .alias("e"))
        .groupBy("adid", F.col("e.at").alias("at"))
        .agg(F.sum(F.col("click_count") * F.col("e.sign")).alias("change"))
        .withColumn("span", floor_div(F.col("at"), span)))

    # What is inside the windows when a span begins: one row per ad and span.
    earlier = (Window.partitionBy("adid").orderBy("span")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = (events.groupBy("adid", "span").agg(F.sum("change").alias("change"))
               .select("adid", (F.col("span") * span).alias("at"),
                       F.sum("change").over(earlier).alias("change"), "span")
               .where(F.col("change") != 0))

    inside = Window.partitionBy("adid", "span").orderBy("at")
    levels = (events.unionByName(carried)
              .groupBy("adid", "span", "at").agg(F.sum("change").alias("change"))
              .select("adid", "at",
                      F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                      .alias("click_count"),
                      F.coalesce(F.lead("at").over(inside), (F.col("span") + 1) * span)
                      .alias("until"))
              .where("click_count > 0 AND until > at"))
    start = F.col("place") * (slide * 60)
    return (levels.select("adid", "click_count",
                          F.explode(F.sequence(F.col("at"), F.col("until") - 1)).alias("place"))
            .select(dates.format_time(F.timestamp_seconds(start)).alias("window_start"),
                    dates.format_time(F.timestamp_seconds(start + length * 60))
                    .alias("window_end"), "adid", "click_count"))
