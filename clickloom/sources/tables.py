"""Readers for stored action, user, product and city tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import dates


def date_range(column: Column, start: str | None, end: str | None) -> Column:
    """Inclusive range; an open end is left out, so the scan sees only real bounds."""
    condition = F.lit(True)
    if start:
        condition = condition & (column >= F.lit(start))
    if end:
        condition = condition & (column <= F.lit(end))
    return condition


def read_actions(spark: SparkSession, table: str, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Actions of a catalog table in a date range.

    ``date`` is compared as stored, so a table partitioned by date is pruned to the
    range and any other one gets the bounds pushed into its scan.  ``action_ts`` is
    the parsed time; ``event_id`` (the tie-break of equal times) is added as a hash of
    the row where the table has none.
    """
    df = spark.table(table)
    if start or end:
        df = df.where(date_range(F.col("date"), start, end))
    if "action_ts" not in df.columns:
        df = df.withColumn("action_ts", dates.parse_time(F.col("action_time")))
    if "event_id" not in df.columns:
        df = df.withColumn("event_id", F.xxhash64("user_id", "page_id", "city_id",
                                                  "search_keyword", "click_category_id",
                                                  "click_product_id", "order_category_ids",
                                                  "pay_category_ids"))
    return df


def product_clicks(actions: DataFrame) -> DataFrame:
    """City and product of real product clicks: two columns of the scan."""
    product = F.col("click_product_id")
    return (actions.where(product.isNotNull() & (product != -1))
            .select("city_id", "click_product_id"))
