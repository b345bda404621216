"""Most clicked products of every area."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import text
from clickloom.operators.ranking import top_per_group


def basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Product clicks with city name and area; clicks of unknown cities drop."""
    named = clicks.join(cities, "city_id")
    kept = [c for c in clicks.columns if c not in ("city_id", "click_product_id")]
    return named.select("city_id", "city_name", "area",
                        F.col("click_product_id").alias("product_id"), *kept)


def ordered(basic_info: DataFrame) -> DataFrame:
    """Full listing by city, last first.  The further keys make the order total, so the
    range partitioning of the sort can cut through one city."""
    tail = [c for c in basic_info.columns if c not in ("city_id", "city_name", "area",
                                                       "product_id")]
    return basic_info.orderBy(F.desc("city_id"), "product_id", *tail)


def product_click_count(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product) with the distinct ``id:name`` list of cities.

    Clicks are first counted per (city, product); the join and the area roll-up then
    work on at most cities x products rows, whatever share of clicks one city has.
    """
    counted = (clicks.groupBy("city_id", "click_product_id")
               .agg(F.count(F.lit(1)).alias("clicks")))
    city = text.concat_long_string(F.col("city_id"), F.col("city_name"), ":")
    return (basic(counted, cities).groupBy("area", "product_id")
            .agg(F.sum("clicks").alias("click_count"),
                 text.group_concat_distinct(city).alias("city_infos")))


def product_status(extend_info: Column) -> Column:
    return (F.when(text.json_value(extend_info, "product_status") == "0", "Self")
            .otherwise("Third Party"))


def with_product(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Name and status of each product; products not in the catalogue drop."""
    info = products.select("product_id", "product_name",
                           product_status(F.col("extend_info")).alias("product_status"))
    return counts.join(info, "product_id").select(
        "area", "city_infos", "product_id", "click_count", "product_name", "product_status")


def level(area: Column, levels: Mapping[str, str], default: str = "D Level") -> Column:
    case = None
    for name in sorted(set(levels.values())):
        members = [key for key, value in levels.items() if value == name]
        case = (F if case is None else case).when(area.isin(members), name)
    return F.lit(default) if case is None else case.otherwise(default)


def top_products(info: DataFrame, levels: Mapping[str, str], k: int = 3) -> DataFrame:
    ranked = top_per_group(info, ["area"], [F.desc("click_count"), F.asc("product_id")], k,
                           "product_id")
    return ranked.select("area", level(F.col("area"), levels).alias("area_level"),
                         "product_id", "city_infos", "click_count", "product_name",
                         "product_status")
