"""City and area dimension of the shop's own market."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.schemas import CITY_INFO

# City id, city name, area.
CITY_AREAS = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)

# Level of each area; an area not listed is a D one.
AREA_LEVELS = {
    "华北": "A Level", "华东": "A Level",
    "华南": "B Level", "华中": "B Level",
    "西南": "C Level", "西北": "C Level",
}


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_AREAS, CITY_INFO)
