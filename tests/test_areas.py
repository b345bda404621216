from clickloom.operators import areas
from clickloom.sources import dimensions, tables


def test_top_products_of_an_area(spark, make_actions):
    clicks = ([(1, 7)] * 3 + [(2, 7)] * 2 + [(1, 8)] * 5 + [(2, 9)] + [(1, 10)] + [(1, 11)] * 9
              + [(99, 7)] * 50 + [(9, 8)])
    rows = [{"city_id": c, "click_product_id": p} for c, p in clicks]
    rows += [{"city_id": 1, "click_product_id": -1}, {"city_id": 1, "click_product_id": None}]
    products = spark.createDataFrame(
        [(i, f"p{i}", '{"product_status": %d}' % (i % 2)) for i in (7, 8, 9, 10)],
        "product_id bigint, product_name string, extend_info string")
    counts = areas.product_click_count(tables.product_clicks(make_actions(rows)),
                                       dimensions.cities(spark))
    top = areas.top_products(areas.with_product(counts, products), dimensions.AREA_LEVELS)
    found = sorted(top.collect(), key=lambda r: (r.area, -r.click_count, r.product_id))
    assert [(r.area, r.area_level, r.product_id, r.click_count, r.city_infos,
             r.product_status) for r in found] == [
        # product 11 is not in the catalogue, city 99 not in the dimension
        ("东北", "D Level", 8, 1, "9:哈尔滨", "Self"),
        ("华东", "A Level", 7, 5, "1:上海,2:南京", "Third Party"),
        ("华东", "A Level", 8, 5, "1:上海", "Self"),
        ("华东", "A Level", 9, 1, "2:南京", "Third Party")]


def test_city_list_keeps_values_that_contain_each_other(spark):
    from clickloom.functions import text
    names = spark.createDataFrame([("1:x",), ("11:x",), ("1:x",)], "c string")
    from pyspark.sql import functions as F
    assert names.agg(text.group_concat_distinct(F.col("c")).alias("l")).first().l == "11:x,1:x"
