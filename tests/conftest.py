import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    session = build_session("clickloom-tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(work / "shared"),
        "spark.sql.warehouse.dir": str(work / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_actions(spark):
    """Actions from short dicts; the absent columns get their "nothing" value."""
    from pyspark.sql import functions as F

    schema = ("session_id string, user_id bigint, page_id bigint, action_time string, "
              "search_keyword string, click_category_id bigint, click_product_id bigint, "
              "order_category_ids string, pay_category_ids string, city_id bigint, "
              "event_id bigint")

    def build(rows):
        default = {"session_id": "s", "user_id": 1, "page_id": 0,
                   "action_time": "2024-01-01 00:00:00", "search_keyword": None,
                   "click_category_id": -1, "click_product_id": -1,
                   "order_category_ids": None, "pay_category_ids": None, "city_id": 0}
        names = [part.split()[0] for part in schema.split(", ")]
        full = [{**default, "event_id": i, **row} for i, row in enumerate(rows)]
        return (spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)
                .withColumn("date", F.substring("action_time", 1, 10))
                .withColumn("order_product_ids", F.lit(None).cast("string"))
                .withColumn("pay_product_ids", F.lit(None).cast("string"))
                .withColumn("action_ts", F.to_timestamp("action_time")))

    return build


@pytest.fixture
def make_users(spark):
    def build(rows):
        return spark.createDataFrame(
            rows, "user_id bigint, age int, professional string, city string, sex string")

    return build
