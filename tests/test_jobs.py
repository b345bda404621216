"""The programs end to end on stored tables."""

import pytest
from pyspark.sql.types import StructType

from clickloom import schemas, workdir
from clickloom.params import TaskParams
from clickloom.plans import jobs
from clickloom.sinks import outputs
from clickloom.sources import ad_log, dimensions, tables


def _same_schema(df, ddl):
    wanted = StructType.fromDDL(ddl)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in wanted]


@pytest.fixture
def stored(spark, make_actions, make_users, tmp_path):
    rows = []
    for i in range(60):
        session = i % 6
        rows.append({"session_id": f"s{session}", "user_id": session % 4, "page_id": i % 5,
                     "action_time": f"2024-01-0{1 + session % 3} 0{session}:{i:02d}:00",
                     "click_category_id": i % 7 if i % 2 else -1,
                     "click_product_id": i % 9 if i % 2 else -1,
                     "order_category_ids": "1,2" if i % 4 == 0 else None, "city_id": i % 12})
    actions = make_actions(rows).drop("action_ts", "event_id")
    outputs.overwrite_table(actions, "actions_t", str(tmp_path / "actions"), ("date",))
    users = make_users([(u, 20 + u, "cook", "Rome", "male") for u in range(3)])
    return tables.read_actions(spark, "actions_t", "2024-01-01", "2024-01-03"), users


def test_session_job(spark, stored, tmp_path):
    actions, users = stored
    sink = outputs.parquet_sink(str(tmp_path / "out"))
    params = TaskParams(start_age=20, end_age=50)
    task = jobs.session_analysis(actions, users, params, sink, sample_size=30)
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    for name, ddl in (("session_stat", schemas.SESSION_STAT),
                      ("session_random_extract", schemas.SESSION_SAMPLE),
                      ("session_detail", schemas.SESSION_DETAIL),
                      ("top10_category", schemas.TOP_CATEGORY),
                      ("top10_session", schemas.TOP_SESSION)):
        _same_schema(read(name), ddl)
        assert {r.taskid for r in read(name).collect()} == {task}
    assert read("session_stat").first().session_count == 5      # users 0, 1, 2
    sampled = {r.sessionid for r in read("session_random_extract").collect()}
    assert {r.sessionid for r in read("session_detail").collect()} == sampled
    assert read("session_detail").count() == 10 * len(sampled)


def test_page_job(spark, stored, tmp_path):
    sink = outputs.parquet_sink(str(tmp_path / "out"))
    jobs.page_conversion(stored[0], TaskParams(page_flow=(1, 2, 3)), sink, "t1")
    found = spark.read.parquet(str(tmp_path / "out" / "page_split_convert_rate"))
    _same_schema(found, schemas.PAGE_CONVERSION)
    assert found.first().convertRate.startswith("1_2=")


def test_area_job(spark, stored, tmp_path):
    products = spark.createDataFrame([(p, f"p{p}", '{"product_status": 0}') for p in range(9)],
                                     schemas.PRODUCT_INFO)
    sink = outputs.parquet_sink(str(tmp_path / "out"))
    jobs.area_top(stored[0], dimensions.cities(spark), products, sink)
    found = spark.read.parquet(str(tmp_path / "out" / "area_top3_product"))
    _same_schema(found, schemas.AREA_TOP)
    assert max(r["count"] for r in found.groupBy("area").count().collect()) <= 3


def test_ad_job(spark, tmp_path):
    spark.createDataFrame([("1704067200123 P C 5 9",)], "value string").write.text(
        str(tmp_path / "in" / "a"))
    lines = ad_log.file_lines(spark, str(tmp_path / "in" / "*"))
    jobs.ad_stream(lines, str(tmp_path / "root"), every=None).awaitTermination()
    from clickloom.streaming.ad_stream import AdStream
    program = AdStream(spark, str(tmp_path / "root"), open_days=2)
    assert [tuple(r) for r in program.ad_stat().collect()] == [("20240101", "P", "C", 9, 1)]


def test_stored_table_is_pruned_by_date(stored):
    plan = stored[0].where("click_product_id != -1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_jdbc_options_leave_out_what_is_not_given():
    assert outputs.jdbc_options("jdbc:x", user="u") == {
        "url": "jdbc:x", "user": "u", "batchsize": "1000"}


def test_shared_dir_is_the_one_the_session_names(spark):
    assert workdir.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workdir.fresh_dir(spark, "a") != workdir.fresh_dir(spark, "a")
