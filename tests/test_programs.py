"""The command line, what the session program reads, and tables that replace themselves."""

import pytest
from pyspark.sql import functions as F

from clickloom import __main__ as program
from clickloom.operators import categories
from clickloom.params import TaskParams
from clickloom.plans import jobs
from clickloom.sinks import outputs


@pytest.fixture
def actions(make_actions):
    rows = [{"session_id": f"s{i % 6}", "user_id": i % 4, "page_id": i % 5,
             "action_time": f"2024-01-0{1 + i % 3} 0{i % 6}:{i:02d}:00",
             "click_category_id": i % 7 if i % 2 else -1,
             "click_product_id": i % 9 if i % 2 else -1,
             "order_category_ids": "1,2" if i % 4 == 0 else None, "city_id": i % 12}
            for i in range(60)]
    return make_actions(rows)


def test_session_program_reads_the_log_three_times(spark, actions, make_users, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    users = make_users([(u, 30, "cook", "Rome", "male") for u in range(4)])
    log = actions.mapInArrow(counted, actions.schema)
    jobs.session_analysis(log, users, TaskParams(), outputs.parquet_sink(str(tmp_path)), "t")
    assert read.value == 3 * 60


def test_top_lists_from_session_counts_equal_those_from_actions(actions):
    counts = categories.touch_counts(actions)
    full = categories.full_counts(actions)
    assert sorted(map(tuple, categories.totals(counts).collect())) == sorted(map(tuple, full.collect()))
    top = categories.top_categories(full, 3)
    wanted = categories.session_clicks(categories.clicks_on(actions, top)).collect()
    found = categories.session_clicks_on(counts, top).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)) != []


@pytest.mark.parametrize("external", [False, True])
def test_table_may_be_overwritten_from_itself(spark, tmp_path, external):
    name, path = f"self_{external}", str(tmp_path / "t") if external else None
    rows = spark.range(10).selectExpr("id", "id % 2 AS part")
    outputs.overwrite_table(rows, name, path, ("part",))
    grown = spark.table(name).withColumn("id", F.col("id") + 100)
    assert sorted(r.id for r in outputs.overwrite_table(grown, name, path, ("part",)).collect()) == list(
        range(100, 110))
    broken = spark.table(name).withColumn("id", F.expr("raise_error('no')").cast("bigint"))
    with pytest.raises(Exception, match="no"):
        outputs.overwrite_table(broken, name, path, ("part",))
    assert spark.table(name).count() == 10


def test_page_and_session_commands(spark, actions, make_users, tmp_path):
    outputs.overwrite_table(actions.drop("action_ts", "event_id"), "actions_p", str(tmp_path / "a"), ("date",))
    make_users([(u, 30, "cook", "Rome", "male") for u in range(4)]).write.saveAsTable("users_p")
    task = '{startDate:"2024-01-01", endDate:"2024-01-03", targetPageFlow:"1,2,3"}'
    for command, table in (("page", "page_split_convert_rate"), ("session", "top10_session")):
        out = str(tmp_path / command)
        program.main([command, "--task", task, "--out", out, "--actions", "actions_p", "--users", "users_p"])
        assert spark.read.parquet(f"{out}/{table}").count() > 0
    spark.sql("DROP TABLE users_p")


def test_database_sink_is_wired_by_its_options(monkeypatch):
    given = {}
    monkeypatch.setattr(program, "jdbc_sink", lambda options, mode: given.update(options, mode=mode))
    monkeypatch.setenv("TEST_SECRET_NAME", "hidden")
    args = program._parser().parse_args([
        "ads-export", "--root", "r", "--jdbc-url", "jdbc:x", "--jdbc-user", "u",
        "--jdbc-password-variable", "TEST_SECRET_NAME"])
    program._sink(args, "overwrite")
    assert given == {"url": "jdbc:x", "user": "u", "password": "hidden", "batchsize": "1000",
                     "mode": "overwrite"}
    with pytest.raises(SystemExit):
        program._parser().parse_args(["page", "--task", "{}"])
