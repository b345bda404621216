"""A log stored by session is read where it lies; its versions are swapped in one step."""

import os

import pytest

from clickloom.operators import sessions as S
from clickloom.params import TaskParams
from clickloom.sinks import outputs
from clickloom.sources import session_store
from clickloom.sources.session_store import SessionStore


@pytest.fixture
def log(make_actions):
    # Session h holds a third of the log; one action has no session.
    rows = [{"session_id": "h" if i % 3 == 0 else f"s{i % 20}", "user_id": i % 5 + 1,
             "action_time": f"2024-01-0{i % 3 + 1} 10:00:{i % 60:02d}"} for i in range(120)]
    return make_actions(rows + [{"session_id": None}]).drop("action_ts")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_work_per_session_shuffles_no_bucket(spark, log, make_users, tmp_path):
    session_store.write(log, "by_session", 4, hot_rows=30, path=str(tmp_path / "t"))
    store = SessionStore.open(spark, "by_session")
    assert {r.session_id for r in store.hot.select("session_id").distinct().collect()} == {"h"}
    assert store.buckets.count() == 81
    plan = S.rollup(store.buckets)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan

    users = make_users([(u, 30, "cook", "Rome", "male") for u in range(1, 6)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = S.actions_of(store.buckets, S.rollup(store.buckets))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def work(actions):
        return S.actions_of(actions, S.filtered(actions, users, TaskParams())).select(log.columns)
    direct = SessionStore(log.withColumn("action_ts", log.action_time.cast("timestamp")), None)
    assert _rows(store.per_session(work)) == _rows(work(direct.buckets))


def test_a_second_version_leaves_one_folder(spark, tmp_path):
    root = str(tmp_path / "v")
    outputs.overwrite_table(spark.range(5), "versions_t", root)
    outputs.overwrite_table(spark.range(7), "versions_t", root)
    assert spark.table("versions_t").count() == 7 and len(os.listdir(root)) == 1
    with pytest.raises(Exception, match="no"):
        outputs.overwrite_table(spark.range(3).selectExpr("raise_error('no') AS id"),
                                "versions_t", root)
    assert spark.table("versions_t").count() == 7 and len(os.listdir(root)) == 1


def test_a_foreign_table_is_not_replaced(spark):
    spark.range(3).write.saveAsTable("foreign_t")
    with pytest.raises(ValueError):
        outputs.overwrite_table(spark.range(5), "foreign_t")
    spark.sql("DROP TABLE foreign_t")
