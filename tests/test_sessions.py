from datetime import datetime, timedelta

import pytest

from clickloom.operators import filters
from clickloom.operators import sessions as S
from clickloom.params import TaskParams

START = datetime(2024, 1, 1)


def _at(seconds):
    return (START + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


@pytest.mark.parametrize("length, bucket", [
    (0, None), (1, "1s_3s"), (3, "1s_3s"), (4, "4s_6s"), (6, "4s_6s"), (7, "7s_9s"),
    (9, "7s_9s"), (10, "10s_30s"), (30, "10s_30s"), (31, "30s_60s"), (60, "30s_60s"),
    (61, "1m_3m"), (180, "1m_3m"), (181, "3m_10m"), (600, "3m_10m"), (601, "10m_30m"),
    (1800, "10m_30m"), (1801, "30m")])
def test_visit_bucket_edges(spark, length, bucket):
    row = S.visit_histogram(spark.createDataFrame([(length,)], "visit_length bigint")).first()
    hit = [name for name, n in row.asDict().items() if n]
    assert hit == ([] if bucket is None else [f"visit_length_{bucket}"])


@pytest.mark.parametrize("length, bucket", [
    (1, "1_3"), (3, "1_3"), (4, "4_6"), (6, "4_6"), (7, "7_9"), (9, "7_9"), (10, "10_30"),
    (30, "10_30"), (31, "30_60"), (60, "30_60"), (61, "60")])
def test_step_bucket_edges(spark, length, bucket):
    row = S.step_histogram(spark.createDataFrame([(length,)], "step_length bigint")).first()
    assert [name for name, n in row.asDict().items() if n] == [f"step_length_{bucket}"]


def test_rollup(make_actions):
    actions = make_actions([
        {"action_time": _at(5), "search_keyword": "xaby"},
        {"action_time": _at(0), "search_keyword": "ab"},
        {"action_time": _at(9), "search_keyword": ""},
        {"action_time": _at(9), "click_category_id": 12},
        {"action_time": _at(9), "click_category_id": 2},
        {"action_time": _at(9), "click_category_id": 12},
        {"session_id": "lone", "user_id": 2, "action_time": _at(1)},
    ])
    rows = {r.session_id: r for r in S.output_columns(S.rollup(actions)).collect()}
    whole = rows["s"]
    assert (whole.visit_length, whole.step_length, whole.start_time) == (9, 6, _at(0))
    assert whole.search_keywords == "ab,xaby"      # exact values, not substrings
    assert whole.click_category_ids == "2,12"      # numbers in order, -1 left out
    lone = rows["lone"]
    assert (lone.visit_length, lone.step_length) == (0, 1)
    assert lone.search_keywords is None and lone.click_category_ids is None


def test_ratio_rounds_half_up_and_survives_no_sessions(spark):
    lengths = spark.createDataFrame([(1, 1)] * 57 + [(0, 4)] * 143,
                                    "visit_length bigint, step_length bigint")
    row = S.stat_ratio(lengths).first()
    assert row.session_count == 200
    assert row.visit_length_1s_3s_ratio == 0.29    # 0.285
    assert row.step_length_4_6_ratio == 0.72       # 0.715
    empty = S.stat_ratio(lengths.where("false")).first()
    assert empty.session_count == 0 and empty.visit_length_1s_3s_ratio == 0.0


@pytest.fixture
def shop(make_actions, make_users):
    actions = make_actions([
        {"session_id": "a", "user_id": 1, "search_keyword": "soup", "click_category_id": 5},
        {"session_id": "a", "user_id": 1, "search_keyword": "cake"},
        {"session_id": "b", "user_id": 2, "search_keyword": "soups"},
        {"session_id": "c", "user_id": 3, "click_category_id": 7},
        {"session_id": "d", "user_id": 99},
    ])
    users = make_users([(1, 20, "cook", "Rome", "male"), (2, 50, "judge", "Oslo", "female"),
                        (3, None, None, "-1", "male")])
    return actions, users


@pytest.mark.parametrize("params, kept", [
    (TaskParams(), "abc"),                                     # unknown user drops
    (TaskParams(start_age=20, end_age=50), "ab"),              # inclusive, missing age fails
    (TaskParams(start_age=30), "abc"),                         # one bound alone is no filter
    (TaskParams(professionals=("cook", "judge")), "ab"),
    (TaskParams(cities=("Oslo", "-1")), "b"),                  # -1 never matches
    (TaskParams(cities=("-1",)), ""),
    (TaskParams(sex="male"), "ac"),
    (TaskParams(sex=""), "abc"),
    (TaskParams(keywords=("soup",)), "a"),                     # equality, not substring
    (TaskParams(category_ids=(7, 8)), "c"),
    (TaskParams(keywords=("soup",), category_ids=(7,)), ""),
    (TaskParams(keywords=("cake",), category_ids=(5,), sex="male"), "a"),
])
def test_filters(shop, params, kept):
    actions, users = shop
    found = S.filtered(actions, users, params)
    assert "".join(sorted(r.session_id for r in found.collect())) == kept
    steps = S.actions_of(actions, found)
    assert {r.session_id for r in steps.collect()} == set(kept)


def test_overlap_on_arrays(spark):
    from pyspark.sql import functions as F
    lists = spark.createDataFrame([(1, [1, 2]), (2, [3]), (3, [])], "id int, items array<bigint>")
    assert filters.overlaps(F.col("items"), ()) is None
    hit = lists.where(filters.overlaps(F.col("items"), (2, 9)))
    assert [r.id for r in hit.collect()] == [1]


def test_params_from_json(spark):
    text = ('{startDate:"2018-06-01", endDate:"2018-06-30", startAge: 20, endAge: 50, '
            'professionals: "", cities: "", sex:"", keywords:"a, b", categoryIds:"3,4", '
            'targetPageFlow:"1,2,3"}')
    assert TaskParams.from_json(spark, text) == TaskParams(
        "2018-06-01", "2018-06-30", 20, 50, keywords=("a", "b"), category_ids=(3, 4),
        page_flow=(1, 2, 3))
