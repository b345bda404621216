"""Plan properties that keep the work spread out on a large, skewed log."""

import pytest

from clickloom.operators import ads, categories, funnel, sampling
from clickloom.operators import sessions as S
from clickloom.params import TaskParams


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of all actions in one session, a third of all sessions with one user."""
    actions = spark.range(60000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('s', id % 900) end as session_id",
        "case when id % 3 = 0 or id % 900 < 300 then 0L else id % 900 end as user_id",
        "id % 10 as page_id", "id % 20 as click_category_id", "id as event_id",
        "cast(null as string) as search_keyword",
        "cast(null as string) as order_category_ids",
        "cast(null as string) as pay_category_ids",
        "timestamp_seconds(1704067200 + id * 5) as action_ts")
    users = spark.range(900).selectExpr("id as user_id", "30 as age", "'p' as professional",
                                        "'c' as city", "'male' as sex")
    return actions, users


@pytest.fixture
def no_broadcast(spark):
    """Small tables take the plan of large ones."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_session_is_split_in_the_semi_join(skewed, no_broadcast):
    actions, users = skewed
    counts = categories.full_counts(
        S.actions_of(actions, S.filtered(actions, users, TaskParams())))
    found = {r.category_id: r.click_count for r in counts.collect()}
    assert found == {c: 3000 for c in range(20)}
    assert "SortMergeJoin(skew=true)" in _plan(counts)


def test_session_top_list_limits_before_the_shuffle(skewed):
    plan = _plan(categories.top_sessions(categories.session_clicks(skewed[0])))
    assert "WindowGroupLimit" in plan and "row_number(), 10, Partial" in plan


def test_sample_limits_before_the_shuffle(skewed):
    plan = _plan(sampling.draw(S.rollup(skewed[0]), 50))
    assert "row_number(), 50, Partial" in plan


def test_unused_lists_are_not_gathered(skewed):
    actions, users = skewed
    assert "collect_set" not in _plan(S.stat_ratio(S.filtered(actions, users, TaskParams())))


def test_funnel_windows_are_cut_by_chunk(skewed):
    moves = funnel.transitions(skewed[0])
    assert len(moves.collect()) == 60000 - (600 + 1)
    assert "ReusedExchange" in _plan(moves).split("Initial Plan")[0]
    counts = funnel.pair_counts(skewed[0], (1, 4, 7))
    assert _plan(counts).count("Scan") == 1 or _plan(counts).count("Range") == 1


def test_top_categories_take_ordered(skewed):
    assert "TakeOrderedAndProject" in _plan(
        categories.top_categories(categories.full_counts(skewed[0])))


def test_blacklist_is_not_forced_into_a_broadcast(spark, no_broadcast):
    clicks = spark.range(1000).selectExpr("id % 7 as userid")
    listed = spark.range(3).selectExpr("id as userid")
    kept = ads.without_blacklisted(clicks, listed)
    assert "Broadcast" not in _plan(kept)
    assert kept.where("userid < 3").count() == 0


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_is_exact_with_and_without_salting(spark, k):
    from pyspark.sql import functions as F

    from clickloom.operators.ranking import top_per_group
    rows = spark.range(9000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 10 as string) end as g",
                                        "(id * 7919) % 1000 as v", "id")
    top = top_per_group(rows, ["g"], [F.desc("v"), F.asc("id")], k, "id")
    found = sorted((r.g, r["rank"], r.id) for r in top.collect())
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append((-r.v, r.id))
    wanted = sorted((g, i, pair[1]) for g, pairs in groups.items()
                    for i, pair in enumerate(sorted(pairs)[:k], start=1))
    assert found == wanted


def test_top_list_is_broadcast_by_its_known_size(skewed):
    actions = skewed[0]
    top = categories.top_categories(categories.full_counts(actions))
    assert "BroadcastHashJoin" in _plan(categories.clicks_on(actions, top))
