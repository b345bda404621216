import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.operators import sampling


def _expected_quota(counts, size):
    days = Counter()
    for (day, _), n in counts.items():
        days[day] += n
    per_day = size // len(days)
    return {key: min(n, math.floor(n / days[key[0]] * per_day)) for key, n in counts.items()}


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.tuples(st.integers(1, 9), st.integers(0, 23)), st.integers(1, 500),
                       min_size=1, max_size=30), st.integers(0, 700))
def test_quota_formula(spark, counts, size):
    rows = [(f"2024-01-0{day}", f"{hour:02d}", n) for (day, hour), n in counts.items()]
    table = spark.createDataFrame(rows, "date string, hour string, session_count bigint")
    found = {(int(r.date[-1]), int(r.hour)): r.quota
             for r in sampling.quotas(table, size).collect()}
    assert found == _expected_quota(counts, size)


@pytest.mark.parametrize("seed", ["0", "again"])
def test_draw_fills_each_quota_without_repeats(spark, seed):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):   # a third of all sessions start in one hour
        minutes = rng.randrange(60) if i % 3 == 0 else rng.randrange(4 * 24 * 60)
        rows.append((f"s{i}", start + timedelta(minutes=minutes)))
    sessions = spark.createDataFrame(rows, "session_id string, start_ts timestamp")
    drawn = sampling.draw(sessions, 100, seed).collect()
    hours = Counter((r[1].day, r[1].hour) for r in rows)
    wanted = {k: q for k, q in _expected_quota(hours, 100).items() if q}
    assert Counter((int(r.date[-2:]), int(r.hour)) for r in drawn) == wanted
    assert len({r.session_id for r in drawn}) == len(drawn) <= 100


def test_draw_repeats_with_its_seed(spark):
    sessions = spark.range(500).selectExpr("cast(id as string) session_id",
                                           "timestamp'2024-01-01 05:00:00' start_ts")
    ids = lambda seed: {r.session_id for r in sampling.draw(sessions, 20, seed).collect()}
    assert ids("a") == ids("a") != ids("b")
