import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from clickloom.operators import funnel


def _log(n, seed=3):
    """A log in which one session holds half of the actions and many times are equal."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [{"session_id": "hot" if i % 2 else f"s{rng.randrange(20)}",
             "page_id": rng.randrange(4),
             "action_time": (start + timedelta(seconds=rng.randrange(4000)))
             .strftime("%Y-%m-%d %H:%M:%S")} for i in range(n)]


def _brute(rows):
    sessions = defaultdict(list)
    for i, row in enumerate(rows):
        sessions[row["session_id"]].append((row["action_time"], i, row["page_id"]))
    pairs = Counter()
    for name, steps in sessions.items():
        pages = [page for _, _, page in sorted(steps)]
        pairs.update((name, a, b) for a, b in zip(pages, pages[1:]))
    return pairs


@pytest.mark.parametrize("chunk", [1, 60, 600, 10**9])
def test_transitions_do_not_depend_on_the_chunk(make_actions, chunk):
    rows = _log(600)
    found = funnel.transitions(make_actions(rows), chunk).collect()
    assert Counter(tuple(r) for r in found) == _brute(rows)


@pytest.mark.parametrize("chunk", [1, 60, 10**9])
def test_pair_counts_do_not_depend_on_the_chunk(make_actions, chunk):
    rows = _log(600, seed=4)
    wanted = Counter()
    for (_, a, b), n in _brute(rows).items():
        wanted[a, b] += n
    found = funnel.pair_counts(make_actions(rows), (0, 1, 1, 3, 2), chunk).collect()
    assert [(r.from_page, r.to_page, r.pair_count) for r in found] == [
        (a, b, wanted[a, b]) for a, b in [(0, 1), (1, 1), (1, 3), (3, 2)]]


def test_missing_page_still_separates_its_neighbours(make_actions):
    rows = [{"page_id": p, "action_time": f"2024-01-01 00:0{i}:00"}
            for i, p in enumerate([1, None, 2])]
    found = funnel.transitions(make_actions(rows), 60).collect()
    assert sorted(map(tuple, found), key=str) == [("s", 1, None), ("s", None, 2)]


def test_rates_chain_and_missing_steps(make_actions):
    pages = [1, 2, 1, 2, 3, 1, 9]
    rows = [{"page_id": p, "action_time": f"2024-01-01 00:00:0{i}"}
            for i, p in enumerate(pages)]
    rates = funnel.convert_rates(make_actions(rows), (1, 2, 3, 4, 5))
    found = [(r.page_pair, r.pair_count, r.rate) for r in rates.orderBy("step").collect()]
    assert found == [("1_2", 2, 2 / 3), ("2_3", 1, 0.5), ("3_4", 0, 0.0), ("4_5", 0, None)]
    text = funnel.rate_string(rates, scale=2).first().convert_rate
    assert text == "1_2=0.67|2_3=0.50|3_4=0.00|4_5=NULL"


def test_repeated_flow_step_and_no_start_page(make_actions):
    rows = [{"page_id": p, "action_time": f"2024-01-01 00:00:0{i}"}
            for i, p in enumerate([1, 2, 1, 2])]
    counts = funnel.pair_counts(make_actions(rows), (1, 2, 1, 2))
    assert [r.pair_count for r in counts.orderBy("step").collect()] == [2, 1, 2]
    none = funnel.convert_rates(make_actions(rows), (7, 8))
    assert [(r.pair_count, r.rate) for r in none.collect()] == [(0, None)]


def test_flow_table(spark):
    assert [tuple(r) for r in funnel.flow_table(spark, (1, 5, 2)).collect()] == [
        (1, 1, 5), (2, 5, 2)]
