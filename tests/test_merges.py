import random

import pytest

from clickloom.operators import merges

SCHEMA = "date string, adid bigint, click_count bigint"


def _table(rng, n):
    return {(f"d{rng.randrange(3)}", rng.randrange(8)): rng.randrange(1, 50) for _ in range(n)}


def _frame(spark, table):
    return spark.createDataFrame([(*k, v) for k, v in table.items()], SCHEMA)


def _dict(df):
    rows = df.collect()
    found = {(r.date, r.adid): r.click_count for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_a_dict(spark, seed):
    rng = random.Random(seed)
    old, new = _table(rng, 12), _table(rng, 6)
    left, right, keys = _frame(spark, old), _frame(spark, new), ["date", "adid"]

    assert _dict(merges.overwrite(left, right, keys)) == {**old, **new}
    assert _dict(merges.insert_new(left, right, keys)) == {**new, **old}
    assert _dict(merges.add_counts(left, right, keys)) == {
        k: old.get(k, 0) + new.get(k, 0) for k in {*old, *new}}
    touched = {k[0] for k in new}
    assert _dict(merges.replace_group(left, right, ["date"])) == {
        **{k: v for k, v in old.items() if k[0] not in touched}, **new}
    for merge in (merges.overwrite, merges.insert_new):     # a repeated batch changes nothing
        once = merge(left, right, keys)
        assert _dict(merge(once, right, keys)) == _dict(once)
