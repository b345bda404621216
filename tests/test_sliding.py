"""Windows by events against counting every click into every window."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from clickloom.operators import sliding

START = datetime(2024, 1, 1, 22, 0, tzinfo=timezone.utc)


def _plain(counts, length, slide):
    found = Counter()
    for minute, ad, n in counts:
        at = int(minute.timestamp()) // 60
        for start in range(at // slide * slide, at - length, -slide):
            found[start, ad] += n
    text = lambda m: datetime.fromtimestamp(m * 60, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return sorted((text(s), text(s + length), ad, n) for (s, ad), n in found.items())


@pytest.mark.parametrize("length, slide", [(60, 1), (60, 7), (5, 5), (180, 15), (2000, 50)])
def test_windows_match_a_plain_count(spark, length, slide):
    rng = random.Random(length)
    counts = {(START + timedelta(minutes=rng.choice((1, 40, 3000)) * rng.randrange(6)), ad)
              for ad in range(4) for _ in range(9)}
    rows = [(minute, ad, rng.randrange(1, 9)) for minute, ad in sorted(counts)]
    frame = spark.createDataFrame(rows, "minute_ts timestamp, adid bigint, click_count bigint")
    found = sorted(tuple(r) for r in sliding.window_counts(frame, length, slide).collect())
    assert found == _plain(rows, length, slide)


def test_no_counts_and_wrong_slides(spark):
    empty = spark.createDataFrame([], "minute_ts timestamp, adid bigint, click_count bigint")
    assert sliding.window_counts(empty).collect() == []
    with pytest.raises(ValueError):
        sliding.window_counts(empty, 5, 6)
