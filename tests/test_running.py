"""Top lists from the ones before, the late ledger, and the processing-time trigger."""

import random
import time
from collections import Counter

import pytest

from clickloom.operators import ads
from clickloom.sources import ad_log
from clickloom.streaming import running
from clickloom.streaming.ad_stream import AdStream
from clickloom.streaming.delta_log import last_committed
from clickloom.streaming.replay import replay

TOTALS = "date string, province string, adid bigint, click_count bigint"
DAY = 1704067200000


@pytest.mark.parametrize("seed", range(3))
def test_next_top_equals_ranking_everything(spark, seed):
    rng = random.Random(seed)
    totals, top = Counter(), spark.createDataFrame([], TOTALS)
    for _ in range(3):
        grown = Counter((rng.choice("ab"), rng.choice("PQ"), rng.randrange(7)) for _ in range(12))
        totals.update(grown)
        touched = spark.createDataFrame([(*key, totals[key]) for key in grown], TOTALS)
        places = touched.select("date", "province").distinct()
        new = ads.next_top(top.join(places, ["date", "province"], "left_semi"), touched, 2)
        rest = top.join(places, ["date", "province"], "left_anti")
        top = spark.createDataFrame(rest.unionByName(new).collect(), TOTALS)
        wanted = ads.province_top(spark.createDataFrame(
            [(*key, n) for key, n in totals.items()], TOTALS), 2)
        assert sorted(top.collect()) == sorted(wanted.collect())


def test_kept_and_late_clicks_are_all_clicks(spark, tmp_path):
    root = str(tmp_path / "ledger")
    at = lambda minute, ad: f"{DAY + minute * 60000} P1 C1 7 {ad}"
    # After minute 100 the watermark of ten minutes stands at 90: minute 89 ends there.
    arrivals = [[at(100, 1), "broken"], [at(89, 2), at(89, 2), at(90, 3), at(300, 4)],
                [at(289, 5), at(290, 6)], []]
    frames = [spark.createDataFrame([(line,) for line in lines], "value string")
              for lines in arrivals]
    replay(frames, f"{root}/landing", lambda: running.upsert_with_ledger(
        ad_log.file_lines(spark, f"{root}/landing/*"), root, "10 minutes"))
    upto = last_committed(spark, f"{root}/checkpoint")
    late = running.late_log(spark, root).rows(upto).collect()
    assert sorted(r.adid for r in late) == [2, 2, 5]
    kept = running.ledger_counts(spark, root).current(upto).collect()
    assert sorted((r.adid, r.click_count) for r in kept) == [(1, 1), (3, 1), (4, 1), (6, 1)]


def test_processing_time_trigger_runs_batch_after_batch(spark, tmp_path):
    root = str(tmp_path / "timed")
    program = AdStream(spark, root, threshold=100)

    def land(number):
        spark.createDataFrame([(f"{DAY} P1 C1 7 {number}",)], "value string").write.text(
            f"{root}/landing/{number}")

    land(0)
    stream = program.start(ad_log.file_lines(spark, f"{root}/landing/*"), every="1 second")
    try:
        for number in range(2):
            if number:
                land(number)
            until = time.time() + 90
            while program.upto() < number and time.time() < until:
                assert stream.exception() is None
                time.sleep(0.5)
    finally:
        stream.stop()
    assert program.upto() == 1
    assert sorted((r.adid, r.click_count) for r in program.ad_stat().collect()) == [(0, 1), (1, 1)]
