"""What the ad program's result logs keep on disk, and what a batch reads of them."""

import os

from clickloom import schemas
from clickloom.__main__ import main
from clickloom.operators import ads
from clickloom.sources import ad_log
from clickloom.streaming import delta_log as dl
from clickloom.streaming.ad_stream import AdStream
from clickloom.streaming.replay import replay
from tests.test_ad_stream import Committed, _batches, _frame, _line, _model, _rows, _tables


def _folders(path):
    return {kind: sorted(os.listdir(f"{path}/{kind}")) for kind in sorted(os.listdir(path))}


def test_folders_stay_level(spark, tmp_path):
    every, counts = 2, []
    program = Committed(spark, str(tmp_path), threshold=5, top=2, compact_every=every)
    batches = _batches(4 * every)
    for number, batch in enumerate(batches):
        program.run(batch)
        if program.stat_log.due(number):
            # The batch before stays readable when this one has been compacted.
            program.last -= 1
            assert _rows(program.ad_stat()) == _model(batches[:number], 5)[2]
            program.last += 1
            counts.append({k: len(v) for k, v in _folders(f"{tmp_path}/stat").items()})
    assert counts[1:] == [{"base": 2, "delta": 2 * every - every}] * 3
    assert _tables(program) == _model(batches, 5)
    program.last -= 1
    program.run(batches[-1])        # a repeat after the removal
    assert _tables(program) == _model(batches, 5)
    assert not os.path.exists(f"{tmp_path}/rejects") and _rows(program.rejects()) == []


def test_a_batch_reads_only_its_days(spark, tmp_path):
    log = dl.DeltaLog(spark, str(tmp_path), schemas.AD_STAT, tuple(ads.STAT), dl.ADD,
                      compact_every=2)
    rows = [(f"2024010{day}", "P", "C", 1, day) for day in range(1, 6)]
    for number in range(3):
        log.write(spark.createDataFrame(rows[number:], schemas.AD_STAT), number)
        log.compact(number)
    only = log.batch(2).where("date = '20240103'").select("date", "province")
    found = log.current(2, only=only)
    assert _rows(found) == [("20240103", "P", "C", 1, 9)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len([s for s in scans if "20240103" in s]) >= 2      # the deltas and the base


def test_no_rows_at_all(spark, tmp_path):
    log = dl.DeltaLog(spark, str(tmp_path), schemas.AD_STAT, tuple(ads.STAT), dl.ADD,
                      compact_every=2)
    empty = spark.createDataFrame([], schemas.AD_STAT)
    for number in range(4):
        log.write(empty, number)
        log.compact(number)
    assert _rows(log.everything(3)) == [] and log.newest_day(3) is None
    assert _rows(log.current(3, only=log.batch(3).select("date"))) == []


def test_a_click_of_the_future_changes_no_other_total(spark, tmp_path):
    program = Committed(spark, str(tmp_path), compact_every=2)
    program.run([f"{1893456000000 + 5} P0 C0 1 1"])     # the year 2030
    for _ in range(3):
        program.run([_line(2, 5, 1, 1), _line(1, 5, 2, 1)])
    assert [(r[0], r[-1]) for r in _rows(program.ad_stat())] == [
        ("20240101", 3), ("20240102", 3), ("20300101", 1)]
    assert _rows(program.rejects()) == []


def test_results_before_the_first_batch_and_export(spark, tmp_path):
    root, landing, out = (str(tmp_path / name) for name in ("root", "landing", "out"))
    program = AdStream(spark, root)
    assert [_rows(t) for t in (program.blacklist(), program.user_day(), program.last_hour(),
                               program.rejects())] == [[], [], [], []]
    batches = _batches(2)
    replay([_frame(spark, batch) for batch in batches], landing, lambda: AdStream(
        spark, root).start(ad_log.file_lines(spark, f"{landing}/*"), every=None))
    for _ in range(2):
        main(["ads-export", "--root", root, "--out", out])
        assert _rows(spark.read.parquet(f"{out}/ad_stat").select(
            "date", "province", "city", "adid", "click_count")) == _model(batches, 100)[2]
    assert sorted(os.listdir(out)) == ["ad_blacklist", "ad_click_trend", "ad_province_top3",
                                       "ad_stat", "ad_user_click_count"]
