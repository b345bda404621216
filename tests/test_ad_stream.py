"""The micro-batch program on hand-made batches."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from clickloom.operators import ads
from clickloom.sources import ad_log
from clickloom.streaming import delta_log, running
from clickloom.streaming.ad_stream import AdStream
from clickloom.streaming.replay import replay


def _line(day, second, user, ad, city=0):
    at = datetime(2024, 1, day, tzinfo=timezone.utc) + timedelta(seconds=second)
    return f"{int(at.timestamp() * 1000)} P{city % 2} C{city} {user} {ad}"


def _frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


class Committed(AdStream):
    """The program driven by hand: the newest batch is told, not read from a checkpoint."""

    last = -1

    def run(self, lines):
        self.last += 1
        self.process(_frame(self.spark, lines), self.last)

    def upto(self):
        return self.last


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_parse_sorts_out_malformed_lines(spark):
    lines = _frame(spark, ["1704067200123 P C 5 9", "1704067200123 P C 5", "soon P C 5 9",
                           "1704067200123 P C me 9", "1704067200123 P C 5 x", "",
                           "1704067200123 P C 5 9 more"])
    parsed = ad_log.parse(lines)
    assert sorted(r.reason for r in ad_log.rejects(parsed).collect()) == [
        "bad ad", "bad time", "bad user", "too few fields", "too few fields"]
    good = ad_log.good(parsed).collect()
    assert [(r.ts_ms, r.date, r.userid, r.adid) for r in good] == [
        (1704067200123, "20240101", 5, 9)] * 2


def _batches(n=9, seed=1):
    rng = random.Random(seed)
    return [[_line(1 + b // 2, rng.randrange(86400), rng.randrange(12), rng.randrange(3),
                   rng.randrange(4)) for _ in range(40)] for b in range(n)]


def _model(batches, threshold):
    """The same program over plain Python containers."""
    black, user_day, stat, trend = set(), Counter(), Counter(), Counter()
    for batch in batches:
        passed = [line.split() for line in batch if int(line.split()[3]) not in black]
        touched = set()
        for ms, province, city, user, ad in passed:
            at = datetime.fromtimestamp(int(ms) / 1000, timezone.utc)
            day = at.strftime("%Y%m%d")
            user_day[day, int(user), int(ad)] += 1
            touched.add((day, int(user), int(ad)))
            stat[day, province, city, int(ad)] += 1
            trend[day, at.strftime("%H"), at.strftime("%M"), int(ad)] += 1
        black |= {k[1] for k in touched if user_day[k] >= threshold}
    provinces = Counter()
    for (day, province, _, ad), n in stat.items():
        provinces[day, province, ad] += n
    top = []
    for group in {k[:2] for k in provinces}:
        ranked = sorted((-n, k[2]) for k, n in provinces.items() if k[:2] == group)[:2]
        top += [(*group, ad, -n) for n, ad in ranked]
    table = lambda counter: sorted((*k, n) for k, n in counter.items())
    return sorted((u,) for u in black), table(user_day), table(stat), sorted(top), table(trend)


def _tables(program):
    return tuple(_rows(t) for t in (program.blacklist(), program.user_day(),
                                    program.ad_stat(), program.province_top(),
                                    program.click_trend()))


@pytest.mark.parametrize("compact_every, open_days", [(20, None), (2, None), (2, 1)])
def test_program_equals_the_model(spark, tmp_path, compact_every, open_days):
    batches = _batches(6)
    program = Committed(spark, str(tmp_path), threshold=5, top=2,
                        compact_every=compact_every, open_days=open_days)
    for batch in batches:
        program.run(batch)
    assert _tables(program) == _model(batches, 5)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    batches = _batches(3)
    program = Committed(spark, str(tmp_path), threshold=4, top=2, compact_every=2)
    for batch in batches:
        program.run(batch)
        program.last -= 1
        program.run(batch)
    assert _tables(program) == _model(batches, 4)


def test_closed_days_reject_late_clicks(spark, tmp_path):
    program = Committed(spark, str(tmp_path), compact_every=2, open_days=1)
    program.run([_line(1, 5, 1, 1), "junk"])
    program.run([_line(4, 5, 1, 1)])
    program.run([_line(3, 5, 1, 1), _line(2, 5, 1, 1)])
    assert [r[0] for r in _rows(program.ad_stat())] == ["20240101", "20240103", "20240104"]
    assert _rows(program.rejects().select("reason")) == [("closed day",), ("too few fields",)]
    assert [r[0] for r in _rows(program.stat_log.current(program.upto()))] == [
        "20240103", "20240104"]     # the first day has left the working set


def test_last_hour(spark, tmp_path):
    program = Committed(spark, str(tmp_path))
    program.run([_line(1, 0, 1, 1), _line(1, 3600, 1, 1), _line(1, 3660, 1, 1)])
    assert [r[1:3] for r in _rows(program.last_hour())] == [("01", "00"), ("01", "01")]


def test_stream_with_restarts_equals_the_model(spark, tmp_path):
    batches = _batches(4)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")

    def start():
        program = AdStream(spark, root, threshold=4, top=2, compact_every=2)
        return program.start(ad_log.file_lines(spark, f"{landing}/*"), every=None)

    replay([_frame(spark, batch) for batch in batches], landing, start)
    program = AdStream(spark, root, threshold=4, top=2, compact_every=2)
    assert program.upto() == 3
    assert _tables(program) == _model(batches, 4)
    exported = {}
    program.export(lambda df, name: exported.update({name: df.count()}))
    assert exported["ad_stat"] == len(_rows(program.ad_stat()))


def test_running_totals_over_restarts(spark, tmp_path):
    batches = _batches(4)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")

    def start():
        totals = running.stat_totals(ad_log.file_lines(spark, f"{landing}/*"), "5 days")
        return running.upsert_with_top(totals, root, k=2)

    replay([_frame(spark, batch) for batch in batches], landing, start)
    upto = delta_log.last_committed(spark, f"{root}/checkpoint")
    _, _, stat, top, _ = _model(batches, 10**9)
    assert _rows(running.stat_log(spark, root).current(upto)) == stat
    assert _rows(running.top_log(spark, root).current(upto)) == top


def test_click_later_than_the_delay_is_dropped(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    log = running.minute_log(spark, root)

    def start():
        totals = running.minute_totals(ad_log.file_lines(spark, f"{landing}/*"), "10 minutes")
        started.append(running.upsert(totals, log, root))
        return started[-1]

    started = []
    arrivals = [[_line(1, 7200, 1, 1)], [_line(1, 7200 - 300, 1, 1), _line(1, 7200 - 900, 1, 1)]]
    replay([_frame(spark, lines) for lines in arrivals], landing, start)
    kept = ads.trend(log.current(delta_log.last_committed(spark, f"{root}/checkpoint")))
    assert [r[1:3] for r in _rows(kept)] == [("01", "55"), ("02", "00")]
    assert [running.late_rows(query) for query in started] == [0, 1]
