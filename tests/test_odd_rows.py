"""Rows and parameters that must not end a job."""

from clickloom.operators import categories, funnel
from clickloom.sources import ad_log
from clickloom.streaming.ad_stream import AdStream


def test_every_line_is_parsed_or_rejected(spark):
    lines = ["9223372036854775807 P C 1 1", "-5 P C 1 1", "1704067200000000 P C 1 1", "1704067200000  C 1 1",
             "1704067200000 P C x 1", "", None, "1704067200000 P C 1 1"]
    parsed = ad_log.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    reasons = [r.reason for r in parsed.select("value", "reason").collect()]
    assert reasons.count(None) == 1 and reasons.count("bad time") == 3 and reasons.count("bad place") == 1
    assert ad_log.good(parsed).count() == 1


def test_bad_lines_leave_the_stream_running(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = ["9223372036854775807 P C 1 1", "1893456000000 P C 1 1", *["1704067200000 P C 1 1"] * 5]
    (source / "a.txt").write_text("\n".join(lines))
    stream = AdStream(spark, str(tmp_path / "root"))
    assert stream.upto() == -1 and stream.blacklist().count() == 0
    stream.start(ad_log.file_lines(spark, str(source)), every=None).awaitTermination()
    (source / "b.txt").write_text("\n".join(lines[2:]))
    stream.start(ad_log.file_lines(spark, str(source)), every=None).awaitTermination()
    totals = {r.date: r.click_count for r in stream.ad_stat().collect()}
    assert totals == {"20300101": 1, "20240101": 10}


def test_category_lists_with_blank_and_malformed_items(make_actions):
    actions = make_actions([{"order_category_ids": ""}, {"order_category_ids": "1, 2,,x,1"}])
    found = {r.category_id: r.order_count for r in categories.order_count(actions).collect()}
    assert found == {1: 2, 2: 1}


def test_a_flow_of_one_page_has_no_steps(make_actions):
    actions = make_actions([{"page_id": 1}])
    assert funnel.pair_counts(actions, [1]).count() == 0
    assert funnel.convert_rates(actions, []).count() == 0
