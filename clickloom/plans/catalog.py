"""Every query by name: ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import workdir
from clickloom.functions import dates, records, text
from clickloom.operators import (ads, areas, categories, filters, funnel, merges, sampling,
                                 sliding)
from clickloom.operators import sessions as S
from clickloom.params import TaskParams
from clickloom.session import pin_utc
from clickloom.sinks import outputs
from clickloom.sources import ad_log, session_store, tables, testdata
from clickloom.streaming import running
from clickloom.streaming.ad_stream import AdStream
from clickloom.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]

RANGE = {"start": "2024-01-03", "end": "2024-01-28"}
FLOW = (1, 2, 3, 4, 5, 6, 7)
DEFAULT = TaskParams(start_date=RANGE["start"], end_date=RANGE["end"], start_age=20,
                     end_age=50, page_flow=FLOW)
ALL_SET = TaskParams(start_age=20, end_age=50,
                     professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
                     cities=tuple(f"NATION_{i}" for i in range(16)), sex="male",
                     keywords=tuple(f"kw{i}" for i in range(7)),
                     category_ids=tuple(range(60)))
TASK = json.dumps({
    "startAge": "20", "endAge": "50", "professionals": ",".join(ALL_SET.professionals),
    "cities": ",".join(ALL_SET.cities), "sex": ALL_SET.sex,
    "keywords": ",".join(ALL_SET.keywords),
    "categoryIds": ",".join(map(str, ALL_SET.category_ids))})
SAMPLE_SIZE = 600
THRESHOLD = 3
# More clicks than anybody makes: the blacklist stays empty.
NOBODY = 2 ** 62
LATE_DELAY = "24 hours"
# Buckets of the stored sessions, and the rows above which one is kept apart.
STORE_BUCKETS, STORE_HOT = 16, 1000
# First and last day of each arrival of the replayed log.
ARRIVALS = ((None, "2024-01-05"), ("2024-01-06", "2024-01-10"),
            ("2024-01-11", "2024-01-15"), ("2024-01-16", "2024-01-20"),
            ("2024-01-21", "2024-01-25"), ("2024-01-26", None))

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(pin_utc(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ---------------------------------------------------------------------------

CLICK, ORDER, PAY = ("click",), ("signup",), ("purchase",)
TOUCH = CLICK + ORDER + PAY


def _actions(spark, d, kinds=()):
    return testdata.actions(spark, d, **RANGE, kinds=kinds)


def _all_actions(spark, d):
    return testdata.actions(spark, d)


def _users(spark, d):
    return testdata.users(spark, d)


def _sessions(spark, d, params=TaskParams()):
    """Filtered sessions of the default date range."""
    return S.filtered(_actions(spark, d), _users(spark, d), params, clock="visit_sec")


def _lines(spark, d):
    return testdata.ad_lines(testdata.table(spark, d, "events"))


def _clicks(spark, d):
    return ad_log.good(ad_log.parse(_lines(spark, d)))


def _morning(clicks):
    return clicks.where(F.date_format("ts", "HH") < "12")


def _afternoon(clicks):
    return clicks.where(F.date_format("ts", "HH") >= "12")


# --- scans ----------------------------------------------------------------------------

@query
def action_scan_date_range(spark, d):
    return _actions(spark, d).drop("action_ts", "visit_sec")


@query
def product_click_scan(spark, d):
    return tables.product_clicks(_actions(spark, d, CLICK))


@query
def city_area_dim(spark, d):
    return testdata.cities(spark, d)


# --- filters --------------------------------------------------------------------------

def _profile_filter(spark, d, column, condition):
    sessions = S.full_info(S.rollup(_actions(spark, d)), filters.keep(_users(spark, d), condition))
    return sessions.select("session_id", "user_id", column)


@query
def filter_age_between(spark, d):
    return _profile_filter(spark, d, "age", filters.between(F.col("age"), 20, 50))


@query
def filter_professional_in(spark, d):
    return _profile_filter(spark, d, "professional",
                           filters.member(F.col("professional"), ["BUILDING", "MACHINERY"]))


@query
def filter_city_in(spark, d):
    return _profile_filter(spark, d, "city",
                           filters.member(F.col("city"), ["NATION_3", "NATION_7"]))


@query
def filter_sex_equal(spark, d):
    return _profile_filter(spark, d, "sex", filters.equals(F.col("sex"), "male"))


@query
def filter_keyword_overlap(spark, d):
    found = _sessions(spark, d, TaskParams(keywords=("kw1", "kw5")))
    return S.output_columns(found).select("session_id", "user_id", "search_keywords")


@query
def filter_category_overlap(spark, d):
    found = _sessions(spark, d, TaskParams(category_ids=(10, 20, 30)))
    return S.output_columns(found).select("session_id", "user_id", "click_category_ids")


@query
def session_filter_all(spark, d):
    return S.output_columns(_sessions(spark, d, ALL_SET))


@query
def session_filter_task_json(spark, d):
    """The same filters, read from a task's JSON."""
    return S.output_columns(_sessions(spark, d, TaskParams.from_json(spark, TASK)))


# --- sessions -------------------------------------------------------------------------

@query
def session_rollup(spark, d):
    return S.output_columns(S.rollup(_actions(spark, d), clock="visit_sec"))


@query
def session_full_info(spark, d):
    return S.output_columns(_sessions(spark, d))


@query
def filtered_session_actions(spark, d):
    kept = S.actions_of(_actions(spark, d), _sessions(spark, d, DEFAULT))
    return kept.select("event_id", "session_id", "user_id", "page_id", "action_time",
                       "search_keyword", "click_category_id", "click_product_id",
                       "order_category_ids", "pay_category_ids", "city_id")


@query
def visit_length_histogram(spark, d):
    return S.visit_histogram(_sessions(spark, d, DEFAULT))


@query
def step_length_histogram(spark, d):
    return S.step_histogram(_sessions(spark, d, DEFAULT))


@query
def session_stat_ratio(spark, d):
    return S.stat_ratio(_sessions(spark, d, DEFAULT))


# --- categories -----------------------------------------------------------------------

def _kept_actions(spark, d, kinds):
    return S.actions_of(_actions(spark, d, kinds), _sessions(spark, d, DEFAULT))


def _top10(spark, d):
    return categories.top_categories(categories.full_counts(_kept_actions(spark, d, TOUCH)))


@query
def category_click_count(spark, d):
    return categories.click_count(_kept_actions(spark, d, CLICK))


@query
def category_order_count(spark, d):
    return categories.order_count(_kept_actions(spark, d, ORDER))


@query
def category_pay_count(spark, d):
    return categories.pay_count(_kept_actions(spark, d, PAY))


@query
def category_universe(spark, d):
    return categories.universe(_kept_actions(spark, d, TOUCH))


@query
def category_full_counts(spark, d):
    return categories.full_counts(_kept_actions(spark, d, TOUCH))


@query
def top10_category(spark, d):
    return _top10(spark, d)


@query
def top10_category_actions(spark, d):
    found = categories.clicks_on(_kept_actions(spark, d, CLICK), _top10(spark, d))
    return found.select("event_id", "session_id", "click_category_id")


@query
def category_session_clicks(spark, d):
    return categories.session_clicks(_kept_actions(spark, d, CLICK))


@query
def top10_session_per_category(spark, d):
    # Clicks are narrowed to ten categories and counted per (category, session) before
    # the session join, which then sees at most ten rows per session.
    counts = categories.session_clicks(
        categories.clicks_on(_actions(spark, d, CLICK), _top10(spark, d)))
    return categories.top_sessions(S.actions_of(counts, _sessions(spark, d, DEFAULT)))


# --- sampling -------------------------------------------------------------------------

def _known_sessions(spark, d):
    """Unfiltered sessions of known users, all dates."""
    return S.full_info(S.rollup(_all_actions(spark, d)), _users(spark, d))


@query
def session_hour_counts(spark, d):
    return sampling.hour_counts(_known_sessions(spark, d))


@query
def session_sample_quota(spark, d):
    return sampling.quotas(sampling.hour_counts(_known_sessions(spark, d)), SAMPLE_SIZE)


@query
def session_random_extract(spark, d):
    drawn = sampling.draw(_known_sessions(spark, d), SAMPLE_SIZE)
    return sampling.extract(_all_actions(spark, d), drawn, SAMPLE_SIZE)


@query
def session_detail_extract(spark, d):
    drawn = sampling.draw(_known_sessions(spark, d), SAMPLE_SIZE)
    return sampling.detail(_all_actions(spark, d), drawn, SAMPLE_SIZE)


# --- page funnel ----------------------------------------------------------------------

@query
def page_flow_steps(spark, d):
    """Steps of the flow with the visits each end of a step gets."""
    visits = (_all_actions(spark, d).groupBy("page_id")
              .agg(F.count(F.lit(1)).alias("visits")))
    steps = funnel.flow_table(spark, FLOW)
    for end in ("from", "to"):
        counted = visits.select(F.col("page_id").alias(f"{end}_page"),
                                F.col("visits").alias(f"{end}_visits"))
        steps = steps.join(counted, f"{end}_page", "left")
    return steps.select("step", F.concat_ws("_", "from_page", "to_page").alias("page_pair"),
                        F.coalesce("from_visits", F.lit(0)).alias("from_visits"),
                        F.coalesce("to_visits", F.lit(0)).alias("to_visits"))


@query
def page_transitions(spark, d):
    return funnel.transitions(_all_actions(spark, d))


@query
def page_pair_counts(spark, d):
    return funnel.pair_counts(_all_actions(spark, d), FLOW)


@query
def page_start_count(spark, d):
    return funnel.start_count(_all_actions(spark, d), FLOW)


@query
def page_convert_rate(spark, d):
    return (funnel.convert_rates(_all_actions(spark, d), FLOW)
            .withColumn("rate", text.round_half_up(F.col("rate"), 6)))


@query
def page_convert_rate_string(spark, d):
    return funnel.rate_string(funnel.convert_rates(_all_actions(spark, d), FLOW), scale=6)


# --- areas ----------------------------------------------------------------------------

def _area_counts(spark, d):
    return areas.product_click_count(tables.product_clicks(_actions(spark, d, CLICK)),
                                     testdata.cities(spark, d))


def _area_info(spark, d):
    return areas.with_product(_area_counts(spark, d), testdata.products(spark, d))


@query
def area_product_basic(spark, d):
    return areas.basic(tables.product_clicks(_actions(spark, d, CLICK)), testdata.cities(spark, d))


@query
def area_basic_ordered(spark, d):
    product = F.col("click_product_id")
    clicks = (_actions(spark, d, CLICK).where(product.isNotNull() & (product != -1))
              .select("city_id", "click_product_id", "event_id"))
    return areas.ordered(areas.basic(clicks, testdata.cities(spark, d)))


@query
def area_product_click_count(spark, d):
    return _area_counts(spark, d)


@query
def group_concat_distinct(spark, d):
    """Distinct city list of every product over all areas."""
    counted = (tables.product_clicks(_actions(spark, d, CLICK))
               .groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("clicks")))
    named = areas.basic(counted, testdata.cities(spark, d))
    city = text.concat_long_string(F.col("city_id"), F.col("city_name"), ":")
    return named.groupBy("product_id").agg(text.group_concat_distinct(city)
                                           .alias("city_infos"))


@query
def product_status_flag(spark, d):
    return testdata.products(spark, d).select(
        "product_id", text.json_value(F.col("extend_info"), "product_status").alias("status"),
        areas.product_status(F.col("extend_info")).alias("product_status"))


@query
def area_product_info(spark, d):
    return _area_info(spark, d)


@query
def area_level_case(spark, d):
    return testdata.cities(spark, d).select(
        "city_id", "area", areas.level(F.col("area"), testdata.AREA_LEVELS).alias("area_level"))


@query
def area_top3_product(spark, d):
    return areas.top_products(_area_info(spark, d), testdata.AREA_LEVELS)


# --- ads, batch -----------------------------------------------------------------------

@query
def ad_record_parse(spark, d):
    ts = F.col("ts")
    return _clicks(spark, d).select("ts_ms", "date", dates.minute_key(ts).alias("minute"),
                                    "province", "city", "userid", "adid")


@query
def ad_user_day_count(spark, d):
    return ads.user_day_count(_clicks(spark, d))


@query
def ad_user_day_lookup(spark, d):
    """Afternoon keys with the totals stored in the morning."""
    stored = ads.user_day_count(_morning(_clicks(spark, d))).withColumnRenamed(
        "click_count", "stored_count")
    batch = ads.user_day_count(_afternoon(_clicks(spark, d)))
    return (batch.join(stored, ads.USER_DAY, "left")
            .withColumn("stored_count", F.coalesce("stored_count", F.lit(0))))


@query
def ad_blacklist_users(spark, d):
    return ads.abusive_users(ads.user_day_count(_clicks(spark, d)), THRESHOLD)


@query
def ad_blacklist_filter(spark, d):
    found = ads.abusive_users(ads.user_day_count(_clicks(spark, d)), THRESHOLD)
    return ads.without_blacklisted(_clicks(spark, d), found).select(
        "ts_ms", "province", "city", "userid", "adid")


@query
def ad_stat_daily(spark, d):
    return ads.stat(_clicks(spark, d))


@query
def ad_province_count(spark, d):
    return ads.province_count(ads.stat(_clicks(spark, d)))


@query
def ad_province_top3(spark, d):
    return ads.province_top(ads.province_count(ads.stat(_clicks(spark, d))))


@query
def ad_click_trend_minute(spark, d):
    return ads.trend(ads.minute_counts(_clicks(spark, d)))


# --- ads, streams ---------------------------------------------------------------------

def _line_stream(spark, d):
    return testdata.ad_lines(testdata.event_stream(spark, d))


def _dealt_arrivals(spark, d, parts=3):
    """The whole click log in arrivals that each hold clicks of all days."""
    events = testdata.table(spark, d, "events")
    dealt = F.pmod(F.xxhash64("event_id"), F.lit(parts))
    return [testdata.ad_lines(events.where(dealt == part)) for part in range(parts)]


def _run_dealt(spark, d, root, upsert):
    """Land the dealt arrivals one by one; the totals of each go on from the state."""
    landing = f"{root}/landing"
    replay(_dealt_arrivals(spark, d), landing,
           lambda: upsert(ad_log.file_lines(spark, f"{landing}/*")))


def _finish(stream):
    stream.awaitTermination()


@query
def ad_stream_ingest(spark, d):
    root = workdir.fresh_dir(spark, "ingest")
    _finish(running.ingest(_line_stream(spark, d), root))
    return spark.read.parquet(f"{root}/clicks").select("ts_ms", "date", "province", "city",
                                                       "userid", "adid")


@query
def ad_stat_running(spark, d):
    root = workdir.fresh_dir(spark, "stat")
    log = running.stat_log(spark, root)
    _run_dealt(spark, d, root,
               lambda lines: running.upsert(running.stat_totals(lines), log, root))
    return log.current(_upto(spark, root))


@query
def ad_province_top3_stream(spark, d):
    root = workdir.fresh_dir(spark, "top")
    _run_dealt(spark, d, root,
               lambda lines: running.upsert_with_top(running.stat_totals(lines), root))
    return running.top_log(spark, root).current(_upto(spark, root))


def _minutes(spark, d):
    root = workdir.fresh_dir(spark, "minutes")
    log = running.minute_log(spark, root)
    _run_dealt(spark, d, root,
               lambda lines: running.upsert(running.minute_totals(lines), log, root))
    return log.current(_upto(spark, root))


@query
def ad_click_trend_stream(spark, d):
    return ads.trend(_minutes(spark, d))


@query
def ad_click_sliding_60m(spark, d):
    return sliding.window_counts(_minutes(spark, d))


@query
def ad_click_sliding_3h(spark, d):
    """Three-hour windows, one each quarter of an hour."""
    return sliding.window_counts(ads.minute_counts(_clicks(spark, d)), length=180, slide=15)


def _upto(spark, root):
    from clickloom.streaming.delta_log import last_committed
    return last_committed(spark, f"{root}/checkpoint")


def _arrivals(spark, d):
    """The click log cut by day range, all rows."""
    events = testdata.table(spark, d, "events")
    return [testdata.ad_lines(testdata.events_between(events, start, end))
            for start, end in ARRIVALS]


def _late_arrivals(spark, d, by=1):
    """The same log where every ``error`` event comes ``by`` arrivals late."""
    events = testdata.table(spark, d, "events")
    late = F.coalesce(F.col("event_type") == "error", F.lit(False))
    parts = [testdata.events_between(events, start, end) for start, end in ARRIVALS]
    slices = []
    for number in range(len(parts) + by):
        found = []
        if number < len(parts):
            found.append(parts[number].where(~late))
        if number >= by:
            found.append(parts[number - by].where(late))
        joined = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        slices.append(testdata.ad_lines(joined))
    return slices


@query
def ad_click_trend_late(spark, d):
    """Minute counts under a watermark: clicks later than the delay are dropped."""
    root = workdir.fresh_dir(spark, "late")
    landing = f"{root}/landing"
    log = running.minute_log(spark, root)

    def start():
        lines = ad_log.file_lines(spark, f"{landing}/*")
        return running.upsert(running.minute_totals(lines, LATE_DELAY), log, root)

    replay(_late_arrivals(spark, d), landing, start)
    return ads.trend(log.current(_upto(spark, root)))


@query
def ad_click_late_ledger(spark, d):
    """The clicks that the watermark of ``ad_click_trend_late`` leaves out."""
    root = workdir.fresh_dir(spark, "ledger")
    landing = f"{root}/landing"
    replay(_late_arrivals(spark, d), landing,
           lambda: running.upsert_with_ledger(ad_log.file_lines(spark, f"{landing}/*"), root,
                                              LATE_DELAY))
    return running.late_log(spark, root).rows(_upto(spark, root)).drop("batch_id")


def _replayed(spark, arrivals, label, threshold=THRESHOLD, compact_every=4):
    root = workdir.fresh_dir(spark, label)
    landing = f"{root}/landing"

    def program():
        # A new object each time: all it needs is under ``root``.
        return AdStream(spark, root, threshold=threshold, compact_every=compact_every)

    replay(arrivals, landing,
           lambda: program().start(ad_log.file_lines(spark, f"{landing}/*"), every=None))
    return program()


@query
def ad_stream_blacklist_replay(spark, d):
    """Totals per user, day and ad of the clicks that got past the blacklist."""
    return _replayed(spark, _arrivals(spark, d), "blacklist").user_day()


@query
def ad_stream_restart(spark, d):
    """Daily totals after a restart of the program at every arrival."""
    return _replayed(spark, _arrivals(spark, d), "restart").ad_stat()


@query
def ad_stream_late_days(spark, d):
    """Daily totals where some clicks come two arrivals, up to ten days, late."""
    return _replayed(spark, _late_arrivals(spark, d, by=2), "late-days", NOBODY, 2).ad_stat()


@query
def ad_click_trend_last_hour(spark, d):
    """Clicks per minute and ad in the hour up to the newest minute."""
    return _replayed(spark, _dealt_arrivals(spark, d), "hour", NOBODY, 2).last_hour()


# --- sinks and merges -----------------------------------------------------------------

@query
def table_overwrite_round_trip(spark, d):
    """Write the action table, partitioned by date, and scan a date range of it."""
    name = f"user_visit_action_{uuid.uuid4().hex}"
    outputs.overwrite_table(_all_actions(spark, d).drop("action_ts", "visit_sec"), name,
                            path=workdir.fresh_dir(spark, "actions"), partition_by=("date",))
    return (tables.read_actions(spark, name, **RANGE)
            .select(F.col("date").cast("string").alias("date"), "event_id", "user_id",
                    "session_id", "page_id", "action_time", "search_keyword",
                    "click_category_id", "order_category_ids", "pay_category_ids", "city_id"))


def _session_store(spark, d):
    """The action table stored by session.  Small here, so are its buckets."""
    name = f"session_actions_{uuid.uuid4().hex}"
    session_store.write(_all_actions(spark, d).drop("action_ts"), name, STORE_BUCKETS,
                        STORE_HOT, workdir.fresh_dir(spark, "session-store"))
    return session_store.SessionStore.open(spark, name, **RANGE)


@query
def session_store_rollup(spark, d):
    """``session_rollup`` on a log stored by session."""
    return S.output_columns(_session_store(spark, d).per_session(
        lambda actions: S.rollup(actions, clock="visit_sec")))


@query
def session_store_actions(spark, d):
    """Actions of the filtered sessions, from a log stored by session."""
    users = _users(spark, d)
    kept = _session_store(spark, d).per_session(lambda actions: S.actions_of(
        actions, S.filtered(actions, users, DEFAULT, clock="visit_sec")))
    return kept.select("event_id", "session_id", "user_id", "page_id", "action_time",
                       "search_keyword", "click_category_id", "click_product_id",
                       "order_category_ids", "pay_category_ids", "city_id")


@query
def merge_insert_new(spark, d):
    """Morning counts, and those of the afternoon for keys that the morning has not."""
    clicks = _clicks(spark, d)
    return merges.insert_new(ads.user_day_count(_morning(clicks)),
                             ads.user_day_count(_afternoon(clicks)), ads.USER_DAY)


@query
def merge_add_counts(spark, d):
    clicks = _clicks(spark, d)
    return merges.add_counts(ads.user_day_count(_morning(clicks)),
                             ads.user_day_count(_afternoon(clicks)), ads.USER_DAY)


@query
def merge_overwrite_counts(spark, d):
    """Morning totals overwritten by the afternoon's for the keys it has."""
    clicks = _clicks(spark, d)
    return merges.overwrite(ads.stat(_morning(clicks)), ads.stat(_afternoon(clicks)), ads.STAT)


@query
def merge_replace_group(spark, d):
    """Morning top 3 of each (date, province), replaced where the afternoon has clicks."""
    def top(clicks):
        return ads.province_top(ads.province_count(ads.stat(clicks)))

    clicks = _clicks(spark, d)
    return merges.replace_group(top(_morning(clicks)), top(_afternoon(clicks)),
                                ["date", "province"])


# --- scalar functions -----------------------------------------------------------------

@query
def fn_dates(spark, d):
    at = F.col("action_time")
    midnight = F.concat(F.col("date"), F.lit(" 00:00:00"))
    noon = F.concat(F.col("date"), F.lit(" 12:00:00"))
    ts = dates.parse_time(at)
    return _all_actions(spark, d).select(
        "event_id",
        dates.format_date(ts).alias("day"), dates.format_time(ts).alias("time"),
        dates.date_key(ts).alias("date_key"), dates.minute_key(ts).alias("minute_key"),
        dates.date_hour(at).alias("date_hour"),
        dates.before(at, noon).cast("int").alias("before_noon"),
        dates.after(at, noon).cast("int").alias("after_noon"),
        dates.minus_seconds(at, midnight).alias("day_seconds"),
        F.date_format(dates.parse_date_key(dates.date_key(ts)), dates.DATE).alias("parsed_day"))


@query
def fn_round_half_up(spark, d):
    value = F.col("value")
    return testdata.table(spark, d, "events").select(
        "event_id", text.round_half_up(value, 1).alias("one_place"),
        text.round_half_up(value / 7, 2).alias("two_places"))


@query
def fn_strings(spark, d):
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    listed = F.regexp_replace(name, " ", ",")
    return testdata.table(spark, d, "part").select(
        "p_partkey",
        text.trim_comma(F.concat(F.lit(","), listed, F.lit(","))).alias("both"),
        text.trim_comma(F.concat(listed, F.lit(","))).alias("right"),
        text.trim_comma(listed).alias("unchanged"),
        text.two_digits(size).alias("two_digits"),
        text.is_empty(F.when(F.col("p_size") > 25, size)).cast("int").alias("is_empty"),
        text.is_not_empty(F.when(F.col("p_size") > 25, size)).cast("int").alias("is_not_empty"))


@query
def fn_record_field(spark, d):
    record = F.concat(F.lit("userid="), F.col("c_custkey").cast("string"),
                      F.lit("|keywords=|professional="), F.col("c_mktsegment"),
                      F.lit("|name="), F.col("c_name"))
    return testdata.table(spark, d, "customer").select(
        "c_custkey",
        records.get_field(record, "userid").alias("userid"),
        records.get_field(record, "professional").alias("professional"),
        records.get_field(record, "keywords").alias("keywords"),
        records.get_field(record, "absent").alias("absent"),
        records.set_field(record, "professional", F.lower("c_mktsegment")).alias("changed"))
