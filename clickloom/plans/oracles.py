"""SQL for DuckDB giving each query's result, written from the definitions."""

from __future__ import annotations

RANGE = "date BETWEEN '2024-01-03' AND '2024-01-28'"

# --- shared WITH clauses ----------------------------------------------------------------

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000000 AS es
  FROM events)"""

ACTIONS = EV + """,
actions AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
         CASE user_id % 3
           WHEN 0 THEN user_id || '_' || strftime(ts, '%Y%m%d')
           WHEN 1 THEN user_id || '_w' || ((day(ts) - 1) // 7)
           ELSE user_id || '_m' END AS session_id,
         k % 10 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (k * 7) % 100 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN k || ',' || ((k + 37) % 100) END
           AS order_category_ids,
         CAST(NULL AS VARCHAR) AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CAST(NULL AS VARCHAR) AS pay_product_ids,
         event_id % 25 AS city_id, event_id, ts,
         1704067200 + (es - 1704067200) //
           ((CASE user_id % 3 WHEN 0 THEN 24 WHEN 1 THEN 168 ELSE 720 END) *
            (CASE (user_id // 3) % 4 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100
             ELSE 400 END)) AS visit_sec
  FROM ev)"""

DIMS = """
users AS (
  SELECT c_custkey AS user_id, CAST((c_custkey * 7) % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size % 2 AS VARCHAR) AS status,
         CASE WHEN p_size % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM part)"""


def _sessions(where: str) -> str:
    return f"""
acts AS (SELECT * FROM actions WHERE {where}),
sess AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time,
         max(visit_sec) - min(visit_sec) AS visit_length, count(*) AS step_length,
         array_to_string(list_sort(list(DISTINCT search_keyword)
           FILTER (search_keyword IS NOT NULL)), ',') AS search_keywords,
         array_to_string(list_sort(list(DISTINCT click_category_id)
           FILTER (click_category_id <> -1)), ',') AS click_category_ids
  FROM acts GROUP BY session_id),
info AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex FROM sess s JOIN users u USING (user_id))"""


BASE = ACTIONS + "," + DIMS + "," + _sessions(RANGE)
BASE_ALL = ACTIONS + "," + DIMS + "," + _sessions("true")
KEPT = BASE + """,
good AS (SELECT * FROM info WHERE age BETWEEN 20 AND 50),
kept AS (SELECT * FROM acts WHERE session_id IN (SELECT session_id FROM good))"""

CATS = KEPT + """,
clicks AS (SELECT click_category_id AS category_id, count(*) AS click_count
  FROM kept WHERE click_category_id <> -1 GROUP BY 1),
orders_ AS (SELECT CAST(id AS BIGINT) AS category_id, count(*) AS order_count
  FROM (SELECT unnest(string_split(order_category_ids, ',')) AS id FROM kept
        WHERE order_category_ids IS NOT NULL) GROUP BY 1),
pays AS (SELECT CAST(id AS BIGINT) AS category_id, count(*) AS pay_count
  FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS id FROM kept
        WHERE pay_category_ids IS NOT NULL) GROUP BY 1),
cats AS (SELECT category_id FROM clicks UNION SELECT category_id FROM orders_
         UNION SELECT category_id FROM pays),
counts AS (
  SELECT category_id, coalesce(click_count, 0) AS click_count,
         coalesce(order_count, 0) AS order_count, coalesce(pay_count, 0) AS pay_count
  FROM cats LEFT JOIN clicks USING (category_id) LEFT JOIN orders_ USING (category_id)
       LEFT JOIN pays USING (category_id)),
top10 AS (SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

SAMPLE = BASE_ALL + """,
hours AS (SELECT substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
            count(*) AS session_count FROM info GROUP BY 1, 2),
dayz AS (SELECT date, CAST(sum(session_count) AS BIGINT) AS day_count FROM hours GROUP BY 1),
quota AS (
  SELECT h.date, h.hour, h.session_count, d.day_count, n.n_days,
         least(CAST(floor(h.session_count / CAST(d.day_count AS DOUBLE) * (600 // n.n_days))
                    AS BIGINT), h.session_count) AS quota
  FROM hours h JOIN dayz d USING (date), (SELECT count(*) AS n_days FROM dayz) n),
drawn AS (
  SELECT i.session_id FROM (
    SELECT session_id, substr(start_time, 1, 10) AS date, substr(start_time, 12, 2) AS hour,
           row_number() OVER (PARTITION BY substr(start_time, 1, 13)
                              ORDER BY md5('0' || session_id), session_id) AS pick
    FROM info) i JOIN quota q USING (date, hour) WHERE i.pick <= q.quota)"""

FUNNEL = ACTIONS + """,
moves AS (
  SELECT session_id, page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS to_page
  FROM actions),
pairs AS (SELECT from_page, to_page, count(*) AS n FROM moves
          WHERE to_page IS NOT NULL GROUP BY 1, 2),
steps AS (SELECT CAST(i AS INTEGER) AS step, CAST(i AS BIGINT) AS from_page,
                 CAST(i + 1 AS BIGINT) AS to_page FROM range(1, 7) r(i)),
step_counts AS (SELECT step, from_page, to_page, coalesce(n, 0) AS pair_count
                FROM steps LEFT JOIN pairs USING (from_page, to_page)),
rates AS (
  SELECT step, from_page || '_' || to_page AS page_pair, pair_count,
         pair_count / CAST(nullif(coalesce(
           lag(pair_count) OVER (ORDER BY step),
           (SELECT count(*) FROM actions WHERE page_id = 1)), 0) AS DOUBLE) AS rate
  FROM step_counts)"""

AREAS = BASE + """,
basic AS (SELECT a.city_id, c.city_name, c.area, a.click_product_id AS product_id, a.event_id
          FROM acts a JOIN cities c USING (city_id) WHERE a.click_product_id <> -1),
area_counts AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT city_id || ':' || city_name, ','
                    ORDER BY city_id || ':' || city_name) AS city_infos
  FROM basic GROUP BY 1, 2),
area_info AS (SELECT a.area, a.city_infos, a.product_id, a.click_count, p.product_name,
                     p.product_status
              FROM area_counts a JOIN products p USING (product_id))"""

LEVEL = """CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A Level' WHEN area = 'ASIA' THEN 'B Level'
  WHEN area = 'EUROPE' THEN 'C Level' ELSE 'D Level' END"""

ADS = EV + """,
clk AS (
  SELECT ms AS ts_ms, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour,
         strftime(ts, '%M') AS minute, 'P' || ((event_id % 25) % 5) AS province,
         'C' || (event_id % 25) AS city, user_id AS userid, k % 20 AS adid,
         ts, event_type, es
  FROM ev),
user_day AS (SELECT date, userid, adid, count(*) AS click_count FROM clk GROUP BY 1, 2, 3),
blacklist AS (SELECT DISTINCT userid FROM user_day WHERE click_count >= 3),
stats AS (SELECT date, province, city, adid, count(*) AS click_count FROM clk
          GROUP BY 1, 2, 3, 4),
prov AS (SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
         FROM stats GROUP BY 1, 2, 3),
prov_top AS (SELECT date, province, adid, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province
                               ORDER BY click_count DESC, adid) AS rn FROM prov)
  WHERE rn <= 3),
trend AS (SELECT date, hour, minute, adid, count(*) AS click_count FROM clk
          GROUP BY 1, 2, 3, 4),
slid AS (SELECT *, least((CAST(date AS INTEGER) - 20240101) // 5, 5) AS slice FROM clk),
caught AS (SELECT userid, min(slice) AS first_slice FROM (
             SELECT userid, slice, count(*) AS n FROM slid GROUP BY userid, slice, date, adid)
           WHERE n >= 3 GROUP BY 1),
passed AS (SELECT s.* FROM slid s LEFT JOIN caught c USING (userid)
           WHERE c.userid IS NULL OR s.slice <= c.first_slice)"""


def _half(clause: str) -> str:
    return f"(SELECT * FROM clk WHERE hour {clause} '12')"


def _top_of(source: str) -> str:
    return f"""SELECT date, province, adid, click_count FROM (
      SELECT *, row_number() OVER (PARTITION BY date, province
                                   ORDER BY click_count DESC, adid) AS rn
      FROM (SELECT date, province, adid, count(*) AS click_count FROM {source}
            GROUP BY 1, 2, 3)) WHERE rn <= 3"""


def _buckets(kind: str) -> str:
    names = {
        "visit": ["1s_3s 1 3", "4s_6s 4 6", "7s_9s 7 9", "10s_30s 10 30", "30s_60s 31 60",
                  "1m_3m 61 180", "3m_10m 181 600", "10m_30m 601 1800", "30m 1801 99999999"],
        "step": ["1_3 1 3", "4_6 4 6", "7_9 7 9", "10_30 10 30", "30_60 31 60",
                 "60 61 99999999"],
    }[kind]
    parts = [n.split() for n in names]
    return ",\n".join(f"count(*) FILTER ({kind}_length BETWEEN {lo} AND {hi}) "
                      f"AS {kind}_length_{n}" for n, lo, hi in parts)


def _half_up(expression: str, places: int) -> str:
    return (f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(30,18)), {places}) "
            f"AS DOUBLE)")


def _ratios() -> str:
    out = []
    for kind in ("visit", "step"):
        for line in _buckets(kind).split(",\n"):
            counter, name = line.rsplit(" AS ", 1)
            share = f"({counter} / CAST(greatest(count(*), 1) AS DOUBLE))"
            out.append(f"{_half_up(share, 2)} AS {name}_ratio")
    return ",\n".join(out)


OUT = ("session_id, user_id, start_time, visit_length, step_length, "
       "nullif(search_keywords, '') AS search_keywords, "
       "nullif(click_category_ids, '') AS click_category_ids")
WORDS = ", ".join(f"'kw{i}'" for i in range(7))
NATIONS = ", ".join(f"'NATION_{i}'" for i in range(16))

FILTERED = f"""
      SELECT {OUT}, age, professional, city, sex FROM info
      WHERE age BETWEEN 20 AND 50 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
        AND city IN ({NATIONS}) AND sex = 'male'
        AND session_id IN (SELECT session_id FROM acts WHERE search_keyword IN ({WORDS}))
        AND session_id IN (SELECT session_id FROM acts
                           WHERE click_category_id BETWEEN 0 AND 59)"""

_SQL: dict[str, tuple[str, str]] = {
    # scans
    "action_scan_date_range": (ACTIONS, f"""
      SELECT date, user_id, session_id, page_id, action_time, search_keyword,
             click_category_id, click_product_id, order_category_ids, order_product_ids,
             pay_category_ids, pay_product_ids, city_id, event_id FROM actions WHERE {RANGE}"""),
    "product_click_scan": (ACTIONS, f"""
      SELECT city_id, click_product_id FROM actions WHERE {RANGE} AND click_product_id <> -1"""),
    "city_area_dim": (DIMS, "SELECT * FROM cities"),
    # filters
    "filter_age_between": (BASE, """
      SELECT session_id, user_id, age FROM info WHERE age >= 20 AND age <= 50"""),
    "filter_professional_in": (BASE, """
      SELECT session_id, user_id, professional FROM info
      WHERE professional = 'BUILDING' OR professional = 'MACHINERY'"""),
    "filter_city_in": (BASE, """
      SELECT session_id, user_id, city FROM info WHERE city IN ('NATION_3', 'NATION_7')"""),
    "filter_sex_equal": (BASE, "SELECT session_id, user_id, sex FROM info WHERE sex = 'male'"),
    "filter_keyword_overlap": (BASE, """
      SELECT session_id, user_id, search_keywords FROM info
      WHERE list_has_any(string_split(search_keywords, ','), ['kw1', 'kw5'])"""),
    "filter_category_overlap": (BASE, """
      SELECT session_id, user_id, click_category_ids FROM info
      WHERE list_has_any(string_split(click_category_ids, ','), ['10', '20', '30'])"""),
    "session_filter_all": (BASE, FILTERED),
    "session_filter_task_json": (BASE, FILTERED),
    # sessions
    "session_rollup": (BASE, f"SELECT {OUT} FROM sess"),
    "session_store_rollup": (BASE, f"SELECT {OUT} FROM sess"),
    "session_store_actions": (KEPT, """
      SELECT event_id, session_id, user_id, page_id, action_time, search_keyword,
             click_category_id, click_product_id, order_category_ids, pay_category_ids,
             city_id FROM kept"""),
    "session_full_info": (BASE, f"SELECT {OUT}, age, professional, city, sex FROM info"),
    "filtered_session_actions": (KEPT, """
      SELECT event_id, session_id, user_id, page_id, action_time, search_keyword,
             click_category_id, click_product_id, order_category_ids, pay_category_ids,
             city_id FROM kept"""),
    "visit_length_histogram": (KEPT, f"SELECT {_buckets('visit')} FROM good"),
    "step_length_histogram": (KEPT, f"SELECT {_buckets('step')} FROM good"),
    "session_stat_ratio": (KEPT, f"SELECT count(*) AS session_count, {_ratios()} FROM good"),
    # categories
    "category_click_count": (CATS, "SELECT * FROM clicks"),
    "category_order_count": (CATS, "SELECT * FROM orders_"),
    "category_pay_count": (CATS, "SELECT * FROM pays"),
    "category_universe": (CATS, "SELECT * FROM cats"),
    "category_full_counts": (CATS, "SELECT * FROM counts"),
    "top10_category": (CATS, "SELECT * FROM top10"),
    "top10_category_actions": (CATS, """
      SELECT event_id, session_id, click_category_id FROM kept
      WHERE click_category_id IN (SELECT category_id FROM top10)"""),
    "category_session_clicks": (CATS, """
      SELECT click_category_id AS category_id, session_id, count(*) AS click_count
      FROM kept WHERE click_category_id <> -1 GROUP BY 1, 2"""),
    "top10_session_per_category": (CATS, """
      SELECT category_id, session_id, click_count FROM (
        SELECT *, row_number() OVER (PARTITION BY category_id
                                     ORDER BY click_count DESC, session_id) AS rn
        FROM (SELECT click_category_id AS category_id, session_id, count(*) AS click_count
              FROM kept WHERE click_category_id IN (SELECT category_id FROM top10)
              GROUP BY 1, 2)) WHERE rn <= 10"""),
    # sampling
    "session_hour_counts": (SAMPLE, "SELECT * FROM hours"),
    "session_sample_quota": (SAMPLE, "SELECT * FROM quota"),
    "session_random_extract": (SAMPLE, """
      SELECT session_id, start_time, nullif(search_keywords, '') AS search_keywords,
             nullif(click_category_ids, '') AS click_category_ids
      FROM info JOIN drawn USING (session_id)"""),
    "session_detail_extract": (SAMPLE, """
      SELECT user_id, session_id, page_id, action_time, search_keyword, click_category_id,
             click_product_id, order_category_ids, order_product_ids, pay_category_ids,
             pay_product_ids FROM acts JOIN drawn USING (session_id)"""),
    # funnel
    "page_flow_steps": (FUNNEL, """
      SELECT step, from_page || '_' || to_page AS page_pair,
             (SELECT count(*) FROM actions WHERE page_id = from_page) AS from_visits,
             (SELECT count(*) FROM actions WHERE page_id = to_page) AS to_visits
      FROM steps"""),
    "page_transitions": (FUNNEL, "SELECT * FROM moves WHERE to_page IS NOT NULL"),
    "page_pair_counts": (FUNNEL, "SELECT * FROM step_counts"),
    "page_start_count": (FUNNEL, """
      SELECT count(*) AS start_count FROM actions WHERE page_id = 1"""),
    "page_convert_rate": (FUNNEL, f"""
      SELECT step, page_pair, pair_count, {_half_up('rate', 6)} AS rate FROM rates"""),
    "page_convert_rate_string": (FUNNEL, """
      SELECT string_agg(page_pair || '=' || coalesce(CAST(CAST(CAST(CAST(rate AS VARCHAR)
        AS DECIMAL(30,18)) AS DECIMAL(20,6)) AS VARCHAR), 'NULL'), '|' ORDER BY step)
        AS convert_rate FROM rates"""),
    # areas
    "area_product_basic": (AREAS, "SELECT city_id, city_name, area, product_id FROM basic"),
    "area_basic_ordered": (AREAS, "SELECT * FROM basic ORDER BY city_id DESC"),
    "area_product_click_count": (AREAS, "SELECT * FROM area_counts"),
    "group_concat_distinct": (AREAS, """
      SELECT product_id, string_agg(DISTINCT city_id || ':' || city_name, ','
                                    ORDER BY city_id || ':' || city_name) AS city_infos
      FROM basic GROUP BY 1"""),
    "product_status_flag": (DIMS, "SELECT product_id, status, product_status FROM products"),
    "area_product_info": (AREAS, "SELECT * FROM area_info"),
    "area_level_case": (DIMS, f"SELECT city_id, area, {LEVEL} AS area_level FROM cities"),
    "area_top3_product": (AREAS, f"""
      SELECT area, {LEVEL} AS area_level, product_id, city_infos, click_count, product_name,
             product_status
      FROM (SELECT *, row_number() OVER (PARTITION BY area
                                         ORDER BY click_count DESC, product_id) AS rn
            FROM area_info) WHERE rn <= 3"""),
    # ads, batch
    "ad_record_parse": (ADS, """
      SELECT ts_ms, date, strftime(ts, '%Y%m%d%H%M') AS minute, province, city, userid, adid
      FROM clk"""),
    "ad_user_day_count": (ADS, "SELECT * FROM user_day"),
    "ad_user_day_lookup": (ADS, """
      SELECT date, userid, adid, count(*) FILTER (hour >= '12') AS click_count,
             count(*) FILTER (hour < '12') AS stored_count
      FROM clk GROUP BY 1, 2, 3 HAVING count(*) FILTER (hour >= '12') > 0"""),
    "ad_blacklist_users": (ADS, "SELECT * FROM blacklist"),
    "ad_blacklist_filter": (ADS, """
      SELECT ts_ms, province, city, userid, adid FROM clk
      WHERE userid NOT IN (SELECT userid FROM blacklist)"""),
    "ad_stat_daily": (ADS, "SELECT * FROM stats"),
    "ad_province_count": (ADS, "SELECT * FROM prov"),
    "ad_province_top3": (ADS, "SELECT * FROM prov_top"),
    "ad_click_trend_minute": (ADS, "SELECT * FROM trend"),
    # ads, streams
    "ad_stream_ingest": (ADS, "SELECT ts_ms, date, province, city, userid, adid FROM clk"),
    "ad_stat_running": (ADS, "SELECT * FROM stats"),
    "ad_province_top3_stream": (ADS, "SELECT * FROM prov_top"),
    "ad_click_trend_stream": (ADS, "SELECT * FROM trend"),
    "ad_click_sliding_60m": (ADS, """
      SELECT strftime(make_timestamp(w * 60000000), '%Y-%m-%d %H:%M:%S')
               AS window_start,
             strftime(make_timestamp((w + 60) * 60000000), '%Y-%m-%d %H:%M:%S')
               AS window_end,
             adid, count(*) AS click_count
      FROM (SELECT adid, unnest(range(es // 60 - 59, es // 60 + 1)) AS w FROM clk)
      GROUP BY 1, 2, 3"""),
    "ad_click_sliding_3h": (ADS, """
      SELECT strftime(make_timestamp(w * 900000000), '%Y-%m-%d %H:%M:%S') AS window_start,
             strftime(make_timestamp((w + 12) * 900000000), '%Y-%m-%d %H:%M:%S')
               AS window_end,
             adid, count(*) AS click_count
      FROM (SELECT adid, unnest(range(es // 900 - 11, es // 900 + 1)) AS w FROM clk)
      GROUP BY 1, 2, 3"""),
    "ad_click_late_ledger": (ADS, """
      SELECT ts_ms, date, province, city, userid, adid
      FROM (SELECT *, slice + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS arrival
            FROM slid) c
      JOIN (
        SELECT arrival, max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING) - INTERVAL 24 HOUR AS watermark
        FROM (SELECT slice + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS arrival,
                     max(ts) AS newest FROM slid GROUP BY 1)) w USING (arrival)
      WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= watermark"""),
    "ad_click_trend_late": (ADS, """
      SELECT date, hour, minute, adid, count(*) AS click_count
      FROM (SELECT *, slice + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS arrival
            FROM slid) c
      LEFT JOIN (
        SELECT arrival, max(newest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING) - INTERVAL 24 HOUR AS watermark
        FROM (SELECT slice + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS arrival,
                     max(ts) AS newest FROM slid GROUP BY 1)) w USING (arrival)
      WHERE watermark IS NULL OR date_trunc('minute', ts) + INTERVAL 1 MINUTE > watermark
      GROUP BY 1, 2, 3, 4"""),
    "ad_stream_blacklist_replay": (ADS, """
      SELECT date, userid, adid, count(*) AS click_count FROM passed GROUP BY 1, 2, 3"""),
    "ad_stream_restart": (ADS, """
      SELECT date, province, city, adid, count(*) AS click_count FROM passed
      GROUP BY 1, 2, 3, 4"""),
    "ad_stream_late_days": (ADS, "SELECT * FROM stats"),
    "ad_click_trend_last_hour": (ADS, """
      SELECT * FROM trend WHERE strptime(date || hour || minute, '%Y%m%d%H%M') >
        (SELECT max(strptime(date || hour || minute, '%Y%m%d%H%M')) FROM trend)
        - INTERVAL 60 MINUTE"""),
    # sinks and merges
    "table_overwrite_round_trip": (ACTIONS, f"""
      SELECT date, event_id, user_id, session_id, page_id, action_time, search_keyword,
             click_category_id, order_category_ids, pay_category_ids, city_id
      FROM actions WHERE {RANGE}"""),
    "merge_insert_new": (ADS, """
      SELECT date, userid, adid,
             coalesce(nullif(count(*) FILTER (hour < '12'), 0), count(*)) AS click_count
      FROM clk GROUP BY 1, 2, 3"""),
    "merge_add_counts": (ADS, "SELECT * FROM user_day"),
    "merge_overwrite_counts": (ADS, f"""
      SELECT coalesce(n.date, o.date) AS date, coalesce(n.province, o.province) AS province,
             coalesce(n.city, o.city) AS city, coalesce(n.adid, o.adid) AS adid,
             coalesce(n.c, o.c) AS click_count
      FROM (SELECT date, province, city, adid, count(*) AS c FROM {_half('<')}
            GROUP BY 1, 2, 3, 4) o
      FULL JOIN (SELECT date, province, city, adid, count(*) AS c FROM {_half('>=')}
                 GROUP BY 1, 2, 3, 4) n
        ON o.date = n.date AND o.province = n.province AND o.city = n.city
           AND o.adid = n.adid"""),
    "merge_replace_group": (ADS, f"""
      SELECT * FROM ({_top_of(_half('>='))})
      UNION ALL
      SELECT * FROM ({_top_of(_half('<'))}) WHERE (date, province) NOT IN (
        SELECT (date, province) FROM {_half('>=')})"""),
    # scalar functions
    "fn_dates": (ACTIONS, """
      SELECT event_id, date AS day, action_time AS time, strftime(ts, '%Y%m%d') AS date_key,
             strftime(ts, '%Y%m%d%H%M') AS minute_key, date || '_' || strftime(ts, '%H')
               AS date_hour,
             CAST(hour(ts) < 12 AS INTEGER) AS before_noon,
             CAST(action_time > date || ' 12:00:00' AS INTEGER) AS after_noon,
             CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS day_seconds,
             date AS parsed_day FROM actions"""),
    "fn_round_half_up": ("", f"""
      SELECT event_id, {_half_up('value', 1)} AS one_place,
             {_half_up('value / 7', 2)} AS two_places FROM events"""),
    "fn_strings": ("", """
      SELECT p_partkey, replace(p_name, ' ', ',') AS both, replace(p_name, ' ', ',') AS right,
             replace(p_name, ' ', ',') AS unchanged,
             lpad(CAST(p_size AS VARCHAR), 2, '0') AS two_digits,
             CAST(p_size <= 25 AS INTEGER) AS is_empty,
             CAST(p_size > 25 AS INTEGER) AS is_not_empty FROM part"""),
    "fn_record_field": ("", """
      SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS userid, c_mktsegment AS professional,
             CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS absent,
             'userid=' || c_custkey || '|keywords=|professional=' || lower(c_mktsegment)
               || '|name=' || c_name AS changed FROM customer"""),
}


def oracle_sql() -> dict[str, str]:
    return {name: (f"WITH {clauses}\n{body}" if clauses else body)
            for name, (clauses, body) in _SQL.items()}
