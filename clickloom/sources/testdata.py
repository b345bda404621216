"""The given star-schema and event tables seen as the engine's inputs.

Filters are put on the stored columns (``ts``, ``event_type``), so they reach the
parquet scan; derived columns nobody asks for are pruned away with their inputs.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# First second of the event tables, start of the compressed visit clock (fixed value).
CLOCK_START = 1704067200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a file stream; the glob fits a file and a folder of files."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parquet*")


def events_between(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Inclusive day range on the stored timestamp."""
    ntz = lambda day: F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    if start:
        events = events.where(F.col("ts") >= ntz(start))
    if end:
        events = events.where(F.col("ts") < ntz(date.fromisoformat(end) + timedelta(days=1)))
    return events


# k of the event.  The text is {"k": n} throughout; a pattern is several times cheaper
# than parsing it.
K = r"""CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS BIGINT)"""

SESSION_ID = """
  CASE user_id % 3
    WHEN 0 THEN concat(user_id, '_', date_format(ts, 'yyyyMMdd'))
    WHEN 1 THEN concat(user_id, '_w', (day(ts) - 1) DIV 7)
    ELSE concat(user_id, '_m') END"""

VISIT_SEC = f"""
  {CLOCK_START} + (unix_seconds(CAST(ts AS TIMESTAMP)) - {CLOCK_START}) DIV (
    CASE user_id % 3 WHEN 0 THEN 24 WHEN 1 THEN 168 ELSE 720 END *
    CASE (user_id DIV 3) % 4 WHEN 0 THEN 1 WHEN 1 THEN 10 WHEN 2 THEN 100 ELSE 400 END)"""

ACTION_COLUMNS = (
    "date_format(ts, 'yyyy-MM-dd') AS date",
    "user_id",
    f"{SESSION_ID} AS session_id",
    "k % 10 AS page_id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k ELSE -1L END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN (k * 7) % 100 ELSE -1L END AS click_product_id",
    "CASE WHEN event_type = 'signup' THEN concat(k, ',', (k + 37) % 100) END "
    "AS order_category_ids",
    "CAST(NULL AS STRING) AS order_product_ids",
    "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_category_ids",
    "CAST(NULL AS STRING) AS pay_product_ids",
    "event_id % 25 AS city_id",
    "event_id",
    "CAST(ts AS TIMESTAMP) AS action_ts",
    f"{VISIT_SEC} AS visit_sec",
)


def actions(spark: SparkSession, sf_dir: str, start: str | None = None,
            end: str | None = None, kinds: tuple[str, ...] = ()) -> DataFrame:
    """``user_visit_action`` with ``event_id``, ``action_ts`` and ``visit_sec`` added.

    ``kinds`` names the event types a query can use at all, so that its filter on a
    derived column (a real click, say) also reaches the scan.
    """
    events = events_between(table(spark, sf_dir, "events"), start, end)
    if kinds:
        events = events.where(F.col("event_type").isin(list(kinds)))
    return events.selectExpr("*", f"{K} AS k").selectExpr(*ACTION_COLUMNS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info``, one row per customer."""
    nation = table(spark, sf_dir, "nation")
    return (table(spark, sf_dir, "customer")
            .join(nation, F.expr("c_nationkey = n_nationkey"))
            .selectExpr("c_custkey AS user_id", "concat('user', c_custkey) AS username",
                        "c_name AS name", "CAST((c_custkey * 7) % 60 AS INT) AS age",
                        "c_mktsegment AS professional", "n_name AS city",
                        "IF(c_custkey % 2 = 0, 'male', 'female') AS sex"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name",
        """concat('{"product_status": ', p_size % 2, '}') AS extend_info""")


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City to area dimension."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS city_id", "n_name AS city_name", "r_name AS area")


# Level of each area; an area not listed is a D one.
AREA_LEVELS = {"AFRICA": "A Level", "AMERICA": "A Level", "ASIA": "B Level", "EUROPE": "C Level"}


def ad_lines(events: DataFrame) -> DataFrame:
    """Ad click record text, one per event; works on a table and on a stream."""
    return events.selectExpr(f"""
      concat_ws(' ', CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING),
                concat('P', (event_id % 25) % 5), concat('C', event_id % 25),
                CAST(user_id AS STRING), CAST({K} % 20 AS STRING)) AS value""")
