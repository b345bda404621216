"""The four programs end to end: inputs and task parameters in, result tables out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators import areas, categories, filters, funnel, sampling
from clickloom.operators import sessions as S
from clickloom.params import TaskParams
from clickloom.sinks.outputs import Sink, new_task_id, with_task_id
from clickloom.sources import dimensions, tables
from clickloom.streaming.ad_stream import AdStream


def session_analysis(actions: DataFrame, users: DataFrame, params: TaskParams, sink: Sink,
                     task_id: str | None = None, *, clock: str = "action_ts",
                     sample_size: int = 100, seed: str | None = None,
                     filtered_sample: bool = False) -> str:
    """Length distribution, random sample with its details, top categories and their top
    sessions.

    The log is read three times: for the sessions, for the actions of the sample, and for
    the category counts per session that both top lists come from.  What is kept of each
    is slim and goes to memory or disk; a lost piece is computed again.
    """
    task = task_id or new_task_id()
    seed = task if seed is None else seed
    kept_tables: list[DataFrame] = []

    def held(df: DataFrame) -> DataFrame:
        kept_tables.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    known = held(S.full_info(S.rollup(actions, clock=clock, params=params), users).drop(
        "search_keywords", "click_category_ids"))
    kept = filters.keep(known, F.col("keyword_hit"), F.col("category_hit"),
                        *filters.profile_conditions(params))

    def store(df: DataFrame, table: str) -> None:
        sink(with_task_id(df, task), table)

    try:
        store(S.stat_ratio(kept), "session_stat")

        pool = kept if filtered_sample else known
        drawn = sampling.draw(pool, sample_size, seed)
        sampled = held(sampling.of_sample(actions, drawn, sample_size)
                       .select(*sampling.DETAIL, "action_ts"))
        store(sampling.summaries(sampled).select(
            F.col("session_id").alias("sessionid"), F.col("start_time").alias("startTime"),
            F.col("search_keywords").alias("searchKeywords"),
            F.col("click_category_ids").alias("clickCategoryIds")), "session_random_extract")
        store(sampled.select(*sampling.DETAIL).toDF(
            "userid", "sessionid", "pageid", "actionTime", "searchKeyword",
            "clickCategoryId", "clickProductId", "orderCategoryIds", "orderProductIds",
            "payCategoryIds", "payProductIds"), "session_detail")

        counts = held(S.actions_of(categories.touch_counts(actions), kept))
        top = held(categories.top_categories(categories.totals(counts)))
        store(top.toDF("categoryid", "clickCount", "orderCount", "payCount"),
              "top10_category")
        store(categories.top_sessions(categories.session_clicks_on(counts, top))
              .toDF("categoryid", "sessionid", "clickCount"), "top10_session")
    finally:
        for df in kept_tables:
            df.unpersist()
    return task


def page_conversion(actions: DataFrame, params: TaskParams, sink: Sink,
                    task_id: str | None = None) -> str:
    task = task_id or new_task_id()
    rates = funnel.rate_string(funnel.convert_rates(actions, params.page_flow))
    sink(with_task_id(rates.toDF("convertRate"), task), "page_split_convert_rate")
    return task


def area_top(actions: DataFrame, cities: DataFrame, products: DataFrame, sink: Sink,
             levels: Mapping[str, str] = dimensions.AREA_LEVELS, k: int = 3,
             task_id: str | None = None) -> str:
    task = task_id or new_task_id()
    counts = areas.product_click_count(tables.product_clicks(actions), cities)
    top = areas.top_products(areas.with_product(counts, products), levels, k)
    sink(with_task_id(top.toDF("area", "areaLevel", "productid", "cityInfos", "clickCount",
                               "productName", "productStatus"), task), "area_top3_product")
    return task


def ad_stream(lines: DataFrame, root: str, *, threshold: int = 100,
              every: str | None = "5 seconds", open_days: int | None = None) -> StreamingQuery:
    """Start the real-time ad program; its tables are read through ``AdStream``."""
    return AdStream(lines.sparkSession, root, threshold, open_days=open_days).start(lines, every)
