"""Declarative streaming aggregates: state in the state store, results upserted.

Without a delay every click counts, however late, and the state keeps every key.  With
one, a day or minute leaves the state once the watermark has passed it, and later clicks
are dropped.  In update mode each batch hands over the new total of every touched key; the
total replaces the stored one, which makes a repeated batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.functions import dates
from clickloom.operators import ads
from clickloom.session import off_heap_state
from clickloom.sources import ad_log
from clickloom.streaming import delta_log as dl

MINUTES = "minute_ts timestamp, adid bigint, click_count bigint"


def _clicks(lines: DataFrame, delay: str | None) -> DataFrame:
    clicks = ad_log.good(ad_log.parse(lines))
    return clicks.withWatermark("ts", delay) if delay else clicks


def stat_totals(lines: DataFrame, delay: str | None = None) -> DataFrame:
    """Running clicks per day, province, city and ad."""
    counts = (_clicks(lines, delay)
              .groupBy(F.window("ts", "1 day").alias("w"), "province", "city", "adid")
              .agg(ads.clicks_total()))
    return counts.select(dates.date_key(F.col("w.start")).alias("date"), "province", "city",
                         "adid", "click_count")


def minute_totals(lines: DataFrame, delay: str | None = None) -> DataFrame:
    """Running clicks per minute and ad; ``minute_ts`` is the start of the minute."""
    counts = (_clicks(lines, delay).groupBy(F.window("ts", "1 minute").alias("w"), "adid")
              .agg(ads.clicks_total()))
    return counts.select(F.col("w.start").alias("minute_ts"), "adid", "click_count")


def late_rows(query: StreamingQuery) -> int:
    """Rows the watermark dropped, over the progress reports the query keeps.  Clicks of
    one key and task are one row here, since they are counted before the watermark is
    applied."""
    return sum(operator["numRowsDroppedByWatermark"]
               for progress in query.recentProgress
               for operator in progress["stateOperators"])


def stat_log(spark, root: str) -> dl.DeltaLog:
    return dl.DeltaLog(spark, f"{root}/stat", schemas.AD_STAT, tuple(ads.STAT), dl.LATEST)


def minute_log(spark, root: str) -> dl.DeltaLog:
    return dl.DeltaLog(spark, f"{root}/minutes",
                       MINUTES, ("minute_ts", "adid"), dl.LATEST)


def top_log(spark, root: str) -> dl.DeltaLog:
    return dl.DeltaLog(spark, f"{root}/province_top", schemas.AD_PROVINCE_TOP,
                       ("date", "province"), dl.REPLACE)


def _run(totals: DataFrame, each_batch, root: str, every: str | None,
         mode: str = "update") -> StreamingQuery:
    off_heap_state(totals.sparkSession)
    writer = (totals.writeStream.outputMode(mode).foreachBatch(each_batch)
              .option("checkpointLocation", f"{root}/checkpoint"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def upsert(totals: DataFrame, log: dl.DeltaLog, root: str,
           every: str | None = None) -> StreamingQuery:
    """Stream new totals into ``log``."""
    def each_batch(rows: DataFrame, batch_id: int) -> None:
        log.write(rows, batch_id)
        log.compact(batch_id)

    return _run(totals, each_batch, root, every)


def upsert_with_top(totals: DataFrame, root: str, k: int = 3,
                    every: str | None = None) -> StreamingQuery:
    """Stream new totals and rank again every (date, province) the batch touched.

    Ranking is not allowed on a stream, so it runs inside the batch, over the old top
    list and the new totals of the touched ads, and its rows replace those of the same
    day and province.  ``k`` must stay the same as long as ``root`` is used.
    """
    spark = totals.sparkSession
    stats, tops = stat_log(spark, root), top_log(spark, root)

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        stats.write(rows, batch_id)
        touched = stats.batch(batch_id).select("date", "province", "adid").distinct()
        grown = ads.province_count(stats.current(batch_id, only=touched))
        old = tops.current(batch_id - 1, only=touched.select("date", "province").distinct())
        tops.write(ads.next_top(old, grown, k), batch_id)
        stats.compact(batch_id)
        tops.compact(batch_id)

    return _run(totals, each_batch, root, every)


def late_log(spark, root: str) -> dl.DeltaLog:
    return dl.DeltaLog(spark, f"{root}/late", schemas.AD_CLICK, (), dl.ADD)


def ledger_counts(spark, root: str) -> dl.DeltaLog:
    """Minute counts of the clicks that came in time."""
    return dl.DeltaLog(spark, f"{root}/minutes", MINUTES, ("minute_ts", "adid"), dl.ADD)


def upsert_with_ledger(lines: DataFrame, root: str, delay: str,
                       every: str | None = None) -> StreamingQuery:
    """Minute counts under a watermark, with a ledger of every click that came too late.

    The watermark of a batch is the newest click of all batches before it less ``delay``;
    a click is late if its minute ended by then.  Clicks are compared one by one before
    anything is counted, so the ledger holds them as they came, and kept and late ones
    together are all good clicks.  A batch depends only on what earlier ones wrote, so a
    repeat leaves the same rows.
    """
    spark = lines.sparkSession
    counts = ledger_counts(spark, root)
    newest = dl.DeltaLog(spark, f"{root}/newest", "ts timestamp", ("ts",), dl.DISTINCT)
    late = late_log(spark, root)

    def each_batch(rows: DataFrame, batch_id: int) -> None:
        # One row: the watermark, null before the first batch.
        mark = (newest.current(batch_id - 1)
                .agg((F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"])
        clicks = ad_log.good(ad_log.parse(rows))
        over = F.date_trunc("minute", "ts") + F.expr("INTERVAL 1 MINUTE")
        passed = F.lit(False) if mark is None else over <= F.lit(mark)
        late.write(clicks.where(passed).select(*late.columns), batch_id)
        counts.write(ads.minute_counts(clicks.where(~passed)), batch_id)
        newest.write(clicks.agg(F.max("ts").alias("ts")).where(F.col("ts").isNotNull()), batch_id)
        counts.compact(batch_id)
        newest.compact(batch_id)

    return _run(lines, each_batch, root, every, "append")


def ingest(lines: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """Append parsed clicks to ``root/clicks`` through the exactly-once file sink."""
    writer = (ad_log.good(ad_log.parse(lines)).writeStream.format("parquet")
              .option("path", f"{root}/clicks")
              .option("checkpointLocation", f"{root}/checkpoint"))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
