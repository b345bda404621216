"""The real-time ad program: blacklist with feedback, running totals, top ads, trend.

Batch N is filtered by the blacklist that batches before N wrote, and then extends it.
A stream-static join would list the blacklist once and go stale, so the batch body
reads it anew and does its steps in a fixed order.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.functions import dates
from clickloom.operators import ads
from clickloom.sinks.outputs import Sink
from clickloom.sources import ad_log
from clickloom.streaming import delta_log as dl


class AdStream:
    """All state lives under ``root``, which must be shared by the executors.

    ``open_days``: a day this many days older than the newest one seen is closed.  Its
    late clicks go to the rejects, and compaction moves its rows to an archive, which
    bounds the working set; None keeps every day open.  ``top`` must stay the same as
    long as ``root`` is used, since a top list is made from the one before.
    """

    def __init__(self, spark: SparkSession, root: str, threshold: int = 100, top: int = 3,
                 compact_every: int = 20, open_days: int | None = None):
        self.spark, self.root = spark, root
        self.threshold, self.top, self.open_days = threshold, top, open_days

        def log(name, schema, keys, mode):
            return dl.DeltaLog(spark, f"{root}/{name}", schema, tuple(keys), mode,
                               compact_every=compact_every)

        self.blacklist_log = log("blacklist", schemas.AD_BLACKLIST, ["userid"], dl.DISTINCT)
        self.user_day_log = log("user_day", schemas.AD_USER_DAY, ads.USER_DAY, dl.ADD)
        self.stat_log = log("stat", schemas.AD_STAT, ads.STAT, dl.ADD)
        self.top_log = log("province_top", schemas.AD_PROVINCE_TOP, ["date", "province"],
                           dl.REPLACE)
        self.trend_log = log("trend", schemas.AD_TREND, ads.TREND, dl.ADD)
        self.day_log = log("days", "date string", ["date"], dl.DISTINCT)
        self.logs = (self.blacklist_log, self.user_day_log, self.stat_log, self.top_log,
                     self.trend_log)

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def process(self, lines: DataFrame, batch_id: int) -> None:
        """One micro-batch.  Safe to repeat with the same ``batch_id``.

        The batch is read, parsed and matched with the blacklist once.  The results
        then depend on nothing but it and their own table, so their jobs run together.
        """
        past = batch_id - 1
        parsed = self._close_days(ad_log.parse(lines), past)
        listed = self.blacklist_log.current(past).withColumn("listed", F.lit(True))
        marked = parsed.join(listed, "userid", "left").persist(StorageLevel.MEMORY_AND_DISK)
        clicks = ad_log.good(marked.where(F.col("listed").isNull()))
        try:
            self._together(
                lambda: self._extend_blacklist(clicks, batch_id),
                lambda: self._rank_provinces(clicks, batch_id),
                lambda: self.trend_log.write(ads.trend(ads.minute_counts(clicks)), batch_id),
                lambda: self._set_aside(marked, batch_id))
            if self.stat_log.due(batch_id):
                horizon = self._horizon(batch_id)
                self._together(*(partial(log.compact, batch_id, horizon)
                                 for log in self.logs))
        finally:
            marked.unpersist()

    def _extend_blacklist(self, clicks: DataFrame, batch_id: int) -> None:
        self.user_day_log.write(ads.user_day_count(clicks), batch_id)
        touched = self.user_day_log.batch(batch_id).select(*ads.USER_DAY)
        totals = self.user_day_log.current(batch_id, only=touched)
        # Nobody listed before is found again: their clicks did not pass.
        self.blacklist_log.write(ads.abusive_users(totals, self.threshold), batch_id)

    def _rank_provinces(self, clicks: DataFrame, batch_id: int) -> None:
        self.stat_log.write(ads.stat(clicks), batch_id)
        touched = self.stat_log.batch(batch_id).select("date", "province", "adid").distinct()
        grown = ads.province_count(self.stat_log.current(batch_id, only=touched))
        old = self.top_log.current(batch_id - 1,
                                   only=touched.select("date", "province").distinct())
        self.top_log.write(ads.next_top(old, grown, self.top), batch_id)

    def _set_aside(self, marked: DataFrame, batch_id: int) -> None:
        """Malformed and late records; and, if days are closed, which days were seen."""
        rejected = ad_log.rejects(marked)
        if not rejected.isEmpty():
            rejected.write.mode("overwrite").parquet(f"{self.root}/rejects/batch_id={batch_id}")
        if self.open_days is not None:
            self.day_log.write(ad_log.good(marked).select("date").distinct(), batch_id)
            self.day_log.compact(batch_id)

    def _together(self, *steps: Callable[[], None]) -> None:
        """Run independent jobs at once; the first failure fails the batch."""
        with ThreadPoolExecutor(len(steps)) as pool:
            waiting = [pool.submit(inheritable_thread_target(self.spark)(step))
                       for step in steps]
        for step in waiting:
            step.result()

    def _horizon(self, upto: int) -> str | None:
        """First open day after batch ``upto``, from the days seen until then."""
        if self.open_days is None or upto < 0:
            return None
        newest = F.to_date(F.max("date"), dates.DATE_KEY)
        first_open = F.date_format(F.date_sub(newest, self.open_days), dates.DATE_KEY)
        return self.day_log.rows(upto).agg(first_open.alias("day")).first()["day"]

    def _close_days(self, parsed: DataFrame, past: int) -> DataFrame:
        horizon = self._horizon(past)
        if horizon is None:
            return parsed
        closed = F.col("reason").isNull() & (dates.date_key(F.col("ts")) < horizon)
        return parsed.withColumn("reason",
                                 F.when(closed, "closed day").otherwise(F.col("reason")))

    def start(self, lines: DataFrame, every: str | None = "5 seconds") -> StreamingQuery:
        """Run on a stream of record text; ``every=None`` drains what is there and ends."""
        writer = (lines.writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", self.checkpoint))
        writer = (writer.trigger(processingTime=every) if every
                  else writer.trigger(availableNow=True))
        return writer.start()

    # --- results as of the newest finished batch --------------------------------------

    def upto(self) -> int:
        return dl.last_committed(self.spark, self.checkpoint)

    def blacklist(self) -> DataFrame:
        return self.blacklist_log.current(self.upto())

    def user_day(self) -> DataFrame:
        return self.user_day_log.everything(self.upto())

    def ad_stat(self) -> DataFrame:
        return self.stat_log.everything(self.upto())

    def province_top(self) -> DataFrame:
        return self.top_log.everything(self.upto())

    def click_trend(self) -> DataFrame:
        return self.trend_log.everything(self.upto())

    def last_hour(self) -> DataFrame:
        """The trend of the sixty minutes up to the newest one."""
        day = self.trend_log.newest_day(self.upto())
        if day is None:
            return self.click_trend()
        # The hour may begin on the day before.
        before = datetime.strptime(day, "%Y%m%d") - timedelta(days=1)
        trend = self.click_trend().where(F.col("date") >= before.strftime("%Y%m%d"))
        at = F.to_timestamp(F.concat("date", "hour", "minute"), dates.MINUTE_KEY)
        newest = trend.agg(F.max(at)).scalar()
        return trend.where(at > newest - F.expr("INTERVAL 60 MINUTES"))

    def export(self, sink: Sink) -> None:
        """Hand the merged result tables to an overwriting sink."""
        for name, table in (("ad_blacklist", self.blacklist()),
                            ("ad_user_click_count", self.user_day()),
                            ("ad_stat", self.ad_stat()),
                            ("ad_province_top3", self.province_top()),
                            ("ad_click_trend", self.click_trend())):
            sink(table, name)

    def rejects(self) -> DataFrame:
        found = dl.load_batches(self.spark, f"{self.root}/rejects", schemas.AD_REJECT)
        return found.where(F.col("batch_id") <= self.upto()).drop("batch_id")
