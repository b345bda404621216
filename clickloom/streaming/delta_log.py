"""Result tables kept as one folder of rows per micro-batch.

A batch overwrites its own folder, so a batch delivered twice leaves what it left the
first time, and a read up to batch N sees the same rows on every attempt.  Every
``compact_every`` batches the rows so far are resolved into a base; the batch number
alone says which base and which folders a read needs, so nothing has to be listed or
locked and at most ``compact_every`` folders are read.

Tables with a date are stored by date, so that a batch reads only the days it touches.
Folders that a later base stands for are removed one base later.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ADD, LATEST, REPLACE, DISTINCT = "add", "latest", "replace", "distinct"
# Days of one batch that a read names one by one.  A batch with more of them reads all
# days; the rows it finds are the same.
NAMED_DAYS = 400


@dataclass(frozen=True)
class DeltaLog:
    """``mode`` says how rows of several batches become the current table:

    ``add``       counts of equal keys add up
    ``latest``    the count of the newest batch wins
    ``replace``   all rows of a key come from the newest batch that has the key
    ``distinct``  set of rows
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    mode: str
    value: str = "click_count"
    compact_every: int = 20

    @property
    def columns(self) -> list[str]:
        return [column.split()[0] for column in self.schema.split(", ")]

    @property
    def dated(self) -> bool:
        """Stored by date.  A set of dates alone is not: a file needs a column."""
        return "date" in self.columns and len(self.columns) > 1

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, self._folder("delta", batch_id))

    def batch(self, batch_id: int) -> DataFrame:
        """The rows one batch wrote."""
        return self._load("delta", [batch_id]).drop("batch_id")

    def rows(self, upto: int) -> DataFrame:
        """Unresolved rows, ``batch_id`` included, of all batches up to ``upto``."""
        base = self._base_of(upto)
        found = self._load("delta", range(base + 1, upto + 1))
        return found if base < 0 else found.unionByName(self._load("base", [base]))

    def current(self, upto: int, only: DataFrame | None = None) -> DataFrame:
        """The open part of the table as of batch ``upto``; ``only`` restricts it to the
        keys it lists (by the columns it has), before anything is resolved."""
        if upto < 0:
            return self.spark.createDataFrame([], self.schema)
        rows = self.rows(upto)
        if only is not None:
            if self.dated and "date" in only.columns:
                days = only.select("date").distinct().limit(NAMED_DAYS + 1).collect()
                if len(days) <= NAMED_DAYS:
                    rows = rows.where(F.col("date").isin([day["date"] for day in days]))
            rows = rows.join(only, only.columns, "left_semi")
        return self._resolve(rows).drop("batch_id")

    def everything(self, upto: int) -> DataFrame:
        """Open and archived rows as of batch ``upto``."""
        table, base = self.current(upto), self._base_of(upto)
        if not self.dated or base < 0:
            return table
        archived = load_batches(self.spark, f"{self.path}/archive", self.schema)
        return table.unionByName(archived.where(F.col("batch_id") <= base).drop("batch_id"))

    def newest_day(self, upto: int) -> str | None:
        """Latest date with rows; read from folder names alone."""
        if upto < 0:
            return None
        return self.rows(upto).agg(F.max("date").alias("day")).first()["day"]

    def due(self, batch_id: int) -> bool:
        return (batch_id + 1) % self.compact_every == 0

    def compact(self, batch_id: int, closed_before: str | None = None) -> None:
        """Write the base, if this batch is due one.  Must run inside the batch.

        Rows dated before ``closed_before`` go to the archive of this base instead; the
        caller promises that no later batch brings rows of those days.
        """
        if not self.due(batch_id):
            return
        rows = self._resolve(self.rows(batch_id)).drop("batch_id")
        # A base may hold many days; ranges over the key keep its files balanced.
        if self.dated and closed_before is not None:
            closed = F.col("date") < closed_before
            self._write_sorted(rows.where(closed), self._folder("archive", batch_id))
            rows = rows.where(~closed)
        self._write_sorted(rows, self._folder("base", batch_id))
        self._remove_superseded(batch_id)

    def _remove_superseded(self, batch_id: int) -> None:
        """Remove what the base before this one stands for.

        That base was finished ``compact_every`` batches ago.  A repeat of this batch and
        readers of any batch since then use it, and not the folders it was made of.
        """
        last = batch_id - self.compact_every
        if last < 0:
            return
        for old in range(last - self.compact_every + 1, last + 1):
            self._remove(self._folder("delta", old))
        self._remove(self._folder("base", last - self.compact_every))

    def _remove(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        folder.getFileSystem(conf).delete(folder, True)

    def _write_sorted(self, rows: DataFrame, path: str) -> None:
        self._write(rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys), path,
                    clustered=True)

    def _write(self, rows: DataFrame, path: str, clustered: bool = False) -> None:
        if self.dated and not clustered:
            # One day's rows come together, in pieces by their size; else every task
            # leaves a file per day.
            rows = rows.hint("rebalance", "date")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy("date") if self.dated else writer).parquet(path)

    def _resolve(self, rows: DataFrame) -> DataFrame:
        if self.mode == DISTINCT:
            return rows.drop("batch_id").distinct()
        if self.mode == ADD:
            return rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))
        if self.mode == LATEST:
            newest = F.max_by(self.value, "batch_id").alias(self.value)
            return rows.groupBy(*self.keys).agg(newest)
        newest = rows.groupBy(*self.keys).agg(F.max("batch_id").alias("batch_id"))
        return rows.join(newest, [*self.keys, "batch_id"], "left_semi")

    def _load(self, kind: str, batches: Sequence[int]) -> DataFrame:
        return load_batches(self.spark, f"{self.path}/{kind}", self.schema, batches)

    def _base_of(self, upto: int) -> int:
        """Newest base a read up to ``upto`` may use.  The base of the running batch
        itself is left out, since that batch is what writes it."""
        return upto // self.compact_every * self.compact_every - 1

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/batch_id={batch_id}"


def load_batches(spark: SparkSession, path: str, schema: str,
                 batches: Sequence[int] | None = None) -> DataFrame:
    """Rows of the ``batch_id=N`` folders under ``path``, ``batch_id`` last.

    Without ``batches`` all of them; an empty table if there is no folder yet.
    """
    full = f"{schema}, batch_id bigint"
    columns = [column.split()[0] for column in full.split(", ")]
    empty = spark.createDataFrame([], full)
    if batches is None:
        try:
            return spark.read.schema(full).parquet(path).select(*columns)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty
    folders = [f"{path}/batch_id={number}" for number in batches]
    if not folders:
        return empty
    return spark.read.schema(full).option("basePath", path).parquet(*folders).select(*columns)


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """Newest micro-batch the checkpoint records as finished, -1 before the first."""
    name = F.regexp_extract(F.input_file_name(), r"/(\d+)$", 1)
    try:
        ids = spark.read.format("text").load(f"{checkpoint}/commits").select(
            name.try_cast("bigint").alias("id"))
        return ids.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
