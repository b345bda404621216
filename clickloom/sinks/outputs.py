"""Result sinks.  A sink is a function ``(df, table) -> None`` chosen by the caller."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Sink = Callable[[DataFrame, str], None]


def new_task_id() -> str:
    return uuid.uuid4().hex


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    return df.select(F.lit(task_id).alias("taskid"), *df.columns)


def parquet_sink(root: str, mode: str = "append") -> Sink:
    """Append to (or overwrite) ``root/<table>``."""
    def write(df: DataFrame, table: str) -> None:
        df.write.mode(mode).parquet(f"{root}/{table}")

    return write


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 1000) -> dict[str, str]:
    """Connection options; credentials come from the caller and are never stored."""
    given = {"url": url, "user": user, "password": password, "driver": driver,
             "batchsize": str(batch_size)}
    return {key: value for key, value in given.items() if value is not None}


def jdbc_sink(options: dict[str, str], mode: str = "append",
              max_connections: int = 10) -> Sink:
    """Append to (or, for merged tables, refill) a table over JDBC.

    ``max_connections`` bounds the number of writing tasks, ``batchsize`` the rows per
    statement batch; an error fails the job.
    """
    def write(df: DataFrame, table: str) -> None:
        (df.write.format("jdbc").options(**options).option("dbtable", table)
         .option("numPartitions", max_connections).option("truncate", True)
         .mode(mode).save())

    return write


def read_jdbc(spark: SparkSession, options: dict[str, str], query: str) -> DataFrame:
    """A pushed-down query as a DataFrame, in place of per-row lookups."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def overwrite_table(df: DataFrame, name: str, path: str | None = None,
                    partition_by: tuple[str, ...] = (),
                    bucket_by: tuple[int, str] | None = None,
                    sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Replace the catalog's ``name`` by ``df``, then read it back.

    ``name`` is a view on the newest of a row of version tables, each with a folder of its
    own below ``path`` (by default one in the warehouse).  The rows are written first and
    the view is then turned to them in one catalog step, so ``df`` may read ``name``, a
    failed write leaves it as it was, and there is no time without it.  The version before
    is dropped with its folder; frames still reading that one must be made anew.  A table
    of that name made by other means is not replaced.

    An action table partitioned by date lets every date range prune whole folders;
    ``bucket_by`` (number, column) and ``sort_by`` store it dealt and sorted.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    fresh = f"{name}_{version}"
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}"
    writer = df.write.mode("errorifexists").option("path", f"{root}/{version}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    old = _version_of(spark, name)
    try:
        writer.saveAsTable(fresh)
    except Exception:
        _remove(spark, None, f"{root}/{version}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{fresh}', "
              f"'{FOLDER}' = '{root}/{version}') AS SELECT * FROM {fresh}")
    if old:
        _remove(spark, *old)
    return spark.table(name)


VERSION, FOLDER = "clickloom.version", "clickloom.folder"


def _version_of(spark: SparkSession, name: str) -> tuple[str, str] | None:
    """Table and folder that the view ``name`` stands for."""
    if not spark.catalog.tableExists(name):
        return None
    said = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if VERSION not in said:
        raise ValueError(f"{name} is a table that this function did not make")
    return said[VERSION], said[FOLDER]


def _remove(spark: SparkSession, table: str | None, folder: str) -> None:
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path.getFileSystem(conf).delete(path, True)
