"""Intermediate tables on shared storage, and helpers to run a function over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.workdir import fresh_dir


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` to the shared scratch folder and read them back.

    A lost executor then costs one task of the reader, never the work before.
    """
    path = fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    found = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found.stored_at = path
    return found


def removed(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for rows in tables:
        path = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(rows.stored_at)
        path.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Tables stored meanwhile hand over at most ``rows`` rows at once to Python, or fewer if so set."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_of(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_remainder(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          *more: Column) -> DataFrame:
    """doc_id and text (never null) of every row, and what else is asked for."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       text_of(text_col).alias("text"), *more)


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows a few at a time, as Python copies of a whole batch of texts are large."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(rows: DataFrame, prepare: Callable[[], Callable[[list[str]], dict[str, list]]],
              added: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns of ``rows`` named in ``carry``, plus those that a function makes of each text.

    ``prepare`` runs once per task and returns the function; it gets a batch of texts and
    returns a list per column of the DDL ``added``.  Carried columns cross untouched, so
    ids keep their type and their nulls.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = to_arrow_schema(StructType.fromDDL(added))
    out = StructType([rows.schema[c] for c in carry] + StructType.fromDDL(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in in_parts(batches):
            made = function(batch.column("text").to_pylist())
            arrays = [batch.column(c) for c in carry]
            arrays += [pa.array(made[f.name], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays(arrays, [*carry, *kinds.names])

    return rows.select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, out)
