"""Exact dedup over an extendible-hash index kept in shared files.

The leading bits of a text's 64-bit key are its cell of the directory.  A bucket that
holds more rows than ``capacity`` is split on the next bit (the directory doubles) until
it fits or the bits are used up.  The bucket is a label: rows are grouped by (bucket, key,
text) and shuffled by the hash of all three, so the grouping compares the texts byte by
byte, and texts whose keys collide are entries of their own.  No task owns a bucket.
Copies are combined before the shuffle: a group of any size reaches its task as one row
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.scratch import stored, text_of

WHITE = r"[\x20\x09-\x0D]+"
CAPACITY = 4096
# The directory has at most 2 ** MAX_DEPTH cells: its broadcast is bounded whatever the
# input.  Buckets at full depth stay as full as they are.
MAX_DEPTH = 16
_STEP = "100000000000000000000"   # 10 ** 20, above the span of a bigint
_TOP = "9223372036854775807"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITE, "")


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        text_of(text_col).alias("text"))
            .select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
                    normalised(F.col("text")).alias("norm"))
            .withColumn("key", F.shiftright(F.xxhash64("norm"), 64 - key_bits)))


def _preference() -> Column:
    """One number that is larger for the row to keep: more code points, then smaller id.

    A decimal is updated in place by the hash aggregate; a struct would force a sort.
    """
    rank = F.coalesce(F.expr(f"CAST({_TOP} AS DECIMAL(20,0)) - CAST(doc_id AS DECIMAL(20,0)) + 1"),
                      F.expr("CAST(0 AS DECIMAL(20,0))"))
    return (F.expr(f"CAST(n_chars AS DECIMAL(12,0)) * CAST('{_STEP}' AS DECIMAL(21,0))")
            + rank).cast("decimal(38,0)")


def depth_for(rows: int, capacity: int) -> int:
    """Depth of the finest cells: two bits more than equal buckets would need."""
    need = max(1, -(-rows // capacity))
    return min(MAX_DEPTH, (need - 1).bit_length() + 2)


def directory(entries: DataFrame, depth: int, capacity: int, key_bits: int = 64) -> DataFrame:
    """(cell, local_depth, bucket): each cell's bucket is the shortest prefix that fits.

    ``cell`` is the first ``depth`` bits of the key, ``bucket`` the first ``local_depth``
    bits, with the depth in front so that prefixes of different length differ.
    """
    cells = entries.groupBy(_cell(depth, key_bits).alias("cell")).agg(F.count("*").alias("rows"))
    prefixes = cells.select("cell", "rows", F.explode(F.sequence(F.lit(0), F.lit(depth)))
                            .alias("local_depth"))
    prefix = F.expr(f"shiftright(cell, {depth} - local_depth)")
    size = F.sum("rows").over(W.partitionBy("local_depth", "prefix"))
    fits = (prefixes.withColumn("prefix", prefix).withColumn("size", size)
            .where((F.col("size") <= capacity) | (F.col("local_depth") == depth)))
    return (fits.groupBy("cell").agg(F.min("local_depth").alias("local_depth"))
            .withColumn("bucket", F.expr(
                f"shiftleft(local_depth, {MAX_DEPTH + 2}) + shiftright(cell, {depth} - local_depth)")))


def _cell(depth: int, key_bits: int) -> Column:
    # Of the signed key: shifting the sign bit along keeps the order of the ranges.
    offset = 1 << (depth - 1)
    return (F.shiftright(F.col("key"), max(0, key_bits - depth)) + offset).cast("int")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket,
    n_chars.

    Equal means identical without ``[\\x20\\x09-\\x0D]``; of equal texts the longest
    original (code points), then the smallest id stays.  Null text counts as empty, so all
    null, empty and blank texts are one group.  A null id loses to any id; of rows that
    repeat both id and text one is kept.  Other columns of ``docs`` are ignored.  An empty
    table gives an empty result.  ``key_bits`` below 64 makes keys collide (for tests).
    """
    entries = stored(_keyed(docs, id_col, text_col, key_bits)
                     .select("doc_id", "n_chars", "key", F.sha2("norm", 256).alias("sha"),
                             F.monotonically_increasing_id().alias("row")), "dedup-entries")
    depth = min(depth_for(entries.count(), capacity), key_bits)
    buckets = stored(directory(entries, depth, capacity, key_bits), "dedup-directory")

    # The text stays in the grouping key, so the aggregate compares bytes, and a slot whose
    # key is shared by different texts yields one entry for each of them.
    slots = (_keyed(docs, id_col, text_col, key_bits)
             .withColumn("cell", _cell(depth, key_bits))
             .join(F.broadcast(buckets.select("cell", "bucket")), "cell")
             .withColumn("preference", _preference()))
    index = stored(slots.groupBy("bucket", "key", "norm")
                   .agg(F.max("preference").alias("best"), F.count("*").alias("group_size"))
                   .select("bucket", "key", F.sha2("norm", 256).alias("sha"), "group_size",
                           F.expr(f"CAST(best DIV CAST('{_STEP}' AS DECIMAL(38,0)) AS BIGINT)")
                           .alias("keep_chars"),
                           F.expr(f"""CAST(nullif(best % CAST('{_STEP}' AS DECIMAL(38,0)), 0)
                                      AS DECIMAL(38,0))""").alias("rank")), "dedup-index")
    index = index.withColumn("keep_id", F.expr(
        f"CAST(CAST({_TOP} AS DECIMAL(38,0)) + 1 - rank AS BIGINT)")).drop("rank")

    again = F.row_number().over(W.partitionBy("doc_id", "key", "sha")
                                .orderBy(F.desc("n_chars"), "row"))
    members = entries.withColumn("again", again)
    return (members.join(index, ["key", "sha"])
            .select("doc_id", "keep_id", F.col("group_size").cast("bigint").alias("group_size"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id"))
                     & (F.col("again") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256"), "bucket", "n_chars"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Rows that lose are taken out by id and text, so that the texts that stay need not be
    shuffled if few lose; only a table that repeats an id with its text is ranked as well.
    """
    mark = "__dedup_{}".format
    found = stored(exact_dedup(docs, id_col, text_col)
                   .select("doc_id", "keep_id", "kept", "text_sha256"), "dedup-found")
    lost = (found.where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .select(F.col("doc_id").alias(mark("id")), F.col("text_sha256").alias(mark("sha")))
            .distinct())
    own = (docs.withColumn(mark("own_id"), F.col(id_col).cast("bigint"))
           .withColumn(mark("own_sha"), F.sha2(normalised(text_of(text_col)), 256)))
    same = (F.col(mark("own_id")).eqNullSafe(F.col(mark("id")))
            & (F.col(mark("own_sha")) == F.col(mark("sha"))))
    own = own.join(lost, same, "left_anti")
    repeats = found.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not repeats.isEmpty():
        text = text_of(text_col)
        first = F.row_number().over(W.partitionBy(mark("own_id"), mark("own_sha"))
                                    .orderBy(F.desc(F.char_length(text)), text))
        own = own.withColumn(mark("rn"), first).where(F.col(mark("rn")) == 1)
    return own.select(*docs.columns)
