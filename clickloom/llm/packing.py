"""Best-fit packing of documents into sequences of a fixed number of tokens.

Which lengths share a sequence is decided on the histogram of piece lengths, which has at
most ``capacity`` rows however many pieces there are.  Exact complements come first: for
the largest length left, a single length, a pair or a triple that fills its gap exactly is
looked up by sum and consumed as often as the counts allow.  What has no exact complement
is best-fitted.  The result is a list of runs ("the next m pieces of length n open or join
sequences s, s+1, ... at offset o"); every piece finds its run by its rank in its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.scratch import map_texts, stored, texts
from clickloom.llm.tokens import vocabulary, word_encoder

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END = 0
# Pieces of one length that are ranked as one group; a common length is as many groups as
# it needs, so no task sorts more than a few of these.
GROUP = 256


def pieces(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian uint32), ids_crc32 of every piece.

    A document is its ids and an end id; only a longer one than ``capacity`` is cut.  Null
    text counts as empty, a document of the end id alone.
    """
    path = path or vocabulary(VOCABULARY)

    def prepare():
        encoder, end, step = word_encoder(path), np.array([END], "<u4").tobytes(), 4 * capacity

        def run(batch: list[str]) -> dict[str, list]:
            cut = []
            for ids in encoder.ids_of(batch):
                ids += end
                cut.append([ids[i:i + step] for i in range(0, len(ids), step)])
            return {"cut": [[(len(p) // 4, zlib.crc32(p), p) for p in own] for own in cut]}

        return run

    kind = "cut array<struct<length:bigint,ids_crc32:bigint,ids:binary>>"
    return (map_texts(texts(docs, id_col, text_col), prepare, kind)
            .select("doc_id", F.posexplode("cut").alias("piece", "p"))
            .select("doc_id", "piece", (F.col("piece").cast("bigint") * capacity).alias("start"),
                    "p.length", "p.ids", "p.ids_crc32"))


@dataclass
class Plan:
    """Runs as parallel lists, in order of (length, first rank)."""

    sequences: int = 0
    runs: list[tuple[int, int, int, int]] = field(default_factory=list)

    def arrays(self) -> tuple[np.ndarray, ...]:
        ordered = sorted(self.runs)
        table = np.array(ordered, "int64").reshape(-1, 4)
        return tuple(table.T)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``histogram`` (pieces by length, 1 to ``capacity``) into sequences."""
    sums = _Sums(histogram, capacity)
    patterns: list[tuple[list[int], int]] = []
    residual: dict[int, int] = {}
    for largest in range(capacity, 0, -1):
        while sums.left[largest]:
            found = sums.complement(largest)
            if found is None:
                residual[largest] = int(sums.left[largest])
                sums.take([largest], residual[largest])
            else:
                patterns.append(([largest, *found], sums.take([largest, *found])))
    patterns += _best_fit(residual, capacity)
    return _runs(patterns)


class _Sums:
    """Availability counts by length, and which sums two available lengths can have."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for n, c in histogram.items():
            self.left[n] = c
        self._index()

    def _index(self) -> None:
        there = (self.left > 0).astype(float)
        self._pairs = np.convolve(there, there)[:self.capacity + 1] > 0.5
        self._stale = False

    def take(self, lengths: list[int], times: int | None = None) -> int:
        """Consume a combination, as often as the counts allow if not told otherwise."""
        need = {n: lengths.count(n) for n in lengths}
        if times is None:
            times = int(min(self.left[n] // k for n, k in need.items()))
        for n, k in need.items():
            self.left[n] -= k * times
            self._stale = self._stale or not self.left[n]
        return times

    def complement(self, largest: int) -> list[int] | None:
        """One, two or three lengths that fill up ``largest`` exactly and are there
        besides it, with the largest possible first."""
        gap = self.capacity - largest
        if gap == 0:
            return []
        self.left[largest] -= 1
        try:
            if self.left[gap] > 0:
                return [gap]
            pair = self._pair(gap)
            return pair or self._triple(gap)
        finally:
            self.left[largest] += 1

    def _pair(self, gap: int) -> list[int] | None:
        if not self._pairs[gap]:
            return None
        a = np.arange((gap + 1) // 2, gap)
        there = (self.left[a] > 0) & (self.left[gap - a] > (2 * a == gap))
        at = np.flatnonzero(there)
        return [int(a[at[-1]]), int(gap - a[at[-1]])] if len(at) else None

    def _triple(self, gap: int) -> list[int] | None:
        if self._stale:
            self._index()
        first = np.arange(1, gap)
        for a in first[(self.left[1:gap] > 0) & self._pairs[gap - first]][::-1].tolist():
            self.left[a] -= 1
            pair = self._pair(gap - a)
            self.left[a] += 1
            if pair:
                return [a, *pair]
        return None


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Longest first, each into the smallest gap that takes it; equal sequences together."""
    by_gap: dict[int, list[tuple[list[int], int]]] = {}
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            gap = min((g for g in by_gap if g >= length), default=None)
            if gap is None:
                each = min(capacity // length, todo)
                times, lengths = todo // each, [length] * each
                by_gap.setdefault(capacity - length * each, []).append((lengths, times))
                todo -= times * each
                continue
            lengths, times = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
            each = min(gap // length, todo)
            used = min(times, todo // each)
            if used < times:
                by_gap.setdefault(gap, []).append((lengths, times - used))
            by_gap.setdefault(gap - length * each, []).append((lengths + [length] * each, used))
            todo -= used * each
    return [x for found in by_gap.values() for x in found]


def _runs(patterns: list[tuple[list[int], int]]) -> Plan:
    out, used = Plan(), {}
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            rank = used.get(n, 0)
            out.runs.append((n, rank, out.sequences, offset))
            used[n], offset = rank + times, offset + n
        out.sequences += times
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (a stored table with a ``length`` from 1 to ``capacity``) with sequence_id
    and offset added.

    Rows are ranked within their length in hashed groups whose size does not grow with the
    table.  Repeated rows get places of their own.  No rows, no result; a length that is
    null or out of range is an error.
    """
    mark = "__pack_{}".format
    row, salt, groups = mark("row"), mark("salt"), mark("groups")
    counts = rows.groupBy("length").agg(F.count("*").alias("rows")).collect()
    histogram = {r["length"]: r["rows"] for r in counts}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    spark = rows.sparkSession
    runs = plan(histogram, capacity).arrays()

    # At most ``capacity`` rows, so the broadcast is bounded.
    sizes = spark.createDataFrame([(n, -(-c // GROUP)) for n, c in histogram.items()],
                                  f"length bigint, `{groups}` bigint")
    salted = (rows.join(F.broadcast(sizes), "length")
              .withColumn(salt, F.pmod(F.xxhash64(row), F.col(groups))).drop(groups))
    before = W.partitionBy("length").orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    starts = (salted.groupBy("length", salt).agg(F.count("*").alias(mark("size")))
              .select("length", salt, F.coalesce(F.sum(mark("size")).over(before), F.lit(0))
                      .alias(mark("start"))))
    own = F.row_number().over(W.partitionBy("length", salt).orderBy(row)) - 1
    ranked = (salted.withColumn(mark("own"), own).join(starts, ["length", salt])
              .withColumn(mark("rank"), F.col(mark("start")) + F.col(mark("own"))))
    kept = [c for c in rows.columns if c != row]
    return _place(ranked.select(*kept, mark("rank")), mark("rank"), runs)


def _place(ranked: DataFrame, rank: str, runs: tuple[np.ndarray, ...]) -> DataFrame:
    lengths, firsts, sequences, offsets = runs
    shift = 1 << 44
    keys = lengths * shift + firsts
    from pyspark.sql.types import LongType, StructType
    kept = [f for f in ranked.schema if f.name != rank]
    out = StructType(list(kept)).add("sequence_id", LongType()).add("offset", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(rank).to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * shift + own, "right") - 1
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(sequences[at] + own - firsts[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return ranked.mapInArrow(run, out)


def numbered(rows: DataFrame, label: str = "pack-rows") -> DataFrame:
    """Store ``rows`` with the number that ``pack`` ranks by."""
    return stored(rows.withColumn("__pack_row", F.monotonically_increasing_id()), label)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text", path: str | None = None,
                   keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their place.  ``keep_ids=False`` leaves the ids out."""
    found = pieces(docs, capacity, id_col, text_col, path)
    return pack(numbered(found if keep_ids else found.drop("ids")), capacity)
