"""Filter interaction audit: what every order of applying a set of filters removes.

Documents are reduced to cells first: a cell is the set of filters that a document fails
(its mask, one bit a filter) within a part of the corpus.  All that an order of filters
does depends on the masks alone, of which there are at most 2^filters however many
documents there are.

A recursive CTE extends prefixes of filter orders by each letter not used yet.  It joins
the masks that occur and carries the bits applied so far; every level tells, for each
mask, whether the level's filter removes it, finds it removed already, or leaves it.  The
cells' counts are then summed over those rows, which gives the step's metrics.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import stored

# Letters at most: prefixes times masks stay far below Spark's row limit of a recursion.
MOST_FILTERS = 6


@dataclass(frozen=True)
class Filter:
    """``fails`` is an SQL condition over text (never null), n_chars (code points), n_words
    and n_distinct; None stands for "some smaller id has the same text"."""

    letter: str
    fails: str | None


FILTERS = (
    Filter("A", "n_words < 100"),
    Filter("B", "100 * n_distinct < 80 * n_words"),
    Filter("C", "100 * length(regexp_replace(text, '[^A-Z]+', '')) > 10 * n_chars"),
    Filter("D", "text RLIKE '[#$%&*|]'"),
    Filter("E", None),
)

_WORDS = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def _bits(filters: tuple[Filter, ...]) -> dict[str, int]:
    letters = [f.letter for f in filters]
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters) \
            or any(len(x) != 1 for x in letters):
        raise ValueError(f"filters need 1 to {MOST_FILTERS} different one-character letters")
    return {x: 1 << i for i, x in enumerate(letters)}


def marked(docs: DataFrame, filters: tuple[Filter, ...] = FILTERS, id_col: str = "doc_id",
           text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part, digest (SHA-256 of the text), mask of the filters that look at one text."""
    bits = _bits(filters)
    mask = " | ".join(["0L"] + [f"IF({f.fails}, {bits[f.letter]}L, 0L)"
                                for f in filters if f.fails is not None])
    return (docs.select(F.col(id_col).cast("bigint").alias("id"),
                        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
            .selectExpr("*", f"{_WORDS} AS words")
            .selectExpr("id", "part", "text", "CAST(length(text) AS BIGINT) AS n_chars",
                        "CAST(size(words) AS BIGINT) AS n_words",
                        "CAST(size(array_distinct(words)) AS BIGINT) AS n_distinct")
            .selectExpr("id", "part", "unhex(sha2(text, 256)) AS digest", f"{mask} AS mask"))


def cells(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS,
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: documents by part and failed filters.

    Null text counts as empty, a null part as the empty string.  ``labels`` (doc_id,
    quality, toxic) marks a document if any of its rows does; documents without a label
    and those with a null id are neither good nor toxic.  A null id is smaller than none
    and has none smaller; rows that repeat an id are documents of their own, and do not
    repeat each other.
    """
    bits = _bits(filters)
    repeats = sum(bits[f.letter] for f in filters if f.fails is None)
    own = (labels.groupBy(F.col("doc_id").cast("bigint").alias("id"))
           .agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"),
                F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic")))
    rows = (marked(docs, filters, id_col, text_col, part_col).join(own, "id", "left")
            .na.fill(False, ["good", "toxic"]))
    # Rows of a text are counted by id, then by what tells cells apart.  A group of copies
    # of any size leaves a few rows, so its first id comes without a sort of the group.
    kinds = ["digest", "part", "mask", "good", "toxic"]
    groups = stored(rows.groupBy(*kinds, "id").agg(F.count("*").alias("n"))
                    .groupBy(*kinds).agg(F.sum("n").alias("n"), F.min("id").alias("low"),
                                         F.min_by("n", "id").alias("at_low"),
                                         F.sum(F.expr("IF(id IS NULL, n, 0L)")).alias("no_id")),
                    "audit-groups")
    first = groups.groupBy("digest").agg(F.min("low").alias("first"))
    split = (groups.join(first, "digest").withColumn(
        "own", F.expr("no_id + IF(coalesce(low = first, false), at_low, 0L)"))
        if repeats else groups.withColumn("own", F.col("n")))
    return (split.selectExpr("part", "good", "toxic", f"""inline(array(
                named_struct('mask', mask, 'n', own),
                named_struct('mask', mask | {repeats}L, 'n', n - own)))""")
            .where("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.expr("IF(good, n, 0L)")).alias("good"),
                 F.sum(F.expr("IF(toxic, n, 0L)")).alias("toxic")))


STEPS = """
WITH RECURSIVE steps (prefix, applied, step, bit, mask) AS (
  SELECT '', 0L, 0, 0L, mask FROM {masks}
  UNION ALL
  SELECT concat(prefix, letter), applied | f.bit, step + 1, f.bit, mask
  FROM steps JOIN {letters} AS f ON applied & f.bit = 0)
SELECT prefix, step, mask, bit, mask & bit <> 0 AS fails,
       mask & (applied ^ bit) <> 0 AS gone
FROM steps WHERE step > 0"""


def steps(masks: DataFrame, filters: tuple[Filter, ...] = FILTERS) -> DataFrame:
    """prefix, step, mask, bit, fails, gone for every prefix of an order and every mask.

    ``fails``: the mask fails the prefix's last filter; ``gone``: an earlier filter of the
    prefix has removed it.  At most 2^filters masks, so the size does not depend on the corpus.
    """
    letters = masks.sparkSession.createDataFrame(list(_bits(filters).items()),
                                                 "letter string, bit bigint")
    return masks.sparkSession.sql(STEPS, masks=masks, letters=letters)


def audit(docs: DataFrame, labels: DataFrame, filters: tuple[Filter, ...] = FILTERS,
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    kept, removed, redundant (failed, but removed earlier), unique_fails (failed no other
    filter), good_lost and toxic_lost (removed here), shapley (removed by the step's filter,
    summed over all orders).  No documents, no parts, no rows; other columns are ignored.
    See ``cells`` for nulls and repeated rows.
    """
    counts = stored(cells(docs, labels, filters, id_col, text_col, part_col), "audit-cells")
    taken = "fails AND NOT gone"
    metrics = stored(
        steps(counts.select("mask").distinct(), filters).join(counts, "mask")
        .groupBy("part", "prefix", "step").agg(*(
            F.sum(F.expr(f"IF({when}, {what}, 0L)")).alias(name) for name, when, what in (
                ("kept", "NOT fails AND NOT gone", "n"), ("removed", taken, "n"),
                ("redundant", "fails AND gone", "n"), ("unique_fails", "mask = bit", "n"),
                ("good_lost", taken, "good"), ("toxic_lost", taken, "toxic")))),
        "audit-metrics")
    orders = metrics.where(F.col("step") == len(filters)).selectExpr(
        "part", "prefix AS filter_order", f"explode(sequence(1, {len(filters)})) AS step")
    found = (orders.withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
             .join(metrics, ["part", "prefix", "step"])
             .withColumn("letter", F.expr("substring(prefix, step, 1)")))
    shapley = found.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return found.join(shapley, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")
