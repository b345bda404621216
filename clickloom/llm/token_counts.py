"""Exact length histogram: how many documents have how many tokens.

Suffix sums over the histogram answer totals, quantiles and truncated totals for every
context limit without another look at the texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.scratch import map_texts, stored, texts
from clickloom.llm.tokens import vocabulary, word_encoder

VOCABULARY = "word_bpe_49k.json"
# Lengths per block of the two-level sums: no task orders more rows than that, and the
# window over block totals has (longest text / BLOCK) rows.
BLOCK = 4096


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every row; null text counts as empty and has 0 tokens."""
    path = path or vocabulary(VOCABULARY)

    def prepare():
        encoder = word_encoder(path)
        return lambda batch: {"n_tokens": [len(ids) // 4 for ids in encoder.ids_of(batch)]}

    return map_texts(texts(docs, id_col, text_col), prepare, "n_tokens bigint")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row per length that occurs, with sums from it upwards.

    n_tokens; n_docs of that length; docs_from and tokens_from, the documents of this
    length or more and their tokens; tokens_upto, tokens of documents no longer than this;
    truncated_total, tokens left if every document is cut to this length; rank_upto, the
    number of documents no longer than this.  Null lengths are left out; no rows, no result.
    """
    # Both levels read the counts; stored, the texts are encoded once.
    counts = stored(lengths.where(F.col(length_col).isNotNull())
                    .groupBy(F.col(length_col).cast("bigint").alias("n_tokens"))
                    .agg(F.count("*").alias("n_docs"))
                    .withColumn("block", F.expr(f"n_tokens DIV {BLOCK}")), "token-histogram")
    sums = [F.sum("n_docs").alias("block_docs"),
            F.sum(F.col("n_docs") * F.col("n_tokens")).alias("block_tokens")]
    later = W.partitionBy(F.lit(0)).orderBy(F.desc("block"))
    after = later.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(F.lit(0))
    blocks = (counts.groupBy("block").agg(*sums)
              .select("block",
                      F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("docs_after"),
                      F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("tokens_after"),
                      F.sum("block_docs").over(whole).alias("all_docs"),
                      F.sum("block_tokens").over(whole).alias("all_tokens")))
    within = W.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    docs_from = F.col("docs_after") + F.sum("n_docs").over(within)
    tokens_from = F.col("tokens_after") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(within)
    return (counts.join(blocks, "block")
            .withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
            .select("n_tokens", "n_docs", "docs_from", "tokens_from",
                    F.expr("all_tokens - tokens_from + n_docs * n_tokens").alias("tokens_upto"),
                    F.expr("all_tokens - tokens_from + docs_from * n_tokens")
                    .alias("truncated_total"),
                    F.expr("all_docs - docs_from + n_docs").alias("rank_upto")))


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """context_limit, docs_over (longer than the limit), truncated_total for any limits.

    Looked up in the suffix sums: the first length above the limit says how many documents
    are cut to it and how many tokens the shorter ones have.
    """
    spark = histogram.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "context_limit bigint")
    sums = histogram.select(
        "n_tokens", "docs_from", "tokens_upto",
        F.expr("tokens_upto - n_docs * n_tokens").alias("tokens_below"),
        F.explode(F.array(*[F.lit(int(x)).cast("bigint") for x in limits])).alias("context_limit"))
    found = sums.groupBy("context_limit").agg(
        F.max("tokens_upto").alias("all_tokens"),
        F.expr("min_by(struct(docs_from, tokens_below), n_tokens)"
               " FILTER (WHERE n_tokens > context_limit)").alias("above"))
    return asked.join(found, "context_limit", "left").select(
        "context_limit", F.coalesce("above.docs_from", F.lit(0)).alias("docs_over"),
        F.expr("coalesce(above.tokens_below + context_limit * above.docs_from, all_tokens, 0)")
        .alias("truncated_total"))


def quantiles(histogram: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of documents keep to."""
    rows = histogram.select("n_tokens", "rank_upto", F.expr("rank_upto + docs_from - n_docs")
                            .alias("all_docs"))
    asked = rows.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    return (asked.where(F.col("rank_upto") >= F.col("share") * F.col("all_docs"))
            .groupBy("share").agg(F.min("n_tokens").alias("n_tokens")))
