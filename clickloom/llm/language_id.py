"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams of a language, most frequent first.  A
document's own list is compared with every profile by the out-of-place distance: how far
each n-gram's rank is from its rank in the profile, with a fixed distance for absent ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.scratch import map_texts, texts

PROFILE = 300
UNKNOWN = "und"
# Characters counted at a time.
PART = 500_000
_NOT_LETTERS = re.compile(r"[\W\d_]+")
# Fractions and numerals are word characters, but no letters (Unicode category L).
_NUMBERS = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha())
_NUMERALS = re.compile(f"[ {re.escape(_NUMBERS)}]+")
_BITS = np.uint64(21)
_BLANK = ord(" ")


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the one- to three-letter n-grams of the text's words.

    Words are lower-cased runs of letters with a blank on either side; n-grams across
    words and blanks alone are left out.  A code packs up to three code points.
    """
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    # Rare, and the long class is slow.
    if not words.replace(" ", "").isalpha():
        words = _NUMERALS.sub(" ", words).strip()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found, start = [], 0
    while start < len(words):
        # A very long text is counted in parts, cut between words.
        end = len(words) if len(words) - start <= PART else words.find(" ", start + PART)
        end = len(words) if end < 0 else end
        found.append(_count(words[start:end]))
        start = end + 1
    return found[0] if len(found) == 1 else add_up(found)


def add_up(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several n-gram counts."""
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    counts = np.zeros(len(codes), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in found]))
    return codes, counts


def _count(words: str) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(f" {words} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    letter = points != _BLANK
    pairs = points[:-1] << _BITS | points[1:]
    triples = pairs[:-1] << _BITS | points[2:]
    return np.unique(np.concatenate([points[letter], pairs, triples[letter[1:-1]]]),
                     return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        held = counts >= least
        codes, counts = codes[held], counts[held]
    return codes[np.lexsort((codes, -counts))][:size]


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
             size: int = PROFILE) -> dict[str, list[int]]:
    """Profile of every non-null language, from the counts of all given texts.

    The result has ``size`` numbers per language, whatever the number of documents.
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    grams = (_per_language(rows)
             .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = grams.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    out: dict[str, list[tuple[int, int]]] = {}
    for row in top.select("lang", "code", "rank").collect():
        out.setdefault(row["lang"], []).append((row["rank"], row["code"]))
    return {lang: [code for _, code in sorted(found)] for lang, found in sorted(out.items())}


def _per_language(rows: DataFrame) -> DataFrame:
    """lang, code, n: n-gram counts of each Arrow batch, summed per language there, so the
    shuffle gets a row per language and n-gram of a batch rather than of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(),
                                  batch.column("text").to_pylist()):
                by.setdefault(lang, []).append(text or "")
            for lang, own in by.items():
                codes, counts = _counted(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()),
                     pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    ["lang", "code", "n"])

    return rows.mapInArrow(run, "lang string, code bigint, n bigint")


def _counted(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of many texts, about PART characters at a time."""
    found, held, size = [], [], 0
    for text in batch:
        held.append(text)
        size += len(text)
        if size >= PART:
            found.append(ngrams("\n".join(held)))
            held, size = [], 0
    found.append(ngrams("\n".join(held)))
    return add_up(found)


class Matcher:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, known: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = list(known), size
        self.codes = np.unique(np.array([c for p in known.values() for c in p], np.uint64))
        self.ranks = np.full((len(self.codes), len(known)), -1, np.int32)
        for i, profile in enumerate(known.values()):
            at = np.searchsorted(self.codes, np.array(profile, np.uint64))
            self.ranks[at, i] = np.arange(len(profile))

    def match(self, text: str | None) -> tuple[str, float]:
        codes, counts = ngrams(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        there = self.ranks[at]
        absent = (self.codes[at] != own)[:, None] | (there < 0)
        away = np.abs(there - np.arange(len(own), dtype=np.int32)[:, None])
        distance = np.where(absent, self.size, away).sum(0) / (self.size * len(own))
        best = int(np.argmin(distance))
        return self.langs[best], float(min(1.0, max(0.0, 1.0 - distance[best])))


def identify(docs: DataFrame, known: dict[str, list[int]], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (1 less the mean distance, 0 to 1) of every row.

    ``und`` and 0 for a text that is null, empty or without a letter, and if there is no
    profile.  Equal distances go to the language first in the alphabet.
    """
    def prepare():
        matcher = Matcher(known)

        def run(batch: list[str]) -> dict[str, list]:
            found = [matcher.match(t) for t in batch]
            return {"lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

        return run

    return map_texts(texts(docs, id_col, text_col), prepare, "lang_pred string, score double")
