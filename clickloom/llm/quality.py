"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every document are computed once, in tasks.  Trees are grown on a bounded
sample of labelled rows (``SAMPLE``), on binned values, and flattened into arrays, so that
a batch of documents walks all trees at once.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import id_remainder, in_parts, map_texts, stored, texts

# At most so many labelled rows are fitted, those with the smallest hash of their id; the
# fit then takes the same memory at every size.
SAMPLE = 20_000
BINS = 64
THRESHOLD = 0.3
_SENTENCE = re.compile(r"[.!?]+\s")

STATISTICS = (
    "log_chars", "log_words", "mean_word", "long_word", "distinct_words", "top_word",
    "repeated_neighbours", "longest_repeat", "upper", "digits", "punctuation", "symbols",
    "blank", "non_ascii", "odd_word_ends", "lines_per_char", "distinct_lines",
    "sentence_words", "short_words", "byte_entropy", "compressed", "capital_words",
    "alphabetic_words", "top_pair")


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, 6))
    for b in range(256):
        c = chr(b)
        table[b] = (c.isascii() and c.isupper(), c.isascii() and c.isdigit(),
                    c in ".,;:'\"-()", c in "!?#$%&*+/<=>@[\\]^_`{|}~", c in " \t\n\r\f\v",
                    b >= 128)
    return table


_CLASSES = _byte_classes()


def statistics(text: str) -> list[float]:
    """The numbers named in ``STATISTICS``; an empty text has zeros."""
    raw = text.encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    upper, digits, punctuation, symbols, blank, wide = counts @ _CLASSES / size
    shares = counts[counts > 0] / size
    words = text.split()
    n = max(1, len(words))
    tally = Counter(words)
    equal = list(map(operator.eq, words, words[1:]))
    longest = run = 0
    if True in equal:
        for same in equal:
            run = run + 1 if same else 0
            longest = max(longest, run)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in text.split("\n") if x]
    pairs = Counter(zip(words, words[1:]))
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))),
        float(lengths.mean()) if len(words) else 0.0,
        float(lengths.max()) if len(words) else 0.0,
        len(tally) / n, max(tally.values(), default=0) / n, sum(equal) / n, longest / n,
        float(upper), float(digits), float(punctuation), float(symbols), float(blank),
        float(wide), sum(not w[-1].isalnum() for w in words) / n, len(lines) / len(text),
        len(set(lines)) / max(1, len(lines)), n / (1 + len(_SENTENCE.findall(text))),
        float((lengths <= 3).mean()) if len(words) else 0.0,
        float(-(shares * np.log2(shares)).sum()), len(zlib.compress(raw, 1)) / size,
        sum(w[0].isupper() for w in words) / n, sum(map(str.isalpha, words)) / n,
        max(pairs.values(), default=0) / n]


@dataclass
class Forest:
    """Trees of equal depth, flattened: node k of a tree has the children 2k+1 and 2k+2."""

    depth: int
    base: float
    feature: np.ndarray      # trees x inner nodes
    threshold: np.ndarray    # trees x inner nodes; a larger value goes right
    value: np.ndarray        # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        total = self.base + self.value[trees, node - (2 ** self.depth - 1)].sum(1)
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
        bins: int = BINS, least: float = 5.0, ridge: float = 1.0) -> Forest:
    """Boosting on the logistic loss; no rows give a forest that scores everything 0.5."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    forest = Forest(depth, float(np.log(share / (1 - share))),
                    np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                    np.zeros((trees, leaves)))
    if not len(y):
        return forest
    grid = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in
            range(x.shape[1])]
    binned = np.stack([np.searchsorted(g, x[:, j], "left") for j, g in enumerate(grid)], 1)
    raw = np.full(len(y), forest.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            gains = np.full(width, 1e-9)
            for j in range(x.shape[1]):
                cell = (node - first) * bins + binned[:, j]
                g = np.bincount(cell, gradient, width * bins).reshape(width, bins)
                h = np.bincount(cell, hessian, width * bins).reshape(width, bins)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = (gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge)
                        - gt ** 2 / (ht + ridge))
                gain[(hl < least) | (ht - hl < least)] = -1
                gain = gain[:, :len(grid[j])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > gains
                gains = np.where(better, gain[np.arange(width), at], gains)
                for k in np.flatnonzero(better):
                    forest.feature[t, first + k] = j
                    forest.threshold[t, first + k] = grid[j][at[k]]
            right = x[np.arange(len(y)), forest.feature[t, node]] > forest.threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, gradient, leaves)
        h = np.bincount(leaf, hessian, leaves)
        forest.value[t] = rate * g / (h + ridge)
        raw += forest.value[t][leaf]
    return forest


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            *more: Column) -> DataFrame:
    """doc_id, features (and ``more``) of every row, from its whole text."""
    rows = texts(docs, id_col, text_col, *more)
    carry = tuple(c for c in rows.columns if c != "text")
    return map_texts(rows, lambda: lambda batch: {"features": [statistics(t) for t in batch]},
                     "features array<double>", carry)


def train(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          label_col: str = "quality", sample: int = SAMPLE) -> Forest:
    """Fit on labelled rows: the ``sample`` ones with the smallest hash of their id.

    Rows with a null id or label take no part.
    """
    wanted = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    rows = (wanted.join(measured.select("doc_id", "features"), "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
            .select("label", "features").toArrow())
    y = np.asarray(rows.column("label").to_numpy(), float)
    x = np.array(rows.column("features").to_pylist(), float).reshape(len(y), len(STATISTICS))
    return fit(x, (y > 0).astype(float))


def score(measured: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``measured`` with ``features`` replaced by score (0 to 1) and predicted (1 from
    ``threshold`` on)."""
    from pyspark.sql.types import DoubleType, IntegerType, StructType
    kept = [f for f in measured.schema if f.name != "features"]
    out = StructType(list(kept)).add("score", DoubleType()).add("predicted", IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            found = forest.scores(flat.reshape(batch.num_rows, len(STATISTICS)))
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array(found, pa.float64()),
                       pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    return measured.mapInArrow(run, out)


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 5, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Labels of ids whose crc32 is divisible by ``held_out`` are not learnt from.  Null text
    counts as empty; empty texts are scored like others.  A null id is not held out.
    Without usable labels every score is 0.5.
    """
    measured = stored(measure(docs, id_col, text_col), "quality-measured")
    learnt = labels.where(id_remainder(id_col, held_out) != 0)
    out = F.coalesce(id_remainder("doc_id", held_out) == 0, F.lit(False))
    forest = train(measured, learnt, id_col, label_col)
    return score(measured, forest, threshold).select(
        "doc_id", out.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, held_out: int = 5, id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns unchanged.

    The texts pass once through the statistics to fit the trees and once more to be judged
    where they are, so that no text is shuffled.
    """
    learnt = labels.where(id_remainder(id_col, held_out) != 0)
    measured = stored(measure(docs, id_col, text_col), "quality-measured")
    forest = train(measured, learnt, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            found = forest.scores(np.array(
                [statistics(t or "") for t in batch.column(text_col).to_pylist()],
                float).reshape(batch.num_rows, len(STATISTICS)))
            yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(run, docs.schema)
