"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Of a batch of texts, each tokenizer's tokens and their bytes are an incidence matrix in
compressed rows: row i holds the bytes of token i.  The product A.B' by rows (Gustavson)
takes, for every byte of a row of A, the row of B' of that byte, and adds up; its entries
are the overlap links, their values the bytes shared.  Offsets where a token of either
ends cut the text into groups.  With the group incidence matrices G_A and G_B (group by
token), G_A'.G_B is what shares a group; it is kept as its factors, since its entries are
the square of a long group.

Texts repeat their words.  No token of either crosses from a word to the space after it,
so tokens, groups and their listing are made once for each distinct chunk of a batch of
texts (a word with the white space before it), and a text's are its chunks' in a row.

Corpus counts.  A pair of ids counts once per document that holds it linked.  Documents'
ids are stored, and their links made again when the counts are known, which is cheaper
than storing links.  The most frequent pairs, at most ``KNOWN`` of them, are looked up
where the links are made; every other pair of a document is joined with the counts.  So a
pair that a third of all documents hold is in no shuffle but that of its count.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bpe import byte_alphabet
from clickloom.llm.scratch import arrow_rows, in_parts, stored, texts
from clickloom.llm.tokens import Generations, vocabulary

VOCABULARY_A, RANKS_A, VOCABULARY_B = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken",
                                       "piece_bpe_32k.model")
# Pairs of ids whose counts are sent to every worker, and distinct pairs of a task that
# are summed before they leave it.
KNOWN, GATHER = 400_000, 1_000_000
# Rows that Spark and a worker hand over at once, and chunks that a worker remembers.
ROWS, CHUNKS = 512, 50_000
# Letters and marks that all versions of Unicode class alike, and the longest run without
# white space that the faster of two equal encoders gets.
_PLAIN = re.compile("[^\x00-ɏ]")
_RUN = re.compile(r"\S{4000}|\s{4000}")
# Such texts are cut where a space follows what is not white space.
_CUT = re.compile("(?<=[^\t-\r \x85\xa0])(?= )")
_BLANK = "\t\n\x0b\x0c\r \x85\xa0"
# Bits of an id; a pair of ids and a document of a batch share a 64-bit number.
_SHIFT = 20


@dataclass(frozen=True)
class Rows:
    """A matrix of ones in compressed rows."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Rows(starts, np.repeat(np.arange(len(self.starts) - 1),
                                      np.diff(self.starts))[order], len(self.starts) - 1)


def spans(lengths: np.ndarray) -> Rows:
    """Incidence of tokens, which lie end to end, and their bytes."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Rows(starts, np.arange(starts[-1]), int(starts[-1]))


def product(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the entries of ``a.b``, by rows of ``a``.

    Every entry of a row of ``a`` takes a whole row of ``b``; equal columns are added up.
    """
    sizes = np.diff(b.starts)[a.columns]
    row = np.repeat(np.repeat(np.arange(len(a.starts) - 1), np.diff(a.starts)), sizes)
    within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    column = b.columns[np.repeat(b.starts[a.columns], sizes) + within]
    key = row * b.width + column
    if len(key) and np.any(key[1:] < key[:-1]):
        key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    return key[first] // b.width, key[first] % b.width, np.diff(np.append(first, len(key)))


def overlap_links(lengths_a: np.ndarray, lengths_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Token of A, token of B and shared bytes of every overlap, in order."""
    # Every byte has one token of B, so B' is its own rows: byte to token.
    of_byte = np.repeat(np.arange(len(lengths_b)), lengths_b)
    return product(spans(lengths_a), Rows(np.arange(len(of_byte) + 1), of_byte, len(lengths_b)))


def groups(lengths_a: np.ndarray, lengths_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of A and of B; a group ends where tokens of both end."""
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    both = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
    return np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)


def group_rows(group: np.ndarray) -> Rows:
    """Incidence of groups and their tokens, which lie in a row."""
    count = int(group[-1]) + 1 if len(group) else 0
    return Rows(np.searchsorted(group, np.arange(count + 1)), np.arange(len(group)), len(group))


def shared_group_links(group_a: np.ndarray, group_b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of tokens in a common group: the product of the group matrices, row by row.

    The rows come one at a time, as a group of n and m tokens has n * m of them.
    """
    by_group, members = group_rows(group_a).transposed(), group_rows(group_b)
    for token in range(len(group_a)):
        for g in by_group.columns[by_group.starts[token]:by_group.starts[token + 1]]:
            for other in members.columns[members.starts[g]:members.starts[g + 1]]:
                yield token, int(other)


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, ranks_a: str | None, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._fast = _ranked(ranks_a) if ranks_a else None
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self._a.get_vocab_size(with_added_tokens=True)
        for token, number in self._a.get_vocab(with_added_tokens=True).items():
            known = all(c in alphabet for c in token)
            self.bytes_a[number] = bytes(alphabet[c] for c in token) if known else token.encode()
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self._b.id_to_piece(i)) for i in range(self._b.get_piece_size()))]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _SHIFT:
            raise ValueError(f"vocabularies may have {1 << _SHIFT} ids")
        self.lengths_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.lengths_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.kind = "<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "<u4"
        # A piece with a space after something else could cross a cut.
        self._cuts = bool(self._fast) and not any(
            " " in b.decode(errors="replace").lstrip(" ") for b in self.bytes_b)
        self._chunks = Generations(CHUNKS)
        self._listed = _Listed(max(len(self.bytes_a), len(self.bytes_b)))

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a space and ``text``, by each; none if either's bytes differ from those."""
        if not text:
            return [], []
        spaced = " " + text
        if self._fast and not _PLAIN.search(text) and not _RUN.search(text):
            a = self._fast(spaced)
        else:
            a = self._a.encode(spaced, add_special_tokens=False).ids
        b, raw = self._b.encode(text), spaced.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw \
                or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return [], []
        return a, b

    def aligned(self, texts: list[str]) -> Iterator[tuple[bytes, bytes, int, bytes] | None]:
        """Of every text the ids of both as ``kind``, the number of groups and their listing.

        None stands for a text without tokens.
        """
        known, cut, new = self._chunks, [], set()
        known.age()
        for text in texts:
            plain = self._cuts and text and not _PLAIN.search(text) and not _RUN.search(text)
            cut.append(_CUT.split(" " + text) if plain else None)
            new.update(cut[-1] or ())
        new.difference_update(known)
        for chunk in [c for c in new if c in known.old]:
            known[chunk] = known.old[chunk]
        new = list(new.difference(known))
        # White space at the end of a text is its own: more must not follow it.
        self._learn([c for c in new if c[-1] not in _BLANK])
        for chunk in new:
            if chunk[-1] in _BLANK:
                self._learn([chunk])
        for text, chunks in zip(texts, cut):
            if chunks is None:
                a, b = self.encode(text)
                yield self._whole(a, b) if a else None
                continue
            found = [known[c] for c in chunks]
            if None in found:
                yield None
                continue
            a, b, count, listed = zip(*found)
            yield b"".join(a), b"".join(b), sum(count), b";".join(listed)

    def _whole(self, a: list[int], b: list[int]) -> tuple[bytes, bytes, int, bytes]:
        wide_a, wide_b = np.array(a, np.int64), np.array(b, np.int64)
        group_a, group_b = groups(self.lengths_a[wide_a], self.lengths_b[wide_b])
        return (wide_a.astype(self.kind).tobytes(), wide_b.astype(self.kind).tobytes(),
                int(group_a[-1]) + 1, self._listed.text(wide_a, wide_b, group_a, group_b))

    def _learn(self, chunks: list[str]) -> None:
        """Remember what becomes of chunks, which are encoded together."""
        if not chunks:
            return
        # A word before them, as B adds a space to the first only and chunks bring their own.
        joined = "x" + "".join(chunks)
        a, b = (np.array(ids, np.int64) for ids in self.encode(joined))
        if not len(a):
            # One of them is not given back byte by byte; it is looked for by halves.
            half = len(chunks) // 2
            if half:
                self._learn(chunks[:half])
                self._learn(chunks[half:])
            else:
                self._chunks[chunks[0]] = None
            return
        ends = np.cumsum([2] + [len(c.encode()) for c in chunks])
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if (ends_a[last_a] != ends).any() or (ends_b[last_b] != ends).any():
            raise ValueError("a token crosses from a word to the space after it")
        group_a, group_b = groups(self.lengths_a[a], self.lengths_b[b])
        parts = self._listed.parts(a, b, group_a, group_b)
        raw_a, raw_b, size = a.astype(self.kind).tobytes(), b.astype(self.kind).tobytes(), int(self.kind[2])
        last_a, last_b, last = last_a + 1, last_b + 1, group_a[last_a] + 1
        slices = zip(chunks, *(
            y for x in (last_a, last_b, last) for y in (x[:-1].tolist(), x[1:].tolist())))
        for chunk, a0, a1, b0, b1, g0, g1 in slices:
            self._chunks[chunk] = (raw_a[size * a0:size * a1], raw_b[size * b0:size * b1], g1 - g0,
                                   b"".join(parts[a0 + b0:a1 + b1])[:-1])


def _ranked(path: str) -> Callable[[str], list[int]]:
    import tiktoken
    from public_tokenizers import PATTERN
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks,
                             special_tokens={}).encode_ordinary


@lru_cache(maxsize=2)
def tokenizers(path_a: str, ranks_a: str | None, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, ranks_a, path_b)


class _Listed:
    """Groups of ids as text, from every id's digits with each mark that may follow."""

    def __init__(self, largest: int):
        digits = [str(i).encode() for i in range(largest)]
        self._parts = [d + mark for mark in (b",", b"|", b";") for d in digits]
        self._largest = largest

    def text(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> bytes:
        return b"".join(self.parts(a, b, group_a, group_b))[:-1]

    def parts(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray,
              group_b: np.ndarray) -> list[bytes]:
        """Each token's, group by group, those of A first; the mark of a group's end comes last."""
        if not len(a):
            return []
        count = group_a[-1] + 1
        sizes_a, sizes_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        parts = np.empty(len(a) + len(b), np.int64)
        # A token comes after all tokens of earlier groups, one of B after its group's A too.
        parts[np.arange(len(a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]] = \
            a + self._largest * np.append(group_a[1:] != group_a[:-1], True)
        parts[np.arange(len(b)) + np.cumsum(sizes_a)[group_b]] = \
            b + 2 * self._largest * np.append(group_b[1:] != group_b[:-1], True)
        return list(map(self._parts.__getitem__, parts.tolist()))


ENCODED = ("doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups_sha256 string, a binary, b binary")


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            paths: tuple[str, str | None, str] | None = None) -> DataFrame:
    """Ids of both tokenizers (uint16 if all fit, else uint32) and what one document alone decides, of every row."""
    paths = paths or tuple(vocabulary(v) for v in (VOCABULARY_A, RANKS_A, VOCABULARY_B))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*paths)
        size = int(own.kind[2])
        for batch in in_parts(batches):
            out: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links",
                                                    "groups_sha256", "a", "b")}
            for found in own.aligned(batch.column("text").to_pylist()):
                a, b, count, listed = found or (b"", b"", 0, b"")
                n_a, n_b = len(a) // size, len(b) // size
                told = hashlib.sha256(listed).hexdigest() if found else ""
                # Tokens of both lie end to end, so all ends but common ones add a link.
                for name, value in zip(out, (n_a, n_b, count, n_a + n_b - count, told, a, b)):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "row": batch.column("row")}
                | {"n_a": out["n_a"], "n_b": out["n_b"], "n_groups": out["n_groups"],
                   "n_links": out["n_links"], "groups_sha256": out["groups_sha256"],
                   "a": out["a"], "b": out["b"]}, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(ENCODED))
    return (texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
            .mapInArrow(run, ENCODED))


class Linker:
    """Links of a batch of encoded documents, as sorted pairs of ids by document."""

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray, kind: str):
        self._lengths, self._kind = (lengths_a, lengths_b), kind

    def pairs(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document (place in the batch), pair of ids and number of links, each pair once."""
        ids, sizes = [], []
        for name in ("a", "b"):
            column = batch.column(name).to_pylist()
            ids.append(np.frombuffer(b"".join(column), self._kind).astype(np.int64))
            sizes.append(np.array([len(x) // int(self._kind[2]) for x in column], np.int64))
        # Texts follow each other end to end in both, so no link crosses from one to the next.
        left, right, _ = overlap_links(self._lengths[0][ids[0]], self._lengths[1][ids[1]])
        doc = np.repeat(np.arange(batch.num_rows), sizes[0])[left]
        key = (doc << _SHIFT | ids[0][left]) << _SHIFT | ids[1][right]
        key.sort()
        key, links = np.unique(key, return_counts=True)
        return key >> 2 * _SHIFT, key & (1 << 2 * _SHIFT) - 1, links


def _linker(paths) -> Linker:
    own = tokenizers(*paths)
    return Linker(own.lengths_a, own.lengths_b, own.kind)


def pair_counts(found: DataFrame, paths) -> DataFrame:
    """pair, count (documents that hold it linked), best (highest of its A id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker = _linker(paths)
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "count"])

        for batch in in_parts(batches, 128):
            own, times = np.unique(linker.pairs(batch)[1], return_counts=True)
            merged = np.concatenate([keys, own])
            keys, at = np.unique(merged, return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, times]), len(keys)).astype(np.int64)
            if len(keys) > GATHER:
                yield sent()
                keys, counts = keys[:0], counts[:0]
        yield sent()

    counts = stored(found.select("a", "b").mapInArrow(run, "pair bigint, count bigint")
                    .groupBy("pair").agg(F.sum("count").alias("count")), "align-pairs")
    # One row per id of A at most, which the vocabulary bounds.
    best = (counts.groupBy(F.shiftright("pair", _SHIFT).alias("id"))
            .agg(F.max("count").alias("highest")))
    return counts.join(F.broadcast(best), F.shiftright("pair", _SHIFT) == F.col("id")).select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def most_frequent(counts: DataFrame, most: int = KNOWN) -> int:
    """The least count of which, and above, there are at most ``most`` pairs.

    Read off a histogram of steps of an eighth of a doubling, so of a few hundred rows.
    """
    step = F.floor(8 * F.log2("count")).alias("step")
    left, bound = most, None
    for r in counts.groupBy(step).agg(F.count("*").alias("n"), F.min("count").alias("low")
                                      ).orderBy(F.desc("step")).collect():
        left -= r["n"]
        if left < 0:
            break
        bound = r["low"]
    return (1 << 62) if bound is None else bound


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          paths: tuple[str, str | None, str] | None = None, known: int = KNOWN) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and those that a tokenizer does not give back byte by byte, have
    no tokens: zeros, and an empty ``groups_sha256``.  Repeated rows are documents of their
    own; null ids are carried; other columns are ignored.  ``paths`` are the vocabulary of
    A, its ranks for the faster encoder (None: not used) and the model of B.
    """
    paths = paths or tuple(vocabulary(v) for v in (VOCABULARY_A, RANKS_A, VOCABULARY_B))
    spark = docs.sparkSession
    # Ids are longer than most rows, and a batch is held on both sides.
    with arrow_rows(spark, ROWS):
        found = stored(encoded(docs, id_col, text_col, paths), "align-ids")
        counts = stored(pair_counts(found, paths), "align-counts")
    frequent = F.col("count") >= most_frequent(counts, known)
    top = counts.where(frequent).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(
        top.column(c).to_numpy() for c in ("pair", "count", "best")))
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linker, (keys, count, best) = _linker(paths), shared.value
        for batch in in_parts(batches, 128):
            doc, pair, links = linker.pairs(batch)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
                there = keys[at] == pair
            else:
                at, there = np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
            own = lambda values: np.bincount(
                doc[there], values, batch.num_rows).astype(np.int64)
            rare = ~there
            starts = np.searchsorted(doc[rare], np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(starts, x[rare]) for x in (pair, links)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in [*plain, "row"]]
                + [pa.array(own(links[there] * best[at[there]])),
                   pa.array(own(links[there] * count[at[there]])), *lists],
                [*plain, "row", "n_best", "count_sum", "rare", "rare_links"])

    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    schema = ", ".join(
        [f"{c} {kinds[c]}" for c in plain] + ["row bigint", "n_best bigint", "count_sum bigint",
                                              "rare array<bigint>", "rare_links array<bigint>"])
    with arrow_rows(spark, ROWS):
        looked_up = stored(found.mapInArrow(run, schema), "align-known")
    rest = (looked_up.where("size(rare) > 0")
            .selectExpr("row", "inline(arrays_zip(rare, rare_links)) AS (pair, links)")
            .join(counts.where(~frequent), "pair").groupBy("row")
            .agg(F.sum(F.expr("IF(best, links, 0L)")).alias("more_best"),
                 F.sum(F.expr("links * count")).alias("more_sum")))
    return looked_up.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.expr("n_best + coalesce(more_best, 0L)").alias("n_best"),
        F.expr("count_sum + coalesce(more_sum, 0L)").alias("count_sum"), "groups_sha256")
