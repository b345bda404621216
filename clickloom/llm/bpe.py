"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A word is held as an array of part ids and, beside it, the merge rank of every adjacent
pair.  The smallest rank is looked up by a scan, its boundary is deleted and the two
neighbouring ranks are refreshed, until no pair has a rank.  Scanning is quadratic, so
words above ``SHORT`` bytes take their smallest pair from a heap over linked parts.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from clickloom.llm.scratch import map_texts, texts
from clickloom.llm.tokens import CACHE_ENTRIES, Generations, vocabulary

VOCABULARY = "byte_bpe_50k.json"
SHORT = 96
NONE = 1 << 30


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte in the vocabulary file: printable Latin-1 bytes
    stand for themselves, the others for the code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairCodec:
    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from public_tokenizers import PATTERN
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        alphabet, model = byte_alphabet(), stored["model"]
        raw = lambda token: bytes(alphabet[c] for c in token)
        size = 1 + max([*model["vocab"].values(), *(t["id"] for t in stored["added_tokens"])])
        self._bytes: list[bytes] = [b""] * size
        for token, number in model["vocab"].items():
            self._bytes[number] = raw(token)
        self._special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        for token, number in self._special.items():
            self._bytes[number] = token.encode()
        self._first = [model["vocab"][c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        self._rank: dict[int, int] = {}
        self._merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._rank[model["vocab"][left] << 20 | model["vocab"][right]] = rank
            self._merged.append(model["vocab"][left + right])
        self._word = regex.compile(PATTERN)
        # A word starts before a blank that a visible character follows, wherever it
        # stands, so text may be cut there before the pattern is applied.
        self._odd = re.compile(r" (?:\s|\Z)")
        self._cut = re.compile(r"(?= \S)")
        self._split = re.compile("(" + "|".join(map(re.escape, self._special)) + ")")
        self._known = Generations(entries)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian uint32."""
        if not any(token in text for token in self._special):
            return self._plain(text)
        return b"".join(np.array([self._special[part]], "<u4").tobytes()
                        if part in self._special else self._plain(part)
                        for part in self._split.split(text))

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self._bytes.__getitem__, numbers)).decode("utf-8", "replace")

    def _plain(self, text: str) -> bytes:
        if self._odd.search(text):
            chunks = self._cut.split(text)
        else:
            first, *rest = text.split(" ")
            chunks = [first, *[" " + x for x in rest]]
        known = self._known
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            known.age()
        for chunk in set(chunks):
            if chunk in known:
                continue
            if chunk in known.old:
                known[chunk] = known.old[chunk]
                continue
            ids: list[int] = []
            for word in self._word.findall(chunk):
                ids += self.merge(word.encode())
            known[chunk] = np.array(ids, "<u4").tobytes()
        return b"".join(map(known.__getitem__, chunks))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word of the splitting pattern."""
        parts = [self._first[b] for b in word]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        look, merged = self._rank.get, self._merged
        ranks = [look(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            at = ranks.index(least)
            parts[at:at + 2] = [merged[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = look(parts[at - 1] << 20 | parts[at], NONE)
            if at < len(ranks):
                ranks[at] = look(parts[at] << 20 | parts[at + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, for words where scanning would be slow."""
        look, end = self._rank.get, len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(end - 1)
                if (r := look(parts[i] << 20 | parts[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        gone = [False] * end

        def offer(i: int) -> None:
            j = after[i]
            if j < end and (r := look(parts[i] << 20 | parts[j], NONE)) != NONE:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= end or parts[i] != left or parts[j] != right:
                continue
            parts[i], gone[j] = self._merged[rank], True
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p, dead in zip(parts, gone) if not dead]


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian uint32 bytes), decoded (text of those ids).

    Null text counts as empty and has no ids.  The strings of special tokens become their
    id.  Other columns are ignored; repeated rows give repeated results.
    """
    path = path or vocabulary(VOCABULARY)

    def prepare():
        own = codec(path)

        def run(batch: list[str]) -> dict[str, list]:
            ids = [own.encode(t) for t in batch]
            return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids,
                    "decoded": [own.decode(x) for x in ids]}

        return run

    return map_texts(texts(docs, id_col, text_col), prepare,
                     "n_tokens bigint, ids binary, decoded string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            path: str | None = None) -> DataFrame:
    """As ``encode``, with SHA-256 digests made beside the ids instead of the ids and text,
    which would cross to the JVM only to be hashed there."""
    path = path or vocabulary(VOCABULARY)

    def prepare():
        own = codec(path)

        def run(batch: list[str]) -> dict[str, list]:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in batch:
                ids = own.encode(text)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            return out

        return run

    return map_texts(texts(docs, id_col, text_col), prepare,
                     "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
