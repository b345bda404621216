"""Token ids of whole texts with a vocabulary file of the tokenizers library.

Texts repeat their words, so the library encodes each distinct chunk once per worker and
a text's ids are its chunks' ids in a row.  Texts of Latin letters and common marks are cut
where the encoder itself cuts, so that a word is one chunk with whatever marks it stands;
others are cut at blanks, line ends and tabs only, where an encoder that drops white space
always ends a word.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Entries of one generation of a worker's cache.  A full generation becomes the old one,
# from which what is still used moves over: memory is bounded, common words stay.
CACHE_ENTRIES = 250_000
# Texts whose chunks are learnt together, in characters.
TOGETHER = 1 << 20
# The encoder's own rules, and its cuts by them for lower-cased texts without other characters than these:
# ASCII, letters of Latin-1 (each composed, with a lower case of one letter) and dashes and
# quotes that no normal form changes.
_OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ\u2010-\u2027]")
_RULES = ({"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"}]},
    {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "</w>")
_CUTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-zß-öø-ÿ0-9]+")


class Generations(dict):
    """A dict of bounded size; ``old`` is looked up by whoever finds a key missing."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.entries, self.old = entries, {}

    def age(self) -> None:
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkEncoder:
    """``ids(text)`` for an encoder that drops white space: little-endian uint32 bytes."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._known = Generations(entries)
        self._special = tuple(t.content for t in self._tokenizer.get_added_tokens_decoder().values())
        # Ids that end a word, which tells the words of a joined text apart.
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        rules = json.loads(self._tokenizer.to_str())
        self._cuts = (rules["normalizer"], rules["pre_tokenizer"]["pretokenizers"][0]["pattern"],
                      rules["model"]["end_of_word_suffix"]) == _RULES

    def ids(self, text: str) -> bytes:
        return next(self.ids_of([text]))

    def ids_of(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text; chunks of about ``TOGETHER`` characters are learnt at once."""
        cut: list[list[str]] = []
        words, others, size = set(), set(), 0
        for text in texts:
            if self._cuts and not _OTHER.search(text) and not any(t in text for t in self._special):
                cut.append(_CUTS.findall(text.lower()))
                words.update(cut[-1])
            else:
                cut.append(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
                others.update(cut[-1])
            size += len(text)
            if size >= TOGETHER:
                yield from self._looked_up(cut, words, others)
                cut, size = [], 0
                words, others = set(), set()
        yield from self._looked_up(cut, words, others)

    def _looked_up(self, cut: list[list[str]], words: set[str], others: set[str]) -> list[bytes]:
        known = self._known
        known.age()
        self._learn(self._unknown(words), self._unknown(others - words))
        return [b"".join(map(known.__getitem__, chunks)) for chunks in cut]

    def _unknown(self, chunks: set[str]) -> list[str]:
        known, old = self._known, self._known.old
        new = []
        for chunk in chunks.difference(known):
            if chunk in old:
                known[chunk] = old[chunk]
            else:
                new.append(chunk)
        return new

    def _learn(self, words: list[str], others: list[str]) -> None:
        known = self._known
        # One call for all words: the library's objects cost more than its merges.
        ids = np.array(self._encoded([" ".join(words)])[0], "<u4")
        ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
        if len(ends) == len(words):
            raw = ids.tobytes()
            known.update(zip(words, map(raw.__getitem__, map(slice, [0, *ends], ends))))
        else:
            others = others + words
        for chunk, found in zip(others, self._encoded(others)):
            known[chunk] = np.array(found, "<u4").tobytes()

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for ``path``, kept between batches and tasks."""
    return ChunkEncoder(path)
