"""Secret scans: fixed patterns, and strings that compression finds new in a sensitive place.

Base kinds are patterns.  The method looks at long unbroken strings near a sensitive word
and measures, with zstandard primed by a dictionary of identifiers, how many bytes the
string adds to its surroundings.  Names and prose share pieces with both and add little;
random keys add as much as other random strings of their length and alphabet and are
reported as ``novel``.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import arrow_rows, in_parts, map_texts, stored, texts

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

# Words near which a long string may be a secret.
SENSITIVE = ("passphrase", "password", "passwd", "credential", "private key", "private_key",
             "access key", "access_key", "auth", "bearer", "secret", "token", "api key",
             "api_key", "apikey", "signature", "encryption key")
_CONTEXT = re.compile("|".join(map(re.escape, sorted(SENSITIVE, key=len, reverse=True))),
                      re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~.$-]{16,}")
REACH = 48          # characters between a sensitive word and a candidate
AROUND = 512        # characters of surroundings on either side
NOVEL = 0.8         # share of a random string's marginal bytes from which a string is new
PLENTY = 0.85       # marginal bytes a character that are enough, unless of letters only
CONTROLS = 4        # random strings of the same length and alphabet to compare with
ROWS = 512          # whole rows handed to Python at once when masking
LONG = 4096         # characters of the longest of them; beyond, the need grows with the length

# Alphabets of random strings, the smallest first; other characters are added as they occur.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = tuple(sorted(
    (_DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _DIGITS + "abcdefABCDEF", _LOWER, _UPPER,
     _LOWER + "234567", _UPPER + "234567", _LOWER + _DIGITS, _UPPER + _DIGITS, _LOWER + _UPPER,
     _LOWER + _UPPER + _DIGITS), key=len))

# Common pieces of program identifiers that prime the compressor.
IDENTIFIERS = tuple((
    "access account address admin api app application array async auth authorization base "
    "batch block boolean buffer build byte cache callback channel check class client cloud "
    "code column command config connection console content context controller count create "
    "credential current data database date default delete device document domain email "
    "encoding endpoint engine environment error event exception export factory field file "
    "filter format function get global group handler hash header host http id image import "
    "index info input instance interface item json key label library limit link list load "
    "local location lock log login manager map master memory message metadata method model "
    "module name network node null number object option order output page parameter parent "
    "parse password path payload permission plugin policy port prefix private process "
    "profile project property provider proxy public query queue read record refresh region "
    "remote request reset resource response result role root route rule runtime schema "
    "secret security select send server service session set size source stack start state "
    "static status storage store stream string system table tag target task template test "
    "thread time token tool type update upload url user value version view web write").split())


class Novelty:
    """Marginal compressed bytes per character of a string in its surroundings."""

    def __init__(self, identifiers: tuple[str, ...] = IDENTIFIERS):
        forms = " ".join([*identifiers, *map(str.capitalize, identifiers),
                          *map(str.upper, identifiers)])
        primed = zstandard.ZstdCompressionDict(forms.encode(), zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(level=9, dict_data=primed)

    def of(self, text: str, start: int, end: int) -> float:
        string = text[start:end]
        around = surroundings(text, start, end).encode()
        size = lambda data: len(self._compressor.compress(data))
        return max(0, size(around + string.encode()) - size(around)) / len(string)

    def share(self, text: str, start: int, end: int) -> tuple[float, float]:
        """Bytes per character, and their share of what random strings add at this place.

        What a random string adds depends on its alphabet, its length and the surroundings;
        compared with others like it, it reaches about 1.
        """
        string = text[start:end]
        around = surroundings(text, start, end).encode()
        base = len(self._compressor.compress(around))
        added = lambda s: max(0, len(self._compressor.compress(around + s.encode())) - base)
        own, size = added(string), min(len(string), LONG)
        need = sum(map(added, controls(alphabet(string), size))) / CONTROLS * len(string) / size
        if not string.isalpha():
            need = min(need, PLENTY / NOVEL * len(string))
        return own / len(string), own / max(need, 1)


def alphabet(string: str) -> str:
    """The smallest usual alphabet with the string's letters and digits, and its other characters."""
    marks = {c for c in string if not (c.isascii() and c.isalnum())}
    plain = set(string) - marks
    return next(a for a in ALPHABETS if plain <= set(a)) + "".join(sorted(marks))


@lru_cache(maxsize=256)
def controls(letters: str, size: int) -> list[str]:
    """Random strings, the same ones whenever asked for."""
    rng = random.Random(f"{size} {letters}")
    return ["".join(rng.choices(letters, k=size)) for _ in range(CONTROLS)]


def surroundings(text: str, start: int, end: int) -> str:
    """``AROUND`` characters on either side of a string, without its other occurrences.

    A copy nearby would make any string a back reference.  Of an assignment the value
    alone counts as a copy too.
    """
    string = text[start:end]
    copies = [string, *(p for p in string.split("=") if 16 <= len(p) < len(string))]
    before, left, at = [], AROUND, start
    while left > 0 and at > 0:
        low = max(0, at - left)
        found, size = max((text.rfind(c, max(0, low - len(c) + 1), at), len(c)) for c in copies)
        piece = text[max(low, found + size) if found >= 0 else low:at]
        before.append(piece)
        left -= len(piece) + 1
        at = found if found >= 0 else low
    after, left, at = [], AROUND, end
    while left > 0 and at < len(text):
        high = min(len(text), at + left)
        hits = [(f, len(c)) for c in copies if 0 <= (f := text.find(c, at, high + len(c) - 1))]
        found, size = min(hits, key=lambda x: (x[0], -x[1])) if hits else (-1, 0)
        piece = text[at:found if hits else high]
        after.append(piece)
        left -= len(piece) + 1
        at = found + size if hits else high
    return "".join(["\n".join(reversed(before)), "\n", "\n".join(after), "\n"])


def base_spans(text: str, lower: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and not overlapping per kind."""
    found = []
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text)
                  if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)
                  if len(m[0]) >= 20]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def _candidates(text: str, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(start, end) of the long strings near ``words``.

    A string that holds sensitive words is a candidate as a whole, if another word is near,
    and so is what follows or goes before a word in it.
    """
    if not words:
        return
    starts, ends = [s for s, _ in words], [e for _, e in words]

    def near(start: int, end: int) -> bool:
        last = bisect_right(ends, start) - 1
        following = bisect_left(starts, end)
        return (last >= 0 and start - ends[last] <= REACH
                or following < len(words) and starts[following] - end <= REACH)

    for run in _CANDIDATE.finditer(text):
        start, end = run.span()
        if near(start, end):
            yield start, end
        for i in range(bisect_right(ends, start), bisect_left(starts, end)):
            if end - ends[i] >= 16:
                yield ends[i], end
            if starts[i] - start >= 16:
                yield start, starts[i]


def scan(text: str, novelty: Novelty, least: float = NOVEL) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, novelty) by start, then kind; ends are exclusive code points.

    Base spans are reported whatever their novelty.  A candidate is a string of 16 or more
    characters up to ``REACH`` before or after a sensitive word that overlaps no base span
    and adds at least the share ``least`` of what a random string would; see ``Novelty``.
    Each distinct string is measured once, and all its places near a sensitive word count.
    """
    lower = text.lower()
    spans = base_spans(text, lower)
    taken = sorted(spans)
    extra: dict[tuple[int, int], tuple[float, float]] = {}
    measured: dict[str, tuple[float, float]] = {}
    words = [m.span() for m in _CONTEXT.finditer(text)] if any(w in lower for w in SENSITIVE) else []
    for start, end in _candidates(text, words):
        own = text[start:end].rstrip(".=-")
        span = (start, start + len(own))
        if len(own) < 16 or span in extra or any(s < span[1] and span[0] < e for s, e, _ in taken):
            continue
        if own not in measured:
            measured[own] = novelty.share(text, *span)
        extra[span] = measured[own]
    spans += [(s, e, "novel") for (s, e), (_, share) in extra.items() if share >= least]
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return [(k, s, e, extra[s, e][0] if k == "novel" else novelty.of(text, s, e)) for s, e, k in spans]


FOUND = "found array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = NOVEL) -> DataFrame:
    """doc_id and ``found`` (kind, start, end, novelty) of every row, in order of start.

    Null text counts as empty; a text without a find has an empty list.
    """
    def prepare():
        novelty = Novelty()
        return lambda batch: {"found": [
            [dict(zip(("kind", "start", "end", "novelty"), x)) for x in scan(t, novelty, least)]
            for t in batch]}

    return map_texts(texts(docs, id_col, text_col), prepare, FOUND)


def masked(text: str, spans: list[tuple[str, int, int, float]], mask: str = "[SECRET]") -> str:
    """``text`` with every span, and every run of overlapping spans, replaced by ``mask``."""
    out, at = [], 0
    for _, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars",
                 least: float = NOVEL) -> DataFrame:
    """``docs`` with the secrets in its texts masked; ``length_col``, if there, follows.

    Texts without a find, null ones included, and all other columns stay as they are.
    The result is stored: whole rows go to Python and back, so a few of them at a time.
    """
    import pyarrow as pa
    schema = docs.schema

    def run(batches):
        novelty = Novelty()
        for batch in in_parts(batches):
            old = batch.column(text_col).to_pylist()
            found = [scan(t, novelty, least) if t else [] for t in old]
            new = [masked(t, f) if f else t for t, f in zip(old, found)]
            batch = batch.set_column(batch.schema.get_field_index(text_col), text_col,
                                     pa.array(new, batch.schema.field(text_col).type))
            if length_col in batch.schema.names:
                kind = batch.schema.field(length_col).type
                sizes = [len(n) if f else s for n, f, s in
                         zip(new, found, batch.column(length_col).to_pylist())]
                batch = batch.set_column(batch.schema.get_field_index(length_col), length_col,
                                         pa.array(sizes, kind))
            yield batch

    with arrow_rows(docs.sparkSession, ROWS):
        return stored(docs.select(*[F.col(f"`{c}`") for c in docs.columns]).mapInArrow(run, schema),
                      "secrets-masked")
