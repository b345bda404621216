"""Main text of web pages by a site style tree.

Pages of a host are merged element by element: an element is its path of tags with class
names.  For every element of the merged tree two entropies are taken over the host's
pages: of the layouts it has (its children) and of the contents it has.  What looks and
reads the same on page after page, such as a menu, has a low importance and is removed;
an article's paragraphs differ and stay.  Elements whose tag or role says what they are
(navigation, forms, ...) need no statistics, and where a page marks its article, text
outside it is left out.  Class names are hints: one that sounds like noise (adverts,
comments, ...) makes an element unimportant unless it holds an article or most of the
page's varied text, and one that sounds like an article marks it only if it holds that.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import stored, text_of

# An element is judged on hosts with this many pages that have it, no fewer.  Below
# ENOUGH_PAGES the bound is lower, by one page's share.
LEAST_PAGES, ENOUGH_PAGES = 2, 8
# Contents of an element that count as repeated are on two pages, and on one in so many.
ONE_IN = 100
# Share of the host's own variety below which an element is noise.
LEAST_IMPORTANCE = 0.25
# Weight of contents against layouts in the importance.
CONTENT_WEIGHT = 0.9
# Share of a page's varied text that is most of it.
MOST = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|math|object|title|select)"
    r"(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>", re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "math q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
# Tags that close an open paragraph when they start.
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figure figcaption footer "
    "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
            "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table div article section body html".split())

NOISE_TAGS = frozenset("head nav aside footer button dialog menu input select".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu "
    "menubar toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disqus disclaimer footer masthead menu "
    "modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup promo promoted promotion related replies reply respond share sharing "
    "sidebar sidebars signup social sponsor sponsored subscribe subscription toolbar "
    "widget widgets".split())
MAIN_NAMES = frozenset("article articlebody entry post story".split())


@dataclass
class Element:
    tag: str
    path: str
    noise: bool
    main: bool
    block: bool
    # Numbers of the elements, itself and around it, whose names hint at noise or at an
    # article; noisy ones outside an article are in ``outer`` too.
    noisy: tuple[int, ...] = ()
    mainly: tuple[int, ...] = ()
    outer: tuple[int, ...] = ()
    # Path of the article it is in.
    root: str = ""
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    path: str
    text: str
    noise: bool
    main: bool
    noisy: tuple[int, ...] = ()
    mainly: tuple[int, ...] = ()
    outer: tuple[int, ...] = ()
    root: str = ""


def _names(value: str) -> set[str]:
    return set(_NAME.findall(_CAMEL.sub(" ", value).lower()))


def parse(html: str) -> tuple[list[Block], list[Element]]:
    """Text blocks in page order, and the elements of the page.

    A block is the text between two starts or ends of block-level elements, with character
    references decoded and white space turned into single spaces.
    """
    root = Element("#root", "", False, False, True)
    stack, blocks, elements = [root], [], []
    pending: list[str] = []

    def holder() -> Element:
        return next(e for e in reversed(stack) if e.block)

    def flush() -> None:
        if pending:
            text = " ".join("".join(pending).split())
            pending.clear()
            if text:
                own, last = holder(), stack[-1]
                blocks.append(Block(own.path, text, last.noise, own.main, last.noisy,
                                    last.mainly, last.outer, own.root))

    def apart(element: Element, parent: Element) -> bool:
        return element.noise > parent.noise or len(element.noisy) > len(parent.noisy)

    def close(index: int) -> None:
        # What an inline advert or the like holds is kept apart from the text around it.
        if any(e.block for e in stack[index:]) or apart(stack[index], stack[index - 1]):
            flush()
        del stack[index:]

    def open_index(tags: set[str] | frozenset[str], stop: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stop:
                break
        return 0

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            pending.append(unescape(html[at:token.start()]))
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if token["end"]:
            found = open_index({tag}, frozenset())
            if found:
                # An inline end tag does not reach across a block.
                if tag not in INLINE or not any(e.block for e in stack[found + 1:]):
                    close(found)
            elif tag == "p" or tag not in INLINE:
                flush()
            continue
        if tag == "br" or tag == "hr":
            pending.append(" ")
        block = tag not in INLINE
        if block:
            flush()
        if tag in CLOSES_P and (i := open_index({"p"}, SCOPES)):
            close(i)
        if tag in SIBLINGS and (i := open_index(SIBLINGS[tag], SCOPES)):
            close(i)
        if tag in VOID:
            continue
        element = _element(tag, token["attrs"] or "", stack[-1], block, at)
        holder().children.append(element.path[element.path.rfind("/"):])
        if block:
            elements.append(element)
        if not (token["attrs"] or "").endswith("/") or tag not in INLINE:
            if apart(element, stack[-1]):
                flush()
            stack.append(element)
    if at < len(html):
        pending.append(unescape(html[at:]))
    flush()
    return blocks, [e for e in elements if e.tag not in ("html", "head", "body")]


def _element(tag: str, attrs: str, parent: Element, block: bool,
             number: int) -> Element:
    found: dict[str, str] = {}
    if attrs:
        for name, *values in _ATTRIBUTE.findall(attrs):
            found.setdefault(name.lower(), next((v for v in values if v), ""))
    label = f"{found.get('class', '')} {found.get('id', '')}".strip()
    names = _names(label) if label else set()
    role = found.get("role", "").lower()
    main = parent.main or tag in ("article", "main") or role in ("main", "article")
    noise = (parent.noise or tag in NOISE_TAGS or role in NOISE_ROLES
             or (tag == "header" and not parent.main)
             or "hidden" in attrs.lower().split() or found.get("aria-hidden") == "true")
    noisy, mainly, outer = parent.noisy, parent.mainly, parent.outer
    if tag not in ("html", "body", "main"):
        likely = tag in ("div", "section") and names & MAIN_NAMES and not names & NOISE_NAMES
        if likely:
            mainly += (number,)
        # A form may be wrapped around a whole page.
        if names & NOISE_NAMES or tag == "form" or (names & {"header"} and not (main or mainly)):
            noisy += (number,)
            outer += () if main else (number,)
    step = tag + "".join("." + _DIGITS.sub("#", n).replace("/", "|") for n in sorted(label.split()))
    path = f"{parent.path}/{step}"
    return Element(tag, path, bool(noise), main, block, noisy, mainly, outer,
                   parent.root or (path if main else ""))


def host_of(url: Column) -> Column:
    """Lower-case host of a url, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^(?:[A-Za-z][\w+.-]*:)?//([^/?#]*)", 1)),
                      F.lit(""))


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def style_counts(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, kind (layout or content), value, n: the pages with each style of an element.

    ``low`` and ``high`` are the smallest and largest digest of these pages' texts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, int, int, int]] = []
            for host, html in zip(batch.column("host").to_pylist(),
                                  batch.column("html").to_pylist()):
                blocks, elements = parse(html)
                merged: dict[str, tuple[list[str], list[str]]] = {}
                for e in elements:
                    layout = merged.setdefault(e.path, ([], []))[0]
                    # A paragraph more or less is no other layout.
                    layout += [c for i, c in enumerate(e.children)
                               if not i or c != e.children[i - 1]]
                for b in blocks:
                    # The content of an element is all text below it.
                    steps = b.path.split("/")
                    for i in range(2, len(steps) + 1):
                        if own := merged.get("/".join(steps[:i])):
                            own[1].append(b.text)
                page = _digest("\n".join(b.text for b in blocks))
                out.append((host, "/", 0, page, page))
                out += [(host, path, _digest("|".join(layout)), _digest("\n".join(content)), page)
                        for path, (layout, content) in merged.items()]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(),
                                                          pa.int64(), pa.int64()))],
                ["host", "path", "layout", "content", "page"])

    seen = (pages.select(host_of(F.col(url_col)).alias("host"), text_of(html_col).alias("html"))
            .mapInArrow(run, "host string, path string, layout bigint, content bigint, page bigint"))
    # Equal styles are counted before anything is gathered by host: a host with a third of
    # all pages is combined in the map tasks and split by path.
    return (seen.selectExpr("host", "path", "page", "stack(2, 'layout', layout, 'content', content) "
                                                    "AS (kind, value)")
            .groupBy("host", "path", "kind", "value")
            .agg(F.count("*").alias("n"), F.min("page").alias("low"), F.max("page").alias("high")))


def style_tree(counts: DataFrame) -> DataFrame:
    """host, path, pages, content and layout entropy (0 to 1), copies of the merged elements.

    Entropies are in the base of the number of pages that have the element: 0 if all of
    them agree, 1 if no two do.  ``copies`` tells that these pages have all the same text.
    The path ``/`` stands for the whole page.
    """
    n = F.col("n").cast("double")
    by_path = counts.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("pages"), F.sum(n * F.log(n)).alias("n_log_n"),
        (F.min("low") == F.max("high")).alias("copies"))
    entropy = F.expr("""CASE WHEN pages > 1
                        THEN greatest(0D, (ln(pages) - n_log_n / pages) / ln(pages)) ELSE 0D END""")
    value = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("entropy"))).alias(kind)
    return (by_path.withColumn("entropy", entropy).groupBy("host", "path")
            .agg(F.max("pages").alias("pages"), value("content"), value("layout"),
                 F.max("copies").alias("copies")))


def low_importance(tree: DataFrame, counts: DataFrame, least_pages: int = LEAST_PAGES,
                   least: float = LEAST_IMPORTANCE) -> DataFrame:
    """host, low, repeats: the paths to remove, and their contents (path, value) that repeat.

    Importance is the weighted entropy over the entropy of the host's whole pages, so a
    host whose pages are copies of each other loses nothing, nor does an element that only
    copies of one page have.
    """
    whole = (tree.where("path = '/' AND pages > 1 AND content > 0")
             .select("host", F.col("content").alias("variety")))
    importance = (CONTENT_WEIGHT * F.col("content") + (1 - CONTENT_WEIGHT) * F.col("layout"))
    bound = F.expr(f"{least}D * IF(pages < {ENOUGH_PAGES}, 1 - 1 / pages, 1D)")
    low = (tree.where((F.col("path") != "/") & (F.col("pages") >= least_pages) & ~F.col("copies"))
           .join(whole, "host").where(importance < bound * F.col("variety"))
           .select("host", "path", "pages"))
    repeats = (counts.where("kind = 'content' AND n > 1").join(low, ["host", "path"])
               .where(f"n * {ONE_IN} >= pages").groupBy("host")
               .agg(F.collect_list(F.struct("path", "value")).alias("repeats")))
    return (low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low"))
            .join(repeats, "host", "left"))


def main_text(html: str, low: frozenset[str],
              repeats: frozenset[tuple[str, int]] = frozenset()) -> str:
    """Text of the blocks that stay, in page order.

    An element with a noisy name is left out with all below it, unless an article begins
    below it or it holds ``MOST`` of the text that is not noise or of low importance.  One
    with a main name marks the article only if it holds more than that.

    Within a marked article a low importance counts only for elements below it.  Plain
    paragraphs and headings, without a class, are left out only if what is repeated there
    is on this page too and is not ``MOST`` of the article.
    """
    blocks, _ = parse(html)
    kept = [b for b in blocks if not b.noise]
    if low:
        contents: dict[str, list[str]] = {}
        for b in blocks:
            for path in _under(b.path, low):
                contents.setdefault(path, []).append(b.text)
        same = {path for path, own in contents.items() if (path, _digest("\n".join(own))) in repeats}
        plain = lambda b: b.main and "." not in b.path.rsplit("/", 1)[-1]
        kept = [b for b in kept if plain(b) or not _under(b.path, low, b.root)]
        gone = {id(b) for b in kept if plain(b) and _under(b.path, same, b.root)}
        size = sum(len(b.text) for b in kept if id(b) in gone)
        if size < MOST * sum(len(b.text) for b in kept if b.main):
            kept = [b for b in kept if id(b) not in gone]
    holds: Counter[int] = Counter()
    for b in kept:
        for number in b.noisy:
            holds[number] += len(b.text)
    around = {n for b in blocks if b.main and not b.noise for n in b.outer}
    most = MOST * sum(len(b.text) for b in kept)
    noise = {n for n, size in holds.items() if size < most and n not in around}
    kept = [b for b in kept if noise.isdisjoint(b.noisy)]
    if any(b.main and not b.noise and noise.isdisjoint(b.noisy) for b in blocks):
        return " ".join(b.text for b in kept if b.main)
    holds = Counter()
    for b in kept:
        for number in b.mainly:
            holds[number] += len(b.text)
    most = MOST * sum(len(b.text) for b in kept)
    main = {n for n, size in holds.items() if size > most}
    return " ".join(b.text for b in kept if not main or not main.isdisjoint(b.mainly))


def _under(path: str, low: frozenset[str] | set[str], root: str = "") -> list[str]:
    """The paths in ``low`` of the element and its ancestors below ``root``."""
    steps = path.split("/")
    paths = ("/".join(steps[:i]) for i in range(2, len(steps) + 1))
    return [p for p in paths if p in low and len(p) > len(root)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null html counts as empty and gives an empty text.  Pages without a host are judged
    as one host.  Repeated rows give repeated results.
    """
    counts = stored(style_counts(pages, url_col, html_col), "style-counts")
    low = stored(low_importance(style_tree(counts), counts), "style-tree")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        host_of(F.col(url_col)).alias("host"), text_of(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(html, frozenset(paths or ()),
                               frozenset((r["path"], r["value"]) for r in repeats or ()))
                     for html, paths, repeats in zip(*(batch.column(c).to_pylist()
                                                       for c in ("html", "low", "repeats")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (rows.join(low, "host", "left").select("page_id", "url", "html", "low", "repeats")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
