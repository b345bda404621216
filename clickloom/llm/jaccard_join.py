"""N-gram Jaccard join by prefix trees, and the components its links make.

A document is the set of its word n-grams, each a 64-bit hash, in one global order.  The
join looks for pairs of sets with ``|x & y| >= t * |x | y|``.

Distribution.  Such a pair of sizes a and b differs in at most (a + b)(1 - t)/(1 + t)
n-grams.  Dealt into more parts than that by hash, the two sets agree on at least one
whole part, that is: in the tree that begins with this part they run along the same
prefix.  Documents therefore meet by (size class, part, contents of the part).  N-grams
that many documents share bring nobody together unless a whole part is shared.

Verification.  The sets to be compared with one set are stored in a trie.  A walk carries
the overlap so far, which sets with a common beginning share, and leaves a subtree when
what remains of it and of the other set cannot reach the needed overlap.

Pairs.  Equal sets are one class from the start.  In a group of classes that share a
prefix, all are compared with the first.  A group whose others still span several
components afterwards is open: they are dealt into blocks, and each block meets every
block.  They first meet as bitmaps, about an eighth to a quarter byte an n-gram; only
those that may be near one of another component go on with their whole sets.  There a
block's sets are a trie, and those of the other block walk through it, leaving subtrees
that hold only their own component.  A walk joins components as it finds links, so it
tells at most one link less than it has components, however many pairs are near.

Turns.  Near sets share many prefixes and so meet in many open groups.  First one group of
each set is walked, the one that comes first by hash, which sets alike choose alike.  Its
links join components before the other groups are looked at, and no pair that has met in
a group that was walked counts again.  What the same sets are left of is walked once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import arrow_rows, map_texts, removed, stored, texts

WORDS = 4
# Similarity as a share of whole numbers, so that the comparison is exact.
LEAST, OF = 85, 100
# 64-bit words of the parity bitmap; a fine one has as many bits as the set n-grams, at least.
BITMAP = 16
# Partitions of the n-grams by different hashes, see ``signatures``.
SCHEMES = 6
# Sets of an open group in one trie, on average.
BLOCK = 192
# Turns in which one open group of each set is walked, before all that are left.
FIRST_TURNS = 1
# n-grams of one trie node.
NODE = 16
# Rows handed to Python at once; a row may hold two whole sets or a long text.
ROWS = 512
# Ids up to which the documents to verify are looked up by a broadcast; beyond, by a join.
LOOKUP = 200_000
_CACHE = 150_000

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * _M[3]
    h = (h ^ (h >> np.uint64(27))) * _M[4]
    return h ^ (h >> np.uint64(31))


def _seed(number: int) -> np.uint64:
    return np.uint64(number * int(_M[1]) & (1 << 64) - 1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_WORD = _WordHashes()


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Distinct n-grams of the lower-cased (A-Z) words as ascending hashes.

    Words are cut at ``[\\x20\\x09-\\x0D]``.  Fewer than ``size`` words are one n-gram; no
    words, none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = np.fromiter(map(_WORD.__getitem__, words), np.uint64, len(words))
    n = len(one) - size + 1
    mixed = one[:n].copy()
    for i in range(1, size):
        mixed = _mix(mixed + _M[0]) + one[i:i + n]
    return np.unique(_mix(mixed))


@lru_cache(maxsize=None)
def _upper(k: int, least: int, of: int) -> int:
    """Largest size of class k.  A set's partners are in its own or a neighbouring class."""
    top = 0
    for _ in range(k):
        top = (top + 1) * of // least
    return top


def size_class(n: int, least: int = LEAST, of: int = OF) -> int:
    k = 1
    while _upper(k, least, of) < n:
        k += 1
    return k


def most_different(total: int, least: int = LEAST, of: int = OF) -> int:
    """Largest symmetric difference of linked sets whose sizes add up to ``total``."""
    return total * (of - least) // (of + least)


@lru_cache(maxsize=None)
def _dealing(level: int, least: int, of: int) -> tuple[int, int]:
    """Parts of a level, and how many more they are than n-grams may differ.

    The parts beyond make up for empty ones: as many as the smallest set of the level is
    expected to leave, and three deviations.  More parts leave more of them empty, so a
    small level may reach no such number; it takes the one with most deviations to spare.
    """
    differ = most_different(2 * _upper(level, least, of), least, of)
    smallest, best = _upper(max(level - 2, 0), least, of) + 1, (-np.inf, -1)
    if not differ:
        return 1, 1
    for room in range(1, 2 * (differ + 8)):
        parts = differ + room
        empty = parts * (1 - 1 / parts) ** smallest
        spare = (room - 1 - empty) / max(empty, 1e-9) ** 0.5
        best = max(best, (min(spare, 3), -room))
    room = -best[1]
    return differ + room, room


def signatures(grams: np.ndarray, least: int = LEAST, of: int = OF) -> np.ndarray:
    """Prefix keys; two linked sets share at least one.

    A set of class c meets its own class and smaller partners at level c, and larger ones
    at level c + 1.  At a level the n-grams are dealt into ``room`` parts more than may
    differ.  Parts that are empty give no key; a set with at most ``room - 1`` empty parts
    agrees with each partner on one that is not.  Sets with more of them (chance; few)
    are dealt again by another hash, where they meet each other, and in the last scheme
    their empty parts are keys as well.
    """
    if not len(grams):
        return np.empty(0, np.uint64)
    own, found = size_class(len(grams), least, of), []
    for level in (own, own + 1):
        parts, room = _dealing(level, least, of)
        for scheme in range(SCHEMES):
            dealt = _mix(grams + _seed(scheme + 1))
            part = (dealt % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            numbers, starts = np.unique(part[order], return_index=True)
            contents = np.add.reduceat(_mix(grams ^ _M[2])[order], starts)
            empty = parts - len(numbers)
            last = scheme == SCHEMES - 1
            if last and empty >= room:
                full = np.zeros(parts, np.uint64)
                full[numbers] = contents
                numbers, contents = np.arange(parts), full
            place = _seed(level * SCHEMES + scheme) + numbers.astype(np.uint64)
            found.append(_mix(_mix(place) + contents))
            if empty < room or last:
                break
    return np.concatenate(found)


def bitmap(grams: np.ndarray, words: int = BITMAP) -> np.ndarray:
    """Parities of the n-grams by hash: as many bits differ as sets do, at most.

    ``words`` is a power of two; the halves of a bitmap give the next smaller one.
    """
    bits = np.bincount((grams & np.uint64(64 * words - 1)).astype(np.int64),
                       minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def fine_bitmap(grams: np.ndarray) -> np.ndarray:
    words = BITMAP
    while 64 * words < len(grams):
        words *= 2
    return bitmap(grams, words)


def _key(grams: np.ndarray) -> int | None:
    """Signed 64-bit name of a set; None for the empty one."""
    if not len(grams):
        return None
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64)))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """doc_id, key, n, bits: each document's set by name, size and bitmap."""
    def prepare():
        def run(batch: list[str]) -> dict[str, list]:
            sets = [shingles(t, size) for t in batch]
            return {"key": [_key(s) for s in sets], "n": [len(s) for s in sets],
                    "bits": [bitmap(s) for s in sets]}
        return run

    return map_texts(texts(docs, id_col, text_col), prepare,
                     "key bigint, n bigint, bits array<bigint>")


def _signed(docs: DataFrame, id_col: str, text_col: str, size: int, least: int,
            of: int) -> DataFrame:
    """key, sig: the prefixes of the sets; a task leaves out sets that it has seen."""
    def prepare():
        seen: set[int | None] = set()

        def run(batch: list[str]) -> dict[str, list]:
            keys, sigs = [], []
            for grams in (shingles(t, size) for t in batch):
                key = _key(grams)
                new = key not in seen
                if new:
                    if len(seen) >= _CACHE:
                        seen.clear()
                    seen.add(key)
                keys.append(key)
                sigs.append((signatures(grams, least, of) if new else grams[:0]).view(np.int64))
            return {"key": keys, "sigs": sigs}
        return run

    return (map_texts(texts(docs, id_col, text_col), prepare, "key bigint, sigs array<bigint>",
                      carry=())
            .select("key", F.explode("sigs").alias("sig")))


def _prefixes(docs: DataFrame, id_col: str, text_col: str, size: int, least: int,
              of: int) -> DataFrame:
    """sig, key, hub: classes that share a prefix with a smaller one, the hub."""
    # Equal sets are combined before the shuffle: a class of any size reaches a signature's
    # task as one row per map task.
    keyed = _signed(docs, id_col, text_col, size, least, of)
    # A running first value and the row before: the window streams over a sorted group.
    return keyed.selectExpr(
        "sig", "key", "first(key) OVER (PARTITION BY sig ORDER BY key) AS hub",
        "lag(key) OVER (PARTITION BY sig ORDER BY key) AS before"
    ).where("key <> hub AND key <> before").drop("before")


def _may_link(a: str, b: str, least: int, of: int) -> Column:
    differ = " + ".join(f"bit_count({a}.bits[{i}] ^ {b}.bits[{i}])" for i in range(BITMAP))
    return F.expr(f"""{of} * least({a}.n, {b}.n) >= {least} * greatest({a}.n, {b}.n)
        AND {differ} <= ({a}.n + {b}.n) * {of - least} DIV {of + least}""")


class _Node:
    __slots__ = ("children", "components", "ends", "longest", "shortest")

    def __init__(self):
        self.children: dict[bytes, _Node] = {}
        self.ends: list[int] = []
        self.components: set[int] = set()
        self.longest, self.shortest = 0, 1 << 60


def build_trie(sets: list[np.ndarray]) -> _Node:
    """Sets in global order, ``NODE`` n-grams to an edge."""
    root = _Node()
    for number, grams in enumerate(sets):
        raw, node = grams.tobytes(), root
        for at in range(0, len(raw), 8 * NODE):
            node.longest, node.shortest = max(node.longest, len(grams)), min(node.shortest, len(grams))
            node = node.children.setdefault(raw[at:at + 8 * NODE], _Node())
        node.longest, node.shortest = max(node.longest, len(grams)), min(node.shortest, len(grams))
        node.ends.append(number)
    return root


def _walk(own: np.ndarray, root: _Node, least: int, of: int, leave: Callable[[_Node], bool],
          wanted: np.ndarray | None = None) -> Iterator[int]:
    """Numbers of the sets in the trie that are linked with ``own``.

    Subtrees are left where ``leave`` says so or the overlap cannot be reached any more.
    """
    walk = [(root, 0, 0)]
    while walk:
        node, depth, overlap = walk.pop()
        # Overlap needed with the shortest set below, and what can still come at best.
        need = -(-least * (len(own) + node.shortest) // (of + least))
        if overlap + min(node.longest - depth, len(own) - overlap) < need or leave(node):
            continue
        if (of + least) * overlap >= least * (len(own) + depth):
            yield from (i for i in node.ends if wanted is None or wanted[i])
        for edge, child in node.children.items():
            grams = np.frombuffer(edge, np.uint64)
            at = np.minimum(np.searchsorted(own, grams), len(own) - 1)
            walk.append((child, depth + len(grams),
                         overlap + int(np.count_nonzero(own[at] == grams))))


def trie_links(own: np.ndarray, root: _Node, least: int = LEAST, of: int = OF) -> list[int]:
    return list(_walk(own, root, least, of, lambda node: False))


# A class as a vertex of the graph of links: ordered by its smallest id, null ids last, so
# that the least node of a component has the component's smallest id.
_VERTEX = "struct(rep IS NULL AS none, rep AS rep, key AS key)"
_LINK = "a struct<none:boolean,rep:bigint,key:bigint>, b struct<none:boolean,rep:bigint,key:bigint>"

_NODE = pa.struct([("none", pa.bool_()), ("rep", pa.int64()), ("key", pa.int64())])


def _verified(pairs: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """a, b: the pairs (hub, key, and both as nodes) whose sets are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs = batch.column("hub").to_pylist()
            own, other = batch.column("hub_grams"), batch.column("grams")
            by_hub: dict[int, list[int]] = {}
            for i, hub in enumerate(hubs):
                by_hub.setdefault(hub, []).append(i)
            linked = []
            for rows in by_hub.values():
                trie = build_trie([np.frombuffer(other[i].as_py(), np.uint64) for i in rows])
                grams = np.frombuffer(own[rows[0]].as_py(), np.uint64)
                linked += [rows[i] for i in trie_links(grams, trie, least, of)]
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return (pairs.join(sets.select("key", "grams"), "key")
            .join(sets.select(F.col("key").alias("hub"), F.col("grams").alias("hub_grams")), "hub")
            .mapInArrow(run, _LINK))


def block_links(sets: list[np.ndarray], components: list, blocks: list[int], least: int = LEAST,
                of: int = OF) -> list[tuple[int, int]]:
    """Links (numbers of sets) between the components of two blocks, one per join of two.

    With two different numbers in ``blocks``, pairs inside a block are left to its own call.
    """
    names: dict = {}
    own = [names.setdefault(c, len(names)) for c in components]
    above = list(range(len(names)))

    def root(c: int) -> int:
        while above[c] != c:
            above[c] = c = above[above[c]]
        return c

    low, within = min(blocks), len(set(blocks)) == 1
    members = [i for i, b in enumerate(blocks) if b == low]
    trie = build_trie([sets[i] for i in members])
    _mark(trie, [own[i] for i in members])
    # Unsigned, as of a negative number numpy counts the bits of its absolute value.
    bits = np.array([bitmap(sets[i]) for i in members]).view(np.uint64)
    sizes = np.array([len(sets[i]) for i in members])
    found = []
    for walker, grams in enumerate(sets):
        if not within and blocks[walker] == low:
            continue
        differ = np.bitwise_count(bits ^ bitmap(grams).view(np.uint64)).sum(axis=1)
        total = sizes + len(grams)
        near = ((of * np.minimum(sizes, len(grams)) >= least * np.maximum(sizes, len(grams)))
                & (differ <= total * (of - least) // (of + least)))
        while near.any():
            here = root(own[walker])
            # A subtree that is not left may hold sets of the walker's own component, too.
            other = next((i for i in _walk(grams, trie, least, of, lambda node: all(
                root(c) == here for c in node.components), near)
                if root(own[members[i]]) != here), None)
            if other is None:
                break
            above[root(own[members[other]])] = here
            found.append((walker, members[other]))
    return found


def _mark(node: _Node, components: list[int]) -> set[int]:
    """Give every node the components of the sets below it."""
    stack, order = [node], []
    while stack:
        at = stack.pop()
        order.append(at)
        stack += at.children.values()
    for at in reversed(order):
        at.components = {components[i] for i in at.ends}.union(
            *(c.components for c in at.children.values()))
    return node.components


def _shared(lists: list) -> np.ndarray:
    """Which two of the lists (or None) have a number in common."""
    names: dict[int, int] = {}
    at = [(row, names.setdefault(x, len(names))) for row, own in enumerate(lists) for x in own or ()]
    holds = np.zeros((len(lists), len(names)), np.float32)
    if at:
        holds[tuple(np.array(at).T)] = 1
    return holds @ holds.T > 0


def may_be_near(sizes: np.ndarray, bitmaps: list[bytes], components: list, blocks: list[int],
                least: int = LEAST, of: int = OF, walked: list | None = None) -> np.ndarray:
    """Which sets may be linked with one of another component, by sizes and fine bitmaps.

    With two different numbers in ``blocks``, pairs inside a block do not count, nor do
    pairs that share one of the groups in ``walked`` (a list, or None, for each set).
    """
    names: dict = {}
    own = np.array([names.setdefault(c, len(names)) for c in components])
    side, within = np.array(blocks), len(set(blocks)) == 1
    widths, found = np.array([len(b) for b in bitmaps]), np.zeros(len(sizes), bool)
    new = ~_shared(walked or [None] * len(sizes))
    for width in np.unique(widths):
        wide = np.flatnonzero(widths >= width)
        folded = np.array([np.bitwise_xor.reduce(
            np.frombuffer(bitmaps[i], np.uint64).reshape(-1, width // 8)) for i in wide])
        for at in np.flatnonzero(widths[wide] == width):
            i, n = wide[at], sizes[wide[at]]
            may = np.flatnonzero(
                (own[wide] != own[i]) & (within | (side[wide] != side[i])) & new[i, wide]
                & (of * np.minimum(sizes[wide], n) >= least * np.maximum(sizes[wide], n)))
            differ = np.bitwise_count(folded[may] ^ folded[at]).sum(axis=1)
            near = may[differ <= (sizes[wide[may]] + n) * (of - least) // (of + least)]
            found[wide[near]] = True
            found[i] |= len(near) > 0
    return found


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``by``, a group at a time."""
    left = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if left is None else pa.concat_tables([left, rows])
        keys = np.stack([rows.column(c).to_numpy() for c in by])
        starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for start, end in zip(starts, starts[1:]):
            yield rows.slice(start, end - start)
        left = rows.slice(starts[-1])
    if left is not None and left.num_rows:
        yield left


_TASK = ["sig", "low", "high"]


def _dealt(members: DataFrame) -> DataFrame:
    """The members (sig, key, rep, component, blocks of its group) of every two blocks.

    A member goes to as many tasks (sig, low, high) as its group has blocks.
    """
    return members.withColumn("block", F.expr("pmod(xxhash64(key), blocks)")).selectExpr(
        "sig", "key", f"{_VERTEX} AS node", "component.key AS component", "block",
        "explode(transform(sequence(0L, blocks - 1), i -> "
        "struct(least(i, block) AS low, greatest(i, block) AS high))) AS pair").selectExpr(
        "sig", "pair.low", "pair.high", "key", "node", "component", "block")


def _close(dealt: DataFrame, sets: DataFrame, walked: DataFrame, least: int, of: int) -> DataFrame:
    """The rows of ``dealt`` that may be near one of another component in their task.

    They meet with their bitmaps.  Pairs that have met in a group of ``walked`` (key,
    walked) are left out.  Of tasks with the same members, one is kept.
    """
    told = dealt.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches, _TASK):
            # Each set once, as those that come twice cancel out in the names of tasks below.
            first = np.unique(rows.column("key").to_numpy(), return_index=True)[1]
            if len(first) < rows.num_rows:
                rows = rows.take(first)
            near = may_be_near(rows.column("n").to_numpy(), rows.column("bits").to_pylist(),
                               rows.column("component").to_pylist(),
                               rows.column("block").to_pylist(), least, of,
                               rows.column("walked").to_pylist())
            if near.any():
                yield from rows.select(told).filter(pa.array(near)).to_batches()

    close = stored(dealt.join(sets.select("key", "n", "bits"), "key").join(walked, "key", "left")
                   .repartition(*_TASK).sortWithinPartitions(*_TASK).mapInArrow(run, dealt.schema), "join-close")
    side = F.expr("low < high AND block = low")
    once = (close.groupBy(*_TASK).agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("key", side)).alias("all"),
        F.bit_xor(F.xxhash64("key", side, F.lit(1))).alias("all_again"))
        .groupBy("size", "all", "all_again").agg(F.min(F.struct(*_TASK)).alias("task"))
        .select("task.*"))
    return close.join(once, _TASK, "left_semi")


def _one_each(members: DataFrame) -> DataFrame:
    """Groups (sig) such that every set is in one of them: of each set, the first by hash."""
    return members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("sig"), "sig")).alias("first")).select("first.sig").distinct()


def _still_open(members: DataFrame, known: DataFrame) -> DataFrame:
    """``members`` with their components by ``known``, without groups of one component."""
    placed = (members.drop("component").withColumn("node", F.expr(_VERTEX))
              .join(known, "node", "left")
              .select("sig", "key", "rep", F.expr("coalesce(component, node)").alias("component"),
                      "blocks"))
    several = (placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
               .where("low <> high").select("sig"))
    return placed.join(several, "sig", "left_semi")


def _across(close: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """a, b: links that join components within the open groups, by the blocks of ``close``."""
    def run(table: pa.Table) -> pa.Table:
        found = block_links([np.frombuffer(g.as_py(), np.uint64) for g in table.column("grams")],
                            table.column("component").to_pylist(),
                            table.column("block").to_pylist(), least, of)
        nodes = table.column("node")
        return pa.table({name: pa.array([nodes[pair[i]].as_py() for pair in found], _NODE)
                         for i, name in enumerate("ab")})

    return (close.join(sets.select("key", "grams"), "key").groupBy(*_TASK)
            .applyInArrow(run, _LINK))


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str,
             size: int) -> DataFrame:
    """key, n, bits (fine bitmap), grams of the documents whose ids are ``wanted`` (rep)."""
    few = wanted.count() <= LOOKUP
    ids = F.broadcast(wanted) if few else wanted
    rows = texts(docs, id_col, text_col)
    chosen = rows.join(ids, rows["doc_id"].eqNullSafe(ids["rep"]), "left_semi")

    def prepare():
        def run(batch: list[str]) -> dict[str, list]:
            sets = [shingles(t, size) for t in batch]
            return {"key": [_key(s) for s in sets], "n": [len(s) for s in sets],
                    "bits": [fine_bitmap(s).tobytes() for s in sets],
                    "grams": [s.tobytes() for s in sets]}
        return run

    return map_texts(chosen, prepare, "key bigint, n bigint, bits binary, grams binary",
                     carry=()).where("key IS NOT NULL")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """node, component (least node reachable) of every node in ``links`` (a, b).

    Alternates star contractions; every round's edges are a stored table, which the next
    one replaces.  With ``rounds`` it stops early, and a component may still be in several
    parts.
    """
    edges = stored(links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v")
                   .distinct(), "join-edges")
    before, done = None, 0
    while done != rounds:
        done += 1
        # Every node's larger neighbours, then its smaller ones, move to its least neighbour.
        both = edges.union(edges.selectExpr("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        larger = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = (larger.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
                   .union(least.select("u", "m")).distinct())
        replaced, edges = edges, stored(smaller, "join-edges")
        removed(replaced)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.selectExpr("v AS node", "v AS component").distinct()
    return edges.selectExpr("u AS node", "v AS component").union(roots)


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` components (node, component) with more links (a, b)."""
    return stored(components(known.selectExpr("node AS a", "component AS b").union(links)),
                  "join-components")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = WORDS, least: int = LEAST, of: int = OF) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row.

    Two documents link if of * intersection >= least * union.  Null text counts as empty:
    no n-grams, no links, a component of its own.  Documents with equal sets are linked.
    Null ids count for the component only if it has no other.  Sets are told apart by a
    64-bit digest, n-grams by a 64-bit hash.
    """
    with arrow_rows(docs.sparkSession, ROWS):
        return _placed(docs, id_col, text_col, size, least, of)


def _placed(docs: DataFrame, id_col: str, text_col: str, size: int, least: int,
            of: int) -> DataFrame:
    """The rows of ``jaccard_join``; all that runs Python is stored here."""
    members = stored(shingle_sets(docs, id_col, text_col, size), "join-members")
    classes = stored(members.where("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")),
        "join-classes")
    groups = stored(_prefixes(docs, id_col, text_col, size, least, of), "join-prefixes")

    a, b = classes.alias("a"), classes.alias("b")
    node = lambda side: F.expr(_VERTEX.replace("rep AS", f"{side}.rep AS").replace(
        "rep IS", f"{side}.rep IS").replace("key AS", f"{side}.key AS"))
    pairs = stored(groups.select("hub", F.col("key").alias("other")).distinct()
                   .join(a, F.expr("hub = a.key")).join(b, F.expr("b.key = other"))
                   .where(_may_link("a", "b", least, of))
                   .select("hub", F.col("other").alias("key"), node("a").alias("a"),
                           node("b").alias("b")), "join-pairs")
    wanted = pairs.selectExpr("explode(array(a.rep, b.rep)) AS rep").distinct()
    sets = stored(_sets_of(docs, wanted, id_col, text_col, size), "join-sets")
    first = stored(_verified(pairs, sets, least, of), "join-links")
    removed(pairs, sets)

    known = stored(components(first), "join-components-hub")
    # All of a group have been compared with its hub, so that is left out.
    placed = (groups.select("sig", "key").join(classes.select("key", "rep"), "key").withColumn("node", F.expr(_VERTEX))
              .join(known, "node", "left")
              .selectExpr("sig", "key", "rep", "coalesce(component, node) AS component"))
    # Groups of several components; of those with the same members, one.
    open_groups = (placed.groupBy("sig").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("key")).alias("all"),
        F.bit_xor(F.xxhash64("key", F.lit(1))).alias("all_again"))
        .where("low <> high").groupBy("size", "all", "all_again").agg(F.min("sig").alias("sig"))
        .selectExpr("sig", f"(size + {BLOCK - 1}) DIV {BLOCK} AS blocks"))
    rest = stored(placed.join(open_groups, "sig"), "join-open")
    sets = stored(_sets_of(docs, rest.select("rep").distinct(), id_col, text_col, size),
                  "join-sets-open")
    # Linked sets meet in many groups.  One group of each set is walked first; of the others
    # what is still in several components, and has not met in a group before.
    walked = rest.select("key", F.array("sig").alias("walked")).limit(0)
    for turn in range(FIRST_TURNS + 1):
        now = rest
        if turn < FIRST_TURNS:
            chosen = stored(_one_each(rest), "join-chosen")
            now = rest.join(chosen, "sig", "left_semi")
        close = stored(_close(_dealt(now), sets, walked, least, of), "join-close-once")
        across = stored(_across(close, sets, least, of), "join-links-open")
        known = _joined(known, across)
        removed(close)
        if turn < FIRST_TURNS:
            met = now.select("key", F.array("sig").alias("walked")).union(walked)
            walked = stored(met.groupBy("key").agg(F.flatten(F.collect_list("walked")).alias("walked")),
                            "join-walked")
            before, rest = rest, stored(_still_open(rest.join(chosen, "sig", "left_anti"), known),
                                        "join-open")
            removed(before)
    removed(rest, sets)
    placed = (classes.select("key", "rep").withColumn("node", F.expr(_VERTEX))
              .join(known, "node", "left")
              .select("key", F.expr("coalesce(component, node).rep AS component_id")))
    return (members.select("doc_id", "n", "key").join(placed, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.expr("IF(key IS NULL, doc_id, component_id)").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
             least: int = LEAST, of: int = OF) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, columns unchanged.

    Rows with a null id stay, as nothing tells them apart.
    """
    mark = "__join_id"
    lost = stored(jaccard_join(docs, id_col, text_col, size, least, of)
                  .where("doc_id <> component_id").select(F.col("doc_id").alias(mark)).distinct(),
                  "join-lost")
    own = docs[id_col].cast("bigint")
    return docs.join(lost, own == lost[mark], "left_anti").select(*docs.columns)
