"""URL filters: rules first, and beyond them the purity of path templates.

Every host has a tree of path segments.  Level by level, from the first segment on,
segments of a node that vary are generalised into a wildcard of their shape.  Plain words
vary if a further page would likely bring a new one, which the share of values seen once
estimates; what holds digits varies if two pages would likely differ in it, however often
each value comes back.  Then sibling branches that are statistically alike, in what lies below them
and in their labels, are merged, from the deepest level up.  What is left are templates.

A page that a rule fits is labelled by it.  A template's purity is its share of blocked
pages, smoothed towards its parent's, that one's towards its own parent's, and so up to
the share over all pages; pages without a label count at that share.  Templates of a
purity of at least ``REJECT`` are rejected.

All of it is grouped counting: values are counted before nodes, templates before trees, so
that a host of any size is no more than one row per task and value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.scratch import stored

# (verdict, host, path) of the rules in force.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
# Levels of a tree; what lies deeper in a path is one segment, its last.
LEVELS = 12
# Pages that stand for what is expected of a shape: digits vary, plain words do not.
BEFORE, VARY, STAY = 8, 0.9, 0.1
# Smoothing pages of a purity, the share that is no evidence, and the bound of rejection.
SMOOTH, NEUTRAL, REJECT = 4, 0.5, 0.8
# Deviations from alike branches that chance may bring (1 in 100).
CHANCE = 2.326


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to a slash, ``?``, ``#`` or the end, A-Z lowered."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_of(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    # Ends with the longest, which so overrules the shorter ones.
    for decides, of_host, of_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        name = F.when(fits, of_host + of_path).otherwise(name)
        verdict = F.when(fits, decides).otherwise(verdict)
    return name, verdict


# A shape is what a segment's characters are like, and its extension.
_SHAPE = r"""concat(
  CASE WHEN stem RLIKE '^[0-9]+$' THEN '<digits>'
       WHEN stem RLIKE '^[0-9a-fA-F-]{8,}$' AND stem RLIKE '[0-9]' THEN '<hex>'
       WHEN stem RLIKE '[0-9]' THEN '<mixed>' ELSE '<word>' END, extension)"""


def _segments(path: Column) -> Column:
    found = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.concat(F.slice(found, 1, LEVELS - 1),
                    F.array(F.array_join(F.slice(found, LEVELS, 1 << 30), "/")))
    return F.when(F.size(found) > LEVELS, deep).otherwise(found)


def parsed(pages: DataFrame, rules=RULES, id_col: str = "page_id",
           url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict (of the rule), segments."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"))
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    return rows.select("*", rule.alias("rule"), verdict.alias("verdict"),
                       _segments(F.col("path")).alias("segments"))


def templates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``template``: constant segments as ``=value``, varying ones as shapes.

    One pass over the rows per level that occurs, at most ``LEVELS``.
    """
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    rows = rows.withColumn("template", F.expr("CAST(array() AS ARRAY<STRING>)"))
    for level in range(deepest):
        here = (rows.withColumn("segment", F.get("segments", F.lit(level)))
                .withColumn("extension", F.regexp_extract("segment", r"\.[A-Za-z0-9]{1,5}$", 0))
                .withColumn("stem", F.expr("left(segment, length(segment) - length(extension))"))
                .withColumn("shape", F.expr(_SHAPE)).drop("stem", "extension"))
        node = ["host", "template", "shape"]
        plain = F.col("shape").startswith("<word>")
        new, differ = F.expr("sum(IF(n = 1, 1L, 0L))"), F.expr("sum(n) - sum(n * double(n)) / sum(n)")
        expected = F.when(plain, STAY).otherwise(VARY)
        varying = (here.where("segment IS NOT NULL").groupBy(*node, "segment")
                   .agg(F.count("*").alias("n"))
                   .groupBy(*node).agg(F.sum("n").alias("pages"), F.when(plain, new).otherwise(differ).alias("vary"))
                   .where((F.col("vary") + BEFORE * expected) / (F.col("pages") + BEFORE) >= 0.5)
                   .select(*node, F.lit(True).alias("varies")))
        rows = stored(here.join(varying, node, "left").withColumn("template", F.expr("""
            CASE WHEN segment IS NULL THEN template WHEN varies THEN array_append(template, shape)
                 ELSE array_append(template, concat('=', segment)) END"""))
            .select(*rows.columns), f"url-level-{level}")
    return rows


def _critical(freedom: str) -> str:
    """Chi-square bound by Wilson and Hilferty, as SQL."""
    return f"{freedom} * pow(1 - 2 / (9 * {freedom}) + {CHANCE} * sqrt(2 / (9 * {freedom})), 3)"


def merged(trees: DataFrame) -> DataFrame:
    """``trees`` (host, template, pages, labelled, blocked) with ``merged``, the template after
    alike siblings became one.

    A branch is held against the pool of its siblings of the same tendency (mostly blocked,
    mostly allowed, mostly unlabelled): by how its pages are spread over what lies below,
    and over the labels.  Where neither differs beyond chance it joins the pool.
    """
    deepest = trees.agg(F.max(F.size("template"))).first()[0] or 0
    trees = trees.withColumn("merged", F.col("template"))
    for level in range(deepest, 0, -1):
        here = trees.where(F.size("merged") >= level).select(
            "host", F.slice("merged", 1, level - 1).alias("parent"),
            F.get("merged", F.lit(level - 1)).alias("branch"),
            F.expr(f"slice(merged, {level + 1}, {LEVELS})").alias("below"),
            "pages", "labelled", "blocked")
        branch, pool = ["host", "parent", "branch"], ["host", "parent", "tendency"]
        sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
        branches = here.groupBy(*branch).agg(*sums).withColumn("tendency", F.expr("""
            CASE WHEN 2 * labelled < pages THEN 'unknown'
                 WHEN 2 * blocked >= labelled THEN 'blocked' ELSE 'allowed' END"""))
        # What lies below, and the labels, as one list of categories of each branch.
        spread = (here.groupBy(*branch, F.array_append("below", F.lit("")).alias("category"))
                  .agg(F.sum("pages").alias("o"))
                  .unionByName(branches.selectExpr(*branch, """inline(array(
                      named_struct('category', array('blocked'), 'o', blocked),
                      named_struct('category', array('allowed'), 'o', labelled - blocked),
                      named_struct('category', array('unknown'), 'o', pages - labelled)))""")))
        spread = stored(spread.where("o > 0").join(
            branches.selectExpr(*branch, "tendency", "pages AS branch_pages"), branch),
            f"url-spread-{level}")
        pools = (spread.groupBy(*pool, "category").agg(F.sum("o").alias("pool_o")))
        whole = branches.groupBy(*pool).agg(F.sum("pages").alias("pool_pages"),
                                            F.count("*").alias("siblings"))
        kinds = pools.groupBy(*pool).agg(F.count("*").alias("kinds"))
        alike = (spread.join(pools, [*pool, "category"]).join(whole, pool)
                 .groupBy(*branch, "tendency", "siblings")
                 .agg(F.sum(F.expr("2 * o * ln(o * pool_pages / (branch_pages * pool_o))"))
                      .alias("g")).join(kinds, pool)
                 .where("siblings > 1")
                 # Two lists of categories, so two degrees fewer.
                 .where(f"g <= {_critical('greatest(kinds - 2, 1)')}")
                 .select(*branch, F.concat(F.lit("<like "), "tendency", F.lit(">")).alias("as")))
        moved = (trees.withColumn("parent", F.slice("merged", 1, level - 1))
                 .withColumn("branch", F.get("merged", F.lit(level - 1))))
        trees = stored(moved.join(alike, branch, "left").withColumn("merged", F.expr(f"""
            IF(`as` IS NULL, merged, concat(parent, array(`as`), slice(merged, {level + 1}, {LEVELS})))"""))
            .select(*trees.columns), f"url-merged-{level}")
    return trees


def purities(trees: DataFrame) -> DataFrame:
    """host, template, merged, purity of every template of ``merged``'s result."""
    whole = trees.agg(F.sum("labelled"), F.sum("blocked")).first()
    labelled, blocked = (x or 0 for x in whole)
    # A share above one half is no evidence against a template without labels of its own.
    prior = min((blocked + 1) / (labelled + 2), NEUTRAL)
    nodes = (trees.groupBy("host", "merged").agg(*(F.sum(c).alias(c) for c in (
        "pages", "labelled", "blocked"))))
    prefixes = nodes.select("host", "merged", F.posexplode(F.expr(
        "transform(sequence(0, size(merged)), i -> slice(merged, 1, i))")).alias("depth", "prefix"),
        "pages", "labelled", "blocked")
    # The node at which templates end counts apart from what goes on below it.
    counted = prefixes.groupBy("host", "prefix").agg(*(F.sum(c).alias(c) for c in (
        "pages", "labelled", "blocked")))
    chain = (prefixes.select("host", "merged", "depth", "prefix").join(counted, ["host", "prefix"])
             .select("host", "merged", F.struct("depth", "pages", "labelled", "blocked").alias("s"))
             .unionByName(nodes.select("host", "merged", F.struct(
                 (F.size("merged") + 1).alias("depth"), "pages", "labelled", "blocked").alias("s")))
             .groupBy("host", "merged").agg(F.array_sort(F.collect_list("s")).alias("chain")))
    step = f"""(s.blocked + {prior!r}D * (s.pages - s.labelled) + {SMOOTH} * p) / (s.pages + {SMOOTH})"""
    found = chain.select("host", "merged", F.expr(
        f"aggregate(chain, {prior!r}D, (p, s) -> {step})").alias("purity"))
    return trees.select("host", "template", "merged").join(found, ["host", "merged"])


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every page.

    ``rules`` are (verdict, host, path); of those that fit, the longest decides.  Where none
    fits, the page's template does.  A null url, or one without ``://``, has an empty host
    and path; its template is the empty path.  Ids are carried as they are, nulls and
    repeats too, and every row gets a verdict of its own; other columns are ignored.  No
    pages, no rows.
    """
    rows = templates(stored(parsed(pages, rules, id_col, url_col), "url-rows"))
    trees = stored(rows.groupBy("host", "template").agg(
        F.count("*").alias("pages"), F.count("verdict").alias("labelled"),
        F.sum(F.expr("IF(verdict = 'block', 1L, 0L)")).alias("blocked")), "url-trees")
    known = stored(purities(merged(trees)), "url-purities")
    return rows.join(known, ["host", "template"]).select(
        "page_id", "host", "path", "rule", F.expr(
            f"coalesce(verdict, IF(purity >= {REJECT}, 'block', 'allow'))").alias("verdict"),
        F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "purity")
