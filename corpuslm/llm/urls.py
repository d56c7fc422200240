"""URL filters (operator 3): explicit rules, then a path-template tree.

A url's path is cut into segments and variable parts are generalised: runs of
digits become ``{n}``, long hexadecimal ids ``{x}``.  Per host the segments
form a tree with counts of pages, labelled pages and bad ones.  Level by level
a branch becomes a wildcard ``*`` if its share of bad pages does not differ
from its siblings' (two-proportion test), or if a node has very many branches
and this one is rare.  Branches without enough labels are never merged with
labelled ones: no evidence is not similarity.  A path is followed as far as it has
siblings, however deep; what is left of it then belongs to the template as it is.

A template is judged by its own labels where there are ``min_labels`` of them; else
by the labels of the same template on all hosts; else by those of its nearest
ancestor on all hosts that has as many.  It is rejected if the smoothed purity,
(bad + strength * prior) / (labelled + strength) with a fixed prior, reaches
``purity``.  Without such an ancestor (the root is none) it is allowed.

Labels: a table (page_id, bad), or by default the verdicts of the rules
themselves, which say of the pages they fit whether they are bad.

Pages are counted per (host, generalised path) per task before any shuffle, so
a host with a third of all pages costs its distinct patterns.

Defined results.  A null url, or one without ``://``, has an empty host and
path and is judged like a host named "".  Repeated pages each get a row.  Of
rules that fit, the longest wins, ties by text.  A very long url is judged whole.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@dataclass(frozen=True)
class Params:
    max_branches: int = 50
    min_pages: int = 20  # of a branch of a node with more branches than that
    min_labels: int = 8
    z_same: float = 1.64  # below it two shares of bad pages do not differ
    strength: float = 4.0
    prior: float = 0.5
    purity: float = 0.8


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)://(.*)", 1)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that wins, and its verdict (null: none fits)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is applied last
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def pattern(path: Column) -> Column:
    """The generalised path, segments between slashes."""
    def general(s: Column) -> Column:
        is_id = F.rlike(s, F.lit("^[0-9a-fA-F-]{12,}$")) & F.rlike(s, F.lit("[0-9]"))
        return F.when(is_id, "{x}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}"))
    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), general), "/")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]


NODE = ["host", "template"]


def _named(t: DataFrame, p: Params) -> DataFrame:
    """``t`` with the next segment, or its wildcard, added to the template."""
    t = t.withColumn("segment", F.get("segments", F.col("k")))
    branch = t.groupBy(*NODE, "segment").agg(*_sums())
    whole = branch.groupBy(*NODE).agg(F.count(F.lit(1)).alias("branches"), F.sum("labelled").alias("all_l"),
                                      F.sum("bad").alias("all_b"))
    b = branch.join(whole, NODE)
    one = F.lit(1)
    rest_l, rest_b = F.col("all_l") - F.col("labelled"), F.col("all_b") - F.col("bad")
    share = F.col("all_b") / F.greatest(F.col("all_l"), one)
    err = F.sqrt(share * (1 - share) * (1 / F.greatest(F.col("labelled"), one) + 1 / F.greatest(rest_l, one)))
    gap = F.abs(F.col("bad") / F.greatest(F.col("labelled"), one) - rest_b / F.greatest(rest_l, one))
    same = (F.col("labelled") >= p.min_labels) & (rest_l >= p.min_labels) & (gap <= p.z_same * err + 1e-9)
    rare = (F.col("branches") > p.max_branches) & (F.col("n") < p.min_pages)
    b = b.select(*NODE, "segment", F.when(same | rare, "*").otherwise(F.col("segment")).alias("name"))
    return t.join(b, [*NODE, "segment"]).withColumn("template", F.concat("template", F.lit("/"), "name")).withColumn(
        "k", F.col("k") + 1).drop("segment", "name")


def templates(pages: DataFrame, p: Params) -> DataFrame:
    """``(host, pattern, template, n, labelled, bad)`` of each host and pattern, from
    rows (host, pattern, labelled, bad), one per page."""
    t = pages.withColumn("n", F.lit(1)).groupBy("host", "pattern").agg(*_sums())
    segments = F.filter(F.split("pattern", "/"), lambda x: x != "")
    t = t.withColumn("segments", segments).withColumn("template", F.lit("")).withColumn("k", F.lit(0)).checkpoint()
    done = None
    below = lambda lo, hi: F.when(hi > lo, F.concat(F.lit("/"), F.array_join(F.slice("segments", lo + 1, hi - lo), "/"))).otherwise("")
    while True:
        # what all paths of a node share (the first and the last of them do) has no siblings
        least, most = F.col("least"), F.col("most")
        upto = F.least(F.size(least), F.size(most))
        differs = F.filter(F.when(upto > 0, F.sequence(F.lit(0), upto - 1)).otherwise(F.array().cast("array<int>")),
                           lambda i: F.get(least, i) != F.get(most, i))
        node = t.groupBy(*NODE).agg(F.count(F.lit(1)).alias("paths"), F.min("segments").alias("least"), F.max("segments").alias("most"))
        node = node.select(*NODE, "paths", F.coalesce(F.get(differs, F.lit(0)), upto).alias("same"))
        t = t.join(node, NODE).withColumn("template", F.concat("template", below(F.col("k"), F.col("same")))).withColumn(
            "k", F.greatest("k", "same")).checkpoint()
        # a path with siblings goes on; one that ends here, or stands alone, is done
        goes_on = (F.col("paths") > 1) & (F.size("segments") > F.col("k"))
        ended = t.filter(~goes_on).select("host", "pattern", F.concat("template", below(F.col("k"), F.size("segments"))).alias("template"),
                                          "n", "labelled", "bad")
        done = ended if done is None else done.unionByName(ended)
        t = t.filter(goes_on).drop("paths", "same")
        if t.isEmpty():
            return done
        t = _named(t, p)


def evidence(t: DataFrame, p: Params) -> DataFrame:
    """``(host, template, labelled, bad, basis)``: the labels that judge a template,
    and whose they are: ``host``, ``path`` (all hosts) or null (none)."""
    own = t.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).checkpoint()
    paths = own.groupBy("template").agg(F.sum("l").alias("l"), F.sum("b").alias("b"))
    parts = F.split("template", "/")  # the first is empty
    above = paths.filter(F.size(parts) > 1).select("template", "l", "b", F.explode(F.sequence(F.lit(2), F.size(parts))).alias("size")).select(
        "template", "l", "b", "size", F.array_join(F.slice(parts, F.lit(1), F.col("size")), "/").alias("node"))
    above = above.checkpoint()
    pool = above.groupBy("node").agg(F.sum("l").alias("all_l"), F.sum("b").alias("all_b")).filter(F.col("all_l") >= p.min_labels)
    near = above.join(pool, "node").groupBy("template").agg(F.max_by(F.struct("all_l", "all_b"), "size").alias("near"))
    enough = F.col("l") >= p.min_labels
    return own.join(near, "template", "left").select(
        "host", "template", F.when(enough, F.col("l")).otherwise(F.coalesce("near.all_l", F.lit(0))).alias("labelled"),
        F.when(enough, F.col("b")).otherwise(F.coalesce("near.all_b", F.lit(0))).alias("bad"),
        F.when(enough, "host").when(F.col("near").isNotNull(), "path").alias("basis"))


def verdicts(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, params: Params = Params()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity and
    basis (whose labels gave it)."""
    p = params
    host, path = parsed(F.col("url"))
    d = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    d = d.select("*", rule.alias("rule"), said.alias("said"), pattern(F.col("path")).alias("pattern"))
    if labels is None:
        seen = d.select("host", "pattern", F.col("said").isNotNull().cast("long").alias("labelled"),
                        F.coalesce((F.col("said") == "block").cast("long"), F.lit(0)).alias("bad"))
    else:  # one label a page: bad if any row says so
        one = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad")).filter("bad is not null")
        seen = d.join(one, "page_id", "left").select("host", "pattern", F.col("bad").isNotNull().cast("long").alias(
            "labelled"), F.coalesce("bad", F.lit(0)).alias("bad"))
    t = templates(seen, p).checkpoint()
    purity = (F.col("bad") + p.strength * p.prior) / (F.col("labelled") + p.strength)
    e = evidence(t, p).withColumn("purity", F.round(purity, 6))
    own = F.when(F.col("basis").isNotNull() & (F.col("purity") >= p.purity), "block").otherwise("allow")
    named = t.select("host", "pattern", "template").join(e, ["host", "template"]).select(
        "host", "pattern", F.concat("host", "template").alias("template"), "purity", "basis", own.alias("own"))
    return d.join(named, ["host", "pattern"]).select(
        "page_id", "host", "path", "rule", F.coalesce("said", "own").alias("verdict"), "template", "purity", "basis")
