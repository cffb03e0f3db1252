"""Urls judged by host and path rules, and, where none fits, by a tree of path templates for each host.

A path becomes segments, and every run of digits in it `#` (a character that no path holds). Level by level, under each node of a
host's tree, a segment with fewer than `SUPPORT` pages becomes the wildcard `#*`. Branches whose pages the rules have labelled
are laid into bins by their blocked share, and neighbouring bins merge while a two-sample test of shares sees no difference; a
merged branch is named after its least segment and ends in `#~`. Unlabelled branches stay apart: nothing shows what they are like.
A template is rejected if its share of blocked among labelled pages, smoothed by that of all pages, is over `REJECTED`.

Only built-in column functions are used. The tree is built from counts per host and path shape, never from pages; a page meets
only rejected shapes, and each of these is spread over `SALTS` copies, so that a hot shape has no task of its own.

A null url, or one without `://`, has an empty host and path. Segments beyond `DEPTH` count as one. Pages with a null or repeated
page_id are judged like others, other columns are not read, an empty table gives no rows, paths may have any length.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import cut_lineage

#: Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Segments of a path that are levels of the tree; the rest of a longer path is one more segment.
DEPTH = 8
#: Pages that a segment needs under its node to keep its name.
SUPPORT = 5
#: Bins of the blocked share, and the square of the test's bound (5 % of equal branches are held apart).
BINS, APART = 20, 3.84
#: Labelled pages that the share of all pages counts for, and the smoothed share beyond which a template is rejected.
SMOOTHING, REJECTED = 5, 0.8
#: Copies of a rejected shape in the join with the pages.
SALTS = 16

_NODE = ["host", "template"]


def parts(url: str = "url") -> list[Column]:
    """Host and path of an address."""
    rest = F.expr(f"IF(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [host.alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path")]


def matched_rule(rules: Iterable[tuple[str, str, str]]) -> Column:
    """The longest rule whose host is the url's or above it, and whose path starts the url's; a struct of rule and verdict, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rules = tuple(rules)
    ruled = pages.select("page_id", *parts()).withColumn("by", matched_rule(rules)).select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"), F.col("by.verdict").alias("verdict"), _shape().alias("shape"),
    )
    refused = templates(ruled).where("rejected").select("host", "shape", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit("block").alias("learned"))
    asked = ruled.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    return asked.join(refused, ["host", "shape", "salt"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "learned", F.lit("allow")).alias("verdict")
    )


def templates(ruled: DataFrame) -> DataFrame:
    """host, shape, verdict of pages (null: no rule) to one row per host and shape: its template, the template's figures and whether it is rejected."""
    blocked = F.count(F.when(F.col("verdict") == "block", 1))
    shapes = ruled.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("verdict").alias("labelled"), blocked.alias("blocked"))
    segments = F.when(F.col("shape") != "", F.split(F.expr("substring(shape, 2)"), "/", DEPTH)).otherwise(F.array().cast("array<string>"))
    tree = cut_lineage(shapes.withColumn("segments", segments).withColumn("template", F.lit("")))
    whole = tree.agg(F.max(F.size("segments")).alias("deep"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).first()
    tree = reduce(_grow, range(whole["deep"] or 0), tree)
    sums = tree.groupBy(*_NODE).agg(F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked"))
    share = whole["blocked"] / whole["labelled"] if whole["labelled"] else 0.0
    purity = (F.col("t_blocked") + F.lit(SMOOTHING * share)) / (F.col("t_labelled") + SMOOTHING)
    sums = sums.withColumn("purity", purity).withColumn("rejected", (F.col("t_labelled") > 0) & (F.col("purity") > REJECTED))
    return tree.select("host", "shape", "template").join(sums, _NODE)


def _shape() -> Column:
    return F.regexp_replace("path", "[0-9]+", "#")


def _grow(tree: DataFrame, level: int) -> DataFrame:
    """One level more: every shape that goes on gets the name of its branch."""
    figures = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    live = tree.where(F.size("segments") > level).withColumn("segment", F.col("segments")[level])
    named = F.when(F.col("n") < SUPPORT, F.lit("#*")).otherwise(F.col("segment"))
    children = live.groupBy(*_NODE, "segment").agg(F.sum("n").alias("n"), *figures).withColumn("name", named)
    bin_of = F.expr(f"CAST(({BINS} * (2 * blocked + 1)) div (2 * labelled + 2) AS INT)")
    branches = children.groupBy(*_NODE, "name").agg(*figures).withColumn("bin", F.when(F.col("labelled") > 0, bin_of))
    merged = _merge_bins(branches.where("bin IS NOT NULL"))
    branches = branches.join(merged, [*_NODE, "bin"], "left").select(*_NODE, "name", F.coalesce("branch", "name").alias("branch"))
    ways = children.select(*_NODE, "segment", "name").join(branches, [*_NODE, "name"]).select(*_NODE, "segment", "branch")
    grown = live.join(ways, [*_NODE, "segment"]).withColumn("template", F.concat("template", F.lit("/"), "branch")).drop("segment", "branch")
    return cut_lineage(grown.unionByName(tree.where(F.size("segments") <= level)))


def _merge_bins(branches: DataFrame) -> DataFrame:
    """Under each node, neighbouring bins that a test of two shares does not tell apart become one branch; at most BINS rows a node."""
    bins = branches.groupBy(*_NODE, "bin").agg(
        F.sum("labelled").cast("double").alias("l"), F.sum("blocked").cast("double").alias("b"), F.min("name").alias("least"), F.count(F.lit(1)).alias("size")
    )
    order = Window.partitionBy(*_NODE).orderBy("bin")
    bins = bins.withColumn("l0", F.lag("l").over(order)).withColumn("b0", F.lag("b").over(order))
    apart = F.expr(f"(b * l0 - b0 * l) * (b * l0 - b0 * l) * (l + l0) > {APART}D * (b + b0) * (l + l0 - b - b0) * l * l0")
    bins = bins.withColumn("run", F.sum(F.when(apart, 1).otherwise(0)).over(order))
    run = Window.partitionBy(*_NODE, "run")
    least = F.min("least").over(run)
    return bins.select(*_NODE, "bin", F.when(F.sum("size").over(run) > 1, F.concat(least, F.lit("#~"))).otherwise(least).alias("branch"))
