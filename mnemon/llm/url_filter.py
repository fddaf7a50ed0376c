"""URL filtering by rules and, beyond them, by a tree of path templates.

Labels are what the rules say.  Each path becomes its shape (digits generalised)
and shapes are counted by host, so the rest works on shapes, not on URLs.  Level
by level, under each host and template so far, segments that vary too much turn
into a wildcard, and of the others those whose labels differ by no more than
chance (a Hoeffding bound) merge into one branch.  A template whose labelled
pages are blocked by a smoothed share above the limit rejects the URLs that fall
on it; others pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import stored


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    pattern: str  # host/path

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


# fixed values: the default rules
RULES = (
    Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/"),
)


@dataclass(frozen=True)
class TreeOptions:
    """``fan_out``: different segments below a template before rare ones turn into a wildcard;
    ``common``: the share of a template's pages that saves a segment from that;
    ``depth``: segments that are told apart, the rest of a path is one (levels end earlier where all paths do);
    ``delta``: of the Hoeffding bound; ``fewest``: labels that a branch needs to merge;
    ``smoothing`` and ``prior``: pseudo-labels of a template and their blocked share;
    ``limit``: the smoothed blocked share from which on a template rejects.
    """

    fan_out: int = 24
    common: float = 0.05
    depth: int = 8
    delta: float = 0.05
    fewest: int = 5
    smoothing: float = 4.0
    prior: float = 0.5
    limit: float = 0.8


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first '://'; both empty for a null or without one."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.coalesce(F.regexp_extract(url, whole, 1), F.lit("")), upper, upper.lower())
    return host, F.coalesce(F.regexp_extract(url, whole, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """struct(pattern, verdict) of the longest rule that fits, or null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.pattern).alias("pattern"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<pattern: string, verdict: string>")


def merge_branches(segments: list[tuple[str, int, int]], options: TreeOptions) -> dict[str, str]:
    """Segment to branch: segments (name, labels, blocked) whose blocked shares may be one join."""
    groups: list[list] = []
    for name, labels, blocked in sorted(segments, key=lambda s: (-s[1], s[0])):
        if labels >= options.fewest:
            for g in groups:
                bound = np.sqrt(0.5 * np.log(2 / options.delta)) * (1 / np.sqrt(g[1]) + 1 / np.sqrt(labels))
                # a branch joins the first that it may equal, on the same side of the limit
                same_side = (g[2] / g[1] >= options.limit) == (blocked / labels >= options.limit)
                if same_side and abs(g[2] / g[1] - blocked / labels) <= bound:
                    g[0].append(name)
                    g[1] += labels
                    g[2] += blocked
                    break
            else:
                groups.append([[name], labels, blocked])
    return {name: "|".join(sorted(g[0])) for g in groups for name in g[0]}


def templates(shapes: DataFrame, options: TreeOptions) -> DataFrame:
    """(host, shape, template) from (host, shape, segments, n, labels, blocked)."""
    state = shapes.withColumn("template", F.lit(""))
    for level in range(options.depth + 1):
        # beyond the depth the rest of a path is one segment
        here = F.try_element_at("segments", F.lit(level + 1)) if level < options.depth else F.when(F.size("segments") > level, F.lit("**"))
        # each level reads the one before several times, so it is kept
        at = stored(state.withColumn("segment", here), "shapes")
        below = at.where("segment is not null").groupBy("host", "template", "segment").agg(F.sum("n").alias("n"), F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"))
        below = stored(below, "segments")
        if below.isEmpty():
            return at.drop("segment")
        total = below.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all"))
        wild = (F.col("kinds") > options.fan_out) & (F.col("n") < F.col("all") * options.common)
        named = below.join(total, ["host", "template"]).withColumn("branch", F.when(wild, F.lit("*")).otherwise(F.col("segment")))
        # what is no wildcard is at most fan_out or 1/common segments a template: a bounded list
        lists = named.where("branch <> '*'").groupBy("host", "template").agg(F.collect_list(F.struct("segment", "labels", "blocked")).alias("segments"))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = pa.schema([("host", pa.string()), ("template", pa.string()), ("segment", pa.string()), ("merged", pa.string())])
            for batch in batches:
                rows = []
                for host, template, found in zip(*(c.to_pylist() for c in batch.columns)):
                    for name, branch in merge_branches([(s["segment"], s["labels"], s["blocked"]) for s in found], options).items():
                        rows.append((host, template, name, branch))
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=kind)

        merged = lists.mapInArrow(merge, "host string, template string, segment string, merged string")
        branch = named.select("host", "template", "segment", "branch").join(merged, ["host", "template", "segment"], "left")
        branch = branch.select("host", "template", "segment", F.coalesce("merged", "branch").alias("branch"))
        state = at.join(branch, ["host", "template", "segment"], "left").withColumn(
            "template", F.when(F.col("branch").isNotNull(), F.concat("template", F.lit("/"), "branch")).otherwise(F.col("template"))
        ).drop("segment", "branch")
    return stored(state, "shapes")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, options: TreeOptions = TreeOptions(), key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key, host, path, rule, verdict, template, purity.

    A url that is null or has no '://' has an empty host and path, which no rule
    fits; its verdict comes from the tree as for any other host.  Rows that
    repeat are judged each, urls of any length whole; an empty table gives no
    rows, and other columns are ignored.
    """
    host, path = split_url(F.col(url))
    seen = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    seen = seen.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    seen = seen.withColumn("shape", F.regexp_replace("path", "[0-9]+", "#"))
    blocked = F.coalesce((F.col("found.verdict") == "block").cast("long"), F.lit(0))
    shapes = seen.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("found.verdict").alias("labels"), F.sum(blocked).alias("blocked"))
    shapes = shapes.withColumn("segments", F.filter(F.split("shape", "/"), lambda s: s != ""))
    tree = templates(shapes, options)
    stats = tree.groupBy("host", "template").agg(F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked"))
    purity = (F.col("blocked") + options.smoothing * options.prior) / (F.col("labels") + options.smoothing)
    told = tree.select("host", "shape", "template").join(stats.select("host", "template", purity.alias("purity")), ["host", "template"])
    # a host may have most pages: a plain join, which Spark may split
    out = seen.join(told, ["host", "shape"], "left")
    by_tree = F.when(F.col("purity") >= options.limit, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(key, "host", "path", F.col("found.pattern").alias("rule"), F.coalesce("found.verdict", by_tree).alias("verdict"), "template", "purity")
