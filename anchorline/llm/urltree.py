"""URL filter: a path-template tree for each host, built and judged with DataFrame functions only.

1. A url is split into host and path; the path's segments become the levels of its host's
   tree. Digits, and long hexadecimal runs, are generalised at once.
2. Level by level from the root, children are counted under the generalised prefix above
   them: where a node has many children with few pages each, its rare children become one
   wildcard, and what lies below them is counted together at the next level.
3. Templates carry labels (the explicit rules' verdicts, and a table of labelled urls if
   there is one). Labelled sibling branches whose rates do not differ significantly from
   their common rate are merged and judged by their sums. A branch without labels takes
   the sums of its siblings if two or more are labelled and all of them are merged; else
   the nearest branch above it that is so decides.
4. A template is rejected when its purity, smoothed towards an even prior, reaches a
   threshold; without labels there, or nearby in this sense, it never is.

Defined cases: a null url or one without ``://`` has an empty host and path; repeated
rows are judged alike; an empty table gives an empty result; only ``url`` is read.
Levels past ``max_depth`` count as one segment, so deep paths are read whole. Groups of a
hot host are pre-aggregated before the shuffle and never gathered; each level is a written
table of distinct paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import ascii_lower, discard, stored


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(host: Column, path: Column, rule: str) -> Column:
    domain, slash, rest = rule.partition("/")
    return ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict. rules: (rule, verdict)."""
    rule = verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        fits = _fits(host, path, text)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _general(segment: Column) -> Column:
    """The wildcard of a segment that is variable by its form, else the segment."""
    form = F.regexp_replace(segment, r"[0-9]+", "{n}")
    return F.when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{h}")).otherwise(form)


def _segments(path: Column, max_depth: int) -> Column:
    """A path's segments with variable forms generalised; those past ``max_depth`` are one."""
    every = F.split(path, "/")
    deep = F.concat(F.slice(every, 1, max_depth - 1), F.array(F.array_join(F.slice(every, F.lit(max_depth), F.size(every)), "/")))
    return F.transform(F.when(F.size(every) > max_depth, deep).otherwise(every), _general)


def filter_urls(
    df: DataFrame,
    *,
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = (),
    labels: DataFrame | None = None,
    min_children: int = 16,
    pages_per_child: float = 4.0,
    max_depth: int = 12,
    z: float = 2.0,
    prior_weight: float = 4.0,
    reject_at: float = 0.8,
) -> DataFrame:
    """``df`` plus host, path, template, rule, purity and verdict (allow or block).

    ``labels``: further labelled urls as (url, bad boolean); they train the templates only.
    """
    own = ["host", "path", "template", "rule", "purity", "verdict"]
    kept = [c for c in df.columns if c not in own]
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    base = df.select(*kept, host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), said.alias("__said"), _segments(F.col("path"), max_depth).alias("__raw"))

    # Every distinct path of a host once, with its pages and labels: all later work is on these rows.
    bad = F.col("__said") == "block"
    leaves = base.groupBy("host", "__raw").agg(F.count(F.lit(1)).alias("pages"), F.count("__said").alias("n"), F.count_if(bad).alias("bad"))
    if labels is not None:
        more = labels.where(F.col("bad").isNotNull()).select(host_of(F.col("url")).alias("host"), _segments(path_of(F.col("url")), max_depth).alias("__raw"), "bad")
        more = more.groupBy("host", "__raw").agg(F.lit(0).cast("long").alias("pages"), F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))
        leaves = leaves.unionByName(more).groupBy("host", "__raw").agg(*[F.sum(c).alias(c) for c in ("pages", "n", "bad")])
    leaves = stored(leaves.select("*", F.array().cast("array<string>").alias("gen")))
    levels = leaves.agg(F.max(F.size("__raw"))).first()[0] or 0
    for level in range(1, levels + 1):
        there = F.size("__raw") >= level
        segment = F.get("__raw", F.lit(level - 1))
        nodes = leaves.where(there).groupBy("host", "gen", segment.alias("segment")).agg(F.sum("pages").alias("here"))
        few = F.sum("here") < pages_per_child * F.count(F.lit(1))
        wide = nodes.groupBy("host", "gen").agg((few & (F.count(F.lit(1)) >= min_children)).alias("wide")).where("wide").drop("wide")
        variable = nodes.where(F.col("here") < min_children).join(wide, ["host", "gen"]).select("host", "gen", "segment", F.lit("*").alias("star"))
        joined = leaves.withColumn("segment", segment).join(variable, ["host", "gen", "segment"], "left")
        before, gen = leaves, F.when(there, F.array_append("gen", F.coalesce("star", "segment"))).otherwise(F.col("gen"))
        leaves = stored(joined.select("host", "__raw", "pages", "n", "bad", gen.alias("gen")))
        discard(before)

    templates = leaves.groupBy("host", "gen").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    prefixes = templates.select("host", "gen", "n", "bad", F.explode(F.sequence(F.lit(1), F.size("gen"))).alias("level"))
    prefixes = prefixes.select("*", F.slice("gen", F.lit(1), F.col("level")).alias("prefix"), F.slice("gen", F.lit(1), F.col("level") - 1).alias("parent"))
    nodes = prefixes.groupBy("host", "level", "parent", "prefix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    siblings = ["host", "level", "parent"]
    rate = nodes.where("n > 0").groupBy(*siblings).agg((F.sum("bad") / F.sum("n")).alias("p"), F.count(F.lit(1)).alias("labelled"))
    p, n = F.col("p"), F.col("n")
    alike = (n > 0) & (F.abs(F.col("bad") / F.nullif(n, F.lit(0)) - p) <= z * F.sqrt(p * (1 - p) / F.nullif(n, F.lit(0)) + F.lit(1e-9)))
    tested = nodes.join(rate, siblings).select(*siblings, "prefix", "n", "bad", "labelled", F.coalesce(alike, F.lit(False)).alias("alike"))
    pool = tested.where("alike").groupBy(*siblings).agg(F.sum("n").alias("pool_n"), F.sum("bad").alias("pool_bad"), F.count(F.lit(1)).alias("merged"))
    known = tested.join(pool, siblings, "left").where((n > 0) | ((F.col("merged") >= 2) & (F.col("merged") == F.col("labelled"))))
    pooled = F.when(F.col("alike") | (n == 0), F.struct(F.col("pool_n").alias("n"), F.col("pool_bad").alias("bad"))).otherwise(F.struct("n", "bad"))
    evidence = known.select("host", "prefix", (n > 0).alias("own"), pooled.alias("e"))
    # The template's own labels, else the deepest unlabelled branch above it (or itself) whose siblings agree.
    usable = prefixes.select("host", "gen", "level", "prefix").join(evidence, ["host", "prefix"]).where(~F.col("own") | (F.col("level") == F.size("gen")))
    found = usable.groupBy("host", "gen").agg(F.max_by("e", "level").alias("e"))
    purity = (F.coalesce("e.bad", F.lit(0)) + 0.5 * prior_weight) / (F.coalesce("e.n", F.lit(0)) + prior_weight)
    judged = leaves.select("host", "__raw", "gen").join(found, ["host", "gen"], "left").select("host", "__raw", F.array_join("gen", "/").alias("template"), purity.alias("purity"))
    out = base.join(judged, ["host", "__raw"], "left")
    verdict = F.coalesce(F.col("__said"), F.when(F.col("purity") >= reject_at, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(*kept, "host", "path", "template", "rule", "purity", verdict.alias("verdict"))
