"""Path templates per host, judged by the labels that their urls carry.

1. *Shapes.* Digit runs of a path segment become ``#``. A url's path is the list
   of all its segments' shapes, then ``$``.
2. *Variable segments.* Level by level below the already generalised prefix, a
   segment that holds less than one in ``RARE`` of its siblings' urls is a value,
   not a branch, and becomes ``*``, unless it has ``OWN`` urls or more or its share
   of blocked differs from its siblings' beyond sampling error. So what a large
   host adds elsewhere does not swallow a branch. A path that is alone behind its
   prefix has no siblings left and is finished at once, so the levels go as deep as
   paths differ.
3. *Similar branches.* The branches below one prefix are held against all of
   them together: by the distribution of what follows (total variation) and by
   the share of blocked among labelled urls. A branch within sampling error of
   the whole in both respects is merged with its like into ``*``. Each branch is
   compared with the sum, never with each other branch.
4. *Purity.* A template is rejected when its blocked share, smoothed towards its
   host's, itself smoothed towards all hosts', reaches ``limit``.

All counts are summed in the map tasks and taken over distinct shapes, so a host
with a third of all rows is no hot key. Levels are written tables. Only the
rejected shapes are joined back to the urls.

Labels come from rules on host and path where one fits; those urls have the
rule's verdict, all others the template's.

Defined results: a null url, or one without ``://``, has empty host and path, no
rule, and the template of an empty path; repeated rows are judged one by one; an
empty table gives an empty one; columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize

#: Segments that the SQL twin looks at; the paths of the given tables have two.
DEPTH = 4
RARE = 50
#: Urls that make a segment a branch however many its siblings have.
OWN = 50
#: Urls that the priors count for.
TEMPLATE_PRIOR, HOST_PRIOR = 5.0, 20.0


@dataclass(frozen=True)
class UrlRule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


PRODUCTION_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.lit(2**31 - 1)))
    return df.withColumns(
        {
            "host": F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit("")),
            "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
        }
    )


def with_rule(df: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    """Add ``rule`` and ``rule_verdict``: those of the longest rule that fits, nulls if none does.

    ``rules`` is a hand-written list, tried in order of length (of equal ones, by name).
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        host_fits = (F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host))
        fits = host_fits & F.startswith(F.col("path"), F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return df.withColumn("rule", name).withColumn("rule_verdict", verdict)


def shape(path: Column) -> Column:
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.concat(F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "#")), F.array(F.lit("$")))


def _same_share() -> Column:
    """Whether blocked and allowed are within sampling error of all_blocked and all_allowed; so without labels."""
    labelled, all_labelled = F.col("blocked") + F.col("allowed"), F.col("all_blocked") + F.col("all_allowed")
    unlike = F.round(F.abs(F.col("blocked") / labelled - F.col("all_blocked") / all_labelled), 9)
    return (labelled == 0) | (unlike <= F.greatest(F.lit(0.05), 1 / F.sqrt(F.greatest(labelled, F.lit(1)))))


def templates(shapes: DataFrame) -> DataFrame:
    """``shapes`` (host, shape, n, blocked, allowed; one row each) with the ``template`` of each shape."""
    columns = ["host", "shape", "n", "blocked", "allowed", "general"]
    level = materialize(shapes.withColumn("general", F.array().cast("array<string>")).select(*columns), "level")
    done, d = [], 0
    while True:
        # a shape that is alone behind its prefix has no siblings at any deeper level; joined by shape, for a
        # hot host has few prefixes
        nodes = level.groupBy("host", "general").agg(F.count("*").alias("shapes"), F.min("shape").alias("shape"))
        alone = nodes.filter("shapes = 1").select("host", "shape", F.lit(False).alias("shared"))
        still = F.coalesce("shared", F.lit(True)) & (F.size("shape") > d)
        level = level.join(alone, ["host", "shape"], "left").select(*columns, still.alias("open"))
        level = materialize(level, "level")
        rest = F.slice("shape", F.size("general") + 1, F.greatest(F.size("shape") - F.size("general"), F.lit(0)))
        done.append(level.filter(~F.col("open")).select(*columns[:-1], F.concat("general", rest).alias("general")))
        level = level.filter("open").select(*columns)
        if level.isEmpty():
            break
        child = F.get("shape", F.lit(d))
        inner = level.withColumn("child", child).filter(child != "$")
        children = inner.groupBy("host", "general", "child").agg(
            F.sum("n").alias("c"), *[F.sum(x).alias(x) for x in ("blocked", "allowed")]
        )
        parents = inner.groupBy("host", "general").agg(
            F.sum("n").alias("p"), *[F.sum(x).alias(f"all_{x}") for x in ("blocked", "allowed")]
        )
        rare = (
            children.filter(F.col("c") < OWN)
            .join(parents, ["host", "general"])
            .filter((F.col("c") * RARE < F.col("p")) & _same_share())
            .select("host", "general", "child", F.lit(True).alias("rare"))
        )
        nxt = level.withColumn("child", child).join(rare, ["host", "general", "child"], "left")
        step = F.when(F.col("rare"), F.lit("*")).otherwise(F.col("child"))
        level = nxt.select(*columns[:-1], F.concat("general", F.array(step)).alias("general"))
        d += 1
    level = materialize(reduce(DataFrame.unionByName, done), "level")
    return _merge(level)


def _merge(level: DataFrame) -> DataFrame:
    """Branches that agree with their siblings as a whole become ``*``."""
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
    prefix = F.when(F.col("d") == 0, F.array().cast("array<string>")).otherwise(F.slice("general", 1, F.col("d")))
    steps = (
        level.withColumn("d", F.explode(F.sequence(F.lit(0), F.size("general") - 1)))
        .withColumn("prefix", prefix)
        .withColumn("branch", F.get("general", F.col("d")))
        .withColumn("following", F.coalesce(F.get("general", F.col("d") + 1), F.lit("$")))
        .filter(F.col("branch") != "$")
    )
    cells = materialize(steps.groupBy("host", "prefix", "branch", "following").agg(*sums), "cells")
    branches = cells.groupBy("host", "prefix", "branch").agg(*sums)
    wholes = cells.groupBy("host", "prefix").agg(*[F.sum(c).alias(f"all_{c}") for c in ("n", "blocked", "allowed")])
    pooled = cells.groupBy("host", "prefix", "following").agg(F.sum("n").alias("pooled"))
    share = F.col("c") / F.col("n") - F.col("pooled") / F.col("all_n")
    variation = (
        cells.select("host", "prefix", "branch", "following", F.col("n").alias("c"))
        .join(pooled, ["host", "prefix", "following"])
        .join(branches, ["host", "prefix", "branch"])
        .join(wholes, ["host", "prefix"])
        .groupBy("host", "prefix", "branch")
        .agg(
            F.round(F.sum(F.greatest(share, F.lit(0.0))), 9).alias("variation"),
            *[F.first(c).alias(c) for c in ("n", "blocked", "allowed", "all_n", "all_blocked", "all_allowed")],
        )
    )
    alike = (F.col("variation") <= F.greatest(F.lit(0.05), 1 / F.sqrt("n"))) & _same_share()
    merged = variation.filter(alike).select("host", "prefix", "branch", F.lit(True).alias("merged"))
    marked = steps.select("host", "shape", "prefix", "branch", "d").join(merged, ["host", "prefix", "branch"], "left")
    final = marked.groupBy("host", "shape").agg(
        F.array_sort(F.collect_list(F.struct("d", F.when(F.col("merged"), F.lit("*")).otherwise(F.col("branch")).alias("s")))).alias("t")
    )
    out = level.select("host", "shape", "n", "blocked", "allowed").join(final, ["host", "shape"], "left")
    return out.withColumn("template", F.concat(F.lit("/"), F.coalesce(F.array_join("t.s", "/"), F.lit("")))).drop("t")


def purities(shapes: DataFrame) -> DataFrame:
    """A row per host and template with its smoothed blocked share, ``purity``."""
    sums = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
    found = materialize(shapes.groupBy("host", "template").agg(*sums), "templates")
    total = found.agg(F.sum("blocked").alias("b"), F.sum(F.col("blocked") + F.col("allowed")).alias("l")).first()
    overall = (total["b"] or 0) / total["l"] if total["l"] else 0.0
    hosts = found.groupBy("host").agg(F.sum("blocked").alias("hb"), F.sum(F.col("blocked") + F.col("allowed")).alias("hl"))
    prior = (F.col("hb") + HOST_PRIOR * overall) / (F.col("hl") + HOST_PRIOR)
    purity = (F.col("blocked") + TEMPLATE_PRIOR * prior) / (F.col("blocked") + F.col("allowed") + TEMPLATE_PRIOR)
    return found.join(hosts, "host").select("host", "template", "n", "blocked", "allowed", F.round(purity, 9).alias("purity"))


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple[UrlRule, ...] = PRODUCTION_RULES, limit: float = 0.8) -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    kept = pages.drop("host", "path", "rule", "verdict")
    parsed = with_rule(with_host_and_path(kept, url), rules).withColumn("_shape", shape(F.col("path")))
    label = lambda v: F.sum(F.when(F.col("rule_verdict") == v, 1).otherwise(0))
    shapes = parsed.groupBy("host", F.col("_shape").alias("shape")).agg(
        F.count("*").alias("n"), label("block").alias("blocked"), label("allow").alias("allowed")
    )
    found = materialize(templates(shapes), "shapes")
    bad = purities(found).filter(F.col("purity") >= limit).select("host", "template")
    rejected = materialize(
        found.join(bad, ["host", "template"], "left_semi").select(
            F.col("host").alias("_host"), F.col("shape").alias("_rejected"), F.lit(True).alias("_bad")
        ),
        "rejected-shapes",
    )
    same = (F.col("host") == F.col("_host")) & (F.col("_shape") == F.col("_rejected"))
    by_method = F.when(F.col("_bad"), F.lit("block")).otherwise(F.lit("allow"))
    return (
        parsed.join(rejected, same, "left")
        .withColumn("verdict", F.coalesce("rule_verdict", by_method))
        .drop("_shape", "_host", "_rejected", "_bad", "rule_verdict")
    )
