"""URL filter: explicit rules, then path templates judged by labelled purity.

Every host gets a tree of path templates. Numbers in a segment are variable at once; beyond
that, a segment becomes a wildcard where a node has many children with few pages each. Sibling
branches of the same form whose shares of blocked labels do not differ significantly are merged.
A template is rejected if its smoothed share of blocked labels is high; the labels are the
verdicts of the rules, or a column of the pages. What a template's own labels are smoothed with
is the share of the same template on all hosts, and that in turn with an even one; so a template
that no label touches on its own host is judged by what it is on others. All steps are DataFrame operations; pages are
counted by (host, path form) before anything else, and a hot host is summed up in the map tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TemplateSettings:
    """Levels of the tree (what lies deeper is one wildcard), children from which a node is
    generalised if each has fewer than `support` pages, labels that a branch needs to be merged,
    z-value up to which shares count as alike, weight of the prior, share to reject above."""

    levels: int = 4
    children: int = 20
    support: float = 4.0
    labels: int = 5
    z: float = 1.96
    prior: float = 4.0
    reject: float = 0.8


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, with A to Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], value: str = "name") -> Column:
    """The name or verdict of the longest rule that fits, else null. A rule fits its host and all
    its subdomains if the path starts with the rule's. Of rules of one length the first wins."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def _segments(path: Column, levels: int) -> Column:
    """The path's segments with numbers as #, at most `levels`; a further one stands for the rest."""
    parts = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda s: s != "")
    head = F.slice(parts, 1, levels)
    return F.when(F.size(parts) > levels, F.concat(head, F.array(F.lit("**")))).otherwise(head)


def _templates(forms: DataFrame, settings: TemplateSettings, scratch: Scratch) -> DataFrame:
    """Adds `template` to (host, form, n, bad, good): the form with wildcards, level by level.

    A level reads the one before twice, so each is stored; else the plan would double by level.
    """
    out = scratch.keep(forms.withColumn("template", F.lit("")))
    for level in range(settings.levels):
        segment = F.get("form", F.lit(level))
        inner = out.filter(F.size("form") > level)
        kinds = inner.groupBy("host", "template", segment.alias("segment")).agg(F.sum("n").alias("n"))
        nodes = kinds.groupBy("host", "template").agg(F.count("segment").alias("kinds"), F.sum("n").alias("pages"))
        wide = nodes.filter((F.col("kinds") > settings.children) & (F.col("pages") < settings.support * F.col("kinds")))
        marked = out.join(wide.select("host", "template", F.lit(True).alias("wide")), ["host", "template"], "left")
        name = F.concat("template", F.lit("/"), F.when(F.col("wide"), F.lit("*")).otherwise(segment))
        named = marked.withColumn("template", F.when(F.size("form") > level, name).otherwise(F.col("template"))).drop("wide")
        before, out = out, scratch.keep(named)
        scratch.drop(before)
    rest = F.when(F.size("form") > settings.levels, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return out.withColumn("template", rest)


def _merged(templates: DataFrame, settings: TemplateSettings) -> DataFrame:
    """(host, template, bad, good) with the counts of all alike siblings in each.

    Siblings have the same template but for the first segment. A branch is alike if it has enough
    labels and its share of blocked ones is within z standard errors of all siblings' together.
    """
    family = F.regexp_replace("template", "^/[^/]*", "/*")
    counted = templates.withColumn("family", family)
    enough = counted.filter(F.col("bad") + F.col("good") >= settings.labels)
    pooled = enough.groupBy("host", "family").agg(F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good"))
    both = counted.join(pooled, ["host", "family"], "left")
    n, total = F.col("bad") + F.col("good"), F.col("all_bad") + F.col("all_good")
    share, common = F.col("bad") / n, (F.col("all_bad") + 0.5) / (total + 1)
    alike = (n >= settings.labels) & (F.abs(share - common) <= settings.z * F.sqrt(common * (1 - common) / n))
    both = both.withColumn("alike", F.coalesce(alike, F.lit(False)))
    again = both.filter("alike").groupBy("host", "family").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    out = both.drop("all_bad", "all_good").join(again, ["host", "family"], "left")
    return out.select(
        "host", "template",
        F.when(F.col("alike"), F.col("b")).otherwise(F.col("bad")).alias("bad"),
        F.when(F.col("alike"), F.col("g")).otherwise(F.col("good")).alias("good"),
    )


def _smoothed(bad: Column, good: Column, prior: Column, settings: TemplateSettings) -> Column:
    return (bad + prior * settings.prior) / (bad + good + settings.prior)


def judge(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", blocked: str | None = None,
    settings: TemplateSettings = TemplateSettings(),
) -> DataFrame:
    """The pages with host, path, rule, template, purity and verdict (`allow` or `block`).

    A null address or one without :// has an empty host and path and is judged like any other. The
    verdict is that of the longest rule that fits; without one, a page is blocked if the smoothed
    share of blocked labels of its template is above the limit. `blocked` names a boolean label
    column; without it the rules' verdicts are the labels. A template without labels on
    any host has an even share and is allowed. Columns of the given names are replaced; all rows stay.
    """
    new = ["host", "path", "rule", "template", "purity", "verdict"]
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in new]
    base = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    base = base.withColumn("_ruled", rule_of(F.col("host"), F.col("path"), rules, "verdict"))
    base = base.withColumn("_form", _segments(F.col("path"), settings.levels))
    bad = F.col(f"`{blocked}`") if blocked else F.col("_ruled") == "block"
    forms = base.groupBy("host", F.col("_form").alias("form")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good")
    )
    scratch = Scratch(pages.sparkSession, "urls")
    shaped = _templates(forms, settings, scratch)
    templates = scratch.keep(
        shaped.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    everywhere = templates.groupBy("template").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    everywhere = everywhere.select("template", _smoothed(F.col("b"), F.col("g"), F.lit(0.5), settings).alias("prior"))
    own = _merged(templates, settings).join(everywhere, "template")
    purity = _smoothed(F.col("bad"), F.col("good"), F.col("prior"), settings)
    judged = own.select("host", "template", purity.alias("purity"))
    by_form = shaped.select("host", F.col("form").alias("_form"), "template").join(judged, ["host", "template"])
    out = base.join(by_form, ["host", "_form"])
    verdict = F.coalesce("_ruled", F.when(F.col("purity") > settings.reject, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(*kept, "host", "path", "rule", "template", "purity", verdict.alias("verdict"))
