"""URL filters: rules, and trust carried over the link graph, in DataFrame operations only.

A page's url is cut into host and path, and the longest fitting rule decides. Hosts of which most pages are allowed by
rule are trusted seeds, those of which most are blocked are blocked seeds; a host without pages that is linked to is a
seed if a rule fits its path `/`. Over the edges between hosts (links in the pages' html, whether their target has pages
or not, and a host with its parent domain where each has pages or is linked to) trust spreads from trusted seeds as personalised
PageRank, and distrust from blocked seeds as the same on reversed edges: who links to a bad host is distrusted. A page no
rule fits is blocked if its host's distrust, in units of a seed's mean share, reaches `THRESHOLD` and exceeds its trust.

Values start from (1 - DAMPING) of the seeds and rounds go on until all that is still to come is below `TOLERANCE` for the
whole graph, far below `THRESHOLD`, so that verdicts are those of the converged values.

Edges are counted before they are shuffled, so a host or a link that is very common is one row per task.

Defined results: a url that is NULL or has no `://` has an empty host and path, fits no rule and is allowed. NULL html has
no links. Repeated pages count as often as they stand. Without seeds of a kind its values are 0. An empty table gives none.
Urls and html of any length are read whole. A host with as many allowed as blocked pages is no seed, and distrust that equals
trust allows. Only the id, url and html are read, so other columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import materialise
from ledgerline.operators.lookup import lookup


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


# The four rules.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
DAMPING, ROUNDS, THRESHOLD = 0.85, 200, 0.05  # rounds at most: 0.85 ** 200 of a hundred million seeds is below the tolerance
TOLERANCE = THRESHOLD / 500
STRIDE = 5  # rounds between two written states
PART = 10_000  # a host with more edges than this sends its value to several tasks
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)


def _by_rule(rules, host: Column, path: Column, value) -> Column:
    """`value` of the longest fitting rule, else NULL."""
    found = None
    for rule in sorted(rules, key=lambda rule: (-len(rule.name), rule.name)):
        held = F.lit(value(rule))
        found = F.when(_fits(rule, host, path), held) if found is None else found.when(_fits(rule, host, path), held)
    return F.lit(None).cast("string") if found is None else found


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) with rule and verdict NULL where no rule fits."""
    cut = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    host, path = F.col("host"), F.col("path")
    return cut.select("page_id", "host", "path", _by_rule(rules, host, path, lambda rule: rule.name).alias("rule"),
                      _by_rule(rules, host, path, lambda rule: rule.verdict).alias("ruled"))


def links_of(pages: DataFrame) -> DataFrame:
    """(source, target, weight) of the links from the pages' hosts to other hosts, with or without pages."""
    own = host_of(F.col("url").cast("string"))
    links = pages.select(own.alias("source"), F.explode(F.regexp_extract_all(
        F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(_LINK), F.lit(1))).alias("target"))
    links = links.select("source", F.translate("target", _UPPER, _LOWER).alias("target")).where("source <> '' AND source <> target")
    return links.groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def nodes_of(judged: DataFrame, links: DataFrame, rules=RULES) -> DataFrame:
    """(host, allowed, blocked) of the hosts that have pages or are linked to: whether they are seeds."""
    paged = judged.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"))
    ruled = _by_rule(rules, F.col("host"), F.lit("/"), lambda rule: rule.verdict)
    linked = links.select(F.col("target").alias("host")).distinct().join(paged, "host", "left_anti").withColumn("ruled", ruled)
    return paged.select("host", (2 * F.col("allowed") > F.col("pages")).alias("allowed"),
                        (2 * F.col("blocked") > F.col("pages")).alias("blocked")).union(
        linked.select("host", F.col("ruled").eqNullSafe("allow"), F.col("ruled").eqNullSafe("block")))


def edges_of(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """(source, target, weight) between different hosts: links, and a host with its parent domain."""
    parent = hosts.select(F.col("host").alias("source"), F.regexp_replace("host", r"^[^.]*\.?", "").alias("target"))
    known = hosts.select(F.col("host").alias("target"))
    parent = parent.where("target <> ''").join(known, "target", "left_semi").select("source", "target")
    family = parent.union(parent.select("target", "source")).withColumn("weight", F.lit(1.0))
    return links.union(family).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def _spread(start: DataFrame, edges: DataFrame, parts: DataFrame) -> DataFrame:
    """(side, host, value) once all but `TOLERANCE` of the values' sum has arrived.

    `fresh` is what the last round brought; what is still to come is at most its sum times DAMPING / (1 - DAMPING), so no
    host lacks more than that. A host's own row goes along as an edge without a share, which keeps a round to one join.
    """
    states = start.join(parts, ["side", "host"], "left").select(
        "side", F.col("host").alias("source"), F.coalesce("parts", F.lit(1)).alias("parts"), "value")
    states = materialise(states)
    edges = materialise(edges.select("side", "source", "part", "target", "share", F.lit(0).alias("parts")).union(
        states.select("side", "source", F.lit(0).alias("part"), F.col("source").alias("target"), F.lit(None).cast("double"), "parts")))
    now = states.withColumn("fresh", F.col("value"))
    for _ in range(0, ROUNDS, STRIDE):
        for _ in range(STRIDE):
            sent = now.select("side", "source", "value", "fresh", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            got = edges.join(sent, ["side", "source", "part"]).select(
                "side", "target", "parts", F.when(F.col("share").isNull(), F.col("value")).alias("held"),
                (F.col("share") * F.col("fresh")).alias("got"))
            now = got.groupBy("side", F.col("target").alias("source")).agg(
                F.max("parts").alias("parts"), (F.sum("held") + F.coalesce(F.sum("got"), F.lit(0.0))).alias("value"),
                F.coalesce(F.sum("got"), F.lit(0.0)).alias("fresh"))
        now = materialise(now)
        if now.agg(F.sum("fresh")).first()[0] * DAMPING / (1 - DAMPING) <= TOLERANCE:
            return now.select("side", F.col("source").alias("host"), "value")
    raise RuntimeError("trust did not settle")


def trust(pages: DataFrame, judged: DataFrame, rules=RULES) -> DataFrame:
    """(host, trust, distrust) in units of a seed's mean share."""
    links = materialise(links_of(pages))
    hosts = materialise(nodes_of(judged, links, rules))
    sides = hosts.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("side"), F.col("allowed").alias("seed")),
        F.struct(F.lit("distrust").alias("side"), F.col("blocked").alias("seed")))).alias("one"))
    sides = sides.select("host", "one.side", F.col("one.seed").cast("double").alias("seed"))
    edges = edges_of(links, hosts)
    edges = edges.select(F.lit("trust").alias("side"), "source", "target", "weight").union(
        edges.select(F.lit("distrust").alias("side"), F.col("target").alias("source"), F.col("source").alias("target"), "weight"))
    out = edges.groupBy("side", "source").agg(F.sum("weight").alias("all"), F.count(F.lit(1)).alias("targets"))
    parts = F.ceil(F.col("targets") / PART).cast("int")
    edges = materialise(edges.join(out, ["side", "source"]).select(
        "side", "source", F.pmod(F.xxhash64("target"), parts).cast("int").alias("part"), "target",
        (DAMPING * F.col("weight") / F.col("all")).alias("share")))
    now = sides.select("side", "host", ((1 - DAMPING) * F.col("seed")).alias("value"))
    if not edges.isEmpty():
        now = _spread(now, edges, materialise(out.select("side", F.col("source").alias("host"), parts.alias("parts"))))
    return now.groupBy("host").agg(
        F.sum(F.when(F.col("side") == "trust", F.col("value")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("side") == "distrust", F.col("value")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    judged = judged_by_rules(pages, rules)
    ranked = trust(pages, judged, rules)
    bad = ranked.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select(
        "host", F.lit(True).alias("bad"))
    joined = lookup(judged, materialise(bad), "host", "left")  # a host with very many pages is spread
    by_method = F.when(F.col("bad"), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"))
