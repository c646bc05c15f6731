"""URL filter: rules first, then a tree of path templates for each host.

A rule fits its host and all subdomains where the path starts with the rule's; the longest wins. What
no rule fits is judged by the share of blocked pages of its template, smoothed level by level. Pages
that rules decide are the labelled ones.

Domains come first: the last label of the host's name, smoothed by PRIOR, the last two, and so on
to the host, each smoothed by the one before; a host in whose domains no page is labelled has PRIOR. Then the host's path segments, as a tree. Children of a node become one
wildcard where their values vary too much to be names. Children whose share differs significantly from
the node's are merged with their siblings on the same side, and the merged branch gets its own share, smoothed by
the node's; the other children, and those without a labelled page, keep the node's. So a branch that
nobody labelled is judged by the nearest part of its host or domain that somebody did. Evidence counts once: a
domain or host with the same labelled pages as the one above it keeps its share. Templates with a share of
THRESHOLD or more are rejected. A branch is followed down until it has no labelled page, or a single path.

All is aggregation and joins by host and template, level by level; a host with a third of the pages is counted by
child first. Null urls and urls without "://" have empty host and path. Pages with null ids are judged
too. Repeated rows count and are judged as often as they come. Without labelled pages nothing is
rejected. Extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm import common

#: (verdict, host, path): the rules of the query.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
#: Children are a wildcard if so many differ, and for so many pages of the node there is one.
VARIED, PAGES_EACH = 8, 20
#: Strength of the parent's share in a template's, in pages; deviations that count as similar.
STRENGTH, SIMILAR = 5.0, 1.96
PRIOR, THRESHOLD = 0.2, 0.5
#: Longer hosts aren't names and have no domain above them.
HOST_CHARS = 253


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path."""
    whole = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    low = F.translate(F.regexp_extract(whole, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, F.regexp_extract(whole, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, like net/es/, and its verdict; null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    names, verdicts = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, own, start in reversed(ordered):
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        names, verdicts = F.when(fits, own + start).otherwise(names), F.when(fits, verdict).otherwise(verdicts)
    return names, verdicts


def _smoothed(blocked: Column, labelled: Column, above: Column) -> Column:
    return (blocked + STRENGTH * above) / (labelled + STRENGTH)


def host_shares(hosts: DataFrame) -> DataFrame:
    """(host, labelled, share) from each host's labelled and blocked pages, by way of its domains."""
    names = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, F.size(names) - i + 1, i), "."))
    ends = F.when(F.length("host") <= HOST_CHARS, ends).otherwise(F.array("host"))
    steps = hosts.select("host", "labelled", "blocked", F.posexplode(ends).alias("at", "domain"))
    domains = steps.where("labelled > 0").groupBy("domain").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    met = steps.select("host", "at", "domain").join(domains, "domain")
    ways = met.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "n", "b"))).alias("way"))
    start = F.struct(F.lit(PRIOR).alias("share"), F.lit(0).cast("long").alias("n"))

    def down(above, domain):
        own = F.struct(_smoothed(domain["b"], domain["n"], above["share"]).alias("share"), domain["n"].alias("n"))
        return F.when(domain["n"] == above["n"], above).otherwise(own)

    share = F.when(F.col("way").isNotNull(), F.aggregate("way", start, down)["share"]).otherwise(F.lit(PRIOR))
    return hosts.join(ways, "host", "left").select("host", "labelled", share.alias("share"))


def _moves(growing: DataFrame) -> DataFrame:
    """(host, node, segment) to its step (the segment or a wildcard), the share below it, and whether it goes on."""
    by_child = growing.groupBy("host", "node", F.get("rest", F.lit(0)).alias("segment")).agg(
        F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
        F.count("*").alias("paths"), F.max("share").alias("share"),
    )
    by_child = common.written(by_child)
    nodes = by_child.groupBy("host", "node").agg(F.count("*").alias("children"), F.sum("pages").alias("below"))
    varied = nodes.where((F.col("children") >= VARIED) & (F.col("children") * PAGES_EACH >= F.col("below"))).select("host", "node", F.lit(True).alias("varied"))
    named = by_child.join(varied, ["host", "node"], "left").withColumn("step", F.when(F.col("varied"), F.lit("*")).otherwise(F.col("segment")))
    steps = named.groupBy("host", "node", "step").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.sum("paths").alias("paths"), F.max("share").alias("share")
    )
    own = F.col("blocked") / F.col("labelled")
    spread = F.sqrt(F.greatest(F.col("share") * (1 - F.col("share")), F.lit(1e-6)) / F.col("labelled"))
    differs = (F.col("labelled") > 0) & (F.abs(F.try_subtract(own, F.col("share"))) > SIMILAR * spread)
    steps = common.written(steps.withColumn("side", F.when(F.coalesce(differs, F.lit(False)), F.signum(own - F.col("share"))).otherwise(0.0)))
    merged = steps.where("side <> 0").groupBy("host", "node", "side").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    share = F.coalesce(_smoothed(F.col("b"), F.col("n"), F.col("share")), F.col("share"))
    shares = steps.join(merged, ["host", "node", "side"], "left").select(
        "host", "node", "step", share.alias("below"), ((F.col("labelled") > 0) & (F.col("paths") > 1)).alias("goes_on")
    )
    return common.written(named.select("host", "node", "segment", "step").join(shares, ["host", "node", "step"]))


def templates(pages: DataFrame) -> DataFrame:
    """(host, path, share): the blocked share by which each distinct path is judged.

    pages: host, path, verdict (of a rule, or null).
    """
    paths = common.written(pages.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.count_if(F.col("verdict").isNotNull()).alias("labelled"), F.count_if(F.col("verdict") == "block").alias("blocked")
    ))
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    shares = host_shares(common.written(hosts)).select("host", "share", (F.col("labelled") > 0).alias("goes_on"))
    rest = F.split(F.regexp_replace("path", "^/", ""), "/")
    state = common.written(paths.join(common.written(shares), "host").select(
        "host", "path", "pages", "labelled", "blocked", F.lit("").alias("node"), rest.alias("rest"), "share", "goes_on"
    ))
    done = []
    while True:
        goes_on = F.col("goes_on") & (F.size("rest") > 0)
        done.append(state.where(~goes_on).select("host", "path", "share"))
        growing = state.where(goes_on)
        if growing.isEmpty():
            return reduce(DataFrame.union, done)
        moved = growing.drop("goes_on").withColumn("segment", F.get("rest", F.lit(0))).join(_moves(growing), ["host", "node", "segment"])
        state = common.written(moved.select(
            "host", "path", "pages", "labelled", "blocked", F.concat("node", F.lit("/"), "step").alias("node"),
            F.slice("rest", F.lit(2), F.size("rest")).alias("rest"), F.col("below").alias("share"), "goes_on",
        ))


def judged(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """Adds host, path, rule, verdict and share (null where a rule decides)."""
    plain = pages.drop("host", "path", "rule", "verdict", "share", "_own")
    host, path = parts(F.col(url))
    found = plain.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = found.withColumn("rule", rule).withColumn("_own", verdict)
    shares = templates(found.select("host", "path", F.col("_own").alias("verdict")))
    both = found.join(shares, ["host", "path"], "left")
    method = F.when(F.col("share") >= THRESHOLD, "block").otherwise("allow")
    return both.select(
        *plain.columns, "host", "path", "rule", F.coalesce("_own", method).alias("verdict"), F.when(F.col("rule").isNull(), F.col("share")).alias("share")
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict")
