"""URL filters with redirect equivalence.

Addresses that redirect to each other, or name each other as their canonical address, are one page. Every
address is a node under its normal form; redirect and canonical-link edges join nodes, and connected
components carry decisions: an explicit allow on any alias wins, else a block on any alias holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.components import components
from millwright.llm.tables import lower_ascii

#: Verdict, host and path (fixed values).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _rule(rules, host_: Column, path_: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | F.endswith(host_, F.lit("." + h))) & F.startswith(path_, F.lit(p))
        found = F.when(fits, F.struct(
            F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")
        )).otherwise(found)
    return found


def normal_form(url: Column) -> Column:
    """What plain redirects leave alone: scheme, `www.`, a final slash, fragments and `utm_` words go.

    Null, and an address without `://`, has none.
    """
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(
        F.split(query, "&"), lambda x: (x != "") & ~F.startswith(x, F.lit("utm_"))
    ), "&")
    plain = F.concat(
        F.regexp_replace(host(url), "^www[.]", ""), F.regexp_replace(path(url), "/$", ""),
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")),
    )
    return F.when(F.contains(url, F.lit("://")), plain)


def _target(html: Column, url: Column) -> Column:
    """Addresses that the page names as its canonical one or as where it moved to."""
    canonical = F.regexp_extract(
        F.regexp_extract(html, r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0),
        r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1,
    )
    moved = F.regexp_extract(
        F.regexp_extract(html, r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0),
        r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1,
    )
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)

    def absolute(x: Column) -> Column:
        return (
            F.when(F.startswith(x, F.lit("//")), F.concat(scheme, x))
            .when(F.startswith(x, F.lit("/")), F.concat(origin, x))
            .when(F.contains(x, F.lit("://")), x)
        )

    return F.array_compact(F.array(
        F.when(F.contains(F.lower(html), F.lit("canonical")), absolute(canonical)),
        F.when(F.contains(F.lower(html), F.lit("refresh")), absolute(moved)),
    ))


def _decisions(frame: DataFrame, by: str) -> DataFrame:
    return frame.groupBy(by).agg(
        F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked")
    )


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, alias_of (the component's name).

    A page that a rule fits has the rule's verdict. Another takes its component's: allow if any of its
    addresses is explicitly allowed, else block if one is blocked, else allow. A null url, or one without
    `://`, has empty host and path, no aliases, and is allowed. Null html has no links. Rows are judged
    each, repeated ones alike; other columns are ignored.
    """
    judged = pages.select(
        "page_id", "url", "html", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        normal_form(F.col("url")).alias("node"),
    ).withColumn("found", _rule(rules, F.col("host"), F.col("path")))
    links = (
        judged.where("node is not null")
        .select("node", F.explode(_target(F.col("html"), F.col("url"))).alias("to"))
        .select(F.col("node").alias("a"), normal_form(F.col("to")).alias("b"), "to")
    )
    group = components(links.select("a", "b"))
    named = judged.select("node", F.col("found.verdict").alias("verdict")).unionByName(
        links.select(
            F.col("b").alias("node"),
            _rule(rules, host(F.col("to")), path(F.col("to")))["verdict"].alias("verdict"),
        )
    ).where("node is not null and verdict is not null")
    node = _decisions(named, "node")
    whole = (
        node.join(group, "node", "left")
        .withColumn("alias_of", F.coalesce("component", "node"))
        .groupBy("alias_of").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    )
    # what a node without a rule of its own learns: only nodes and components with a decision are joined
    members = group.select("node", F.col("component").alias("alias_of")).join(whole, "alias_of").select(
        "node", "alias_of", "allowed", "blocked"
    )
    alone = (
        node.join(group, "node", "left_anti")
        .select("node", F.col("node").alias("alias_of"), "allowed", "blocked")
    )
    told = members.unionByName(alone)
    return judged.select("page_id", "host", "path", "node", "found").join(told, "node", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(
            F.col("found.verdict"),
            F.when(F.col("allowed"), F.lit("allow")).when(F.col("blocked"), F.lit("block")),
            F.lit("allow"),
        ).alias("verdict"),
        F.coalesce("alias_of", "node").alias("alias_of"),
    )
