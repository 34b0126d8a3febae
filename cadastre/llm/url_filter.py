"""Page addresses allowed or blocked by rules and, where no rule fits, by the link graph of hosts.

1. A rule (verdict, host, path) fits its host and all subdomains if the address's path starts with
   the rule's; the longest one that fits decides (of equal length: block, then the first by text).
2. Every ``href`` to another host is an edge between hosts, weighed by how many such addresses the
   pages of one hold of the other.
3. A host is a trusted seed by the share of its pages that rules allow, a blocked seed by the share
   that they block; a host without pages by the addresses that link to it.  Trust goes along the
   edges and distrust against them, as a personalised PageRank each: what arrives is damped and
   divided among a host's edges.  Neither is scaled by the number of hosts.
4. A host is blocked when its distrust exceeds its trust by ``threshold`` or more; pages without a
   rule take the verdict of their host.

All steps are joins and groupings of DataFrames; pages of one host, or edges of one hub, are
counted before they are shuffled, and the rounds are stored tables with one row per host.

Edge cases: a null address or one without ``://`` has an empty host and path, no rule, and is
allowed; null html has no links; an empty host is no node; repeated rows come back each (and count
each); links of a page count once per address; an empty table gives no row; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared

Rule = tuple[str, str, str]

#: verdict, host, path
RULES: list[Rule] = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
                     ("block", "net", "/es/"), ("block", "net", "/fr/")]
DAMPING, ROUNDS, THRESHOLD = 0.85, 24, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
#: absolute addresses in links, and those that leave the scheme out
_LINK = r"(?i)\bhref[ \t-\r]*{0}=[ \t-\r]*{0}[\"']?{0}[ \t-\r]*{0}((?:[a-z][a-z0-9+.\-]*:)?//[^ \t-\r\"'<>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def _in_order(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(set(rules), key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1], r[2]))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the rule that decides, verdict before it (``block net/es/``); null where none fits."""
    chosen = F.lit(None).cast("string")
    for verdict, domain, start in reversed(_in_order(rules)):
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(start))
        chosen = F.when(fits, f"{verdict} {domain}{start}").otherwise(chosen)
    return chosen


def _judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return (pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
            .withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)))


def _links(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Addresses that pages of ``source`` hold of another host: source, target, n, allowed, blocked."""
    found = F.array_distinct(F.regexp_extract_all(F.col("html"), F.lit(_LINK.format("+")), 1))
    held = (pages.select(host_of(F.col("url")).alias("source"), F.explode(found).alias("_link"))
            # the scheme, which may be missing, plays no part
            .withColumn("url", F.concat(F.lit("x://"), F.expr("substring(_link, locate('//', _link) + 2)"))))
    judged = _judged(held, rules).where("source <> '' and host <> '' and host <> source")
    return (judged.groupBy("source", F.col("host").alias("target"))
            .agg(F.count("*").alias("n"), *_decided()))


def _decided() -> list[Column]:
    return [F.count_if(F.startswith("_rule", F.lit(word))).alias(name)
            for word, name in (("allow", "allowed"), ("block", "blocked"))]


def _seeds(pages: DataFrame, links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Trust and distrust that each host has of its own."""
    own = (_judged(pages.select("url"), rules).where("host <> ''").groupBy("host")
           .agg(F.count("*").alias("n"), *_decided()))
    named = links.groupBy(F.col("target").alias("host")).agg(*(F.sum(c).alias(c) for c in ("n", "allowed", "blocked")))
    return (own.unionByName(named.join(own, "host", "left_anti"))
            .select("host", (F.col("allowed") / F.col("n")).alias("trust"),
                    (F.col("blocked") / F.col("n")).alias("distrust")))


def _flows(links: DataFrame) -> DataFrame:
    """Share of a host's trust, or distrust, that goes to another host: kind, source, target, share."""
    edges = links.select(F.lit("trust").alias("kind"), "source", "target", "n").union(
        links.select(F.lit("distrust"), "target", "source", "n"))
    total = edges.groupBy("kind", "source").agg(F.sum("n").alias("total"))
    return edges.join(total, ["kind", "source"]).select("kind", "source", "target", (F.col("n") / F.col("total")).alias("share"))


def host_scores(pages: DataFrame, rules: Sequence[Rule] = RULES, damping: float = DAMPING,
                rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust of every host of ``url`` and of the links in ``html``."""
    links = shared.stored(_links(pages, rules), "links")
    seeds = shared.stored(_seeds(pages, links, rules).select(
        "host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust")))
        .alias("kind", "value")), "seeds")
    flows = shared.stored(_flows(links), "flows")
    scores, mass = seeds, _mass(seeds)
    for _ in range(rounds):
        arriving = flows.join(scores, (flows["kind"] == scores["kind"]) & (flows["source"] == scores["host"])).select(
            F.col("target").alias("host"), flows["kind"], (F.lit(damping) * F.col("share") * F.col("value")).alias("value"))
        scores = shared.stored(seeds.union(arriving).groupBy("host", "kind").agg(F.sum("value").alias("value")), "scores")
        # no score ever falls, so scores stand still when their sum does
        mass, before = _mass(scores), mass
        if mass <= before * (1 + 1e-12):
            break
    return scores.groupBy("host").agg(*(F.sum(F.when(F.col("kind") == kind, F.col("value")).otherwise(0.0)).alias(kind)
                                        for kind in ("trust", "distrust")))


def _mass(scores: DataFrame) -> float:
    return scores.agg(F.sum("value")).first()[0] or 0.0


def judge(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html",
          rules: Sequence[Rule] = RULES, damping: float = DAMPING, rounds: int = ROUNDS,
          threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, host, path, rule (null where none fits), verdict, host_trust, host_distrust."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    hosts = host_scores(rows, rules, damping, rounds).withColumnRenamed("host", "_host")
    # sums of doubles depend on their order in the last places
    bad = F.round(F.col("distrust") - F.col("trust"), 9) >= threshold
    return (_judged(rows.select("key", "url"), rules).join(hosts, F.col("host") == F.col("_host"), "left")
            .select(F.col("key").alias(key), "host", "path", F.substring_index("_rule", " ", -1).alias("rule"),
                    F.when(F.col("_rule").isNotNull(), F.substring_index("_rule", " ", 1))
                    .when(bad, "block").otherwise("allow").alias("verdict"),
                    F.round("trust", 6).alias("host_trust"), F.round("distrust", 6).alias("host_distrust")))


def oracle_sql(rules: Sequence[Rule] = RULES, damping: float = DAMPING, rounds: int = ROUNDS,
               threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB, all rounds written out."""
    def judged(url: str) -> str:
        host = f"translate(coalesce(regexp_extract({url}, '{_HOST}', 1), ''), '{_UPPER}', '{_LOWER}')"
        return f"{host} AS host, coalesce(regexp_extract({url}, '{_PATH}', 1), '') AS path"

    cases = " ".join(f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}') THEN '{v} {d}{p}'"
                     for v, d, p in _in_order(rules))
    decided = ("count(*) AS n, count(*) FILTER (rule LIKE 'allow%') AS allowed, "
               "count(*) FILTER (rule LIKE 'block%') AS blocked")
    link = _LINK.format("").replace("'", "''")
    parts = [f"""WITH page AS MATERIALIZED (SELECT *, CASE {cases} END AS rule FROM (
  SELECT page_id, {judged('url')}, html FROM pages))
, link AS MATERIALIZED (SELECT source, host AS target, {decided} FROM (SELECT *, CASE {cases} END AS rule FROM (
  SELECT source, {judged("'x://' || substr(link, instr(link, '//') + 2)")} FROM (
   SELECT host AS source, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS link FROM page)))
 WHERE source <> '' AND host <> '' AND host <> source GROUP BY ALL)
, own AS (SELECT host, {decided} FROM page WHERE host <> '' GROUP BY host)
, named AS (SELECT target AS host, sum(n) AS n, sum(allowed) AS allowed, sum(blocked) AS blocked FROM link GROUP BY 1)
, share AS (FROM own UNION ALL SELECT * FROM named WHERE host NOT IN (SELECT host FROM own))
, s0 AS MATERIALIZED (SELECT host, 'trust' AS kind, CAST(allowed AS DOUBLE) / n AS value FROM share
 UNION ALL SELECT host, 'distrust', CAST(blocked AS DOUBLE) / n FROM share)
, edge AS (SELECT 'trust' AS kind, source, target, n FROM link UNION ALL SELECT 'distrust', target, source, n FROM link)
, flow AS MATERIALIZED (SELECT kind, source, target, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY kind, source) AS share
 FROM edge)"""]
    for k in range(rounds):
        parts.append(f"""
, s{k + 1} AS MATERIALIZED (SELECT host, kind, sum(value) AS value FROM (FROM s0 UNION ALL
 SELECT f.target, f.kind, {damping} * f.share * s.value FROM flow f JOIN s{k} s ON s.kind = f.kind AND s.host = f.source)
 GROUP BY 1, 2)""")
    parts.append(f"""
, bad AS (SELECT host FROM s{rounds} GROUP BY host
 HAVING round(sum(CASE kind WHEN 'distrust' THEN value ELSE -value END), 9) >= {threshold})
SELECT page_id, host, path, split_part(rule, ' ', 2) AS rule, CASE WHEN rule IS NOT NULL THEN split_part(rule, ' ', 1)
 WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict FROM page""")
    return "".join(parts)
