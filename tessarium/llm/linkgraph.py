"""URL filters: host and path rules, and for pages without a rule link-graph propagation.

Each host is seeded with the shares of its pages that rules allow (trust) and block (distrust). Trust
flows along host edges as personalised PageRank, t = (1 - a) v + a W't, and distrust against them,
so that a host that links to blocked hosts is distrusted itself. Edges are the absolute links
of the pages between different hosts (with a scheme or "//" alone), weighted by their number. Steps go on
until no score moves by TOLERANCE; as each shrinks what still moves by the damping, log(TOLERANCE) / log(DAMPING)
steps always suffice. A host is blocked where its distrust exceeds its trust and reaches the threshold. What
flows into hosts without edges is not returned to the seeds: that would multiply all trust by one number and all
distrust by another, while both are to be compared, and with the share of a host's own pages.

Rules meet paths through the hosts' suffixes and the lengths of the rules' paths, all equi-joins, so no list of
rules is ever built. Joins by host are salted SALT ways, so that the pages of one host meet in no
single task.

Defined cases: a null url or one without "://" has empty host and path, fits no rule and belongs
to the host '' (no links, so allow); null html has no links; of rules of equal length the
smaller string wins; repeated rows and null page_ids are judged one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING, THRESHOLD, TOLERANCE, SALT = 0.85, 0.5, 1e-9, 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, suffix string, prefix string")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<long>")))


def _salt(*by: Column) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(SALT))


def best_rules(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict: the longest rule that fits each host and path that has one.

    A host's suffixes know how long their rules' paths are; each path asks with its beginnings of these lengths, an
    equi-join with the rules, however many a host has.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    lengths = rules.select("suffix", F.length("prefix").alias("n")).distinct()
    keys = paths.select("host").distinct().select("host", F.explode(F.array_distinct(suffixes)).alias("suffix")).join(lengths, "suffix")
    asked = paths.withColumn("salt", _salt(F.col("path"))).join(_salted(keys), ["host", "salt"]).filter(F.length("path") >= F.col("n"))
    asked = asked.select("host", "path", "suffix", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("prefix"))
    name = F.concat("suffix", "prefix")
    best = F.min(F.struct((-F.length(name)).alias("n"), name.alias("rule"), "verdict")).alias("best")
    return asked.join(rules, ["suffix", "prefix"]).groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: absolute links between different hosts."""
    links = F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1)
    )
    return (
        pages.select(host(F.col("url")).alias("src"), F.explode(links).alias("link"))
        .select("src", F.translate("link", _UPPER, _LOWER).alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def propagate(seeds: DataFrame, graph: DataFrame, scratch: Scratch, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, score: personalised PageRank from seeds (host, v) over edges (src, dst, n), written after each step."""
    out = graph.groupBy("src").agg(F.sum("n").alias("total"))
    weights = scratch.write(graph.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("w")))
    base = seeds.select("host", (F.col("v") * (1 - damping)).alias("v"))
    now = scratch.write(base.select("host", F.col("v").alias("score")))
    if weights.isEmpty():
        return now
    for _ in range(math.ceil(math.log(tolerance) / math.log(damping))):
        flow = (
            now.select(F.col("host").alias("src"), "score")
            .join(weights, "src")
            .groupBy(F.col("dst").alias("host"))
            .agg((F.sum(F.col("score") * F.col("w")) * damping).alias("v"))
        )
        then = scratch.write(base.unionByName(flow).groupBy("host").agg(F.sum("v").alias("score")))
        gap = then.alias("a").join(now.alias("b"), "host", "left").agg(
            F.max(F.abs(F.col("a.score") - F.coalesce("b.score", F.lit(0.0))))
        ).first()[0]
        scratch.drop(now)
        now = then
        if gap is None or gap < tolerance:
            break
    scratch.drop(weights)
    return now


def judge(
    pages: DataFrame,
    scratch: Scratch,
    rules: DataFrame,
    damping: float = DAMPING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    address, page_path = host(F.col("url")), path(F.col("url"))
    parsed = scratch.write(
        pages.select(F.col("page_id").cast("long").alias("page_id"), address.alias("host"), page_path.alias("path"), _salt(page_path, F.col("page_id")).alias("salt"))
    )
    best = scratch.write(best_rules(parsed.select("host", "path").distinct(), rules))
    ruled = parsed.join(best, ["host", "path"], "left").select("page_id", "host", "salt", "path", "rule", F.col("verdict").alias("ruling"))
    share = lambda verdict: F.sum((F.coalesce("ruling", F.lit("")) == verdict).cast("long"))
    # one row a host and salt, then one a host, with the shares of its pages that rules allow and block
    part = ruled.groupBy("host", "salt").agg(share("allow").alias("allow"), share("block").alias("block"), F.count("*").alias("n"))
    seeds = scratch.write(
        part.groupBy("host").agg((F.sum("allow") / F.sum("n")).alias("allow"), (F.sum("block") / F.sum("n")).alias("block"))
    )
    graph = scratch.write(edges(pages))
    trust = propagate(seeds.select("host", F.col("allow").alias("v")), graph, scratch, damping)
    back = graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(seeds.select("host", F.col("block").alias("v")), back, scratch, damping)
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold * (1 - damping) * (1 - 1e-6))
    hosts = (
        seeds.select("host")
        .join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
        .fillna(0.0, ["trust", "distrust"])
        .select("host", "trust", "distrust", bad.alias("bad"))
    )
    return ruled.join(_salted(hosts), ["host", "salt"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruling", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), Scratch(spark, "op9"), rule_table(spark))


OP9_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, suffix, prefix) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hp AS (
  SELECT host, path, arg_min(suffix || prefix, (-length(suffix || prefix), suffix || prefix)) AS rule,
         arg_min(verdict, (-length(suffix || prefix), suffix || prefix)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) JOIN rules
    ON (host = suffix OR ends_with(host, '.' || suffix)) AND starts_with(path, prefix)
  GROUP BY host, path
), r AS (
  SELECT p.page_id, p.host, p.path, hp.rule, hp.verdict, p.html FROM p LEFT JOIN hp USING (host, path)
), seeds AS (
  SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS a,
         avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) AS b
  FROM r GROUP BY host
), l AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\s*=\s*["'']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1)) AS link
  FROM p
), e AS (
  SELECT src, translate(link, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst, count(*) AS n
  FROM l WHERE src <> '' GROUP BY 1, 2 HAVING src <> dst
), g AS (
  SELECT 't' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS w FROM e
  UNION ALL
  SELECT 'd', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM e
), v AS (
  SELECT 't' AS kind, host, 0.15 * a AS v FROM seeds UNION ALL SELECT 'd', host, 0.15 * b FROM seeds
), it AS (  -- 128 steps leave 0.85^128 < 1e-9 of the mass to move
  SELECT 0 AS i, kind, host, v AS score FROM v
  UNION ALL
  SELECT i + 1, kind, host, sum(x) FROM (
    SELECT it.i, it.kind, g.dst AS host, 0.85 * it.score * g.w AS x FROM it JOIN g ON it.kind = g.kind AND it.host = g.src WHERE it.i < 128
    UNION ALL
    SELECT m.i, v.kind, v.host, v.v FROM v, (SELECT max(i) AS i FROM it WHERE i < 128) m WHERE m.i IS NOT NULL
  ) GROUP BY i, kind, host
), f AS (
  SELECT host, max(score) FILTER (kind = 't') AS trust, max(score) FILTER (kind = 'd') AS distrust
  FROM it WHERE i = (SELECT max(i) FROM it) GROUP BY host
)
SELECT r.page_id, r.host, r.path, r.rule,
       coalesce(r.verdict, CASE WHEN f.distrust > f.trust AND f.distrust >= 0.5 * 0.15 * (1 - 1e-6) THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN f USING (host)
"""
