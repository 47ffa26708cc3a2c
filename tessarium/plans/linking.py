"""Queries on pages: URLs, links, HTML, dates, source health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, html, urls
from ..operators.relational import classify_by_suffix
from ..sources.discovery import discover
from ..sources.readers import discovered_links, parquet, registry
from .registry import query

_SCHEME = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
_NETLOC = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_HOST = f"regexp_replace(regexp_replace({_NETLOC}, '^.*@', ''), ':\\d*$', '')"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_CANON = f"""{_SCHEME} || '://' || regexp_replace({_NETLOC}, ':(?:80|443)$', '')
 || CASE WHEN regexp_replace({_PATH}, ';[^/]*$', '') = '' THEN '/' ELSE regexp_replace({_PATH}, ';[^/]*$', '') END
 || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: regexp_matches(p, '^[^=]+=.+') AND NOT starts_with(lower(p), 'utm_'))), '&'), ''), '')"""

#: A registry for the test tables' hosts, in order.
REGISTRY = (
    {"id": "blog", "name": "Blogs", "family": "civil_society", "domains": ["blog.tionble.example.com"]},
    {"id": "com", "name": "Commercial", "family": "technical_community", "domains": ["example.com"]},
    {"id": "net", "name": "Networks", "family": "technical_community", "domains": ["example.net"]},
)


def pages(spark, sf_dir):
    return parquet(spark, sf_dir, "pages")


@query("url_canonical", f"SELECT page_id, {_CANON} AS url FROM pages")
def url_canonical(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.canonical(F.col("url")).alias("url"))


@query("url_canonical_distinct", f"SELECT {_CANON} AS url, min(page_id) AS page_id FROM pages GROUP BY 1")
def url_canonical_distinct(spark, sf_dir):
    return url_canonical(spark, sf_dir).groupBy("url").agg(F.min("page_id").alias("page_id"))


@query(
    "url_normalize",
    f"SELECT page_id, {_SCHEME} || '://' || {_NETLOC} || regexp_replace({_PATH}, '/+$', '') || regexp_extract(url, '^[^?#]*(.*)$', 1) AS url FROM pages",
)
def url_normalize(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.trimmed(F.col("url")).alias("url"))


@query("url_validate", f"SELECT page_id, {_SCHEME} IN ('http', 'https') AND {_NETLOC} <> '' AS valid FROM pages")
def url_validate(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.valid(F.col("url")).alias("valid"))


@query(
    "url_stakeholder",
    f"""WITH p AS (SELECT page_id, {_HOST} || lower({_PATH}) AS w FROM pages), g AS (SELECT * FROM (VALUES """
    + ", ".join(f"('{g}', '{x}')" for g, xs in urls.STAKEHOLDER_PARTS.items() for x in xs)
    + """) AS v(stakeholder_group, part)) SELECT DISTINCT page_id, stakeholder_group FROM p JOIN g ON contains(w, part)""",
)
def url_stakeholder(spark, sf_dir):
    groups = F.array(*[F.when(urls.matches_group(F.col("url"), g), F.lit(g)) for g in urls.STAKEHOLDER_PARTS])
    out = pages(spark, sf_dir).select("page_id", F.explode(F.array_compact(groups)).alias("stakeholder_group"))
    return out


@query(
    "source_classify",
    "SELECT page_id, CASE WHEN coalesce(url, '') = '' THEN 'unknown' "
    + " ".join(f"WHEN contains(lower(url), '{d}') THEN '{n}'" for d, n in urls.SOURCE_LABELS)
    + " ELSE 'other' END AS label FROM pages",
)
def source_classify(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.source_label(F.col("url")).alias("label"))


@query(
    "source_domain_join",
    f"""WITH r(k, source_id, d) AS (VALUES (0, 'blog', 'blog.tionble.example.com'), (1, 'com', 'example.com'), (2, 'net', 'example.net'))
    SELECT page_id, arg_min(source_id, k) AS source_id FROM (SELECT page_id, {_HOST} AS host FROM pages) p
    JOIN r ON host = d OR ends_with(host, '.' || d) GROUP BY page_id""",
)
def source_domain_join(spark, sf_dir):
    return classify_by_suffix(pages(spark, sf_dir), "page_id", urls.host(F.col("url")), registry(spark, REGISTRY))


@query("source_id", "SELECT page_id, substring(sha256(url), 1, 24) AS source_id FROM pages")
def source_id(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", urls.source_id(F.col("url")).alias("source_id"))


_LINKS = """regexp_extract_all(html, '<a [^>]*href="([^"#][^"]*)"', 1)"""


@query(
    "discover_links",
    f"""WITH l AS (SELECT page_id, {_SCHEME} || '://' || {_NETLOC} AS root, unnest({_LINKS}) AS link FROM pages)
    SELECT page_id, CASE WHEN starts_with(link, '/') THEN root || link ELSE link END AS url, count(*) AS n FROM l GROUP BY ALL""",
)
def discover_links(spark, sf_dir):
    links = pages(spark, sf_dir).select("page_id", "url", F.explode(discovered_links("html", F.col("html"))).alias("link"))
    absolute = urls.resolve(F.col("url"), F.col("link"))
    return links.groupBy("page_id", absolute.alias("url")).agg(F.count("*").alias("n"))


@query("html_text")
def html_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.html_text("html").alias("text"))


@query(
    "html_meta",
    r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title,
    regexp_extract(html, '(?i)<html[^>]*\slang=["'']([^"'']*)["'']', 1) AS lang FROM pages""",
)
def html_meta(spark, sf_dir):
    return pages(spark, sf_dir).select(
        "page_id", html.title(F.col("html")).alias("title"), html.language(F.col("html")).alias("lang")
    )


@query(
    "source_health",
    f"""SELECT {_HOST} AS host, count(*) AS discovered, count(*) FILTER ({_SCHEME} = 'https') AS secure,
    CASE WHEN count(*) FILTER (length(html) >= 1000) = count(*) THEN 'reachable'
         WHEN count(*) FILTER (length(html) >= 1000) > 0 THEN 'degraded' ELSE 'unreachable' END AS status FROM pages GROUP BY 1""",
)
def source_health(spark, sf_dir):
    good = F.count_if(F.length("html") >= 1000)
    return pages(spark, sf_dir).groupBy(urls.host(F.col("url")).alias("host")).agg(
        F.count("*").alias("discovered"),
        F.count_if(urls.scheme(F.col("url")) == "https").alias("secure"),
        F.when(good == F.count("*"), "reachable").when(good > 0, "degraded").otherwise("unreachable").alias("status"),
    )


_TRIMMED = f"{_SCHEME} || '://' || {_NETLOC} || regexp_replace({_PATH}, '/+$', '') || regexp_extract(url, '^[^?#]*(.*)$', 1)"


@query(
    "discovery_chain",
    f"""WITH p AS (SELECT url, min(page_id) AS page_id, max(html) AS html FROM pages GROUP BY url),
    l AS (SELECT {_HOST} AS source_id, {_SCHEME} || '://' || {_NETLOC} AS root, unnest({_LINKS}) AS link FROM p WHERE length(html) >= 1000),
    u AS (SELECT source_id, CASE WHEN starts_with(link, '//') THEN split_part(root, '//', 1) || link WHEN starts_with(link, '/') THEN root || link ELSE link END AS url FROM l),
    d AS (SELECT source_id, count(DISTINCT {_TRIMMED}) AS n FROM u WHERE regexp_matches(lower(url), '^https?://[^/?#]') GROUP BY 1),
    h AS (SELECT {_HOST} AS source_id, count(*) FILTER (length(html) >= 1000) AS good, count(*) FILTER (NOT coalesce(length(html) >= 1000, false)) AS bad FROM p GROUP BY 1)
    SELECT h.source_id, CASE WHEN good > 0 THEN 'reachable' ELSE 'degraded' END AS status, good AS n_captured, bad AS n_failed, coalesce(n, 0) AS discovered FROM h LEFT JOIN d USING (source_id)""",
)
def discovery_chain(spark, sf_dir):
    """Hosts as sources, their pages as what was captured (short ones failed): links, deduplication, health."""
    p = pages(spark, sf_dir).groupBy("url").agg(F.min("page_id").cast("int").alias("ordinal"), F.max("html").alias("body"))
    wanted = p.select(urls.host(F.col("url")).alias("source_id"), "ordinal", "url")
    status = F.when(F.length("body") >= 1000, 200).otherwise(500)
    captures = p.select("url", status.alias("http_status"), F.lit(True).alias("robots_allowed"), F.lit("text/html").alias("content_type"), "body")
    return discover(wanted, captures)[1].select("source_id", "status", "n_captured", "n_failed", "discovered")


@query(
    "provenance_score",
    """SELECT page_id, round((CASE WHEN url <> '' THEN 1 ELSE 0 END + CASE WHEN html IS NOT NULL THEN 1 ELSE 0 END + 0) / 3.0::DOUBLE, 4) AS score FROM pages""",
)
def provenance_score(spark, sf_dir):
    """Of source URL, content hash and retrieval time, the share that a page carries (the table has no times)."""
    has = (F.col("url") != "").cast("int") + F.col("html").isNotNull().cast("int")
    return pages(spark, sf_dir).select("page_id", F.round(has / F.lit(3.0), 4).alias("score"))


@query(
    "decade_hist",
    "SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS BIGINT) || 's' AS decade, count(*) AS n FROM orders GROUP BY 1",
)
def decade_hist(spark, sf_dir):
    decade = F.concat((F.floor(F.year("o_orderdate") / 10) * 10).cast("string"), F.lit("s"))
    return parquet(spark, sf_dir, "orders").groupBy(decade.alias("decade")).agg(F.count("*").alias("n"))


@query(
    "date_parse",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y-%m-%d') AS long_form,
    strftime(o_orderdate, '%Y-%m-01') AS month_form FROM orders""",
)
def date_parse(spark, sf_dir):
    d = F.col("o_orderdate")
    return parquet(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.parse(F.date_format(d, "yyyy-MM-dd")).cast("string").alias("iso"),
        dates.parse(F.date_format(d, "d MMMM yyyy")).cast("string").alias("long_form"),
        dates.parse(F.date_format(d, "MMMM yyyy")).cast("string").alias("month_form"),
    )


@query(
    "date_provenance",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN strftime(o_orderdate, '%Y-07-01')
      ELSE strftime(o_orderdate, '%Y-%m-%d') END AS published_at,
    CASE o_orderkey % 3 WHEN 0 THEN 'structured_meta' WHEN 1 THEN 'url_pattern' ELSE 'url_year_only' END AS date_source,
    CASE o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS date_confidence FROM orders""",
)
def date_provenance(spark, sf_dir):
    """Order dates written as meta tags, as days in URLs and as years in URLs."""
    d, kind = F.col("o_orderdate"), F.col("o_orderkey") % 3
    page = F.when(kind == 0, F.concat(F.lit('<meta name="dc.date" content="'), F.date_format(d, "yyyy-MM-dd"), F.lit('">'))).otherwise("")
    url = F.when(kind == 1, F.concat(F.lit("https://a.org/"), F.date_format(d, "yyyy/MM/dd"), F.lit("/x"))).otherwise(
        F.concat(F.lit("https://a.org/"), F.date_format(d, "yyyy"), F.lit("/x"))
    )
    found = dates.provenance(page, url, F.lit(""), as_of_year=2026)
    return parquet(spark, sf_dir, "orders").select("o_orderkey", found.alias("f")).select(
        "o_orderkey", F.col("f.published_at").cast("string").alias("published_at"), "f.date_source", "f.date_confidence"
    )


@query(
    "date_fallback",
    """SELECT o_orderkey, strftime(make_date(year(o_orderdate), month(o_orderdate), least(day(o_orderdate), 28)), '%Y-%m-%d') AS day FROM orders""",
)
def date_fallback(spark, sf_dir):
    d = F.col("o_orderdate")
    url = F.concat(F.lit("https://a.org/"), F.date_format(d, "yyyy/MM/dd"))
    return parquet(spark, sf_dir, "orders").select("o_orderkey", dates.fallback(url, F.lit("")).cast("string").alias("day"))
