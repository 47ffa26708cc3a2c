"""Source discovery over captured pages: candidates, links by kind of page, deduplication, health; a registry of adapters.

Capture itself is outside; `captures` holds what it brought (url, http_status, robots_allowed, content_type, body),
one row a URL. All sources are discovered in one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import urls
from .readers import discovered_links

#: Keys of a source's discovery settings that list URLs, in order; then what is tried where none does.
URL_KEYS = ("seed_urls", "start_urls", "sitemap_urls", "feed_urls", "urls")
PROBES = ("", "sitemap.xml", "feed", "rss.xml", "atom.xml")


def _listed(value: object) -> list[str]:
    values = [value] if isinstance(value, str) else list(value or [])
    return [str(v).strip() for v in values if str(v).strip()]


def candidates(spark: SparkSession, sources: Sequence[Mapping]) -> DataFrame:
    """source_id, ordinal, url: what to capture of each source (id, domains, discovery), each URL once, in order."""
    rows = []
    for s in sources:
        root, settings = f"https://{s['domains'][0].rstrip('/')}/", s.get("discovery") or {}
        found = [u for key in URL_KEYS for u in _listed(settings.get(key))] or [root + p for p in PROBES]
        found += [root + p.lstrip("/") for p in _listed(settings.get("paths"))]
        rows += [(s["id"], k, u) for k, u in enumerate(dict.fromkeys(found))]
    return spark.createDataFrame(rows, "source_id string, ordinal int, url string")


def page_kind(url: Column, content_type: Column) -> Column:
    """html, sitemap, feed, or null for what holds no links."""
    low, kind = F.lower(url), F.lower(F.coalesce(content_type, F.lit("")))
    xml = kind.endswith("xml") | low.rlike(r"\.(xml|rss|atom)$")
    return F.when(F.contains(kind, F.lit("html")), "html").when(xml & F.contains(low, F.lit("sitemap")), "sitemap").when(xml, "feed")


def captured(wanted: DataFrame, captures: DataFrame) -> DataFrame:
    """The candidates with their captures and an outcome: captured, blocked (robots), failed (status), or missing."""
    ok = F.col("http_status").between(200, 399)
    outcome = (
        F.when(F.col("http_status").isNull(), "missing").when(~F.coalesce("robots_allowed", F.lit(True)), "blocked").when(ok, "captured").otherwise("failed")
    )
    return wanted.join(captures, "url", "left").withColumn("outcome", outcome)


def links(seen: DataFrame) -> DataFrame:
    """source_id, url, found_on, ordinal: the links of captured pages, absolute and valid, each normalised URL once a source."""
    kind = page_kind(F.col("url"), F.col("content_type"))
    found = F.when(kind == "html", discovered_links("html", F.col("body"))).when(kind == "sitemap", discovered_links("sitemap", F.col("body")))
    found = found.when(kind == "feed", discovered_links("feed", F.col("body")))
    rows = seen.filter("outcome = 'captured'").select("source_id", "ordinal", F.col("url").alias("found_on"), F.posexplode(found).alias("place", "link"))
    rows = rows.withColumn("url", urls.resolve(F.col("found_on"), F.col("link"))).filter(urls.valid(F.col("url")))
    first = F.min(F.struct("ordinal", "place", "url", "found_on")).alias("first")
    per = rows.groupBy("source_id", urls.trimmed(F.col("url")).alias("normalized_url")).agg(first)
    return per.select("source_id", "normalized_url", "first.url", "first.found_on", "first.ordinal", "first.place")


def health(seen: DataFrame, found: DataFrame) -> DataFrame:
    """One row a source: status, outcomes, the last captured page, the last failure, and the number of URLs found.

    reachable: something was captured; else the last outcome decides: blocked, degraded (failed), unreachable.
    """
    last = F.max_by(F.struct("url", "http_status", "content_type"), F.when(F.col("outcome") == "captured", F.col("ordinal")))
    refused = F.max_by("outcome", F.when(F.col("outcome").isin("blocked", "failed"), F.col("ordinal")))
    n = lambda o: F.count_if(F.col("outcome") == o).alias(f"n_{o}")
    per = seen.groupBy("source_id").agg(*map(n, ("captured", "blocked", "failed", "missing")), last.alias("last"), refused.alias("refused"))
    status = F.when(F.col("n_captured") > 0, "reachable").when(F.col("refused") == "blocked", "blocked").when(F.col("refused") == "failed", "degraded")
    counts = found.groupBy("source_id").agg(F.count("*").alias("discovered"))
    out = per.join(counts, "source_id", "left").withColumn("discovered", F.coalesce("discovered", F.lit(0)).cast("long"))
    return out.select("source_id", status.otherwise("unreachable").alias("status"), "n_captured", "n_blocked", "n_failed", "n_missing", "last", "discovered")


def discover(wanted: DataFrame, captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The URLs that sources lead to, and the sources' health."""
    seen = captured(wanted, captures)
    found = links(seen)
    return found, health(seen, found)


def health_index(rows: DataFrame) -> DataFrame:
    """One row: numbers of sources and URLs, and sources by status."""
    by = F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n"))))
    per = rows.groupBy("status").agg(F.count("*").alias("n"), F.sum("discovered").alias("d"))
    return per.agg(F.sum("n").alias("sources"), F.sum("d").alias("discovered"), by.alias("by_status"))


def write_health(rows: DataFrame, path: str) -> None:
    """The health rows and the index as JSON."""
    rows.write.mode("overwrite").json(f"{path}/sources")
    health_index(rows).write.mode("overwrite").json(f"{path}/index")


class Adapter:
    """How one publisher's URLs are found: seeds, at most max_pages of them, then links of their captures."""

    seeds: Sequence[str] = ()

    def __init__(self, source_id: str, seeds: Sequence[str] | None = None, max_pages: int = 50):
        self.source_id, self.max_pages = source_id, max_pages
        self.seeds = tuple(self.seeds if seeds is None else seeds)

    def candidates(self) -> list[tuple[str, int, str]]:
        return [(self.source_id, k, u) for k, u in enumerate(dict.fromkeys(self.seeds[: self.max_pages]))]


class Publisher(Adapter):
    """A publisher's site: its sitemap, then its front page."""

    def __init__(self, source_id: str, seeds: Sequence[str] | None = None, max_pages: int = 50):
        root = f"https://{SITES[source_id]}/"
        super().__init__(source_id, (f"{root}sitemap.xml", root) if seeds is None else seeds, max_pages)


#: Publishers with adapters of their own, and their hosts.
SITES = {
    "icann": "www.icann.org",
    "ietf": "www.ietf.org",
    "itu": "www.itu.int",
    "un": "www.un.org",
    "igf": "www.intgovforum.org",
    "itut": "www.itu.int",
    "academic": "arxiv.org",
    "government": "www.ntia.gov",
}
ADAPTERS: dict[str, Callable[..., Adapter]] = dict.fromkeys(SITES, Publisher)


def register(source_id: str, make: Callable[..., Adapter] = Adapter) -> None:
    ADAPTERS[source_id] = make


def adapter(source_id: str, **settings) -> Adapter:
    if source_id not in ADAPTERS:
        raise KeyError(f"no adapter for {source_id!r}; known: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[source_id](source_id, **settings)


def discover_all(spark: SparkSession, captures: DataFrame, settings: Mapping[str, Mapping] | None = None) -> tuple[DataFrame, DataFrame]:
    """discover() for all registered adapters, or for those that settings name, in one plan."""
    names = list(ADAPTERS if settings is None else settings)
    rows = [r for name in names for r in adapter(name, **dict((settings or {}).get(name, {}))).candidates()]
    return discover(spark.createDataFrame(rows, "source_id string, ordinal int, url string"), captures)


def rows_of(found: DataFrame, documents: DataFrame) -> DataFrame:
    """source_id, document_ids: discovered URLs that became documents (document_id, source_url), by source."""
    same = documents.select("document_id", urls.trimmed(F.col("source_url")).alias("normalized_url"))
    first = Window.partitionBy("source_id", "normalized_url").orderBy("document_id")
    one = found.join(same, "normalized_url").withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return one.groupBy("source_id").agg(F.array_sort(F.collect_set("document_id")).alias("document_ids"))
