"""Publication dates with provenance, as column expressions.

`as_of_year` stands for the clock: years from as_of_year + 1 on are in the future and never accepted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST = 1990
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
#: Meta names that carry a publication date, in order.
META_DATES = (
    "article:published_time",
    "og:article:published_time",
    "date",
    "dc.date",
    "dc:date",
    "citation_date",
    "citation_publication_date",
    "prism.publicationDate",
)
#: How pages and URLs state dates.
LABELLED_DAY = rf"(?i)(?:published|posted|released|issued)(?:\s+(?:on|date))?\s*:?\s*(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})"
LABELLED_ISO = r"(?i)(?:published|posted|released|issued)(?:\s+(?:on|date))?\s*:?\s*(\d{4}-\d{2}-\d{2})"
DATE_FIELD = rf"(?i)Date\s*:\s*(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})"
URL_DAY = r"/(199\d|20[0-2]\d)[/-](0[1-9]|1[0-2])[/-](0[1-9]|[12]\d|3[01])"
URL_YEAR = r"(?:/|-)(199\d|20[0-2]\d)(?:/|-|\.|$|_)"
TEXT_YEAR = r"(?i)(?:^|\n)(?:Published|Posted|Released|Issued)\s+(?:in\s+)?(\d{4})"


def parse(text: Column) -> Column:
    """A date from ISO dates and timestamps, slashed dates, long forms, months and years."""
    t = F.trim(text)
    iso = F.regexp_extract(t, r"^(\d{4})[-/](\d{2})[-/](\d{2})(?:[T ].*)?$", 0)
    day_first = F.regexp_extract(t, rf"(?i)^\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}$", 0)
    month_first = F.regexp_extract(t, rf"(?i)^(?:{MONTHS})\s+\d{{1,2}},\s*\d{{4}}$", 0)
    month = F.regexp_extract(t, rf"(?i)^(?:{MONTHS})\s+\d{{4}}$", 0)
    one = F.initcap(F.regexp_replace(day_first, r"\s+", " "))
    two = F.regexp_replace(F.initcap(month_first), r"\s*,\s*", ", ")
    three = F.initcap(F.regexp_replace(month, r"\s+", " "))
    return F.coalesce(
        F.when(iso != "", F.try_to_date(F.regexp_replace(F.substring(t, 1, 10), "/", "-"), "yyyy-MM-dd")),
        F.when(day_first != "", F.try_to_date(one, "d MMMM yyyy")),
        F.when(month_first != "", F.try_to_date(two, "MMMM d, yyyy")),
        F.when(month != "", F.try_to_date(F.concat(F.lit("1 "), three), "d MMMM yyyy")),
        F.when(t.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(t, F.lit("-01")), "yyyy-MM-dd")),
        F.when(t.rlike(r"^\d{4}$"), F.try_to_date(F.concat(t, F.lit("-01-01")), "yyyy-MM-dd")),
    )


def _accept(d: Column, as_of_year: int, historic: bool = True) -> Column:
    good = F.year(d) <= as_of_year
    return F.when(good & (F.year(d) >= EARLIEST) if historic else good, d)


def _found(d: Column, source: str, confidence: str) -> Column:
    return F.when(
        d.isNotNull(), F.struct(d.alias("published_at"), F.lit(source).alias("date_source"), F.lit(confidence).alias("date_confidence"))
    )


def _mid_year(y: Column, as_of_year: int) -> Column:
    n = F.nullif(y, F.lit("")).try_cast("int")
    return F.when((n >= EARLIEST) & (n <= as_of_year), F.make_date(n, F.lit(7), F.lit(1)))


def url_day(url: Column) -> Column:
    part = lambda k: F.regexp_extract(url, URL_DAY, k)
    return F.try_to_date(F.when(part(1) != "", F.concat_ws("-", part(1), part(2), part(3))), "yyyy-MM-dd")


def url_year(url: Column) -> Column:
    """The year in a URL's path; ranges such as 2025-2028 are study periods, not publication years."""
    return F.regexp_extract(F.regexp_replace(url, r"\d{4}-\d{4}", ""), URL_YEAR, 1)


def meta_date(html: Column) -> Column:
    """The content of the first date meta tag in the order of META_DATES."""
    found = []
    for name in META_DATES:
        quoted = name.replace(".", r"\.")
        found.append(
            F.nullif(
                F.regexp_extract(html, rf"""(?i)<meta\s+(?:name|property)=["']{quoted}["']\s+content=["']([^"']+)["']""", 1), F.lit("")
            )
        )
    return F.coalesce(*found)


def provenance(html: Column, url: Column, text: Column, as_of_year: int, published: Column | None = None) -> Column:
    """published_at, date_source, date_confidence of the first source that yields an acceptable date.

    In order: meta tags, given metadata, labelled days of the text, a day in the URL, a year in the
    URL (July 1, weak), a publication year in the text.
    """
    head = F.substring(text, 1, 3000)
    raw = [meta_date(html), F.lit(None).cast("string") if published is None else published]
    raw += [F.nullif(F.regexp_extract(head, p, 1), F.lit("")) for p in (LABELLED_DAY, LABELLED_ISO, DATE_FIELD)]
    seen = F.struct(
        # parsed through a lambda, so that the parser's code appears once
        F.transform(F.array(*raw), parse).alias("days"),
        url_day(url).alias("day"),
        _mid_year(url_year(url), as_of_year).alias("year"),
        _mid_year(F.regexp_extract(F.substring(text, 1, 2000), TEXT_YEAR, 1), as_of_year).alias("said"),
    )
    none = F.struct(
        F.lit(None).cast("date").alias("published_at"), F.lit("unknown").alias("date_source"), F.lit("none").alias("date_confidence")
    )

    def choose(s: Column) -> Column:
        day = lambda k: F.get(s["days"], F.lit(k))
        return F.coalesce(
            _found(_accept(day(0), as_of_year, historic=False), "structured_meta", "high"),
            _found(_accept(day(1), as_of_year), "document_metadata", "high"),
            *[_found(_accept(day(k), as_of_year), "page_content", "medium") for k in (2, 3, 4)],
            _found(_accept(s["day"], as_of_year, historic=False), "url_pattern", "medium"),
            _found(s["year"], "url_year_only", "low"),
            _found(s["said"], "page_content", "medium"),
            none,
        )

    return F.get(F.transform(F.array(seen), choose), F.lit(0))


def title_year(title: Column, as_of_year: int) -> Column:
    """The year that a title names, unless it is the number of a document (RFC, arXiv)."""
    y = F.regexp_extract(title, r"\b(199[0-9]|20[0-2][0-9])\b", 1)
    return _mid_year(F.when(~title.rlike(r"(?i)\bRFC\s*\d{4}\b") & ~title.rlike(r"(?i)\b(?:RFC|arxiv|doc\s*id)\s*(?:199\d|20[0-2]\d)"), y), as_of_year)


def fallback(url: Column, text: Column) -> Column:
    """A day from the URL or the text's head; July and the first where parts are missing; days end at 28."""
    where = F.concat_ws("\n", url, F.substring(text, 1, 2000))
    p = r"(199\d|20[0-2]\d)[-/](0[1-9]|1[0-2])(?:[-/](0[1-9]|[12]\d|3[01]))?"
    y, m, d = (F.nullif(F.regexp_extract(where, p, k), F.lit("")).cast("int") for k in (1, 2, 3))
    only = F.nullif(F.regexp_extract(where, r"(?:^|[^0-9])(199\d|20[0-2]\d)(?:[^0-9]|$)", 1), F.lit("")).cast("int")
    return F.coalesce(
        F.make_date(y, m, F.least(F.coalesce(d, F.lit(1)), F.lit(28))), F.make_date(only, F.lit(7), F.lit(1))
    )
