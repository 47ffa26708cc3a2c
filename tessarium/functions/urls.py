"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of sources by a part of their URL, in order; the first that fits counts.
SOURCE_LABELS = (
    ("icann.org", "ICANN"),
    ("ietf.org", "IETF"),
    ("rfc-editor.org", "IETF"),
    ("datatracker.ietf.org", "IETF"),
    ("itu.int", "ITU"),
    ("intgovforum.org", "IGF"),
    ("internetsociety.org", "ISOC"),
    ("isocfoundation.org", "ISOC"),
    ("oecd.org", "OECD"),
    ("un.org", "UN"),
    ("unesco.org", "UNESCO"),
    ("arin.net", "ARIN"),
    ("ripe.net", "RIPE"),
    ("apnic.net", "APNIC"),
    ("lacnic.net", "LACNIC"),
    ("afrinic.net", "AFRINIC"),
    ("europa.eu", "EU"),
    ("arxiv.org", "Academic"),
    ("iana.org", "IANA"),
    ("wto.org", "WTO"),
)

#: Parts of host and path that mark a stakeholder group.
STAKEHOLDER_PARTS = {
    "government": ("gov", "agency", "regulation", "legislation"),
    "industry": ("corp", "inc", "company", "business", "commercial"),
    "civil_society": ("org", "ngo", "civil", "society", "advocacy"),
    "technical_community": ("ietf", "rfc", "standard", "wg", "working-group"),
    "academia": ("edu", "university", "research", "institute", "academic"),
    "intergovernmental": ("un", "unesco", "itu", "oecd", "unicef", "undp"),
    "regional_internet_registry": ("arin", "ripe", "apnic", "lacnic", "afrinic"),
}


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":\d*$", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def valid(url: Column, schemes: tuple[str, ...] = ("http", "https")) -> Column:
    return scheme(url).isin(*schemes) & (netloc(url) != "")


def canonical(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no ports 80 and 443, no utm_ parameters, sorted query."""
    site = F.regexp_replace(netloc(url), r":(?:80|443)$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike(r"^[^=]+=.+") & ~F.lower(p).startswith("utm_"))
    kept = F.array_join(F.array_sort(pairs), "&")
    way = F.regexp_replace(path(url), r";[^/]*$", "")
    way = F.when(way == "", "/").otherwise(way)
    return F.concat(scheme(url), F.lit("://"), site, way, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def trimmed(url: Column) -> Column:
    """Lower-case scheme and host, no slashes at the path's end; query and fragment stay."""
    way = F.regexp_replace(path(url), r"/+$", "")
    rest = F.regexp_extract(url, r"^[^?#]*(.*)$", 1)
    return F.concat(scheme(url), F.lit("://"), netloc(url), way, rest)


def source_label(url: Column) -> Column:
    low = F.lower(url)
    out = F.when(F.coalesce(url, F.lit("")) == "", "unknown")
    for part, label in SOURCE_LABELS:
        out = out.when(F.contains(low, F.lit(part)), label)
    return out.otherwise("other")


def matches_group(url: Column, group: str) -> Column:
    where = F.concat(host(url), F.lower(path(url)))
    return F.exists(F.array(*[F.lit(p) for p in STAKEHOLDER_PARTS.get(group, ("\x00",))]), lambda p: F.contains(where, p))


def source_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 24)


def suffixes(site: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c], for suffix joins on equality."""
    parts = F.split(site, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link: absolute, scheme-relative, rooted, query-only and relative ones."""
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    folder = F.regexp_replace(F.when(path(base) == "", "/").otherwise(path(base)), r"[^/]*$", "")
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path(base), link))
        .otherwise(F.concat(root, folder, link))
    )
