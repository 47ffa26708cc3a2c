"""HTML to text with the standard parser, in Arrow batches, and page metadata as column expressions."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Elements without readable text.
SKIPPED = ("script", "style", "noscript", "template")


class _Text(HTMLParser):
    def __init__(self, skipped: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.skipped, self.depth, self.parts, self.title, self.in_title = skipped, 0, [], [], False

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.skipped
        self.in_title |= tag == "title"

    def handle_endtag(self, tag):
        if tag in self.skipped and self.depth:
            self.depth -= 1
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.depth or not data.strip():
            return
        (self.title if self.in_title else self.parts).append(data.strip())


def page_text(page: str | None, skipped: tuple[str, ...] = SKIPPED) -> str | None:
    """Text nodes one a line; the title first unless the first 500 characters hold it."""
    if page is None:
        return None
    p = _Text(skipped)
    p.feed(page)
    p.close()
    body, title = "\n".join(p.parts), " ".join(p.title)
    return f"{title}\n{body}" if title and title not in body[:500] else body


@F.pandas_udf(StringType())
def html_text(page: pd.Series) -> pd.Series:
    return page.map(page_text)


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def language(html: Column) -> Column:
    return F.regexp_extract(html, r"""(?i)<html[^>]*\slang=["']([^"']*)["']""", 1)
