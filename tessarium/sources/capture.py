"""What surrounds capture without a network: robots rules, options, rate limits, file extraction, artifact status."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from urllib import robotparser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import page_text
from ..functions.urls import host

TIMEOUT_S, MAX_BYTES = 30, 50 * 1024 * 1024


def capture_options(max_bytes: int | None = None, max_download_mb: float | None = None, timeout_s: float | None = None) -> dict:
    """Checked options: one size limit at most, all positive, with defaults."""
    if max_bytes is not None and max_download_mb is not None:
        raise ValueError("give max_bytes or max_download_mb, not both")
    size = int(max_download_mb * 1024 * 1024) if max_download_mb is not None else MAX_BYTES if max_bytes is None else max_bytes
    wait = TIMEOUT_S if timeout_s is None else timeout_s
    if size <= 0 or wait <= 0:
        raise ValueError("limits must be positive")
    return {"max_bytes": size, "timeout_s": wait}


def robots_allowed(urls: DataFrame, robots: DataFrame, agent: str = "*") -> DataFrame:
    """url, allowed: by pre-fetched robots files (host, http_status, body), one a host.

    404 and empty files allow, other errors and hosts never fetched deny, else the rules decide.
    """

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, robotparser.RobotFileParser] = {}
        for pdf in batches:
            out = []
            for url, status, body in zip(pdf["url"], pdf["http_status"], pdf["body"], strict=True):
                if pd.isna(status):
                    out.append(False)
                elif status == 404 or not (body or "").strip():
                    out.append(bool(status < 400 or status == 404))
                elif status >= 400:
                    out.append(False)
                else:
                    if body not in known:
                        known.clear()
                        known[body] = robotparser.RobotFileParser()
                        known[body].parse(body.splitlines())
                    out.append(known[body].can_fetch(agent, url))
            yield pd.DataFrame({"url": pdf["url"], "allowed": out})

    named = urls.select("url").withColumn("host", host(F.col("url")))
    return named.join(robots, "host", "left").select("url", "http_status", "body").mapInPandas(decide, "url string, allowed boolean")


def rate_plan(urls: DataFrame, order: str, seconds: float = 1.0) -> DataFrame:
    """Adds wait_s: the pause before a URL whose predecessor in its source has the same host."""
    w = Window.partitionBy("source_id").orderBy(order)
    rows = urls.withColumn("_host", host(F.col("url")))
    return rows.withColumn("wait_s", F.when(F.lag("_host").over(w) == F.col("_host"), seconds).otherwise(0.0)).drop("_host")


def docx_text(data: bytes) -> str:
    """The non-blank paragraphs of a word-processor file."""
    tree = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    lines = ("".join(t.text or "" for t in p.iter(f"{space}t")).strip() for p in tree.iter(f"{space}p"))
    return "\n".join(x for x in lines if x)


def _plain(data: bytes) -> str:
    return data.decode("utf-8", errors="replace")


#: What reads images of pages: bytes of a file to text; none unless one registers here.
PAGE_READERS: list = []


def pdf_text(data: bytes, pages: list[str]) -> str:
    """The text of a file's pages; where none has any, what a registered page reader makes of the file."""
    if any(p.strip() for p in pages):
        return "\n\n".join(pages)
    return next((text for read in PAGE_READERS if (text := read(data))), "")


def _pdf(data: bytes) -> str:
    from pypdf import PdfReader  # optional: rows get an error where it is missing

    return pdf_text(data, [p.extract_text() or "" for p in PdfReader(io.BytesIO(data)).pages])


#: Extractors by media type; OCR, speech and video extractors register here.
EXTRACTORS = {
    "text/html": lambda data: page_text(_plain(data)),
    "text/plain": _plain,
    "application/pdf": _pdf,
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": docx_text,
}


def extract(artifacts: DataFrame) -> DataFrame:
    """path, text, method, error of captured files (path, media_type, content); a failure is a row, not a crash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, kind, data in zip(pdf["path"], pdf["media_type"], pdf["content"], strict=True):
                try:
                    out.append((path, EXTRACTORS[kind](bytes(data)), kind, None))
                except KeyError:
                    out.append((path, None, kind, "unsupported media type"))
                except Exception as e:  # whatever a library raises on a broken file
                    out.append((path, None, kind, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["path", "text", "method", "error"])

    return artifacts.select("path", "media_type", "content").mapInPandas(run, "path string, text string, method string, error string")
