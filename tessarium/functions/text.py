"""Text functions as column expressions: tokens, sentences, paragraphs, segments, shingles, passages."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Words in every script, with inner apostrophes and hyphens; written so that Java and RE2 agree.
TOKEN = r"[\p{L}\p{N}_]+(?:['-]+[\p{L}\p{N}_]+)*"
SPACE = r"[\s\x{85}\x{A0}]+"


def tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)), F.lower)


def term_counts(words: Column) -> Column:
    """The distinct words of an array with their counts (term, tf), inside the row: runs of the sorted array."""

    def runs(s: Column) -> Column:
        n = F.size(s)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(s, i) != F.get(s, i - 1)))
        return F.get(F.transform(F.array(ends), lambda e: F.transform(e, lambda i, k: F.struct(F.get(s, i - 1).alias("term"), (i - F.when(k > 0, F.get(e, k - 1)).otherwise(0)).alias("tf")))), F.lit(0))

    none = F.expr("CAST(array() AS array<struct<term:string,tf:int>>)")
    # bound to a lambda variable, so that the words are found and sorted once
    return F.get(F.transform(F.array(F.sort_array(words)), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none)), F.lit(0))


def ascii_bounds(pattern: str) -> str:
    """The pattern with \\b between ASCII word characters and all others, as in RE2; Java's also knows letters beyond ASCII."""
    return pattern.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))")


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def reading_minutes(text: Column, per_minute: int = 200) -> Column:
    return F.greatest(F.lit(1), F.ceil(word_count(text) / per_minute)).cast("long")


def sentences(text: Column) -> Column:
    """Split after ., ! or ? before white space; blank pieces dropped."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+"), strip)
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column) -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\n\s*\n"), strip)
    return F.filter(parts, lambda p: p != "")


def char_shingles(text: Column, k: int = 5) -> Column:
    """Distinct character k-grams of the text's stripped lines; the text itself where it is shorter."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\n"), strip)
    flat = F.array_join(F.filter(lines, lambda x: x != ""), " ")

    def grams(chars: Column) -> Column:
        # characters as an array: a slice costs k steps wherever it starts, a substring its whole way there
        n = F.size(chars)
        found = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.array_join(F.slice(chars, i, F.lit(k)), ""))
        return F.when(n >= k, F.array_distinct(found)).otherwise(F.array(F.array_join(chars, "")))

    # bound to a lambda variable, so that the characters are split once
    return F.get(F.transform(F.array(F.split(flat, "")), grams), F.lit(0))


def key_passage(text: Column, cut: int = 500) -> Column:
    """The first line over 80 characters that opens no navigation, else the first over 40, else the text."""
    #: Words that open navigation lines.
    opens = r"^(?:Skip|Search|Menu|Home|Log)"
    lines = F.filter(F.transform(F.split(text, r"\n"), strip), lambda x: F.length(x) > 40)
    good = F.filter(lines, lambda x: (F.length(x) > 80) & ~x.rlike(opens))
    return F.substring(F.coalesce(F.get(good, F.lit(0)), F.get(lines, F.lit(0)), text), 1, cut)


def quality_score(text: Column, minimum: int = 20) -> Column:
    n = F.length(text)
    broken = n - F.length(F.replace(text, F.lit("�"), F.lit("")))
    good = F.least(n / F.lit(float(minimum * 10)), F.lit(1.0))
    penalty = F.least(F.lit(100.0) * broken / F.greatest(n, F.lit(1)), F.lit(0.5))
    score = F.round(F.greatest(F.lit(0.0), good - penalty), 4)
    blank = strip(text) == ""
    return F.struct(
        F.when(blank | (F.length(strip(text)) < minimum), "failed").otherwise("passed").alias("status"),
        F.when(blank, 0.0).otherwise(score).alias("score"),
    )


@F.pandas_udf(StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalize(text: Column) -> Column:
    """NFKC, line ends, runs of blanks, blanks round line ends, at most one empty line, ends stripped.

    Spark has no NFKC; ASCII text needs none, so callers split rows by `needs_nfkc` and pass only
    the others through `_nfkc` (see operators.corpus.normalized).
    """
    text = F.regexp_replace(text, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r" *\n *", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return strip(text)


def needs_nfkc(text: Column) -> Column:
    return text.rlike(r"[^\x00-\x7F]")


def segments(text: Column, target: int = 1800) -> Column:
    """Greedy chunks of paragraphs: ordinal, text, char_start, char_end.

    A fold over the paragraphs joins them by an empty line until a chunk has `target` characters; offsets
    count the chunks' characters in the joined paragraphs, so substring(joined, start + 1, end - start) is the chunk.
    """
    zero = F.expr("named_struct('buf', '', 'at', 0, 'done', CAST(array() AS array<struct<text:string,char_start:int,char_end:int>>))")

    def item(s: Column, buf: Column) -> Column:
        return F.struct(buf.alias("text"), s["at"].alias("char_start"), (s["at"] + F.length(buf)).alias("char_end"))

    def step(s: Column, p: Column) -> Column:
        buf = F.when(s["buf"] == "", p).otherwise(F.concat(s["buf"], F.lit("\n\n"), p))
        full = F.length(buf) >= target
        return F.struct(
            F.when(full, "").otherwise(buf).alias("buf"),
            F.when(full, s["at"] + F.length(buf) + 2).otherwise(s["at"]).alias("at"),
            F.when(full, F.concat(s["done"], F.array(item(s, buf)))).otherwise(s["done"]).alias("done"),
        )

    def last(s: Column) -> Column:
        return F.when(s["buf"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(item(s, s["buf"]))))

    return F.aggregate(paragraphs(text), zero, step, last)
