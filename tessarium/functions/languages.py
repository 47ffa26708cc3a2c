"""Language detection by frequent words, and code maps of recognisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import term_counts

#: Codes that recognisers of text in images and of speech take; others fall back to the defaults.
OCR_CODES = {"en": "eng", "de": "deu", "fr": "fra", "es": "spa"}
ASR_CODES = {"en": "en", "de": "de", "fr": "fr", "es": "es"}


def ocr_code(lang: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for p in OCR_CODES.items() for x in p))[lang], F.lit("eng"))


def asr_model(lang: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for p in ASR_CODES.items() for x in p))[lang], F.lit("base"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}]+"), F.lit(0))


def profile(docs: DataFrame, top: int = 300) -> DataFrame:
    """lang, word, weight: log shares, smoothed, of the words that are among the `top` of any language of labelled texts (lang, text)."""
    counts = docs.filter("lang IS NOT NULL").select("lang", F.inline(term_counts(words(F.col("text")))))
    counts = counts.groupBy("lang", F.col("term").alias("word")).agg(F.sum("tf").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    chosen = counts.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= top).select("word").distinct()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # at most `top` words a language, for each language
    every = chosen.crossJoin(F.broadcast(totals)).join(counts, ["lang", "word"], "left")
    return every.select("lang", "word", F.log((F.coalesce("n", F.lit(0)) + 1) / (F.col("total") + 1)).alias("weight"))


def detect(docs: DataFrame, known: DataFrame, key: str, unknown: str = "und") -> DataFrame:
    """key, guess: the language under which a text's profile words are most likely; ties to the smaller code."""
    terms = docs.select(key, F.inline(term_counts(words(F.col("text")))))
    score = terms.join(known, terms["term"] == known["word"]).groupBy(key, "lang").agg(F.round(F.sum(F.col("tf") * F.col("weight")), 6).alias("s"))
    best = score.groupBy(key).agg(F.min(F.struct((-F.col("s")).alias("s"), "lang"))["lang"].alias("guess"))
    return docs.select(key).join(best, key, "left").select(key, F.coalesce("guess", F.lit(unknown)).alias("guess"))
