"""Retrieval, transcription and benchmark metrics as column expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L


def recall_at(got: str, want: str, k: int) -> Column:
    """1 where nothing is relevant."""
    hits = F.size(F.array_intersect(F.slice(got, 1, k), F.col(want)))
    return F.when(F.size(want) == 0, 1.0).otherwise(hits / F.size(want))


def precision_at(got: str, want: str, k: int) -> Column:
    """Over what was retrieved, not over k."""
    cut = F.slice(got, 1, k)
    return F.when(F.size(cut) == 0, 0.0).otherwise(F.size(F.filter(cut, lambda x: F.array_contains(want, x))) / F.size(cut))


def reciprocal_rank(got: str, want: str) -> Column:
    places = F.transform(F.col(got), lambda x, i: F.when(F.array_contains(want, x), i + 1))
    return F.coalesce(1 / F.array_min(F.array_compact(places)), F.lit(0.0))


def evidence_recall(got: Column, want: Column) -> Column:
    """0 where nothing is wanted, in contrast to recall_at."""
    return F.when(F.size(want) == 0, 0.0).otherwise(F.size(F.array_intersect(got, want)) / F.size(want))


def coverage(represented: Column, expected: Column) -> Column:
    return F.when(F.size(expected) == 0, 1.0).otherwise(F.size(F.array_intersect(represented, expected)) / F.size(expected))


def set_wer(expected: Column, got: Column) -> Column:
    words = lambda x: F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"\S+"), F.lit(0)))
    return 1 - F.size(F.array_intersect(words(expected), words(got))) / F.greatest(F.size(words(expected)), F.lit(1))


def overlap_score(expected: DataFrame, got: DataFrame, bucket: float) -> DataFrame:
    """group, score: overlapping time of all pairs by the expected time; an equi-join on time buckets."""
    def cut(df: DataFrame) -> DataFrame:
        return df.withColumn("_lo", F.floor(F.col("start") / bucket)).withColumn(
            "_b", F.explode(F.sequence(F.col("_lo"), F.floor(F.col("end") / bucket)))
        )

    b = cut(got).select("group", "_b", F.col("start").alias("s2"), F.col("end").alias("e2"), F.col("_lo").alias("_lo2"))
    both = cut(expected).join(b, ["group", "_b"]).filter(F.col("_b") == F.greatest("_lo", "_lo2"))
    shared = both.groupBy("group").agg(F.sum(F.greatest(F.least("end", "e2") - F.greatest("start", "s2"), F.lit(0.0))).alias("shared"))
    total = expected.groupBy("group").agg(F.sum(F.col("end") - F.col("start")).alias("total"))
    return total.join(shared, "group", "left").select("group", (F.coalesce("shared", F.lit(0.0)) / F.col("total")).alias("score"))


def pass_rates(results: DataFrame) -> DataFrame:
    n = F.count("*")
    return results.groupBy("suite").agg(n.alias("total"), F.count_if("passed").alias("passed"), (F.count_if("passed") / n).alias("rate"))


def fabricated(answer: Column, evidence: Column, phrases: tuple[str, ...] = L.UNCERTAIN) -> Column:
    """No evidence, something said, and no uncertainty disclosed."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    open_about_it = F.lit(False)
    for p in phrases:
        open_about_it = open_about_it | F.contains(low, F.lit(p))
    return (evidence <= 0) & (F.trim(low) != "") & ~open_about_it


def loss_summary(losses: DataFrame, key: str) -> DataFrame:
    """Mean, upper median, extremes and mean of exp(loss); value counts carry the median, not the rows."""
    per = losses.groupBy(key, "loss").agg(F.count("*").alias("c"))
    w = Window.partitionBy(key)
    ranked = per.withColumn("upto", F.sum("c").over(w.orderBy("loss"))).withColumn("n", F.sum("c").over(w))
    mid = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col("loss")))
    return ranked.groupBy(key).agg(
        (F.sum(F.col("loss") * F.col("c")) / F.sum("c")).alias("mean"),
        mid.alias("median"),
        F.min("loss").alias("low"),
        F.max("loss").alias("high"),
        (F.sum(F.exp("loss") * F.col("c")) / F.sum("c")).alias("perplexity"),
    )
