"""Ingestion of captured files in one plan: known files, extraction, normalisation, gates, near duplicates, segments, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import quality_score, reading_minutes, segments, word_count
from ..sources.capture import extract
from .corpus import near_firsts, normalized


def gate(text: Column, size: Column, minimum: int = 20) -> Column:
    """Why a file is rejected: no bytes, or less than the least text; null where it passes."""
    return F.when(F.coalesce(size, F.lit(0)) < 1, "empty file").when(F.length(F.trim(F.coalesce(text, F.lit("")))) < minimum, "too little text")


def ingest(artifacts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row a file (path, bytes, sha256, media_type, content): status, reason, text, quality, segments and counts.

    known (sha256) are files that were ingested before. Of equal files the first path counts. Status: duplicate,
    failed (extraction), rejected (gates) or accepted; every file keeps its row.
    """
    rows = artifacts.select("path", "bytes", "sha256", "media_type")
    firsts = rows.groupBy("sha256").agg(F.min("path").alias("path"))
    if known is not None:
        firsts = firsts.join(known.select("sha256").distinct(), "sha256", "left_anti")
    new = artifacts.join(firsts.select("path"), "path", "left_semi")
    texts = normalized(extract(new))
    out = rows.join(texts.select("path", "text", "error", F.lit(True).alias("_new")), "path", "left")
    reason = (
        F.when(F.col("_new").isNull(), "known content").when(F.col("error").isNotNull(), F.col("error")).otherwise(gate(F.col("text"), F.col("bytes")))
    )
    status = F.when(F.col("_new").isNull(), "duplicate").when(F.col("error").isNotNull(), "failed").when(F.col("reason").isNotNull(), "rejected").otherwise("accepted")
    out = out.withColumn("reason", reason).withColumn("status", status)
    fine = F.col("status") == "accepted"
    return out.select(
        "path", "bytes", "sha256", "media_type", "status", "reason", F.when(fine, F.col("text")).alias("text"),
        F.when(fine, quality_score(F.col("text"))).alias("quality"), F.when(fine, segments(F.col("text"))).alias("segments"),
        F.when(fine, word_count(F.col("text"))).alias("word_count"), F.when(fine, reading_minutes(F.col("text"))).alias("reading_minutes"),
    )


def without_near_duplicates(ingested: DataFrame, accepted: DataFrame | None, folder: str, threshold: float = 0.9) -> DataFrame:
    """Accepted files that are near an accepted earlier one (doc_id, text) or an earlier path become rejected."""
    new = ingested.filter("status = 'accepted'").select(F.col("path").alias("doc_id"), "text")
    kept = near_firsts(new, accepted, folder, threshold).select(F.col("doc_id").alias("path"), F.lit(True).alias("_kept"))
    near = (F.col("status") == "accepted") & F.col("_kept").isNull()
    out = ingested.join(kept, "path", "left")
    return out.withColumns({"status": F.when(near, "rejected").otherwise(F.col("status")), "reason": F.when(near, "near duplicate").otherwise(F.col("reason"))}).drop("_kept")


def events(ingested: DataFrame, agent: str, at: str) -> DataFrame:
    """One provenance event a file: what became of it, by whom, at a time that is given."""
    kind = F.concat(F.lit("FILE_"), F.upper("status"))
    key = F.concat_ws("\x01", "path", "sha256", "status")
    return ingested.select(
        F.sha2(key, 256).alias("event_id"), kind.alias("event_type"), F.col("path").alias("entity_id"), F.lit(agent).alias("agent"),
        F.create_map(F.lit("reason"), F.coalesce("reason", F.lit(""))).alias("attributes"), F.lit(at).alias("timestamp"),
    )
