"""Sinks: JSON, Parquet, content-addressed files, splits, manifests and alias tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def content_addressed(artifacts: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    """Appends artifacts whose hash the store lacks, by hash prefix; returns what was new."""
    try:
        held = spark.read.parquet(path).select("sha256")
        new = artifacts.join(held, "sha256", "left_anti")
    except Exception as e:  # an empty store has no files yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        new = artifacts
    new = new.dropDuplicates(["sha256"]).withColumn("prefix", F.substring("sha256", 1, 2))
    new.write.mode("append").partitionBy("prefix").parquet(path)
    return new


def export_corpus(docs: DataFrame, path: str) -> None:
    """Canonical export: full JSON lines, and Parquet without texts and segments, nested columns as JSON."""
    docs.write.mode("overwrite").json(f"{path}/jsonl")
    flat = docs.drop("text", "segments")
    nested = [c for c, t in flat.dtypes if t.startswith(("array", "struct", "map"))]
    flat.withColumns({c: F.to_json(c) for c in nested}).write.mode("overwrite").parquet(f"{path}/parquet")


def sft_splits(examples: DataFrame, path: str, **facts: str) -> None:
    """Examples by split, and metadata: numbers by split and task, and what else is to be recorded."""
    examples.write.mode("overwrite").partitionBy("split").json(f"{path}/examples")
    counts = examples.groupBy("split", "task_type").agg(F.count("*").alias("n"))
    counts.withColumns({k: F.lit(v) for k, v in facts.items()}).write.mode("overwrite").json(f"{path}/metadata")


def hub_dataset(docs: DataFrame, flat: DataFrame, path: str, cut: int = 500) -> None:
    """Nested JSON lines, and flat Parquet whose texts are cut."""
    docs.write.mode("overwrite").json(f"{path}/nested")
    short = {c: F.substring(c, 1, cut) for c, t in flat.dtypes if t == "string"}
    flat.withColumns(short).write.mode("overwrite").parquet(f"{path}/flat")


def dataset_folder(splits: dict[str, DataFrame], path: str, title: str) -> None:
    """A dataset of splits: JSON lines a split, their numbers, and a short readme, as text files."""
    spark = next(iter(splits.values())).sparkSession
    rows = []
    for name, df in splits.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
        rows.append((name, df.count(), ", ".join(f"{c} {t}" for c, t in df.dtypes)))
    spark.createDataFrame(rows, "split string, n long, columns string").coalesce(1).write.mode("overwrite").json(f"{path}/info")
    lines = [(f"# {title}",), ("",), *((f"* {name}: {n} rows",) for name, n, _ in rows)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/readme")


def gated_manifest(files: DataFrame, errors: DataFrame, path: str) -> bool:
    """Writes a release's manifest unless a gate has errors; says whether it was written."""
    if not errors.isEmpty():
        return False
    manifest(files).coalesce(1).write.mode("overwrite").json(path)
    return True


def alias_corpus(survivors: DataFrame, aliases: DataFrame, path: str) -> None:
    """The corpus without duplicates, and what each duplicate's id now stands for; written beside, not over, the old one."""
    survivors.write.mode("overwrite").parquet(f"{path}/corpus")
    aliases.write.mode("overwrite").json(f"{path}/aliases")


def hub_records(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with their source's name and family (first match), events renamed (agent to actor), and their size as JSON."""
    from ..operators.relational import first_match

    named = first_match(docs, sources.select("source_id", "name", "family", "registry_order"), "source_id", ["registry_order"]).drop("registry_order")
    size = F.octet_length(F.to_json(F.struct(*(F.col(c) for c in docs.columns)))).alias("json_bytes")
    events = F.transform("provenance_events", lambda e: F.struct(e["event_id"].alias("event_id"), e["event_type"].alias("event_type"), e["agent"].alias("actor"), e["timestamp"].alias("timestamp")))
    out = named.select("*", size)
    return out.withColumn("provenance_events", events) if "provenance_events" in docs.columns else out


def manifest(files: DataFrame) -> DataFrame:
    """path, bytes, sha256 of a release, sorted by path."""
    return files.select("path", "bytes", "sha256").orderBy("path")


def verify_manifest(files: DataFrame, expected: DataFrame) -> DataFrame:
    """path, problem of every file of a manifest that is missing or differs."""
    seen = files.select("path", F.col("sha256").alias("found"))
    problem = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("sha256"), "hash mismatch")
    return expected.join(seen, "path", "left").select("path", problem.alias("problem")).filter("problem IS NOT NULL")
