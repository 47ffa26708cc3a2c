"""Sources: typed readers for corpora, captured artifacts, JSON lines and small dimension files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CANONICAL_DOCUMENT, SFT_EXAMPLE


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus_json(spark: SparkSession, path: str, min_chars: int = 200) -> DataFrame:
    """One JSON document a file; unreadable files and short texts are skipped; `path_key` orders the rows."""
    rows = (
        spark.read.schema(CANONICAL_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", "*.json")
        .json(path)
        .withColumn("path_key", F.input_file_name())
    )
    return valid_documents(rows, min_chars)


def valid_documents(docs: DataFrame, min_chars: int) -> DataFrame:
    return docs.filter(F.length("text") >= min_chars)


def sft_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of examples, one file a split; the split is the file's name."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.jsonl", 1)
    return (
        spark.read.schema(SFT_EXAMPLE)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .withColumn("split", F.coalesce(F.nullif(F.col("split"), F.lit("")), name))
    )


def messages_only(examples: DataFrame) -> DataFrame:
    """The messages of examples, with the role user and empty content where they lack one."""
    fill = lambda m: F.struct(F.coalesce(m["role"], F.lit("user")).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"))
    return examples.filter(F.size("messages") > 0).select(F.transform("messages", fill).alias("messages"))


def document_meta(docs: DataFrame) -> DataFrame:
    """document_id and its standard metadata, with defaults where they are missing or blank."""
    or_else = lambda c, d: F.coalesce(F.nullif(F.trim(c), F.lit("")), d)
    return docs.select(
        "document_id",
        or_else(F.col("metadata.title"), F.coalesce("source_url", F.lit("untitled"))).alias("title"),
        or_else(F.col("metadata.language"), F.lit("und")).alias("language"),
        F.col("metadata.published_at").alias("published_at"),
        F.coalesce("source_url", "final_url", F.lit("")).alias("source_url"),
        F.coalesce("source_id", F.lit("unknown")).alias("source_id"),
        F.coalesce("artifact_sha256", F.lit("")).alias("source_hash"),
    )


def yaml_config(path: str) -> dict:
    """A configuration file; it must hold a mapping."""
    import yaml

    loaded = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(loaded, dict):
        raise ValueError(f"{path} holds no mapping")
    return loaded


def registry(spark: SparkSession, sources: Sequence[Mapping]) -> DataFrame:
    """The source registry as a dimension, in its order; domains must be non-empty and without '/'."""
    rows = []
    for k, s in enumerate(sources):
        domains = list(s["domains"])
        if not domains or any(not d or "/" in d for d in domains):
            raise ValueError(f"source {s.get('id')!r} has invalid domains {domains!r}")
        rows.append((k, s["id"], s.get("name"), s.get("family"), [d.lower() for d in domains], bool(s.get("enabled", True))))
    return spark.createDataFrame(
        rows, "registry_order int, source_id string, name string, family string, domains array<string>, enabled boolean"
    )


def url_list(spark: SparkSession, urls: Sequence[str], source_id: str) -> DataFrame:
    return spark.createDataFrame([(source_id, k, u) for k, u in enumerate(urls)], "source_id string, ordinal int, url string")


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Captured files with their bytes, content hash and media type by file name."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.lower("path")
    media = (
        F.when(name.rlike(r"\.html?$"), "text/html")
        .when(name.endswith(".pdf"), "application/pdf")
        .when(name.endswith(".docx"), "application/vnd.openxmlformats-officedocument.wordprocessingml.document")
        .when(name.rlike(r"\.(txt|md)$"), "text/plain")
        .otherwise("application/octet-stream")
    )
    return rows.select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), media.alias("media_type"), "content"
    )


def discovered_links(kind: str, text: F.Column) -> F.Column:
    """The links of a sitemap (<loc>), a feed (<item><link>) or a page (<a href>, without fragments)."""
    if kind == "sitemap":
        return F.transform(F.regexp_extract_all(text, F.lit(r"(?s)<loc>(.*?)</loc>"), F.lit(1)), lambda x: F.trim(x))
    if kind == "feed":
        items = F.regexp_extract_all(text, F.lit(r"(?s)<item\b.*?</item>"), F.lit(0))
        return F.transform(items, lambda i: F.trim(F.regexp_extract(i, r"(?s)<link>(.*?)</link>", 1)))
    found = F.regexp_extract_all(text, F.lit(r"""<a [^>]*href="([^"#][^"]*)\""""), F.lit(1))
    return F.transform(found, lambda x: F.trim(x))
