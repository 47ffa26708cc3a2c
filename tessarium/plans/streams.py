"""Streaming queries over files of the test tables, and vector and manifest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import languages
from ..operators.deliberation import record_errors
from ..sources.readers import artifacts, parquet
from ..sources.sinks import manifest, verify_manifest
from ..streaming import streams as S
from .corpus import docs, scratch_folder
from .registry import query


def _stream(spark, sf_dir, name):
    # the glob makes a file or a folder of part files alike a source of files
    table = parquet(spark, sf_dir, name)
    return spark.readStream.schema(table.schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


@query("stream_dedup", "SELECT DISTINCT sha256(text) AS sha256 FROM documents")
def stream_dedup(spark, sf_dir):
    rows = _stream(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"))
    return S.run_once(S.dedup(rows), scratch_folder(spark, "stream_dedup"), "out")


@query(
    "stream_provenance_window",
    "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS started, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def stream_provenance_window(spark, sf_dir):
    rows = _stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = S.windowed_counts(rows, "ts", "event_type")
    out = S.run_once(counts, scratch_folder(spark, "stream_window"), "out", mode="complete")
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "event_type", "n")


@query("stream_sync", "SELECT doc_id FROM documents WHERE length(text) >= 100")
def stream_sync(spark, sf_dir):
    rows = _stream(spark, sf_dir, "documents").filter(F.length("text") >= 100).select("doc_id")
    return S.sync(rows, scratch_folder(spark, "stream_sync"), "doc_id")


@query("manifest_verify")
def manifest_verify(spark, sf_dir):
    """All files of a table folder as a release manifest, by content hash, checked against the files read again."""
    found = artifacts(spark, sf_dir).filter("path LIKE '%.parquet'")
    listed = manifest(found)
    wrong = verify_manifest(found, listed)
    name = F.regexp_replace("path", r"^.*/([^/]+\.parquet)", "$1")
    return listed.join(wrong, "path", "left").select(name.alias("name"), "bytes", "sha256", F.coalesce("problem", F.lit("")).alias("problem"))


@query(
    "candidate_gate",
    """SELECT doc_id, concat_ws('; ', CASE WHEN text IS NULL OR text = '' THEN 'text is required' END,
      CASE WHEN n_chars / 10000.0 > 1 THEN 'confidence must be between 0 and 1' END) AS errors FROM documents""",
)
def candidate_gate(spark, sf_dir):
    rows = docs(spark, sf_dir).withColumn("confidence", F.col("n_chars") / 10000.0)
    return rows.select("doc_id", F.array_join(record_errors(), "; ").alias("errors"))


_LANG = r"""w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}]+')) AS word FROM documents),
    c AS (SELECT lang, word, count(*) AS n FROM w WHERE lang IS NOT NULL GROUP BY ALL),
    k AS (SELECT DISTINCT word FROM (SELECT word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM c) WHERE r <= 300),
    t AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
    p AS (SELECT t.lang, k.word, ln((coalesce(c.n, 0) + 1) / (t.total + 1)) AS weight FROM k CROSS JOIN t LEFT JOIN c ON c.lang = t.lang AND c.word = k.word),
    f AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
    s AS (SELECT doc_id, p.lang, round(sum(tf * weight), 6) AS s FROM f JOIN p USING (word) GROUP BY ALL)"""


@query("lang_profile", f"WITH {_LANG}, g AS (SELECT doc_id, arg_min(lang, (-s, lang)) AS guess FROM s GROUP BY doc_id) SELECT doc_id, lang, coalesce(guess, 'und') AS guess FROM documents LEFT JOIN g USING (doc_id)")
def lang_profile(spark, sf_dir):
    """Each text's language by the profiles of all labelled texts; tests hold the guesses against the labels."""
    rows = docs(spark, sf_dir).select("doc_id", "lang", "text")
    return rows.select("doc_id", "lang").join(languages.detect(rows.select("doc_id", "text"), languages.profile(rows), "doc_id"), "doc_id")
