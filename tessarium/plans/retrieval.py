"""Retrieval queries: documents as records, benchmark items as questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import retrieval as op
from ..sources.readers import parquet
from .registry import query

TOKENS_SQL = r"list_transform(regexp_extract_all(coalesce({0}, ''), '[\p{{L}}\p{{N}}_]+(?:[''-]+[\p{{L}}\p{{N}}_]+)*'), lambda x: lower(x))"

_POST = f"""
t AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS words FROM documents),
st AS (SELECT count(*) AS n, greatest(avg(len(words)), 1.0) AS avgdl FROM t),
e AS (SELECT doc_id, len(words) AS dl, unnest(words) AS term FROM t),
p AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM e GROUP BY ALL)
"""

_SCORED = f"""{_POST},
q AS (SELECT item_id AS qid, unnest({TOKENS_SQL.format('text')}) AS term FROM benchmark),
qt AS (SELECT qid, term, count(*) AS qtf FROM q GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (
  SELECT qt.qid, p.doc_id AS record_id,
         round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5
                   / (tf + 1.5 * (0.25 + 0.75 * greatest(dl, 1) / avgdl))), 6) AS score,
         array_to_string(list_sort(list(DISTINCT p.term)), ' ') AS matched_terms
  FROM p JOIN df USING (term) JOIN qt USING (term) CROSS JOIN st {{where}} GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, record_id) AS INTEGER) AS rank FROM s WHERE score > 0)
"""


ENGLISH = "JOIN documents d ON d.doc_id = p.doc_id AND d.lang = 'en' AND d.source IN ('src1', 'src2', 'src3')"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text", "source", "lang")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


@query("bm25_topk", f"WITH {_SCORED.replace('{where}', '')} SELECT qid, rank, record_id, score, matched_terms FROM r WHERE rank <= 8")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op.top_k(records(spark, sf_dir), questions(spark, sf_dir))
    return out.withColumn("matched_terms", F.array_join("matched_terms", " "))


@query(
    "bm25_evidence",
    f"""WITH {_SCORED.replace('{where}', '')} SELECT r.qid, r.rank, r.record_id, r.score, d.source, substring(d.text, 1, 300) AS snippet
    FROM r JOIN documents d ON d.doc_id = r.record_id WHERE rank <= 3""",
)
def bm25_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = records(spark, sf_dir)
    return op.evidence(op.top_k(recs, questions(spark, sf_dir), k=3), recs).select(
        "qid", "rank", "record_id", "score", "source", "snippet"
    )


@query(
    "bm25_stats",
    f"WITH {_POST} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY term",
)
def bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.term_statistics(records(spark, sf_dir))


@query(
    "facet_filter",
    f"""WITH {_SCORED.replace('{where}', ENGLISH)}
    SELECT qid, rank, record_id, score, matched_terms FROM r WHERE rank <= 5""",
)
def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the questions' facets: an empty one passes, of the others each must overlap the record's
    recs = records(spark, sf_dir).select("record_id", "text", F.array("source").alias("topics"), F.array("lang").alias("languages"))
    asked = questions(spark, sf_dir).select(
        "qid", "text", F.array(*map(F.lit, ("src1", "src2", "src3"))).alias("topics"), F.array(F.lit("en")).alias("languages")
    )
    out = op.top_k(recs, asked, k=5, facets=("topics", "languages"))
    return out.withColumn("matched_terms", F.array_join("matched_terms", " "))


@query(
    "evidence_service",
    f"""WITH {_SCORED.replace('{where}', '')}, c AS (SELECT qid, count(*) AS n, min(record_id) FILTER (rank = 1) AS best FROM r WHERE rank <= 4 GROUP BY qid)
    SELECT item_id AS qid, CAST(coalesce(n, 0) AS BIGINT) AS n, best, n IS NOT NULL AS found FROM benchmark LEFT JOIN c ON c.qid = item_id""",
)
def evidence_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op.retrieve_evidence(records(spark, sf_dir), questions(spark, sf_dir), k=4)
    return out.select("qid", F.size("evidence").cast("long").alias("n"), F.get("evidence", F.lit(0))["record_id"].alias("best"), "found")


@query(
    "tokenize_stats",
    f"WITH t AS (SELECT doc_id, {TOKENS_SQL.format('text')} AS w FROM documents) "
    "SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct FROM t",
)
def tokenize_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokens(F.col("text"))
    return parquet(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(words).cast("long").alias("n_tokens"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
    )
