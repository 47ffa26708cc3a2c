"""Corpus queries: scans, gates, duplicates, reports, text functions."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import corpus as op
from ..sources.readers import parquet, valid_documents
from .registry import query


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "documents")


@query("scan_valid_docs", "SELECT doc_id, source, lang, n_chars FROM documents WHERE length(text) >= 200")
def scan_valid_docs(spark, sf_dir):
    return valid_documents(docs(spark, sf_dir), 200).select("doc_id", "source", "lang", "n_chars")


@query(
    "invalid_reasons",
    """SELECT doc_id, CAST(length(text) AS BIGINT) AS text_length,
    CASE WHEN length(text) >= 200 THEN NULL
         WHEN contains(lower(text), 'signing in') OR contains(lower(text), 'sign in') THEN 'authentication_page'
         WHEN contains(lower(text), 'cookie') THEN 'cookie_page'
         WHEN length(text) < 20 THEN 'empty' WHEN length(text) < 60 THEN 'navigation_page'
         ELSE 'insufficient_extraction' END AS reason,
    CASE WHEN contains(lower(text), 'signing in') OR contains(lower(text), 'sign in') THEN 'authentication_page'
         WHEN length(text) < 20 THEN 'empty_or_near_empty'
         WHEN contains(lower(text), 'cookie') AND length(text) < 200 THEN 'cookie_page'
         WHEN length(text) < 60 THEN 'navigation_stub'
         WHEN contains(lower(text), 'privacy policy') AND length(text) < 200 THEN 'legal_stub'
         WHEN length(text) < 200 THEN 'insufficient_extraction' ELSE 'unknown' END AS label
    FROM documents""",
)
def invalid_reasons(spark, sf_dir):
    return docs(spark, sf_dir).select(
        "doc_id",
        F.length("text").cast("long").alias("text_length"),
        op.invalid_reason(F.col("text")).alias("reason"),
        op.stub_reason(F.col("text")).alias("label"),
    )


_QUALITY = r"""
SELECT doc_id, CASE WHEN length(trim(text, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) < 20 THEN 'failed' ELSE 'passed' END AS status,
  CASE WHEN length(trim(text, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) = 0 THEN 0.0
       ELSE round(greatest(0.0, least(length(text) / 200.0::DOUBLE, 1.0)
            - least(100.0 * (length(text) - length(replace(text, chr(65533), ''))) / greatest(length(text), 1), 0.5)), 4) END AS score
FROM documents"""


@query("quality_score", _QUALITY)
def quality_score(spark, sf_dir):
    q = T.quality_score(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", q["status"].alias("status"), q["score"].alias("score"))


@query(
    "ingest_gate",
    r"""SELECT doc_id, CASE WHEN length(trim(coalesce(text, ''), (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) < 20 THEN 'rejected'
        WHEN octet_length(encode(coalesce(text, ''))) < 1 THEN 'rejected' ELSE 'accepted' END AS decision FROM documents""",
)
def ingest_gate(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    bad = (F.length(T.strip(text)) < 20) | (F.octet_length(text) < 1)
    return docs(spark, sf_dir).select("doc_id", F.when(bad, "rejected").otherwise("accepted").alias("decision"))


@query("source_distribution", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_distribution(spark, sf_dir):
    return op.counted(docs(spark, sf_dir), "source")


@query(
    "dup_stats",
    """SELECT count(*) AS n, count(DISTINCT sha256(text)) AS n_distinct, count(*) - count(DISTINCT sha256(text)) AS n_duplicates
    FROM documents""",
)
def dup_stats(spark, sf_dir):
    # distinct in two steps, so that no task holds a set of all hashes
    hashes = docs(spark, sf_dir).groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("c"))
    return hashes.agg(
        F.sum("c").alias("n"), F.count("h").alias("n_distinct"), (F.sum("c") - F.count("h")).alias("n_duplicates")
    )


@query(
    "corpus_report",
    """SELECT count(*) AS n_docs, count(*) FILTER (length(text) >= 200) AS n_valid, count(*) FILTER (length(text) < 200) AS n_invalid,
    CAST(sum(length(text)) AS BIGINT) AS total_chars, CAST(min(length(text)) AS BIGINT) AS min_chars, CAST(max(length(text)) AS BIGINT) AS max_chars,
    count(DISTINCT source) AS n_sources, count(DISTINCT lang) AS n_langs FROM documents""",
)
def corpus_report(spark, sf_dir):
    n = F.length("text")
    return docs(spark, sf_dir).agg(
        F.count("*").alias("n_docs"),
        F.count_if(n >= 200).alias("n_valid"),
        F.count_if(n < 200).alias("n_invalid"),
        F.sum(n).alias("total_chars"),
        F.min(n).cast("long").alias("min_chars"),
        F.max(n).cast("long").alias("max_chars"),
        F.countDistinct("source").alias("n_sources"),
        F.countDistinct("lang").alias("n_langs"),
    )


@query(
    "source_detail",
    """SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(min(length(text)) AS BIGINT) AS shortest,
    CAST(max(length(text)) AS BIGINT) AS longest, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY source""",
)
def source_detail(spark, sf_dir):
    n = F.length("text")
    return docs(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("n"),
        F.sum(n).alias("chars"),
        F.min(n).cast("long").alias("shortest"),
        F.max(n).cast("long").alias("longest"),
        F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"),
    )


@query(
    "length_percentiles",
    """WITH s AS (SELECT list_sort(list(length(text))) AS v FROM documents WHERE text IS NOT NULL)
    SELECT CAST(v[1 + CAST(floor(len(v) * 0.5::DOUBLE) AS INT)] AS BIGINT) AS p50, CAST(v[1 + CAST(floor(len(v) * 0.95::DOUBLE) AS INT)] AS BIGINT) AS p95,
    CAST(v[1 + CAST(floor(len(v) * 0.99::DOUBLE) AS INT)] AS BIGINT) AS p99 FROM s""",
)
def length_percentiles(spark, sf_dir):
    values = docs(spark, sf_dir).select(F.length("text").cast("long").alias("v0"))
    return op.list_percentile(values, "v0", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


@query(
    "corpus_stats",
    """SELECT lang, source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 6) AS mean_chars
    FROM documents GROUP BY lang, source""",
)
def corpus_stats(spark, sf_dir):
    n = F.length("text")
    return docs(spark, sf_dir).groupBy("lang", "source").agg(
        F.count("*").alias("n"), F.sum(n).alias("chars"), F.round(F.avg(n), 6).alias("mean_chars")
    )


@query(
    "corpus_ready",
    """SELECT CASE WHEN count(*) < 50 THEN 'too few documents' WHEN count(DISTINCT source) < 5 THEN 'too few sources'
    WHEN sum(length(text)) < 500000 THEN 'too little text' ELSE 'ready' END AS verdict FROM documents WHERE length(text) >= 100""",
)
def corpus_ready(spark, sf_dir):
    return valid_documents(docs(spark, sf_dir), 100).agg(
        F.when(F.count("*") < 50, "too few documents")
        .when(F.countDistinct("source") < 5, "too few sources")
        .when(F.sum(F.length("text")) < 500_000, "too little text")
        .otherwise("ready")
        .alias("verdict")
    )


@query(
    "normalize_text",
    r"""WITH a AS (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS t FROM documents),
    b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g') AS t FROM a)
    SELECT doc_id, sha256(trim(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS sha256 FROM b""",
)
def normalize_text(spark, sf_dir):
    return op.normalized(docs(spark, sf_dir)).select("doc_id", F.sha2("text", 256).alias("sha256"))


_SENT = r"list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))), lambda x: x <> '')"


@query("sentence_split", f"SELECT doc_id, CAST(len({_SENT}) AS BIGINT) AS n, sha256(array_to_string({_SENT}, '|')) AS sha256 FROM documents")
def sentence_split(spark, sf_dir):
    s = T.sentences(F.col("text"))
    return docs(spark, sf_dir).select(
        "doc_id", F.size(s).cast("long").alias("n"), F.sha2(F.array_join(s, "|"), 256).alias("sha256")
    )


@query(
    "reading_time",
    r"SELECT doc_id, greatest(1, CAST(ceil(len(regexp_extract_all(text, '\S+')) / 200.0) AS BIGINT)) AS minutes FROM documents",
)
def reading_time(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.reading_minutes(F.col("text")).alias("minutes"))


_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))), lambda x: length(x) > 40)"


@query(
    "key_passage",
    f"""WITH l AS (SELECT doc_id, text, {_LINES} AS v FROM documents)
    SELECT doc_id, substring(coalesce(list_filter(v, lambda x: length(x) > 80 AND NOT regexp_matches(x, '^(?:Skip|Search|Menu|Home|Log)'))[1],
      v[1], text), 1, 500) AS passage FROM l""",
)
def key_passage(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.key_passage(F.col("text")).alias("passage"))


_FLAT = r"array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))), lambda x: x <> ''), ' ')"
#: k-grams by windows over unnested characters; shorter texts are one gram.
_SHING = """c AS (SELECT d, f, unnest(string_split(f, '')) AS ch, generate_subscripts(string_split(f, ''), 1) AS i FROM a WHERE length(f) >= 5),
    w AS (SELECT d, ch || lead(ch, 1) OVER k || lead(ch, 2) OVER k || lead(ch, 3) OVER k || lead(ch, 4) OVER k AS g FROM c WINDOW k AS (PARTITION BY d ORDER BY i)),
    s AS (SELECT DISTINCT d, g FROM w WHERE g IS NOT NULL UNION ALL SELECT d, f FROM a WHERE length(f) < 5)"""


@query(
    "shingle_stats",
    f"WITH a AS (SELECT doc_id AS d, {_FLAT} AS f FROM documents), {_SHING} SELECT d AS doc_id, count(*) AS n_shingles FROM s GROUP BY d",
)
def shingle_stats(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.size(T.char_shingles(F.col("text"))).cast("long").alias("n_shingles"))


_WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query(
    "segment_docs",
    rf"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '((?:[^\n]*\n){{3}})', '\1' || chr(10), 'g'), '\n\s*\n'),
      lambda x: trim(x, {_WS})), lambda x: x <> '') AS ps FROM documents),
    it AS (SELECT doc_id, 0 AS i, '' AS buf, 0 AS pos, 0 AS ordinal, CAST(NULL AS VARCHAR) AS done, 0 AS start FROM d
      UNION ALL
      SELECT doc_id, i + 1, CASE WHEN length(nb) >= 1800 THEN '' ELSE nb END, CASE WHEN length(nb) >= 1800 THEN CAST(pos + length(nb) + 2 AS INT) ELSE pos END,
        ordinal + CASE WHEN done IS NULL THEN 0 ELSE 1 END, CASE WHEN length(nb) >= 1800 THEN nb END, pos
      FROM (SELECT it.*, CASE WHEN buf = '' THEN ps[i + 1] ELSE buf || chr(10) || chr(10) || ps[i + 1] END AS nb FROM it JOIN d USING (doc_id) WHERE i < len(ps))),
    s AS (SELECT doc_id, ordinal, done AS text, start FROM it WHERE done IS NOT NULL
      UNION ALL SELECT doc_id, ordinal + CASE WHEN done IS NULL THEN 0 ELSE 1 END, buf, pos FROM it JOIN d USING (doc_id) WHERE i = len(ps) AND buf <> '')
    SELECT sha256(doc_id || chr(1) || ordinal) AS segment_id, doc_id, ordinal, text, start AS char_start, CAST(start + length(text) AS INT) AS char_end,
      CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_count, greatest(1, CAST(ceil(len(regexp_extract_all(text, '\S+')) / 200.0) AS BIGINT)) AS reading_minutes FROM s""",
)
def segment_docs(spark, sf_dir):
    """Paragraph breaks are put in place of every third line end, since the table has none."""
    broken = F.regexp_replace("text", r"(?:[^\n]*\n){3}", "$0\n")
    out = docs(spark, sf_dir).select("doc_id", F.posexplode(T.segments(broken)).alias("ordinal", "s"))
    words = T.word_count(F.col("s.text"))
    return out.select(
        F.sha2(F.concat_ws("\x01", F.col("doc_id").cast("string"), F.col("ordinal").cast("string")), 256).alias("segment_id"),
        "doc_id",
        "ordinal",
        "s.text",
        "s.char_start",
        "s.char_end",
        words.alias("word_count"),
        T.reading_minutes(F.col("s.text")).alias("reading_minutes"),
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def content_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256"))


@query(
    "exact_dup_groups",
    "SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents WHERE length(text) >= 200 GROUP BY 1 HAVING count(*) > 1",
)
def exact_dup_groups(spark, sf_dir):
    groups = valid_documents(docs(spark, sf_dir), 200).groupBy(F.sha2("text", 256).alias("sha256"))
    return groups.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("n > 1")


@query("exact_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def exact_dedup(spark, sf_dir):
    # keep-first by the smallest id is an aggregate, so copies shrink before the shuffle
    return docs(spark, sf_dir).groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@query(
    "dedup_first",
    "SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n = 1",
)
def dedup_first(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source", "lang", (-F.col("n_chars")).alias("order"))
    return op.first_of(rows, ["source", "lang"], ["order", "doc_id"]).select("doc_id", "source", "lang")


@query(
    "resolve_dups",
    """WITH h AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS canonical_id FROM documents WHERE length(text) >= 200)
    SELECT doc_id AS alias_id, canonical_id, 'identical_content' AS reason FROM h WHERE doc_id <> canonical_id""",
)
def resolve_dups(spark, sf_dir):
    return op.resolve_duplicates(docs(spark, sf_dir).select("doc_id", "text"))[1]


_NEAR = f"""a AS (SELECT min(doc_id) AS d, any_value({_FLAT}) AS f FROM documents WHERE text IS NOT NULL GROUP BY sha256(text)),
    {_SHING}, n AS (SELECT d, count(*) AS n FROM s GROUP BY d),
    p AS (SELECT x.d AS a, y.d AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.d < y.d GROUP BY 1, 2),
    e AS (SELECT a, b, round(i / (u.n + v.n - i), 6) AS jaccard FROM p JOIN n u ON u.d = a JOIN n v ON v.d = b WHERE i / (u.n + v.n - i) >= 0.9)"""


@query("near_dup_pairs", f"WITH {_NEAR} SELECT a, b, jaccard FROM e")
def near_dup_pairs(spark, sf_dir):
    return op.near_pairs(docs(spark, sf_dir), folder=scratch_folder(spark, "near_dup_pairs")).withColumn("jaccard", F.round("jaccard", 6))


@query("near_dup_classes", "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id FROM documents WHERE text IS NOT NULL")
def near_dup_classes(spark, sf_dir):
    return op.text_classes(docs(spark, sf_dir))


@query(
    "near_dup_resolve",
    f"""WITH RECURSIVE {_NEAR}, cl AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id FROM documents WHERE text IS NOT NULL),
    v AS (SELECT d, row_number() OVER (ORDER BY d) AS k FROM (SELECT a AS d FROM e UNION SELECT b FROM e)),
    nb AS (SELECT v.k, v.d, coalesce(list(e.a) FILTER (e.a IS NOT NULL), []) AS before FROM v LEFT JOIN e ON e.b = v.d GROUP BY v.k, v.d),
    acc AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS good
      UNION ALL SELECT nb.k, CASE WHEN list_has_any(acc.good, nb.before) THEN acc.good ELSE list_append(acc.good, nb.d) END FROM acc JOIN nb ON nb.k = acc.k + 1),
    g AS (SELECT arg_max(good, k) AS good FROM acc),
    bad AS (SELECT e.b AS class_id, min(e.a) AS first FROM e, g WHERE list_contains(good, e.a) AND NOT list_contains(good, e.b) GROUP BY e.b)
    SELECT doc_id, coalesce(first, CASE WHEN doc_id <> class_id THEN class_id END) AS duplicate_of FROM cl LEFT JOIN bad USING (class_id)""",
)
def near_dup_resolve(spark, sf_dir):
    rows = docs(spark, sf_dir)
    folder = scratch_folder(spark, "near_dup_resolve")
    return op.greedy_resolve(op.text_classes(rows), op.near_pairs(rows, folder=folder), folder)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the cluster's checkpoint folder; where that is unset, a temporary one in local mode only."""
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessarium-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "report_rollup",
    """SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(grouping(source) * 2 + grouping(lang) AS BIGINT) AS level
    FROM documents GROUP BY ROLLUP (source, lang)""",
)
def report_rollup(spark, sf_dir):
    return docs(spark, sf_dir).rollup("source", "lang").agg(
        F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("level")
    )


@query(
    "report_cube",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
)
def report_cube(spark, sf_dir):
    return parquet(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("qty")
    )


@query("corpus_manifest", r"""SELECT doc_id AS document_id, source, lang AS language, sha256(text) AS artifact_sha256, CAST(length(text) AS BIGINT) AS text_length,
    substring(string_split(trim(text, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), chr(10))[1], 1, 120) AS title FROM documents WHERE length(text) >= 200""")
def corpus_manifest(spark, sf_dir):
    return valid_documents(docs(spark, sf_dir), 200).select(
        F.col("doc_id").alias("document_id"),
        "source",
        F.col("lang").alias("language"),
        F.sha2("text", 256).alias("artifact_sha256"),
        F.length("text").cast("long").alias("text_length"),
        F.substring(F.split_part(T.strip(F.col("text")), F.lit("\n"), F.lit(1)), 1, 120).alias("title"),
    )


@query("hf_projection", r"""SELECT CAST(doc_id AS VARCHAR) AS id,
    coalesce(nullif(substring(string_split(trim(text, (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), chr(10))[1], 1, 120), ''), 'Untitled') AS title, source,
    substring(coalesce(nullif(lang, ''), 'und'), 1, 10) AS language, trim(substring(text, 1, 500), (' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS summary FROM documents""")
def hf_projection(spark, sf_dir):
    first = F.substring(F.split_part(T.strip(F.col("text")), F.lit("\n"), F.lit(1)), 1, 120)
    return docs(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        F.coalesce(F.nullif(first, F.lit("")), F.lit("Untitled")).alias("title"),
        "source",
        F.substring(F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("und")), 1, 10).alias("language"),
        T.strip(F.substring("text", 1, 500)).alias("summary"),
    )


@query("corpus_records", f"""WITH l AS (SELECT doc_id, {_SENT} AS v FROM documents WHERE length(text) >= 100),
    s AS (SELECT doc_id, unnest(v) AS text, generate_subscripts(v, 1) - 1 AS k FROM l)
    SELECT doc_id || '/' || k AS record_id, doc_id AS document_id, text FROM s WHERE length(text) >= 50""")
def corpus_records(spark, sf_dir):
    """Records from segments (here sentences) of at least 50 characters of documents of at least 100."""
    parts = valid_documents(docs(spark, sf_dir), 100).select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("k", "text"))
    return parts.filter(F.length("text") >= 50).select(
        F.concat_ws("/", F.col("doc_id").cast("string"), F.col("k").cast("string")).alias("record_id"),
        F.col("doc_id").alias("document_id"),
        "text",
    )


#: Words of titles that mark a document's type, in order.
DOC_TYPES = (
    (("report", "annual", "review"), "report"),
    (("policy", "procedure", "guideline", "framework"), "policy_document"),
    (("meeting", "minutes", "agenda", "transcript"), "meeting_document"),
    (("recommendation", "standard"), "standard"),
    (("blog", "news", "press", "announcement"), "news_article"),
    (("about", "overview", "history"), "overview_page"),
)


def document_type(title, url):
    low, where = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(url, F.lit("")))
    out = F.when(F.contains(low, F.lit("rfc")) & low.rlike("[0-9]"), "rfc").when(
        F.contains(where, F.lit("arxiv")) | F.contains(low, F.lit("arxiv")), "academic_paper"
    )
    for words, label in DOC_TYPES:
        out = out.when(low.rlike("|".join(words)), label)
    return out.otherwise("web_page")


@query("doc_type", "SELECT page_id, CASE WHEN contains(t, 'rfc') AND regexp_matches(t, '[0-9]') THEN 'rfc' WHEN contains(lower(url), 'arxiv') OR contains(t, 'arxiv') THEN 'academic_paper' "
    + " ".join(f"WHEN regexp_matches(t, '{'|'.join(w)}') THEN '{n}'" for w, n in DOC_TYPES)
    + r" ELSE 'web_page' END AS document_type FROM (SELECT page_id, url, lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS t FROM pages)")
def doc_type(spark, sf_dir):
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return parquet(spark, sf_dir, "pages").select("page_id", document_type(title, F.col("url")).alias("document_type"))


@query("sample_docs", "SELECT doc_id FROM documents ORDER BY sha256('42' || chr(1) || doc_id), doc_id LIMIT 50")
def sample_docs(spark, sf_dir):
    """A seeded sample of fifty documents: the sampling operator itself."""
    return docs(spark, sf_dir).select("doc_id").orderBy(seeded("42", F.col("doc_id")), "doc_id").limit(50)


def seeded(seed: str, key):
    return F.sha2(F.concat_ws("\x01", F.lit(seed), key.cast("string")), 256)
