"""Queries that build, render, check and compare instruction-tuning data, on conversations and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sft
from ..operators.suites import extremes
from ..sources.readers import parquet
from .corpus import _LINES, docs, seeded
from .registry import query


def chats(spark, sf_dir):
    """One row a conversation with its messages in turn order."""
    c = parquet(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return c.groupBy("conv_id").agg(F.transform(turns, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


_CHAT = "c AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn, role, text) AS m FROM conversations GROUP BY 1)"
_FIRST = "coalesce(list_filter(m, lambda x: x.role = '{0}')[1].content, '')"


def _any(expr: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{p}')" for p in phrases) + ")"


@query("chat_render", f"WITH {_CHAT} SELECT conv_id, sha256(array_to_string(list_transform(m, lambda x: '<|im_start|>' || x.role || chr(10) || x.content || '<|im_end|>'), chr(10))) AS sha256 FROM c")
def chat_render(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", F.sha2(sft.chat_text("messages"), 256).alias("sha256"))


@query(
    "sft_validate",
    f"""WITH {_CHAT} SELECT conv_id, concat_ws('; ', CASE WHEN NOT list_contains(list_transform(m, lambda x: x.role), 'user') THEN 'missing user message' END,
      CASE WHEN NOT list_contains(list_transform(m, lambda x: x.role), 'assistant') THEN 'missing assistant message' END,
      CASE WHEN len(list_filter(m, lambda x: length(x.content) < 10)) > 0 THEN 'message too short' END) AS errors FROM c""",
)
def sft_validate(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", F.array_join(sft.example_errors("messages"), "; ").alias("errors"))


@query("sft_substantive", f"WITH {_CHAT} SELECT conv_id, contains({_FIRST.format('assistant')}, '[source') OR length({_FIRST.format('assistant')}) > 100 AS substantive FROM c")
def sft_substantive(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", sft.is_substantive(sft.content("messages", "assistant")).alias("substantive"))


def grounded(spark, sf_dir):
    """Conversations as examples: with documents, hashes, evidence, perspectives and tasks by their number."""
    none = F.expr("CAST(array() AS array<string>)")
    id_ = F.array(F.col("conv_id").cast("string"))
    quote = F.array(F.struct(F.when(F.col("conv_id") % 7 > 0, "a quote").otherwise("").alias("quote_or_excerpt")))
    task = F.get(F.array(*map(F.lit, ("summarise", "policy_analysis", "other"))), (F.col("conv_id") % 3).cast("int"))
    return chats(spark, sf_dir).select(
        "conv_id", "messages", task.alias("task_type"),
        F.when(F.col("conv_id") % 2 == 0, id_).otherwise(none).alias("source_document_ids"),
        F.when(F.col("conv_id") % 5 > 0, id_).otherwise(none).alias("source_hashes"),
        F.when(F.col("conv_id") % 4 > 0, quote).otherwise(F.expr("CAST(array() AS array<struct<quote_or_excerpt:string>>)")).alias("evidence"),
        F.when(F.col("conv_id") % 6 > 0, id_).otherwise(none).alias("stakeholder_perspectives"),
    )


_GROUNDED = f"""{_CHAT}, x AS (SELECT conv_id, m, list_transform(m, lambda x: x.role) AS roles, ['summarise', 'policy_analysis', 'other'][1 + CAST(conv_id % 3 AS INT)] AS task,
    conv_id % 2 = 0 AS ids, conv_id % 5 > 0 AS hashes, conv_id % 4 > 0 AS ev, conv_id % 7 > 0 AS quote, conv_id % 6 > 0 AS views FROM c)"""
_ROLE = "NOT list_contains(roles, '{0}')"


@query(
    "sft_errors",
    f"""WITH {_GROUNDED} SELECT conv_id,
      concat_ws('; ', CASE WHEN {_ROLE.format('user')} THEN 'missing user message' END, CASE WHEN {_ROLE.format('assistant')} THEN 'missing assistant message' END,
        CASE WHEN NOT ids THEN 'missing source_document_ids' END, CASE WHEN NOT hashes THEN 'missing source_hashes' END, CASE WHEN NOT ev THEN 'missing evidence' END,
        CASE WHEN task <> 'summarise' THEN 'invalid task_type: ' || task END,
        nullif(array_to_string(list_transform(list_filter(m, lambda y: length(y.content) < 10), lambda y: y.role || ' message too short (' || length(y.content) || ' chars)'), '; '), ''),
        CASE WHEN ev AND NOT quote THEN 'evidence exists but no valid entries' END) AS full_errors,
      concat_ws('; ', CASE WHEN len(m) < 2 THEN 'messages must be a list with at least 2 entries' END,
        CASE WHEN len(m) >= 2 AND {_ROLE.format('user')} THEN 'messages must contain a ''user'' role' END,
        CASE WHEN len(m) >= 2 AND {_ROLE.format('assistant')} THEN 'messages must contain an ''assistant'' role' END,
        CASE WHEN NOT ev THEN 'evidence is required' END, CASE WHEN NOT views THEN 'stakeholder_perspectives is required' END) AS perspective_errors,
      concat_ws('; ', CASE WHEN {_ROLE.format('user')} THEN 'missing user' END, CASE WHEN {_ROLE.format('assistant')} THEN 'missing assistant' END,
        CASE WHEN task <> 'policy_analysis' AND NOT ids THEN 'missing source_document_ids' END, CASE WHEN task <> 'policy_analysis' AND NOT ev THEN 'missing evidence' END) AS task_errors,
      CAST(({_ROLE.format('user')} OR {_ROLE.format('assistant')})::INT + (task = 'summarise' AND NOT ids)::INT + len(list_filter(m, lambda y: trim(y.content, ' ') = '')) AS BIGINT) AS schema_errors FROM x""",
)
def sft_errors(spark, sf_dir):
    """The four validators beside each other."""
    joined = lambda c: F.array_join(c, "; ")
    return grounded(spark, sf_dir).select(
        "conv_id",
        joined(sft.full_errors()).alias("full_errors"),
        joined(sft.perspective_example_errors()).alias("perspective_errors"),
        joined(sft.task_errors()).alias("task_errors"),
        sft.schema_error_count().cast("long").alias("schema_errors"),
    )


_PH = {"disagreement": ("en", "on the"), "recommendation": ("that", "with"), "uncertainty": ("from",), "refusal": ("no",), "violation": ("the law",), "legal": ("by the",)}
_AUDIT = f"WITH {_CHAT}, a AS (SELECT lower({_FIRST.format('assistant')}) AS t FROM c) SELECT count(*) AS n, " + ", ".join(
    f"count(*) FILTER ({_any('t', getattr(sft, k.upper()))}) AS {k}" for k in _PH
) + " FROM a"


@query("sft_audit", _AUDIT)
def sft_audit(spark, sf_dir):
    return sft.audit(chats(spark, sf_dir))


@query("dataset_gate", f"WITH x AS ({_AUDIT}) SELECT *, concat_ws('; ', CASE WHEN n < 100 THEN 'n below 100' END, CASE WHEN disagreement < 20 THEN 'disagreement below 20' END, CASE WHEN refusal > 0 THEN 'refusal above 0' END) AS errors FROM x")
def dataset_gate(spark, sf_dir):
    return sft.gate(sft.audit(chats(spark, sf_dir)), {"n": 100, "disagreement": 20}, {"refusal": 0})


@query(
    "sft_quality",
    f"WITH {_GROUNDED}, a AS (SELECT *, lower({_FIRST.format('assistant')}) AS t, lower({_FIRST.format('user')}) AS q FROM x) SELECT round(avg(CASE WHEN {_any('t', sft.GROUNDED)} THEN 3 ELSE 0 END + CASE WHEN ev THEN 2 ELSE 0 END), 1) AS grounding, round(avg(CASE WHEN ev THEN 2 ELSE 1 END), 1) AS evidence, round(avg(least(5, "
    + " + ".join(f"CAST(contains(q || t, '{w}') AS INT)" for w in sft.POLICY)
    + ")), 1) AS policy, round(avg(least(5, floor(length(t) / 100))), 1) AS specificity, 1.0::DOUBLE AS reasoning, round(avg(CASE WHEN ids THEN 3 ELSE 0 END + CASE WHEN hashes THEN 2 ELSE 0 END), 1) AS provenance FROM a",
)
def sft_quality(spark, sf_dir):
    return sft.quality_means(grounded(spark, sf_dir))


@query("conv_dups", "WITH m AS (SELECT sha256(string_agg(role || chr(1) || text, chr(2) ORDER BY turn, role, text)) AS h FROM conversations GROUP BY conv_id) SELECT count(*) AS n, count(DISTINCT h) AS n_distinct, count(*) - count(DISTINCT h) AS duplicates FROM m")
def conv_dups(spark, sf_dir):
    key = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\x01"), m["content"])), "\x02")
    per = chats(spark, sf_dir).groupBy(F.sha2(key, 256).alias("h")).agg(F.count("*").alias("c"))
    return per.agg(F.sum("c").alias("n"), F.count("h").alias("n_distinct"), (F.sum("c") - F.count("h")).alias("duplicates"))


_TASKS = "k(task, question) AS (VALUES " + ", ".join(f"('{t}', '{q}')" for t, q in sft.TASKS) + ")"


@query("sft_examples", f"WITH {_TASKS}, r AS (SELECT doc_id, task, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('42' || chr(1) || doc_id || chr(1) || task)) AS n FROM documents, k WHERE length(text) >= 500) SELECT doc_id, task AS task_type FROM r WHERE n <= 2")
def sft_examples(spark, sf_dir):
    return sft.examples(docs(spark, sf_dir)).select("doc_id", "task_type")


_TITLE = "'Document ' || doc_id"


def titled(spark, sf_dir):
    return docs(spark, sf_dir).select(
        F.col("doc_id").alias("document_id"), F.concat(F.lit("Document "), "doc_id").alias("title"), F.concat(F.lit("doc:"), "doc_id").alias("source_url"),
        "text", "source", F.make_date(F.lit(1985) + F.col("doc_id").cast("int") % 40, F.lit(1), F.lit(1)).alias("published_at"), "lang",
    )


@query(
    "sft_instruction",
    f"SELECT doc_id AS document_id, kind, replace(q, '{{}}', {_TITLE}) AS question, replace(replace(a, chr(39) || '{{}}' || chr(39), chr(39) || {_TITLE} || chr(39)), '{{}}', doc_id::VARCHAR) AS answer, "
    "sha256(substring(text, 1, 500)) AS quote_sha256 FROM documents, (VALUES "
    + ", ".join("('{}', '{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in sft.INSTRUCTIONS)
    + ") AS k(kind, q, a) WHERE (SELECT count(*) FROM documents) >= 10",
)
def sft_instruction(spark, sf_dir):
    out = sft.instruction_examples(titled(spark, sf_dir))
    quote = F.get("evidence", F.lit(0))["quote_or_excerpt"]
    return out.select("document_id", "kind", sft.content("messages", "user").alias("question"), sft.content("messages", "assistant").alias("answer"), F.sha2(quote, 256).alias("quote_sha256"))


@query(
    "teacher_accept",
    """SELECT doc_id AS document_id, CASE doc_id % 6 WHEN 1 THEN 'empty' WHEN 2 THEN 'not parsed' WHEN 3 THEN 'skipped' WHEN 4 THEN 'too short' END AS rejected,
      CASE WHEN doc_id % 6 IN (0, 5) THEN 'What is document ' || doc_id || ' about?' END AS question,
      CASE doc_id % 6 WHEN 0 THEN 'the words' WHEN 5 THEN substring(text, 1, 500) END AS quote FROM documents""",
)
def teacher_accept(spark, sf_dir):
    """Replies of six kinds: fenced with evidence, empty, no JSON, skipped, too short, bare without evidence."""
    id_ = F.col("document_id").cast("string")
    said = F.concat(F.lit('"question": "What is document '), id_, F.lit(' about?", "answer": "It is about document '), id_, F.lit(', as far as it says."'))
    kinds = F.array(
        F.concat(F.lit("Here: ```json {"), said, F.lit(', "evidence": [{"quote_or_excerpt": "the words", "relevance": "all"}, {"quote_or_excerpt": ""}]} ```')),
        F.lit("  "), F.lit("no object at all"), F.lit('{"skip": true}'), F.lit('{"question": "Why so?", "answer": "no"}'), F.concat(F.lit("{"), said, F.lit("}")),
    )
    replies = titled(spark, sf_dir).select("document_id", F.lit("summarise").alias("task_type"), "text", F.get(kinds, (F.col("document_id") % 6).cast("int")).alias("reply"))
    out = sft.accepted(replies)
    quote = F.get("example.evidence", F.lit(0))["quote_or_excerpt"]
    return out.select("document_id", "rejected", F.get("example.messages", F.lit(1))["content"].alias("question"), quote.alias("quote"))


_EXAMPLES = f"""{_TASKS}, e AS (SELECT doc_id, lang, source, task FROM (SELECT doc_id, lang, source, task, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('42' || chr(1) || doc_id || chr(1) || task)) AS n
    FROM documents, k WHERE length(text) >= 500) WHERE n <= 2)"""


def cited(spark, sf_dir):
    return sft.examples(docs(spark, sf_dir)).select("task_type", F.col("lang").alias("language"), F.array("doc_id").alias("source_document_ids"))


@query(
    "example_distributions",
    f"""WITH {_EXAMPLES}, v AS (SELECT 'task' AS kind, task AS value FROM e UNION ALL SELECT 'language', lang FROM e UNION ALL SELECT 'source', source FROM e
      UNION ALL SELECT 'year', CAST(1985 + doc_id % 40 AS VARCHAR) FROM e) SELECT kind, value, count(*) AS n FROM v GROUP BY ALL""",
)
def example_distributions(spark, sf_dir):
    return sft.distributions(cited(spark, sf_dir), titled(spark, sf_dir))


@query(
    "example_periods",
    f"""WITH {_EXAMPLES}, y AS (SELECT 1985 + doc_id % 40 AS y FROM e)
    SELECT CASE WHEN y >= 2020 THEN '2020-2026' WHEN y >= 2010 THEN '2010-2019' WHEN y >= 2000 THEN '2000-2009' ELSE '1990-1999' END AS period, CAST(count(*) AS BIGINT) AS n FROM y WHERE y >= 1990 GROUP BY 1""",
)
def example_periods(spark, sf_dir):
    return sft.periods(example_distributions(spark, sf_dir).filter("kind = 'year'"))


@query(
    "example_coverage",
    f"WITH {_EXAMPLES}, u AS (SELECT DISTINCT doc_id FROM e) SELECT source, count(*) AS n_corpus, count(u.doc_id) AS n_examples, count(u.doc_id) = 0 AS missing FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY source",
)
def example_coverage(spark, sf_dir):
    return sft.source_coverage(titled(spark, sf_dir), cited(spark, sf_dir))


@query(
    "evaluation_set",
    "SELECT k AS question_id, q AS question, (SELECT array_to_string(list(t ORDER BY t), '|') FROM (SELECT DISTINCT " + _TITLE + " AS t FROM documents ORDER BY t LIMIT 3)) AS titles, (SELECT count(*) FROM documents) AS n_documents FROM (VALUES "
    + ", ".join(f"({k}, '{q}')" for k, q in enumerate(sft.QUESTIONS))
    + ") AS q(k, q)",
)
def evaluation_set(spark, sf_dir):
    out = sft.evaluation_set(titled(spark, sf_dir))
    return out.select("question_id", "question", F.array_join("titles", "|").alias("titles"), "n_documents")


@query(
    "loss_extremes",
    """WITH r AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS loss, CAST(row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS lo,
      CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS hi FROM orders)
    SELECT id, loss, lo AS rank, 'best' AS side FROM r WHERE lo <= 5 UNION ALL SELECT id, loss, hi, 'worst' FROM r WHERE hi <= 5""",
)
def loss_extremes(spark, sf_dir):
    rows = parquet(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("double").alias("loss"))
    return extremes(rows)


_PASSAGE = """coalesce(list_filter(v, lambda x: length(x) > 80 AND NOT regexp_matches(x, '^(?:Skip|Search|Menu|Home|Log)'))[1], v[1], text)"""


@query(
    "example_id",
    f"""WITH {_EXAMPLES}, p AS (SELECT doc_id, substring({_PASSAGE}, 1, 500) AS passage FROM (SELECT doc_id, text, {_LINES} AS v FROM documents))
    SELECT e.doc_id, e.task AS task_type, substring(sha256('[source ' || e.doc_id || '] ' || passage || chr(1) || question || chr(10) || chr(10) || passage || chr(1) || e.task), 1, 16) AS example_id
    FROM e JOIN p USING (doc_id) JOIN k ON k.task = e.task""",
)
def example_id(spark, sf_dir):
    return sft.examples(docs(spark, sf_dir)).select("doc_id", "task_type", "example_id")


@query("final_merge", f"WITH {_TASKS}, r AS (SELECT doc_id, task, row_number() OVER (PARTITION BY doc_id ORDER BY sha256('42' || chr(1) || doc_id || chr(1) || task)) AS n FROM documents, k WHERE length(text) >= 500) SELECT doc_id, task AS task_type FROM r WHERE n <= 2")
def final_merge(spark, sf_dir):
    """Two versions of examples, of which the newer covers even documents; the newer is preferred."""
    old = sft.examples(docs(spark, sf_dir))
    new = old.filter("doc_id % 2 = 0")
    return sft.merge_preferred(new, old, ["doc_id", "task_type"]).select("doc_id", "task_type")


@query(
    "v1v2_compare",
    f"""WITH p AS (SELECT a.doc_id, a.text AS v1, b.text AS v2, lower(a.text) AS x, lower(b.text) AS y FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
    f AS (SELECT *, {_any('x', ('source:', '[source', 'document', 'evidence'))} AS rx, {_any('y', ('source:', '[source', 'document', 'evidence'))} AS ry,
      {_any('x', ('policy', 'governance', 'regulation', 'stakeholder', 'standard'))} AS px, {_any('y', ('policy', 'governance', 'regulation', 'stakeholder', 'standard'))} AS py FROM p),
    s AS (SELECT doc_id, CASE WHEN ry AND NOT rx THEN 2 WHEN rx AND NOT ry THEN -2 WHEN rx AND ry THEN CASE WHEN length(v2) > length(v1) * 0.5 THEN 1 ELSE -1 END ELSE 0 END
      + CASE WHEN length(v2) > length(v1) * 1.5 AND ry THEN 2 WHEN length(v1) > length(v2) * 2 THEN -1 ELSE 0 END + CASE WHEN py AND NOT px THEN 2 WHEN px AND NOT py THEN -1 ELSE 0 END AS total FROM f)
    SELECT doc_id, total, CASE WHEN total >= 1 THEN 'v2_better' WHEN total <= -2 THEN 'v1_better' ELSE 'equivalent' END AS verdict FROM s""",
)
def v1v2_compare(spark, sf_dir):
    rows = docs(spark, sf_dir)
    later = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("v2"))
    pairs = rows.select("doc_id", F.col("text").alias("v1")).join(later, "doc_id")
    return sft.compare_versions(pairs).select("doc_id", "total", "verdict")


@query("sft_distributions", "SELECT lang, source, CAST(n_chars / 1000 AS BIGINT) AS thousand, count(*) AS n FROM (SELECT lang, source, floor(n_chars / 1000) * 1000 AS n_chars FROM documents) GROUP BY ALL")
def sft_distributions(spark, sf_dir):
    return docs(spark, sf_dir).groupBy("lang", "source", F.floor(F.col("n_chars") / 1000).alias("thousand")).agg(F.count("*").alias("n"))


def _has(expr: str, phrases) -> str:
    return "(" + " OR ".join("contains({}, '{}')".format(expr, p.replace("'", "''")) for p in phrases) + ")"


_EV, _END = (lambda x, p=p: _has(f"lower({x})", p) for p in (sft.EVIDENCE_LINE, sft.CONCLUSION_LINE))


@query(
    "reasoning_clean",
    f"""WITH l AS (SELECT conv_id, turn, text, {_has('substring(lower(text), 1, 100)', sft.PRIVATE)} AS private,
      list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '' AND NOT {_has('lower(x)', sft.SKIP_LINE)}) AS v FROM conversations),
    e AS (SELECT *, list_filter(v, lambda x: {_EV('x')}) AS ev, list_filter(v, lambda x: NOT {_EV('x')} AND {_END('x')}) AS fin,
      coalesce(list_min(list_filter(range(1, len(v) + 1), lambda i: {_EV('v[i]')})), 1000000000) AS start FROM l),
    r AS (SELECT *, list_transform(list_filter(range(1, len(v) + 1), lambda i: NOT {_EV('v[i]')} AND NOT {_END('v[i]')} AND (i > start OR length(v[i]) > 40)), lambda i: v[i]) AS rest FROM e)
    SELECT conv_id, turn, CASE WHEN private THEN nullif(substring(array_to_string(ev, ' '), 1, 500), '') END AS evidence_summary,
      CASE WHEN private THEN nullif(substring(array_to_string(rest[1:3], ' '), 1, 500), '') ELSE substring(text, 1, 500) END AS policy_analysis,
      CASE WHEN private THEN nullif(substring(array_to_string(fin, ' '), 1, 300), '') END AS justification FROM r""",
)
def reasoning_clean(spark, sf_dir):
    r = sft.clean_reasoning(F.col("text"))
    return parquet(spark, sf_dir, "conversations").select("conv_id", "turn", r.alias("r")).select("conv_id", "turn", "r.*")


@query("inspect_tasks", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('7' || chr(1) || doc_id), doc_id) AS n FROM documents) WHERE n <= 2")
def inspect_tasks(spark, sf_dir):
    """The first two examples of each group: the report itself is a top-k."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy(seeded("7", F.col("doc_id")), "doc_id")
    return docs(spark, sf_dir).select("doc_id", "lang", F.row_number().over(w).alias("n")).filter("n <= 2").drop("n")
