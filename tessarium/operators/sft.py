"""Instruction-tuning data: examples, rendering, validation, audits, gates, merges, comparisons.

Phrases that mark behaviour in answers are fixed values, given once below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key_passage

#: Phrases by the behaviour that they show.
DISAGREEMENT = ("disagree", "conflict", "tension", "trade-off", "tradeoff", "competing")
RECOMMENDATION = ("should", "recommend", "ought", "must consider")
UNCERTAINTY = ("cannot be established", "cannot be verified", "evidence is incomplete", "not been comprehensively")
REFUSAL = ("cannot answer because no source", "cannot answer without", "no source was provided")
VIOLATION = ("constitutes a violation of", "is a violation of", "violates international law", "is illegal under")
LEGAL = ("the law requires that", "is legally required to", "must by law", "is mandatory under")
GROUNDED = ("source", "document", "[", "http", "evidence", "states", "according")
POLICY = (
    "policy", "governance", "regulation", "stakeholder", "standard", "internet", "digital", "rights", "public", "multistakeholder",
)
PROMPTS = (
    ("not a prerequisite for policy reasoning", "multistakeholder_v3"),
    ("only the supplied source evidence", "restrictive_v3"),
    ("using supplied evidence", "v1_template"),
)
PRIVATE = ("i think", "let me", "first, i", "i'll", "i will", "step by step", "let's", "we need to", "we should", "okay", "now i", "i note", "i see")
SKIP_LINE = ("i think", "let me", "i'll", "i will", "okay", "now i")
EVIDENCE_LINE = ("evidence:", "source:", "the document", "states", "according")
CONCLUSION_LINE = ("therefore", "thus", "conclusion", "in summary", "overall")

#: Our own short task templates: task, question.
TASKS = (
    ("summarise", "What does the passage say?"),
    ("extract_evidence", "Which statement of the passage can be cited as evidence?"),
    ("find_gaps", "What does the passage leave open?"),
)
SYSTEM = "Answer from the passage, name its source, and say what it cannot establish."


def has_any(text: Column, phrases: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(text, F.lit(p))
    return out


def content(messages: str, role: str) -> Column:
    """The first message of a role, '' without one."""
    return F.coalesce(F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["content"], F.lit(""))


def prompt_kind(system: Column) -> Column:
    out = F.when(F.lit(False), "")
    for phrase, kind in PROMPTS:
        out = out.when(F.contains(system, F.lit(phrase)), kind)
    return out.otherwise("unknown")


def examples(docs: DataFrame, tasks: tuple = TASKS, per_doc: int = 2, seed: str = "42", min_chars: int = 500) -> DataFrame:
    """Template examples: for each document the first tasks in the order of seeded hashes."""
    choices = F.array(*[F.struct(F.lit(t).alias("task"), F.lit(q).alias("question")) for t, q in tasks])
    ordered = F.array_sort(
        F.transform(
            choices,
            lambda c: F.struct(
                F.sha2(F.concat_ws("\x01", F.lit(seed), F.col("doc_id").cast("string"), c["task"]), 256).alias("h"),
                c["task"].alias("task"),
                c["question"].alias("question"),
            ),
        )
    )
    rows = docs.filter(F.length("text") >= min_chars).select(
        "doc_id", "source", "lang", key_passage(F.col("text")).alias("passage"), F.explode(F.slice(ordered, 1, per_doc)).alias("t")
    )
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    messages = F.array(
        say("system", F.lit(SYSTEM)),
        say("user", F.concat(F.col("t.question"), F.lit("\n\n"), F.col("passage"))),
        say("assistant", F.concat(F.lit("[source "), F.col("doc_id").cast("string"), F.lit("] "), F.col("passage"))),
    )
    return rows.select("doc_id", "source", "lang", F.col("t.task").alias("task_type"), messages.alias("messages")).withColumn(
        "example_id", example_id("messages", "task_type")
    )


def example_id(messages: str, task: str) -> Column:
    key = F.concat_ws("\x01", content(messages, "assistant"), content(messages, "user"), F.col(task))
    return F.substring(F.sha2(key, 256), 1, 16)


def chat_text(messages: str) -> Column:
    """Role and content between markers, joined by line ends."""
    return F.array_join(
        F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>"))), "\n"
    )


def is_substantive(answer: Column, least: int = 100) -> Column:
    """An answer with a source mark, or longer than `least` characters."""
    return F.contains(answer, F.lit("[source")) | (F.length(answer) > least)


def example_errors(messages: str, min_chars: int = 10) -> Column:
    roles = F.transform(messages, lambda m: m["role"])
    return F.array_compact(
        F.array(
            F.when(F.size(messages) == 0, "missing messages"),
            F.when(~F.array_contains(roles, "user"), "missing user message"),
            F.when(~F.array_contains(roles, "assistant"), "missing assistant message"),
            F.when(F.exists(messages, lambda m: F.length(m["content"]) < min_chars), "message too short"),
        )
    )


#: Tasks that need no document; tasks that do.
POLICY_TASKS = ("policy_analysis", "stakeholder_analysis")
DOCUMENT_TASKS = tuple(t for t, _ in TASKS)


def _roles(messages: str) -> Column:
    return F.transform(F.coalesce(messages, F.expr("CAST(array() AS array<struct<role:string,content:string>>)")), lambda m: m["role"])


def _empty(c: str) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def full_errors(tasks: tuple[str, ...] = DOCUMENT_TASKS, min_chars: int = 10) -> Column:
    """Errors of an example with provenance: messages, roles, ids, hashes, evidence with quotes, a known task, lengths."""
    quotes = F.filter("evidence", lambda e: F.coalesce(e["quote_or_excerpt"], F.lit("")) != "")
    short = F.transform(
        F.filter("messages", lambda m: F.length(F.coalesce(m["content"], F.lit(""))) < min_chars),
        lambda m: F.concat(m["role"], F.lit(" message too short ("), F.length(F.coalesce(m["content"], F.lit(""))).cast("string"), F.lit(" chars)")),
    )
    fixed = F.array(
        F.when(_empty("messages"), "missing messages"),
        F.when(~_empty("messages") & ~F.array_contains(_roles("messages"), "user"), "missing user message"),
        F.when(~_empty("messages") & ~F.array_contains(_roles("messages"), "assistant"), "missing assistant message"),
        F.when(_empty("source_document_ids"), "missing source_document_ids"),
        F.when(_empty("source_hashes"), "missing source_hashes"),
        F.when(_empty("evidence"), "missing evidence"),
        F.when(~F.coalesce(F.col("task_type").isin(*tasks), F.lit(False)), F.concat(F.lit("invalid task_type: "), F.coalesce("task_type", F.lit("None")))),
    )
    last = F.array(F.when(~_empty("evidence") & (F.size(quotes) == 0), "evidence exists but no valid entries"))
    return F.array_compact(F.concat(fixed, F.coalesce(short, F.expr("CAST(array() AS array<string>)")), last))


def perspective_example_errors() -> Column:
    """Errors of an example with perspectives: two messages at least, both roles, evidence, perspectives."""
    two = F.coalesce(F.size("messages"), F.lit(0)) >= 2
    return F.array_compact(
        F.array(
            F.when(_empty("messages"), "messages is required").when(~two, "messages must be a list with at least 2 entries"),
            F.when(two & ~F.array_contains(_roles("messages"), "user"), "messages must contain a 'user' role"),
            F.when(two & ~F.array_contains(_roles("messages"), "assistant"), "messages must contain an 'assistant' role"),
            F.when(_empty("evidence"), "evidence is required"),
            F.when(_empty("stakeholder_perspectives"), "stakeholder_perspectives is required"),
        )
    )


def task_errors(policy_tasks: tuple[str, ...] = POLICY_TASKS) -> Column:
    """Errors of an example whose policy tasks need neither documents nor evidence; without messages nothing else counts."""
    grounded = ~F.coalesce(F.col("task_type").isin(*policy_tasks), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(~F.array_contains(_roles("messages"), "user"), "missing user"),
            F.when(~F.array_contains(_roles("messages"), "assistant"), "missing assistant"),
            F.when(grounded & _empty("source_document_ids"), "missing source_document_ids"),
            F.when(grounded & _empty("evidence"), "missing evidence"),
        )
    )
    return F.when(_empty("messages"), F.array(F.lit("missing messages"))).otherwise(found)


def schema_error_count(document_tasks: tuple[str, ...] = DOCUMENT_TASKS) -> Column:
    """How many faults the schema pass counts: a missing role, missing documents, each blank message; 1 without messages."""
    roles = F.array_contains(_roles("messages"), "user") & F.array_contains(_roles("messages"), "assistant")
    blank = F.size(F.filter("messages", lambda m: F.trim(F.coalesce(m["content"], F.lit(""))) == ""))
    needs = F.coalesce(F.col("task_type").isin(*document_tasks), F.lit(False)) & _empty("source_document_ids")
    return F.when(_empty("messages"), 1).otherwise((~roles).cast("int") + needs.cast("int") + blank)


def with_duplicates(examples: DataFrame, errors: Column, order: str) -> DataFrame:
    """Examples with their errors; of equal ones (messages and evidence) all but the first also count as duplicates."""
    key = F.sha2(F.to_json(F.struct("messages", "evidence")), 256)
    first = Window.partitionBy(key).orderBy(order)
    again = F.when(F.row_number().over(first) > 1, F.array(F.lit("DUPLICATE"))).otherwise(F.expr("CAST(array() AS array<string>)"))
    return examples.withColumn("errors", F.concat(errors, again))


#: Our own short system text and questions of instruction examples over documents.
INSTRUCTIONS = (
    ("stakeholders", "Which stakeholders does the document '{}' name or imply?", "Stakeholders are to be taken from the text of '{}' alone. [document {}]"),
    ("position", "Which policy position, if any, does the document '{}' take?", "A position counts where the text of '{}' states it. [document {}]"),
)


def instruction_examples(docs: DataFrame, least: int = 10) -> DataFrame:
    """Two examples a document (document_id, title, source_url, text) with its evidence; none from fewer than `least` documents."""
    enough = docs.limit(least).count() >= least
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    filled = lambda text, *values: F.format_string(text.replace("%", "%%").replace("{}", "%s"), *values)
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("source_url"))
    id_ = F.col("document_id").cast("string")
    kinds = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.array(say("system", F.lit(SYSTEM)), say("user", filled(q, title)), say("assistant", filled(a, title, id_))).alias("messages"),
            )
            for kind, q, a in INSTRUCTIONS
        )
    )
    evidence = F.array(F.struct(id_.alias("document_id"), F.col("source_url"), F.substring("text", 1, 500).alias("quote_or_excerpt")))
    rows = docs.filter(F.lit(enough)).select("document_id", evidence.alias("evidence"), F.explode(kinds).alias("k"))
    return rows.select("document_id", "k.kind", "k.messages", "evidence")


def teacher_prompt(task: Column, title: Column, url: Column, text: Column, cut: int = 8000) -> Column:
    """What a teacher model is asked: the task, the document's data, an excerpt, and the form of the answer."""
    return F.array_join(
        F.array(
            F.concat(F.lit("Task: "), task),
            F.concat(F.lit("Document: "), F.coalesce(title, F.lit("untitled")), F.lit(" ("), F.coalesce(url, F.lit("")), F.lit(")")),
            F.lit("Excerpt:"),
            F.substring(F.coalesce(text, F.lit("")), 1, cut),
            F.lit('Answer with JSON: {"question", "answer", "reasoning", "evidence": [{"quote_or_excerpt", "relevance"}], "uncertainty", "skip"}.'),
        ),
        "\n",
    )


TEACHER = (
    "struct<skip:boolean,question:string,answer:string,reasoning:string,uncertainty:string,confidence:string,"
    "evidence:array<struct<quote_or_excerpt:string,relevance:string>>>"
)


def teacher_output(reply: Column) -> Column:
    """The object of a reply: in a json fence, in any fence, or between its first and last brace; null where none parses."""
    tries = [F.regexp_extract(reply, p, 1) for p in (r"(?s)```json(.*?)```", r"(?s)```(.*?)```", r"(?s)(\{.*\})")]
    return F.coalesce(*(F.when(F.trim(t) != "", F.from_json(F.trim(t), TEACHER, {"mode": "PERMISSIVE"})) for t in tries))


def accepted(replies: DataFrame) -> DataFrame:
    """Replies (document_id, task_type, text, reply) with example and rejection: none parsed, skipped, or too short.

    Evidence without a quote goes; without any left, the document's first 500 characters stand for it.
    """
    out = teacher_output(F.col("reply"))
    rows = replies.withColumn("t", out)
    question, answer = F.trim(F.coalesce("t.question", F.lit(""))), F.trim(F.coalesce("t.answer", F.lit("")))
    why = (
        F.when(F.trim(F.coalesce("reply", F.lit(""))) == "", "empty")
        .when(F.col("t").isNull() | (F.col("t.question").isNull() & F.col("t.answer").isNull() & F.col("t.skip").isNull()), "not parsed")
        .when(F.coalesce("t.skip", F.lit(False)), "skipped")
        .when((F.length(question) < 10) | (F.length(answer) < 20), "too short")
    )
    quotes = F.filter(F.coalesce("t.evidence", F.expr("CAST(array() AS array<struct<quote_or_excerpt:string,relevance:string>>)")), lambda e: F.coalesce(e["quote_or_excerpt"], F.lit("")) != "")
    cut = F.transform(quotes, lambda e: F.struct(F.substring(e["quote_or_excerpt"], 1, 500).alias("quote_or_excerpt"), F.substring(F.coalesce(e["relevance"], F.lit("")), 1, 300).alias("relevance")))
    own = F.array(F.struct(F.substring("text", 1, 500).alias("quote_or_excerpt"), F.concat(F.lit("Generated from document for "), F.col("task_type")).alias("relevance")))
    say = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    messages = F.array(say("system", F.lit(SYSTEM)), say("user", question), say("assistant", answer))
    example = F.struct(messages.alias("messages"), F.when(F.size(cut) > 0, cut).otherwise(own).alias("evidence"), F.trim(F.coalesce("t.reasoning", F.lit(""))).alias("reasoning"), F.coalesce("t.uncertainty", F.lit("")).alias("uncertainty"))
    return rows.select("document_id", "task_type", F.when(why.isNull(), example).alias("example"), why.alias("rejected"))


def dispatch(template: DataFrame, taught: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Examples (document_id, task_type, messages): a teacher's where it was asked, else the template's; and counts of rejections.

    A document and task that a teacher was asked for and failed gives no example.
    """
    keys = ["document_id", "task_type"]
    good = taught.filter("rejected IS NULL").select(*keys, F.col("example.messages").alias("messages"))
    rest = template.select(*keys, "messages").join(taught.select(*keys).distinct(), keys, "left_anti")
    return good.unionByName(rest), taught.filter("rejected IS NOT NULL").groupBy("rejected").count()


#: Our own questions of the evaluation set.
QUESTIONS = (
    "Which documents discuss who decides?", "What evidence is given for costs?", "Which groups are not heard?", "What do the sources disagree on?",
    "Which statements lack a source?", "What changed over time?", "Which duties do the sources name?", "What is recommended, and by whom?",
    "Which risks are named?", "What cannot be concluded?",
)


def evaluation_set(docs: DataFrame, shown: int = 3) -> DataFrame:
    """question_id, question, titles, n_documents: fixed questions beside the corpus' first titles and its size."""
    asked = docs.sparkSession.createDataFrame(list(enumerate(QUESTIONS)), "question_id int, question string")
    # one row: at most `shown` titles
    titles = docs.filter("title <> ''").select("title").distinct().orderBy("title").limit(shown).agg(F.array_sort(F.collect_list("title")).alias("titles"))
    return asked.crossJoin(F.broadcast(titles.crossJoin(docs.agg(F.count("*").alias("n_documents")))))


def append_fixed(examples: DataFrame, fixed: DataFrame) -> DataFrame:
    """Examples and literal ones; an example whose id is there already is not added again."""
    new = fixed.join(examples.select("example_id"), "example_id", "left_anti").dropDuplicates(["example_id"])
    return examples.unionByName(new, allowMissingColumns=True)


def distributions(examples: DataFrame, docs: DataFrame) -> DataFrame:
    """kind, value, n: examples by task and language; their documents by source and year of publication (first matching one).

    examples (task_type, language, source_document_ids), docs (document_id, source, published_at).
    """
    first = Window.partitionBy("document_id").orderBy("source", "published_at")
    known = docs.select("document_id", "source", "published_at").withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    cited = examples.select(F.explode("source_document_ids").alias("document_id")).join(known, "document_id")
    year = F.nullif(F.regexp_extract(F.col("published_at").cast("string"), r"^(\d{4})", 1), F.lit(""))
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("value"))
    own = examples.select(F.explode(F.array(pair("task", F.coalesce("task_type", F.lit("?"))), pair("language", F.coalesce("language", F.lit("und"))))).alias("p"))
    of_docs = cited.select(F.explode(F.array(pair("source", F.coalesce("source", F.lit("unknown"))), pair("year", year))).alias("p"))
    rows = own.unionByName(of_docs).select("p.*").filter("value IS NOT NULL")
    return rows.groupBy("kind", "value").agg(F.count("*").alias("n"))


def periods(years: DataFrame) -> DataFrame:
    """period, n of years (value, n): decades from 1990 on, the last one open."""
    y = F.col("value").cast("int")
    name = F.when(y >= 2020, "2020-2026").when(y >= 2010, "2010-2019").when(y >= 2000, "2000-2009").when(y >= 1990, "1990-1999")
    return years.groupBy(name.alias("period")).agg(F.sum("n").alias("n")).filter("period IS NOT NULL")


def source_coverage(corpus: DataFrame, examples: DataFrame) -> DataFrame:
    """source, n_corpus, n_examples, missing: documents by source beside the examples that cite them."""
    cited = examples.select(F.explode("source_document_ids").alias("document_id")).distinct()
    per = corpus.join(cited.withColumn("_c", F.lit(1)), "document_id", "left").groupBy("source")
    return per.agg(F.count("*").alias("n_corpus"), F.count("_c").alias("n_examples")).withColumn("missing", F.col("n_examples") == 0)


def validate_final(examples: DataFrame, docs: DataFrame) -> DataFrame:
    """One row on examples by split: hash mismatches, leaked documents of each two splits, missing provenance, duplicates, private reasoning.

    examples (split, messages, source_document_ids, source_hashes, reasoning), docs (document_id, sha256).
    """
    pairs = examples.select("split", F.explode("source_document_ids").alias("document_id"), "source_hashes")
    held = pairs.join(docs.select("document_id", "sha256"), "document_id")
    wrong = held.filter("sha256 <> ''").select(F.size(F.filter("source_hashes", lambda h: (h != "") & (h != F.col("sha256")))).alias("n"))
    places = pairs.select("document_id", "split").distinct().groupBy("document_id").agg(F.collect_set("split").alias("s"))
    both = lambda a, b: F.count_if(F.array_contains("s", a) & F.array_contains("s", b))
    leaks = places.agg(*(both(a, b).alias(f"{a}_{b}") for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))))
    copies = examples.groupBy(F.sha2(F.to_json("messages"), 256).alias("h")).agg(F.count("*").alias("c")).agg(F.sum(F.col("c") - 1).alias("duplicates"))
    lacking = _empty("source_document_ids").cast("int") + _empty("source_hashes").cast("int")
    facts = examples.agg(F.sum(lacking).alias("missing_provenance"), F.count_if(F.length("reasoning") > 500).alias("private_fields"))
    # rows of one line each
    out = facts.crossJoin(leaks).crossJoin(copies).crossJoin(wrong.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("hash_mismatches")))
    fine = (F.col("hash_mismatches") == 0) & (F.col("train_validation") + F.col("train_test") + F.col("validation_test") == 0)
    return out.withColumn("valid", fine)


def build(docs: DataFrame, splits: DataFrame, least: int = 10, **options) -> tuple[DataFrame, str]:
    """Template examples with their document's split (doc_id, split); the verdict is BLOCKED below `least` documents."""
    if docs.limit(least).count() < least:
        return examples(docs.limit(0), **options).withColumn("split", F.lit(None).cast("string")), "BLOCKED"
    return examples(docs, **options).join(splits, "doc_id"), "READY"


def audit(rows: DataFrame) -> DataFrame:
    """One row of counts, in one pass over examples with messages."""
    answer = F.lower(content("messages", "assistant"))
    count = lambda p, name: F.count_if(has_any(answer, p)).alias(name)
    return rows.agg(
        F.count("*").alias("n"),
        count(DISAGREEMENT, "disagreement"),
        count(RECOMMENDATION, "recommendation"),
        count(UNCERTAINTY, "uncertainty"),
        count(REFUSAL, "refusal"),
        count(VIOLATION, "violation"),
        count(LEGAL, "legal"),
    )


def gate(counts: DataFrame, least: dict[str, int], most: dict[str, int]) -> DataFrame:
    """The errors of a one-row audit against bounds."""
    found = [F.when(F.col(c) < n, F.lit(f"{c} below {n}")) for c, n in least.items()]
    found += [F.when(F.col(c) > n, F.lit(f"{c} above {n}")) for c, n in most.items()]
    return counts.select("*", F.array_join(F.array_compact(F.array(*found)), "; ").alias("errors"))


def merge_preferred(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newer version, and of the older those whose key the newer lacks."""
    both = new.withColumn("_v", F.lit(0)).unionByName(old.withColumn("_v", F.lit(1)))
    first = Window.partitionBy(*keys).orderBy("_v", "example_id")
    return both.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n", "_v")


def clean_reasoning(text: Column) -> Column:
    """evidence_summary, policy_analysis and justification from private reasoning; other texts stay as analysis."""
    low = lambda x: F.lower(x)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~has_any(low(x), SKIP_LINE))
    is_ev = lambda x: has_any(low(x), EVIDENCE_LINE)
    is_end = lambda x: ~is_ev(x) & has_any(low(x), CONCLUSION_LINE)
    # analysis: other lines after the first evidence line, or longer than 40 characters
    numbered = F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    start = F.coalesce(F.get(F.filter(numbered, lambda p: is_ev(p["x"])), F.lit(0))["i"], F.lit(1 << 30))
    rest = F.filter(numbered, lambda p: ~is_ev(p["x"]) & ~is_end(p["x"]) & ((p["i"] > start) | (F.length(p["x"]) > 40)))
    private = has_any(F.substring(low(text), 1, 100), PRIVATE)
    some = lambda a, n: F.nullif(F.substring(F.array_join(a, " "), 1, n), F.lit(""))
    return F.struct(
        F.when(private, some(F.filter(lines, is_ev), 500)).alias("evidence_summary"),
        F.when(private, some(F.slice(F.transform(rest, lambda p: p["x"]), 1, 3), 500)).otherwise(F.substring(text, 1, 500)).alias("policy_analysis"),
        F.when(private, some(F.filter(lines, is_end), 300)).alias("justification"),
    )


def compare_versions(pairs: DataFrame) -> DataFrame:
    """Scores rows (v1, v2: answers) for grounding, specificity and policy relevance, and names the better."""
    a, b = F.lower("v1"), F.lower("v2")
    ref = lambda x: has_any(x, ("source:", "[source", "document", "evidence"))
    pol = lambda x: has_any(x, ("policy", "governance", "regulation", "stakeholder", "standard"))
    n1, n2 = F.length("v1"), F.length("v2")
    grounding = (
        F.when(ref(b) & ~ref(a), 2).when(ref(a) & ~ref(b), -2).when(ref(a) & ref(b), F.when(n2 > n1 * 0.5, 1).otherwise(-1)).otherwise(0)
    )
    specificity = F.when((n2 > n1 * 1.5) & ref(b), 2).when(n1 > n2 * 2, -1).otherwise(0)
    policy = F.when(pol(b) & ~pol(a), 2).when(pol(a) & ~pol(b), -1).otherwise(0)
    total = grounding + specificity + policy
    return pairs.select("*", total.alias("total")).withColumn(
        "verdict", F.when(F.col("total") >= 1, "v2_better").when(F.col("total") <= -2, "v1_better").otherwise("equivalent")
    )


def quality_means(rows: DataFrame) -> DataFrame:
    """Means from 0 to 5 of what examples hold; columns that rows lack count as empty."""
    answer, question = F.lower(content("messages", "assistant")), F.lower(content("messages", "user"))
    terms = sum((F.contains(F.concat(question, answer), F.lit(w)).cast("int") for w in POLICY), F.lit(0))
    mean = lambda c, name: F.round(F.avg(F.least(F.lit(5), c)), 1).alias(name)
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) if c in rows.columns else F.lit(0)
    n = size("evidence")
    points = lambda good, some: F.when(good, some).otherwise(0)
    return rows.agg(
        mean(points(has_any(answer, GROUNDED), 3) + points(n > 0, 2), "grounding"),
        mean(F.when(n > 0, n * 2).otherwise(1), "evidence"),
        mean(terms, "policy"),
        mean(F.floor(F.length(answer) / 100), "specificity"),
        mean(F.when(size("analysis") > 0, 3).otherwise(1), "reasoning"),
        mean(points(size("source_document_ids") > 0, 3) + points(size("source_hashes") > 0, 2), "provenance"),
    )
