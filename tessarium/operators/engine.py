"""Questions answered end to end: retrieval, perspectives, gates, deliberation, limitations, prompt, provider, status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import deliberation as D
from .plugins import Provider, generate
from .retrieval import evidence, top_k

#: Our own short instructions to a model.
RULES = (
    "Use only the evidence below and cite its record ids.",
    "Say what the evidence cannot establish.",
    "Keep stakeholder positions apart; do not average them.",
    "Treat a group without evidence as not heard, not as agreeing.",
    "Mark inference as inference.",
)


def evidence_line(item: Column) -> Column:
    return F.format_string("[%s] (score %.4f) %s", item["record_id"].cast("string"), item["score"], item["snippet"])


def synthesis_prompt(question: Column, groups: Column, cited: Column) -> Column:
    """The prompt of a question: the question, the groups heard, the rules, and a line of evidence each."""
    lines = F.transform(cited, evidence_line)
    return F.array_join(
        F.concat(
            F.array(
                F.concat(F.lit("Question: "), question),
                F.concat(F.lit("Groups heard: "), F.when(F.size(groups) > 0, F.array_join(groups, ", ")).otherwise("none")),
                F.lit("Rules:"),
            ),
            F.array(*(F.lit(f"{k}. {rule}") for k, rule in enumerate(RULES, 1))),
            F.array(F.lit("Evidence:")),
            F.when(F.size(cited) > 0, lines).otherwise(F.array(F.lit("none"))),
        ),
        "\n",
    )


def analyze(
    records: DataFrame,
    questions: DataFrame,
    k: int = 8,
    perspectives: DataFrame | None = None,
    make: Callable[[], Provider] | None = None,
    group: str = "stakeholder_group",
    **options,
) -> DataFrame:
    """One answer a question (question_id, text, required_stakeholder_groups), all questions in one plan.

    Evidence is what BM25 finds in records (record_id, text, and their group). Questions without given perspectives
    get them from their evidence. Perspectives with errors are left out of the deliberation, and their errors are listed. With a
    provider the prompt is answered; a failure leaves synthesis null and is listed. Status: needs_evidence, needs_review
    (perspectives with errors), ready_for_model_synthesis, or model_synthesis_complete.
    """
    asked = questions.select(F.col("question_id").alias("qid"), "text")
    cited = evidence(top_k(records.select("record_id", "text"), asked, k, **options), records.select("record_id", "text", F.col(group).alias("stakeholder_group")))
    cited = cited.select(F.col("qid").alias("question_id"), "stakeholder_group", "rank", F.col("record_id").cast("string").alias("record_id"), "score", "snippet")
    # k rows a question, read by each step below; a lost part is computed again
    cited = cited.persist()
    kinds = {"is_official_position": F.lit(False), "attribution": F.lit(None).cast("string"), "constraints": F.expr("CAST(array() AS array<string>)")}
    own = D.perspectives_from_evidence(cited.filter("stakeholder_group IS NOT NULL")).withColumns(kinds)
    if perspectives is not None:
        given = perspectives.withColumns({c: v for c, v in kinds.items() if c not in perspectives.columns}).select(own.columns)
        own = given.unionByName(own.join(given.select("question_id").distinct(), "question_id", "left_anti"))
    judged = own.withColumn("errors", D.perspective_errors())
    out = D.deliberate(questions.select("question_id", "required_stakeholder_groups"), judged.filter(F.size("errors") == 0))
    wrong = judged.filter(F.size("errors") > 0).groupBy("question_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("errors")))).alias("errors"))
    item = F.struct("rank", "record_id", "score", "snippet")
    lists = cited.groupBy("question_id").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    out = out.join(questions.select("question_id", "text"), "question_id").join(wrong, "question_id", "left").join(lists, "question_id", "left")
    none = F.expr("CAST(array() AS array<string>)")
    out = out.withColumns({"errors": F.coalesce("errors", none), "evidence": F.coalesce("evidence", F.expr("CAST(array() AS array<struct<rank:int,record_id:string,score:double,snippet:string>>)"))})
    found = F.size("evidence") > 0
    limits = F.array_compact(
        F.array(
            F.when(~found, D.NOTHING),
            F.when(F.size("missing") > 0, F.concat(F.lit(D.MISSING), F.array_join("missing", ", "))),
            F.when(F.col("disagreement"), D.DIFFER),
            F.when(F.size("errors") > 0, F.concat(F.lit("Perspectives were left out: "), F.array_join("errors", "; "))),
        )
    )
    status = F.when(~found, "needs_evidence").when(F.size("errors") > 0, "needs_review").otherwise("ready_for_model_synthesis")
    out = out.withColumns({"limitations": limits, "prompt": synthesis_prompt(F.col("text"), F.col("represented"), F.col("evidence")), "status": status})
    if make is None:
        return out.withColumn("synthesis", F.lit(None).cast("string"))
    answered = generate(out.filter(found).select(F.col("question_id").alias("id"), "prompt"), make)
    answered = answered.select(F.col("id").alias("_id"), F.col("output").alias("synthesis"), F.col("error").alias("_error"))
    out = out.join(answered, F.col("question_id").cast("string") == F.col("_id"), "left")
    failed = F.when(F.col("_error").isNotNull(), F.array(F.concat(F.lit("No synthesis: "), F.col("_error")))).otherwise(none)
    return out.withColumns(
        {"status": F.when(F.col("synthesis").isNotNull(), "model_synthesis_complete").otherwise(F.col("status")), "limitations": F.concat("limitations", failed)}
    ).drop("_id", "_error")


def answer(records: DataFrame, questions: DataFrame, **options) -> DataFrame:
    """What a service returns for a batch of questions: status, evidence, groups, limitations and synthesis, without the prompt."""
    cols = ("question_id", "status", "represented", "missing", "agreements", "disagreements", "evidence", "limitations", "unresolved", "synthesis")
    return analyze(records, questions, **options).select(*cols)
