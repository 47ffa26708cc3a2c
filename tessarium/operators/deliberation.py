"""Candidates, organisations, council deliberation, synthesis and recommendations."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import sentences, term_counts


def any_of(text: Column, patterns: Sequence[str]) -> Column:
    """Whether any pattern occurs in the lower-cased text: one alternation."""
    return F.lower(text).rlike("|".join(f"(?:{p})" for p in patterns))


KINDS: Mapping[str, Sequence[str]] = {
    "position": L.POSITION,
    "argument": tuple(L.ARGUMENT),
    "counterargument": L.COUNTER,
    "evidence": tuple(L.EVIDENCE),
}


def candidates(segments: DataFrame, kinds: Mapping[str, Sequence[str]] = KINDS) -> DataFrame:
    """Up to one candidate of each kind for a segment (segment_id, text); ids are hashes, so reruns agree, and null without a segment_id."""
    found = F.array_compact(F.array(*[F.when(any_of(F.col("text"), p), F.lit(k)) for k, p in kinds.items()]))
    rows = segments.select("segment_id", "text", F.explode(found).alias("candidate_type"))
    key = F.concat(F.col("segment_id").cast("string"), F.lit("\x01"), F.col("candidate_type"))
    return rows.select(F.sha2(key, 256).alias("candidate_id"), "candidate_type", "segment_id", "text")


def spans(segments: DataFrame, weights: Mapping[str, float], before: int = 50, after: int = 100) -> DataFrame:
    """Every match of weighted patterns: segment_id, keyword, pattern, weight, position, window; one scan for all patterns.

    Splitting at the matches gives their positions: a running sum of what stands before each.
    """
    low = F.lower("text")
    found = F.array(
        *(
            F.struct(F.lit(p).alias("pattern"), F.lit(float(w)).alias("weight"), F.regexp_extract_all(low, F.lit(p), F.lit(0)).alias("hits"), F.split(low, p).alias("rest"))
            for p, w in weights.items()
        )
    )
    rows = segments.select("segment_id", "text", F.explode(F.filter(found, lambda x: F.size(x["hits"]) > 0)).alias("m"))
    start = F.expr("named_struct('at', 0, 'done', CAST(array() AS array<struct<keyword:string,position:int>>))")

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + F.length(x["before"])
        return F.struct(
            (at + F.length(x["hit"])).alias("at"), F.concat(s["done"], F.array(F.struct(x["hit"].alias("keyword"), at.alias("position")))).alias("done")
        )

    pairs = F.zip_with(F.slice("m.rest", F.lit(1), F.size("m.hits")), "m.hits", lambda r, h: F.struct(r.alias("before"), h.alias("hit")))
    placed = F.inline(F.aggregate(pairs, start, step, lambda s: s["done"]))
    out = rows.select("segment_id", "text", "m.pattern", "m.weight", placed)
    first = F.greatest(F.lit(0), F.col("position") - before)
    end = F.col("position") + F.length("keyword") + after
    return out.select(
        "segment_id", "keyword", "pattern", "weight", "position", F.trim(F.substring(F.col("text"), first + 1, end - first)).alias("window")
    )


def evidence_counts(segments: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """segment_id and, by name, how often each pattern occurs in the lower-cased text."""
    low = F.lower("text")
    return segments.select("segment_id", *(F.regexp_count(low, F.lit(p)).cast("long").alias(name) for name, p in patterns.items()))


def stakeholders(segments: DataFrame, pattern: str = L.ORGANISATION) -> DataFrame:
    """segment_id, mention: the first name in a segment that the pattern's first group matches, in its own case."""
    return segments.select("segment_id", F.regexp_extract("text", pattern, 1).alias("mention")).filter("mention <> ''")


def argument_claims(docs: DataFrame, split: str = L.REASONS[0], words: Sequence[str] = L.REASONS) -> DataFrame:
    """doc_id, claim, justification: sentences with a word of reason that the splitting word cuts in two."""
    s = docs.select("doc_id", F.explode(sentences(F.col("text"))).alias("s"))
    low = F.lower("s")
    with_reason = F.lit(False)
    for w in words:
        with_reason = with_reason | F.contains(low, F.lit(w))
    parts = F.split("s", split)
    return s.filter(with_reason & (F.size(parts) == 2)).select("doc_id", F.trim(parts[0]).alias("claim"), F.trim(parts[1]).alias("justification"))


def modal_positions(docs: DataFrame, words: Sequence[str] = L.MODALS, confidence: float = 0.85) -> DataFrame:
    """doc_id, ordinal, position, confidence: sentences that hold a word, as part of another or not."""
    rows = docs.select("doc_id", F.posexplode(sentences(F.col("text"))).alias("ordinal", "position"))
    low, hit = F.lower("position"), F.lit(False)
    for w in words:
        hit = hit | F.contains(low, F.lit(w))
    return rows.filter(hit).withColumn("confidence", F.lit(confidence))


def is_counterargument(main: Column, counter: Column, negations: Sequence[str] = L.NEGATIONS, oppositions: Sequence[str] = L.OPPOSITIONS) -> Column:
    """A word of negation in the counter, or one of opposition in the main text."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    of = lambda some: F.array(*map(F.lit, some))
    return F.arrays_overlap(words(counter), of(negations)) | F.arrays_overlap(words(main), of(oppositions))


def record_errors() -> Column:
    """What is wrong with a candidate record: missing text, or a confidence outside 0 to 1."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce("text", F.lit("")) == "", "text is required"),
            F.when((F.col("confidence") < 0) | (F.col("confidence") > 1), "confidence must be between 0 and 1"),
        )
    )


def weighed(text: Column) -> Column:
    """The distinct words of two letters and more with their counts."""
    return term_counts(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)))


def similarity(left: str, right: str) -> Column:
    """The TF-IDF cosine of two columns of weighed words, each pair being the corpus of its own idf; inside the row."""
    alone = math.log(1.5) + 1  # the idf of a word of one of the two; that of a word of both is 1

    def cosine(z: Column) -> Column:
        dot = F.aggregate(z["a"], F.lit(0.0), lambda s, x: s + x["tf"] * F.coalesce(F.try_element_at(z["m"], x["term"]), F.lit(0)))
        square = lambda x, both: F.pow(x["tf"] * F.when(both, 1.0).otherwise(alone), F.lit(2.0))
        one = F.aggregate(z["a"], F.lit(0.0), lambda s, x: s + square(x, F.map_contains_key(z["m"], x["term"])))
        two = F.aggregate(z["b"], F.lit(0.0), lambda s, x: s + square(x, F.array_contains(z["own"], x["term"])))
        return F.coalesce(dot / F.nullif(F.sqrt(one) * F.sqrt(two), F.lit(0.0)), F.lit(0.0))

    terms = lambda c: F.transform(c, lambda x: x["term"])
    counts = F.map_from_arrays(terms(right), F.transform(right, lambda x: x["tf"]))
    # bound to a lambda variable, so that the look-ups are built once a pair
    whole = F.struct(F.col(left).alias("a"), F.col(right).alias("b"), counts.alias("m"), terms(left).alias("own"))
    return F.get(F.transform(F.array(whole), cosine), F.lit(0))


def link_evidence(claims: DataFrame, evidence: DataFrame, group: str, top: int = 3, least: float = 0.0) -> DataFrame:
    """claim_id, rank, evidence_id, similarity: the top pieces of evidence of each claim's group, above the least similarity.

    claims (claim_id, group, claim) meet evidence (evidence_id, group, text) of their own group only.
    """
    left = claims.select("claim_id", group, weighed(F.col("claim")).alias("_a"))
    right = evidence.select("evidence_id", group, weighed(F.col("text")).alias("_b"))
    scored = left.join(right, group).filter("claim_id <> evidence_id").select("claim_id", "evidence_id", F.round(similarity("_a", "_b"), 6).alias("similarity"))
    best = Window.partitionBy("claim_id").orderBy(F.desc("similarity"), "evidence_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter((F.col("rank") <= top) & (F.col("similarity") > least))
    return ranked.select("claim_id", "rank", "evidence_id", "similarity")


def temporal_positions(docs: DataFrame, markers: Sequence[str] = L.TEMPORAL) -> DataFrame:
    """doc_id, ordinal, marker, position, reference_to: sentences with a marker, each after the one before it."""
    words = F.regexp_extract_all(F.lower("s"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    first = F.get(F.filter(words, lambda w: w.isin(*markers)), F.lit(0))
    rows = docs.select("doc_id", F.posexplode(sentences(F.col("text"))).alias("ordinal", "s")).withColumn("marker", first)
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    return rows.filter("marker IS NOT NULL").select(
        "doc_id", "ordinal", "marker", F.col("s").alias("position"), F.lag("s").over(w).alias("reference_to")
    )


def resolve_organisations(mentions: DataFrame, spark: SparkSession) -> DataFrame:
    """mention rows with canonical, type, confidence: exact name, other name (either contains the other), initials."""
    known = [(k, *row) for k, row in enumerate(L.ORGANISATIONS)]
    base = F.broadcast(spark.createDataFrame(known, "k int, canonical string, type string, alias string"))  # fixed list of 14
    m, a = F.lower("mention"), F.lower("alias")
    initials = F.array_join(F.transform(F.split(F.trim("mention"), r"\s+"), lambda w: F.substring(w, 1, 1)), "")
    how = (
        F.when(F.col("mention") == F.col("canonical"), 0)
        .when(F.contains(m, a) | F.contains(a, m), 1)
        .when((F.size(F.split(F.trim("mention"), r"\s+")) > 1) & (initials == F.col("canonical")), 2)
    )
    names = mentions.select("mention").distinct()
    best = (
        names.crossJoin(base)
        .withColumn("how", how)
        .filter("how IS NOT NULL")
        .groupBy("mention")
        .agg(F.min(F.struct("how", "k", "canonical", "type")).alias("b"))
        .select("mention", "b.canonical", "b.type", F.lit(0.9).alias("confidence"))
    )
    return mentions.join(best, "mention")


def organisation_network(resolved: DataFrame) -> DataFrame:
    """a, b, n: how often two different organisations are named in one document, both ways.

    Counts per document and organisation multiply, so no document's mentions are paired one by one.
    """
    per = resolved.groupBy("doc_id", "canonical").agg(F.count("*").alias("c"))
    other = per.select("doc_id", F.col("canonical").alias("b"), F.col("c").alias("d"))
    return (
        per.join(other, "doc_id").filter("canonical <> b").groupBy(F.col("canonical").alias("a"), "b").agg(F.sum(F.col("c") * F.col("d")).alias("n"))
    )


def position_key(position: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(position), r"\s+", " "))


def shared_positions(perspectives: DataFrame) -> DataFrame:
    """question_id, position, n_groups: positions that at least two groups hold."""
    keyed = perspectives.select("question_id", position_key(F.col("position")).alias("position"), "stakeholder_group").distinct()
    return keyed.filter("position <> ''").groupBy("question_id", "position").agg(F.count("*").alias("n_groups")).filter("n_groups >= 2")


#: Said where positions differ, where groups are missing, and where nothing was found.
DIFFER = "Stakeholder groups hold different positions; they are listed, not merged."
MISSING = "No perspective is given for: "
NOTHING = "No evidence was retrieved; nothing can be concluded."


def evidence_pairs(perspectives: DataFrame) -> DataFrame:
    """question_id, record_id: one row a record that a question's perspectives cite."""
    return perspectives.select("question_id", F.explode("evidence_record_ids").alias("record_id")).distinct()


def deliberate(questions: DataFrame, perspectives: DataFrame, ids: bool = True) -> DataFrame:
    """One row a question: represented and missing groups, agreements, disagreements, evidence, constraints, what is unresolved.

    Evidence is counted pair by pair; with ids its record ids are listed too, which suits evidence of a bounded number a
    question (evidence_pairs holds any number). Missing groups stay missing and silence is no agreement. Perspectives may bring `constraints` (an array); a question
    is unresolved in each required group that is missing and, where positions differ, in their difference.
    """
    held = perspectives if "constraints" in perspectives.columns else perspectives.withColumn("constraints", F.expr("CAST(array() AS array<string>)"))
    by = held.groupBy("question_id").agg(
        F.array_sort(F.collect_set("stakeholder_group")).alias("represented"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("constraints")))).alias("constraints"),
        F.countDistinct(F.nullif(position_key(F.col("position")), F.lit(""))).alias("n_positions"),
    )
    listed = [F.array_sort(F.collect_list("record_id")).alias("evidence_record_ids")] if ids else []
    cited = evidence_pairs(perspectives).groupBy("question_id").agg(F.count("*").alias("n_evidence"), *listed)
    agreed = shared_positions(perspectives).groupBy("question_id").agg(F.array_sort(F.collect_list("position")).alias("agreements"))
    none = F.expr("CAST(array() AS array<string>)")
    out = questions.join(by, "question_id", "left").join(agreed, "question_id", "left").join(cited, "question_id", "left")
    represented = F.coalesce("represented", none)
    missing = F.array_sort(F.array_except("required_stakeholder_groups", represented))
    differ = F.coalesce("n_positions", F.lit(0)) > 1
    said = F.when(differ, F.array(F.lit(DIFFER))).otherwise(none)
    return out.select(
        "question_id",
        represented.alias("represented"),
        missing.alias("missing"),
        F.coalesce("agreements", none).alias("agreements"),
        differ.alias("disagreement"),
        said.alias("disagreements"),
        F.coalesce("n_evidence", F.lit(0)).cast("long").alias("n_evidence"),
        *([F.coalesce("evidence_record_ids", none).alias("evidence_record_ids")] if ids else []),
        F.coalesce("constraints", none).alias("constraints"),
        F.concat(F.transform(missing, lambda g: F.concat(F.lit("perspective missing: "), g)), said).alias("unresolved"),
    )


def perspectives_from_evidence(evidence: DataFrame, shown: int = 3, cut: int = 500, ids: bool = True) -> DataFrame:
    """One perspective a question and group, from the first snippets of the group's evidence (question_id,
    stakeholder_group, rank, record_id, snippet); ids lists the records, which suits a bounded number of them."""
    keys = ["question_id", "stakeholder_group"]
    first = Window.partitionBy(*keys).orderBy("rank", "record_id")
    # the window is cut to `shown` rows a group before it moves any
    heads = evidence.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= shown)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "snippet"))), lambda x: x["snippet"]), "; ")
    heads = heads.groupBy(*keys).agg(F.substring(text, 1, cut).alias("position"))
    counts = evidence.groupBy(*keys).agg(
        *([F.array_sort(F.collect_set("record_id")).alias("evidence_record_ids")] if ids else []),
        F.least(F.lit(0.8), F.lit(0.4) + F.lit(0.1) * F.count("*")).alias("confidence"),
    )
    return heads.join(counts, keys).select(*keys, "position", *(["evidence_record_ids"] if ids else []), "confidence")


def perspective_errors() -> Column:
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return F.array_compact(
        F.array(
            F.when(blank("stakeholder_group"), "stakeholder_group is required"),
            F.when(blank("position"), "position is required"),
            F.when((F.col("confidence") < 0) | (F.col("confidence") > 1), "confidence must be between 0 and 1"),
            F.when(F.col("is_official_position") & blank("attribution"), "official positions require explicit attribution"),
        )
    )


def negate(claim: Column) -> Column:
    for pattern, to in L.NEGATE:
        claim = F.regexp_replace(claim, f"(?i){pattern}", to)
    return F.trim(F.regexp_replace(claim, r"\s+", " "))


ARGUED = "struct<pro_argument:string,pro_confidence:double,contra_argument:string,contra_confidence:double>"


def argue(claims: DataFrame, make: Callable | None = None) -> DataFrame:
    """claim_id, pro, pro_confidence, contra, contra_confidence, consensus, method of claims (claim_id, claim, evidence).

    A provider's JSON with all four fields counts; else the claim stands against its negation, at 0.8 and 0.6, with the
    consensus that the negation's weight leaves.
    """
    from .plugins import generate, json_in

    found = F.lit(None).cast(ARGUED)
    rows = claims
    if make is not None:
        prompt = F.format_string(
            "Claim: %s\nEvidence: %s\nAnswer with JSON: pro_argument, pro_confidence, contra_argument, contra_confidence.", F.col("claim"), F.array_join("evidence", " | ")
        )
        said = generate(claims.select(F.col("claim_id").alias("id"), prompt.alias("prompt")), make).select(F.col("id").alias("_id"), "output")
        rows = claims.join(said, F.col("claim_id").cast("string") == F.col("_id"), "left")
        found = json_in(F.col("output"), ARGUED)
    rows = rows.withColumn("_m", found)
    whole = F.lit(True)
    for c in ("pro_argument", "pro_confidence", "contra_argument", "contra_confidence"):
        whole = whole & F.col(f"_m.{c}").isNotNull()
    whole = F.coalesce(whole, F.lit(False))
    either = lambda c, plain: F.when(whole, F.col(f"_m.{c}")).otherwise(plain)
    consensus = F.when(whole, 1 - F.abs(F.col("_m.pro_confidence") - F.col("_m.contra_confidence")) * 0.5).otherwise(F.lit(1 - 0.6 * 0.5))
    return rows.select(
        "claim_id",
        either("pro_argument", F.col("claim")).alias("pro"), either("pro_confidence", F.lit(0.8)).alias("pro_confidence"),
        either("contra_argument", negate(F.col("claim"))).alias("contra"), either("contra_confidence", F.lit(0.6)).alias("contra_confidence"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), consensus)).alias("consensus"),
        F.when(whole, "provider_model").otherwise("rule_based_fallback").alias("method"),
    )


def metrics(pro: Column, contra: Column, coverage: Column, sources: Column) -> Column:
    """Consensus, balance, diversity and overall quality of a pro and contra pair."""
    consensus = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(pro - contra) * 0.5))
    top = F.greatest(pro, contra)
    balance = F.when(top > 0, F.least(pro, contra) / top).otherwise(0.0)
    diversity = F.least(sources / F.lit(3.0), F.lit(1.0))
    overall = 0.4 * consensus + 0.2 * balance + 0.2 * coverage + 0.2 * diversity
    return F.struct(consensus.alias("consensus"), balance.alias("balance"), diversity.alias("diversity"), overall.alias("overall"))


def recommend(consensus: Column, pro: Column, threshold: float = 0.6) -> Column:
    good = consensus >= threshold
    return F.struct(
        F.when(good, F.concat(F.lit("Implement policy aligned with: "), pro))
        .otherwise("Commission further analysis and stakeholder consultation.")
        .alias("text"),
        F.when(good, consensus).otherwise(1 - consensus).alias("confidence"),
    )


def word_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))


def extractive(claims: DataFrame, snippets: DataFrame, min_confidence: float = 0.5, top: int = 3) -> DataFrame:
    """claim_id, rank, sentence, score: the sentences that share most words with their claim.

    Snippets (claim_id, k, text, confidence) below the least confidence count only where a claim has no others.
    """
    good = F.col("confidence") >= min_confidence
    none = snippets.groupBy("claim_id").agg(F.max(good.cast("int")).alias("_good")).filter("_good = 0").select("claim_id")
    kept = snippets.filter(good).unionByName(snippets.join(none, "claim_id", "left_semi"))
    s = kept.select("claim_id", "k", F.posexplode(sentences(F.col("text"))).alias("j", "sentence"))
    words = claims.select("claim_id", word_set(F.col("claim")).alias("cw"))
    shared = F.size(F.array_intersect("cw", word_set(F.col("sentence"))))
    scored = s.join(words, "claim_id").withColumn("score", F.when(F.size("cw") > 0, shared / F.size("cw")).otherwise(0.0))
    best = Window.partitionBy("claim_id").orderBy(F.desc("score"), "k", "j")
    return (
        scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("claim_id", "rank", "sentence", "score")
    )
