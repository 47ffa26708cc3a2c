"""BM25 retrieval: statistics, batched top-k with facets, evidence, and incremental postings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TOKEN, term_counts, tokens

K1, B = 1.5, 0.75
#: Query terms that are looked for inside the rows; with more, rows meet them in a join.
VOCABULARY = 20_000
FACETS = ("stakeholder_groups", "organizations", "topics")


def latest(records: DataFrame, order: str) -> DataFrame:
    """The last added record of each record_id."""
    last = Window.partitionBy("record_id").orderBy(F.desc(order))
    return records.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def _terms(wanted: list[str] | None = None, total: bool = False) -> Column:
    """A record's terms (term, tf, dl), counted inside its row: all, or the wanted ones; with total, its length under a null term.

    One column that is to be used once, as inline(...): every other use would cut the text into words again.
    """

    def count(words: Column) -> Column:
        found = words if wanted is None else F.filter(words, lambda w: w.isin(wanted))
        n = F.size(words)
        rows = F.transform(term_counts(found), lambda x: F.struct(x["term"].alias("term"), x["tf"].alias("tf"), n.alias("dl")))
        whole = F.array(F.struct(F.lit(None).cast("string").alias("term"), n.alias("tf"), n.alias("dl")))
        return F.concat(rows, whole) if total else rows

    return F.get(F.transform(F.array(tokens(F.col("text"))), count), F.lit(0))


def postings(records: DataFrame) -> DataFrame:
    """record_id, term, tf, dl: one row a record and distinct term; no shuffle, as a record's terms are in its row."""
    return records.select("record_id", F.inline(_terms())).select("record_id", "term", F.col("tf").cast("long").alias("tf"), "dl")


def statistics(records: DataFrame) -> DataFrame:
    """One row: number of records and their average length in tokens (1 at least)."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TOKEN))
    return records.agg(F.count("*").alias("n"), F.greatest(F.avg(n), F.lit(1.0)).alias("avgdl"))


def term_statistics(records: DataFrame) -> DataFrame:
    """term, df, cf: how many records hold each term and how often."""
    return records.select(F.inline(_terms())).groupBy("term").agg(F.count("*").alias("df"), F.sum(F.col("tf").cast("long")).alias("cf"))


def facet_pass(record_facets: dict[str, Column], query_facets: dict[str, Column]) -> Column:
    """An empty facet of the query passes; of the others each must overlap the record's."""
    out = F.lit(True)
    for name, wanted in query_facets.items():
        out = out & ((F.size(wanted) == 0) | F.arrays_overlap(record_facets[name], wanted))
    return out


def top_k(
    records: DataFrame,
    queries: DataFrame,
    k: int = 8,
    k1: float = K1,
    b: float = B,
    allowed: DataFrame | None = None,
    where: Column | None = None,
    facets: tuple[str, ...] = (),
) -> DataFrame:
    """qid, rank, record_id, score, matched_terms of the best k records of each query (qid, text).

    Query terms are looked up inside the rows of records, so only their counts leave the scan; a query's
    repeated terms count repeatedly. What is ranked, but not the statistics, is restricted by `where` (on records), by
    `facets` (arrays that records and queries both have; see facet_pass) and by `allowed` (qid, record_id).
    Ranks follow the score at six decimals, then record_id.
    """
    asked = queries.select("qid", F.explode(tokens(F.col("text"))).alias("term")).groupBy("qid", "term").agg(F.count("*").alias("qtf"))
    names = [r.term for r in asked.select("term").distinct().limit(VOCABULARY + 1).collect()]
    wanted = names if len(names) <= VOCABULARY else None
    weights = asked.join(_idf(records, asked, wanted), "term").select("qid", "term", (F.col("qtf") * F.col("idf")).alias("weight"), "avgdl")
    ranked = records if where is None else records.filter(where)
    carried = [F.col(c).alias(f"_{c}") for c in facets]
    hits = ranked.select("record_id", *carried, F.inline(_terms(wanted))).join(weights, "term")
    if facets:
        hits = hits.join(queries.select("qid", *facets), "qid").filter(facet_pass({c: F.col(f"_{c}") for c in facets}, {c: F.col(c) for c in facets}))
    if allowed is not None:
        hits = hits.join(allowed.select("qid", "record_id"), ["qid", "record_id"], "left_semi")
    tf = F.col("tf")
    norm = tf + k1 * (1 - b + b * F.greatest(F.col("dl"), F.lit(1)) / F.col("avgdl"))
    scored = hits.groupBy("qid", "record_id").agg(
        F.round(F.sum(F.col("weight") * tf * (k1 + 1) / norm), 6).alias("score"), F.array_sort(F.collect_set("term")).alias("matched_terms")
    )
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "record_id")
    return (
        scored.filter("score > 0")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= max(k, 0))
        .select("qid", "rank", "record_id", "score", "matched_terms")
    )


def _idf(records: DataFrame, asked: DataFrame, wanted: list[str] | None) -> DataFrame:
    """term, idf, avgdl of the asked terms, over all records."""
    spark = records.sparkSession
    if wanted is None:
        df = term_statistics(records).join(asked.select("term").distinct(), "term", "left_semi")
        value = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        # one row of statistics
        return df.crossJoin(F.broadcast(statistics(records))).select("term", value.alias("idf"), "avgdl")
    # one pass over the records; a null term stands for all tokens, so its row has the number of records and of tokens
    counts = records.select(F.inline(_terms(wanted, total=True)))
    found = {r.term: r for r in counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).collect()}
    every = found.pop(None, None)
    if every is None:
        return spark.createDataFrame([], "term string, idf double, avgdl double")
    avgdl = max(every.cf / every.df, 1.0)
    rows = [(t, math.log(1 + (every.df - r.df + 0.5) / (r.df + 0.5)), avgdl) for t, r in found.items()]
    return spark.createDataFrame(rows, "term string, idf double, avgdl double")


def evidence(ranked: DataFrame, records: DataFrame, snippet: int = 300) -> DataFrame:
    """Ranked items with what is cited of their records: the first characters of the text."""
    cols = [c for c in records.columns if c not in ("text", "record_id")]
    cited = records.select("record_id", *cols, F.substring("text", 1, snippet).alias("snippet"))
    return ranked.join(cited, "record_id")


def append_postings(index: DataFrame, batch: DataFrame) -> DataFrame:
    """An index of postings after a batch: records that come again replace their old postings."""
    return index.join(batch.select("record_id").distinct(), "record_id", "left_anti").unionByName(postings(batch))


def retrieve_evidence(records: DataFrame, queries: DataFrame, k: int = 8, **options) -> DataFrame:
    """qid, evidence: the cited items of each query, best first, and whether there are any; queries without hits stay."""
    cited = evidence(top_k(records, queries, k, **options), records)
    item = F.struct("rank", "record_id", "score", "snippet")
    lists = cited.groupBy("qid").agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    found = queries.select("qid").join(lists, "qid", "left")
    # an empty list of the same kind for queries without hits
    none = F.filter(F.array(F.get("evidence", F.lit(0))), lambda x: F.lit(False))
    return found.select("qid", F.coalesce("evidence", none).alias("evidence"), F.col("evidence").isNotNull().alias("found"))
