"""Benchmark suites: case files, generated cases, results by suite, and the schema of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .metrics import coverage, evidence_recall, precision_at, recall_at, reciprocal_rank, set_wer

#: The fields that each suite's cases have.
CASES: Mapping[str, str] = {
    "ocr": "case_id string, image_path string, expected_text string, expected_confidence_min double",
    "asr": "case_id string, audio_path string, expected_transcript string, expected_language string",
    "diarization": "case_id string, audio_path string, expected_segments array<struct<start:double,end:double,speaker:string>>",
    "multilingual": "case_id string, text string, expected_language string, expected_supported boolean",
    "stakeholder": "case_id string, text string, expected_stakeholders array<struct<name:string,type:string>>",
    "position": "case_id string, text string, expected_positions array<string>",
    "argument": "case_id string, text string, expected_arguments array<string>",
    "evidence_linking": "case_id string, claim string, evidence_candidates array<string>, expected_relevant array<int>",
    "temporal": "case_id string, text string, expected_positions array<string>",
}
#: The fields that a result must have.
RESULT = ("case_id", "suite", "passed")


def read_cases(spark: SparkSession, folder: str, suite: str) -> DataFrame:
    """The cases of a suite from its JSON file (a list), with their schema."""
    return spark.read.schema(CASES[suite]).option("multiLine", True).json(f"{folder}/{suite}_cases.json")


def write_cases(cases: DataFrame, path: str) -> None:
    cases.write.mode("overwrite").json(path)


def generated_cases(spark: SparkSession, templates: Sequence[str], values: Mapping[str, Sequence[str]], n: int, seed: str = "42") -> DataFrame:
    """case_id, text: n cases whose template and values hashes of the seed and the case choose; {name} marks a value."""
    pick = lambda what, some: F.get(F.array(*map(F.lit, some)), F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "id"), F.lit(len(some))).cast("int"))
    text: Column = pick("template", templates)
    for name, some in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), pick(name, some))
    return spark.range(n).select(F.format_string("case_%05d", "id").alias("case_id"), text.alias("text"))


def confidence_match(expected: Column, got: Column, confidence: Column, least: Column) -> Column:
    return (F.trim(expected) == F.trim(got)) & (confidence >= least)


def transcript(expected: Column, got: Column, most: float = 0.3) -> Column:
    """Word sets alone decide; where nothing is expected, nothing may be said."""
    silent = F.trim(F.coalesce(expected, F.lit(""))) == ""
    return F.when(silent, F.trim(F.coalesce(got, F.lit(""))) == "").otherwise(set_wer(expected, got) <= most)


def language(expected: Column, got: Column, expected_supported: Column, supported: Sequence[str]) -> Column:
    return (expected == got) & (got.isin(*supported) == expected_supported)


def covered(expected: Column, got: Column, least: float = 0.5) -> Column:
    """Where no names are expected, none may be found."""
    share = F.size(F.array_intersect(F.array_distinct(got), F.array_distinct(expected))) / F.size(F.array_distinct(expected))
    return F.when(F.size(expected) == 0, F.size(got) == 0).otherwise(share >= least)


def any_as_expected(expected: Column, got: Column) -> Column:
    return (F.size(expected) > 0) == (F.size(got) > 0)


def top_recall(scores: Column, relevant: Column, least: float = 0.5) -> Column:
    """Of as many candidates with the highest scores as are relevant (ties to the first), the share that is."""
    ordered = F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("s"), i.alias("i"))))
    top = F.transform(F.slice(ordered, F.lit(1), F.greatest(F.size(relevant), F.lit(1))), lambda x: x["i"])
    found = F.size(F.array_intersect(top, relevant)) / F.size(relevant)
    return F.when(F.size(relevant) == 0, F.lit(True)).otherwise(found >= least)


def results(suite: str, rows: DataFrame, passed: Column) -> DataFrame:
    """case_id, suite, passed, error of predictions beside their cases; a row with an error fails."""
    error = F.col("error") if "error" in rows.columns else F.lit(None).cast("string")
    return rows.select("case_id", F.lit(suite).alias("suite"), (error.isNull() & F.coalesce(passed, F.lit(False))).alias("passed"), error.alias("error"))


def result_errors(rows: DataFrame, required: Sequence[str] = RESULT) -> DataFrame:
    """Rows of results with the required fields that they lack."""
    lacking = [F.lit(c) if c not in rows.columns else F.when(F.col(c).isNull(), c) for c in required]
    return rows.withColumn("missing", F.array_compact(F.array(*lacking))).filter(F.size("missing") > 0)


def run_evaluation(cases: DataFrame, k: int = 8) -> DataFrame:
    """One row of means over cases (got, want: arrays; evidence_got, evidence_want; represented, expected)."""
    mean = lambda c, name: F.round(F.avg(c), 6).alias(name)
    return cases.agg(
        F.count("*").alias("n"),
        mean(recall_at("got", "want", k), "recall"),
        mean(precision_at("got", "want", k), "precision"),
        mean(reciprocal_rank("got", "want"), "mrr"),
        mean(evidence_recall(F.col("evidence_got"), F.col("evidence_want")), "evidence_recall"),
        mean(coverage(F.col("represented"), F.col("expected")), "coverage"),
    )


def extremes(losses: DataFrame, n: int = 5) -> DataFrame:
    """The n rows with the least and the n with the greatest loss: side, rank and the row; ties by id."""
    best, worst = Window.orderBy("loss", "id"), Window.orderBy(F.desc("loss"), "id")
    # two limits, each a bounded number of rows, are ranked
    low = losses.orderBy("loss", "id").limit(n).withColumn("rank", F.row_number().over(best)).withColumn("side", F.lit("best"))
    high = losses.orderBy(F.desc("loss"), "id").limit(n).withColumn("rank", F.row_number().over(worst)).withColumn("side", F.lit("worst"))
    return low.unionByName(high)


def capped(items: Column, n: int) -> Column:
    """What a report shows of a list, and how many more there are."""
    return F.struct(F.slice(items, 1, n).alias("shown"), F.greatest(F.size(items) - n, F.lit(0)).alias("more"))
