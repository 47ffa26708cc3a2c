"""Policy inference: rules where rules suffice, and places where models attach, with failures as a column.

Named entities, dependency parses, translation, OCR and speech need models. Each has a row type, a batch function
to be given, and an error column; entities and subject-verb-object positions have rule-based stand-ins, labelled so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions.text import sentences

#: What modal verbs say of a policy.
FACTORS = (("requirement", r"\b(?:must|shall)\b"), ("recommendation", r"\bshould\b"), ("permission", r"\b(?:may|can)\b"))
ROLES = r"\b([A-Z][a-z]+(?: [A-Z][a-z]+)+), (?:the )?([a-z]+(?: [a-z]+){0,3})\b"
SVO = r"^\W*((?:[Tt]he |[Aa]n? )?[\p{L}&-]+(?: [\p{L}&-]+){0,4}?) (supports?|opposes?|recommends?|proposes?|endorses?|rejects?) (.+?)[.!?]*$"


def entities(segments: DataFrame) -> DataFrame:
    """segment_id, mention, kind, role, method: organisations and persons with a role, by patterns."""
    orgs = F.transform(F.regexp_extract_all("text", F.lit(L.ORGANISATION), F.lit(1)), lambda m: F.struct(m.alias("mention"), F.lit("organization").alias("kind"), F.lit(None).cast("string").alias("role")))
    names, roles = (F.regexp_extract_all("text", F.lit(ROLES), F.lit(k)) for k in (1, 2))
    people = F.zip_with(names, roles, lambda n, r: F.struct(n.alias("mention"), F.lit("person").alias("kind"), r.alias("role")))
    return segments.select("segment_id", F.inline(F.array_distinct(F.concat(orgs, people)))).withColumn("method", F.lit("rules"))


def policy_factors(segments: DataFrame) -> DataFrame:
    """segment_id, ordinal, factor, sentence: requirements, recommendations and permissions of sentences."""
    rows = segments.select("segment_id", F.posexplode(sentences(F.col("text"))).alias("ordinal", "sentence"))
    found = F.array_compact(F.array(*(F.when(F.lower("sentence").rlike(p), name) for name, p in FACTORS)))
    return rows.select("segment_id", "ordinal", F.explode(found).alias("factor"), "sentence")


def svo_positions(segments: DataFrame, confidence: float = 0.8) -> DataFrame:
    """segment_id, ordinal, subject, verb, object, confidence, method: sentences of the form 'X supports Y'."""
    rows = segments.select("segment_id", F.posexplode(sentences(F.col("text"))).alias("ordinal", "s"))
    part = lambda k: F.regexp_extract("s", SVO, k)
    out = rows.select("segment_id", "ordinal", part(1).alias("subject"), part(2).alias("verb"), part(3).alias("object"), F.lit(confidence).alias("confidence"))
    return out.filter("subject <> ''").withColumn("method", F.lit("rules"))


def batched(rows: DataFrame, key: str, value: str, call: Callable[[Sequence], Sequence[dict]], schema: str) -> DataFrame:
    """key, the schema's fields, error: what a batch function makes of values; a batch that fails is tried row by row."""
    names = [c.strip().split(" ")[0] for c in schema.split(",") if " " in c.strip()]

    def one(values: list) -> list[tuple[dict | None, str | None]]:
        try:
            made = list(call(values))
            if len(made) != len(values):
                raise ValueError(f"{len(made)} results for {len(values)} values")
            return [(m, None) for m in made]
        except Exception as e:  # a model may raise anything; its rows say so
            if len(values) > 1:
                return [r for v in values for r in one([v])]
            return [(None, f"{type(e).__name__}: {e}"[:200])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = one(pdf[value].tolist())
            cols = {n: [None if m is None else m.get(n) for m, _ in got] for n in names}
            yield pd.DataFrame({"key": pdf[key].astype(str), **cols, "error": [e for _, e in got]})

    out = rows.select(key, value).mapInPandas(run, f"key string, {schema}, error string")
    return out.withColumnRenamed("key", key)


def translate(segments: DataFrame, call: Callable[[Sequence[str]], Sequence[dict]]) -> DataFrame:
    """Segments with their translation, confidence (0.9 unless given) and error; times and speakers stay."""
    made = batched(segments, "segment_id", "text", call, "translation string, confidence double")
    made = made.select(F.col("segment_id").alias("_id"), "translation", F.coalesce("confidence", F.when(F.col("error").isNull(), 0.9)).alias("confidence"), "error")
    return segments.join(made, F.col("segment_id").cast("string") == F.col("_id"), "left").drop("_id")


def ocr(images: DataFrame, call: Callable[[Sequence[bytes]], Sequence[dict]]) -> DataFrame:
    """path, text, confidence, error of images (path, content)."""
    return batched(images, "path", "content", call, "text string, confidence double")


def transcribe(audio: DataFrame, call: Callable[[Sequence[bytes]], Sequence[dict]]) -> DataFrame:
    """path, language, ordinal, start, end, text, error of audio (path, content): one row a segment, one row a failure."""
    made = batched(audio, "path", "content", call, "language string, segments array<struct<start:double,end:double,text:string>>")
    rows = made.select("path", "language", F.posexplode_outer("segments").alias("ordinal", "s"), "error")
    return rows.select("path", "language", "ordinal", "s.start", "s.end", "s.text", "error")


def frame_timeline(frames: DataFrame, fps: Column) -> DataFrame:
    """frames (path, frame, text) with the second at which each stands; equal texts in a row are one entry."""
    from pyspark.sql import Window

    order = Window.partitionBy("path").orderBy("frame")
    timed = frames.withColumn("at", F.when(fps > 0, F.col("frame") / fps))
    new = timed.withColumn("_new", (F.lag("text").over(order).isNull() | (F.lag("text").over(order) != F.col("text"))).cast("int"))
    runs = new.withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("path", "_run").agg(F.min("at").alias("start"), F.max("at").alias("end"), F.first("text").alias("text"), F.count("*").alias("frames")).drop("_run")


def edge_confidence(edges: Column, pixels: Column) -> Column:
    """The share of edge pixels, which stands for an OCR result's confidence; 0 for an empty image."""
    return F.when(pixels > 0, F.least(edges / pixels, F.lit(1.0))).otherwise(0.0)
