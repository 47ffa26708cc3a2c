"""Mixing sources to target weights along a time-varying curriculum.

Each source s has a weight and a linear schedule r_s(t) = T_s * (1 + a_s * (1 - 2 t)) for the
training time t in [0, 1]; its integral over [0, 1] is the target T_s. The documents of a source
lie one after another in a fixed pseudo-random order, so that each has a place c on the source's
token axis; the place is mapped to a training position by inverting the cumulative demand
T_s * (t + a_s * t * (1 - t)). Sorting by position interleaves the sources as scheduled.

The running token sums that this needs come from three nested levels of hash buckets (256 x 256 and
the rows of one bucket), so no task ever holds all rows of a source, however large its share.

Defined cases: null text has size 0; a null source is a source of its own and comes last; a source
without words has target 0 and takes nothing; an empty table gives an empty result; rows that repeat
a doc_id count one by one; extra columns stay out of the plan (`plan`) or are kept (`mix`), whatever their names.
The order inside a source is that of the hash of doc_id and text, so that rows that share an id, or have none,
spread over the buckets too; ties fall to doc_id, size, and the hash of the row. Equal positions of different
sources are ordered by source, doc_id and that hash, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, table

WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (0.5, 0.0, -0.5)
SHARE = 1.5
REPEAT = 2


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; rows that agree in it are taken for the same row."""
    plain = [F.col(f"`{c}`") for c in docs.columns]
    return F.xxhash64(*(F.to_json(F.struct(c)) if "map" in t else c for c, (_, t) in zip(plain, docs.dtypes, strict=True)))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the order key of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))).alias("h"),
        row_hash(docs).alias("x"),
    )


def _cycle(values: tuple[float, ...], rank: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(float(v)) for v in values]),
        (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"),
    )


def source_targets(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    slopes: tuple[float, ...] = SLOPES,
    share: float = SHARE,
    repeat: int = REPEAT,
) -> DataFrame:
    """source, source_size, target, slope: one row a source.

    Water filling: with level L, target = min(repeat * size, L * weight) and the targets sum to
    share * all sizes. Sorted by the level at which each source fills up, L follows from running
    sums. The windows here are over one row a source.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("k", F.row_number().over(by_name))
    per = per.withColumn("w", _cycle(weights, F.col("k"))).withColumn("slope", _cycle(slopes, F.col("k")))
    fills = Window.orderBy("full_at", "k")
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("cap", F.lit(float(repeat)) * F.col("source_size")).withColumn(
        "full_at", F.col("cap") / F.col("w")
    )
    per = per.withColumn(
        "level",
        (
            F.lit(float(share)) * F.sum("source_size").over(everything)
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        )
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    )
    # the first source (in filling order) that its level leaves below its cap fixes the common level
    level = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "k", "level"))).over(everything)
    per = per.withColumn("final", level["level"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("final") * F.col("w"))
    )
    return per.select("source", "source_size", target.alias("target"), "slope")


def _prefix(rows: DataFrame) -> DataFrame:
    """Adds `before`: the words of the same source that precede the row in hash order."""
    rows = rows.withColumn("b1", F.substring("h", 1, 2)).withColumn("b2", F.substring("h", 3, 2))
    preceding = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    fine = rows.groupBy("source", "b1", "b2").agg(F.sum("size").alias("n"))
    coarse = fine.groupBy("source", "b1").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    coarse = coarse.select(
        "source", "b1", F.coalesce(F.sum("n").over(preceding("source").orderBy("b1")), zero).alias("o1")
    )
    fine = fine.select(
        "source", "b1", "b2", F.coalesce(F.sum("n").over(preceding("source", "b1").orderBy("b2")), zero).alias("o2")
    )
    own = F.coalesce(
        F.sum("size").over(preceding("source", "b1", "b2").orderBy("h", "doc_id", "size", "x")), zero
    ).alias("o3")
    rows = rows.select("*", own)
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    rows = rows.withColumn("sk", key)
    fine = fine.select(key.alias("sk"), "b1", "b2", "o2")
    coarse = coarse.select(key.alias("sk"), "b1", "o1")
    offsets = fine.join(coarse, ["sk", "b1"])
    return rows.join(offsets, ["sk", "b1", "b2"]).withColumn("before", F.expr("o1 + o2 + o3"))


def _position(at: Column, target: Column, slope: Column) -> Column:
    """The time t with t + slope * t * (1 - t) = at / target."""
    y = F.least(F.lit(1.0), at / target)
    root = F.sqrt(F.greatest(F.lit(0.0), (1 + slope) * (1 + slope) - 4 * slope * y))
    return F.when(slope == 0, y).otherwise(((1 + slope) - root) / (2 * slope))


def plan(
    docs: DataFrame,
    scratch: Scratch,
    weights: tuple[float, ...] = WEIGHTS,
    slopes: tuple[float, ...] = SLOPES,
    share: float = SHARE,
    repeat: int = REPEAT,
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, copies, first_position, last_position, x.

    Every document is taken floor(target / source_size) times; those whose middle lies in the first
    target - floor * source_size words of the source's order are taken once more, so a source's
    taken words differ from its target by half a document at most.
    """
    rows = scratch.write(sized(docs))
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    # one row a source: small beside the documents; Spark broadcasts it only below its size threshold
    targets = source_targets(rows, weights, slopes, share, repeat).withColumn("sk", key).drop("source")
    out = _prefix(rows).join(targets, "sk")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = out.withColumn("passes", F.least(passes, F.lit(repeat)).cast("long"))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    middle = F.col("before") + F.col("size") / 2
    more = ((middle < rest) & (F.col("passes") < repeat)).cast("long")
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + more).otherwise(F.lit(0)).cast("long"))
    first = F.when(F.col("copies") > 0, _position(middle, F.col("target"), F.col("slope")))
    last = F.when(
        F.col("copies") > 0,
        _position(middle + (F.col("copies") - 1) * F.col("source_size"), F.col("target"), F.col("slope")),
    )
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        first.alias("first_position"),
        last.alias("last_position"),
        "x",
        "source",
    )


def mix(docs: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The documents in training order: each row as often as it is taken, range-sorted by position.

    Texts move to their plan rows, where they are written, and then to their positions, so that the disk never holds both
    moves. Only rows that repeat as a whole are numbered, to meet one plan row each.
    """
    slopes = tuple(options.get("slopes", SLOPES))
    assert all(abs(s) < 1 for s in slopes)
    ident = ["doc_id", "source", "x"]
    p = scratch.write(plan(docs, scratch, **options).filter("copies > 0").select(*ident, "copies", "first_position", "last_position"))
    repeated = scratch.write(p.groupBy(*ident).agg(F.count("*").alias("m")).filter("m > 1").drop("m"))
    left = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        row_hash(docs).alias("x"),
    )

    def among(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(repeated, [rows[c].eqNullSafe(repeated[c]) for c in ident], how)

    def meet(a: DataFrame, b: DataFrame, *more: str) -> DataFrame:
        on = [a[c].eqNullSafe(b[c]) for c in ident] + [a[c] == b[c] for c in more]
        return a.join(b, on).select("row", *(a[c] for c in ident), "copies", "first_position", "last_position")

    numbered = lambda rows, order: rows.withColumn("r", F.row_number().over(Window.partitionBy(*ident).orderBy(order)))
    joined = meet(left, among(p, "left_anti")).unionByName(
        meet(numbered(among(left, "left_semi"), F.lit(0)), numbered(among(p, "left_semi"), "first_position"), "r")
    )
    joined = scratch.write(joined)
    once = F.array("first_position")
    places = F.explode(F.when(F.col("copies") > 1, F.array("first_position", "last_position")).otherwise(once)).alias("position")
    return joined.select("row", *ident, places).orderBy("position", "source", "doc_id", "x").select("row.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op5")
    out = plan(table(spark, sf_dir, "documents"), scratch)
    return out.select("doc_id", "size", "source_size", "target", "taken", "first_position").orderBy(
        "first_position", "doc_id"
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents
), s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS k
  FROM d GROUP BY source
), s1 AS (
  SELECT *, CASE (k - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         CASE (k - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS slope,
         2.0::DOUBLE * source_size AS cap
  FROM s0
), s2 AS (
  SELECT *, cap / w AS full_at FROM s1
), s3 AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY full_at, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER ()
               - coalesce(sum(w) OVER (ORDER BY full_at, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM s2
), lv AS (
  SELECT arg_min(level, (full_at, k)) FILTER (level < full_at) AS final FROM s3
), s4 AS (
  SELECT source, source_size, slope,
         CASE WHEN final IS NULL THEN cap ELSE least(cap, final * w) END AS target
  FROM s3, lv
), p AS (
  SELECT d.doc_id, d.size, s4.source_size, s4.target, s4.slope,
         CASE WHEN s4.source_size > 0 THEN CAST(least(floor(s4.target / s4.source_size), 2) AS BIGINT) ELSE 0 END AS passes,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2 AS middle
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source
), c AS (
  SELECT *, CASE WHEN size > 0 THEN passes + CASE WHEN middle < target - passes * source_size AND passes < 2 THEN 1 ELSE 0 END
                 ELSE 0 END AS copies
  FROM p
)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN
         CASE WHEN slope = 0 THEN least(1.0::DOUBLE, middle / target)
              ELSE ((1 + slope) - sqrt(greatest(0.0::DOUBLE,
                    (1 + slope) * (1 + slope) - 4 * slope * least(1.0::DOUBLE, middle / target)))) / (2 * slope) END
       END AS first_position
FROM c
"""
