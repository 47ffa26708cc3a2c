"""Joins, set operations and windows with the engine's conventions for first matches and order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import suffixes


def first_match(left: DataFrame, right: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each left row with the first right row of its key; rows without one are dropped."""
    w = Window.partitionBy(key).orderBy(*order)
    first = right.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    return left.join(first, key)


def last_by(rows: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def lookup(left: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    return left.join(right, key, "left").fillna(defaults)


def classify_by_suffix(rows: DataFrame, key: str, host: Column, registry: DataFrame) -> DataFrame:
    """key, source_id: the first registry entry whose domain is the host or a parent of it.

    Hosts explode into their suffixes, so the match is an equi-join on small strings.
    """
    entries = registry.select("source_id", "registry_order", F.explode("domains").alias("suffix"))
    ends = rows.select(key, F.explode(suffixes(host)).alias("suffix"))
    return ends.join(entries, "suffix").groupBy(key).agg(F.min_by("source_id", "registry_order").alias("source_id"))


def speaker_of(segments: DataFrame, turns: DataFrame, bucket: float) -> DataFrame:
    """Each segment (group, seg, start, end) with the speaker of most overlap; null without any.

    Turns (group, turn, speaker, start, end) are cut into time buckets, so the range join is an equi-join
    on group and bucket; an overlapping pair counts in its first common bucket only.
    """
    def cut(df: DataFrame) -> DataFrame:
        lo, hi = F.floor(F.col("start") / bucket), F.floor(F.col("end") / bucket)
        return df.withColumn("_b", F.explode(F.sequence(lo, hi))).withColumn("_lo", lo)

    a = cut(segments)
    b = cut(turns).select(
        "group", "turn", "speaker", F.col("start").alias("s2"), F.col("end").alias("e2"), "_b", F.col("_lo").alias("_lo2")
    )
    overlap = F.least("end", "e2") - F.greatest("start", "s2")
    pairs = (
        a.join(b, ["group", "_b"])
        .filter(F.col("_b") == F.greatest("_lo", "_lo2"))
        .withColumn("overlap", overlap)
        .filter("overlap > 0")
    )
    best = pairs.groupBy("group", "seg").agg(F.min(F.struct((-F.col("overlap")).alias("o"), "turn", "speaker"))["speaker"].alias("speaker"))
    return segments.select("group", "seg").join(best, ["group", "seg"], "left")


def islands(rows: DataFrame, keys: list[str], order: str, inside: Column) -> DataFrame:
    """Contiguous runs of rows where `inside` holds: keys, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = rows.withColumn("_in", inside.cast("int"))
    change = (F.col("_in") != F.coalesce(F.lag("_in").over(w), F.lit(0))).cast("int")
    named = marked.withColumn("_c", change).withColumn("_run", F.sum("_c").over(w))
    return (
        named.filter("_in = 1")
        .groupBy(*keys, "_run")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
        .drop("_run")
    )


def early_stop(losses: DataFrame, run: str, warm: int = 10, patience: int = 2) -> DataFrame:
    """The epoch at which each run (run, epoch, loss) stops: none before `warm`, then after `patience` epochs without a new best."""
    w = Window.partitionBy(run).orderBy("epoch")
    best = losses.withColumn("_best", F.min("loss").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    at = F.when(F.col("_best").isNull() | (F.col("loss") < F.col("_best")), F.col("epoch"))
    seen = best.withColumn("_last", F.max(at).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    stop = (F.col("epoch") >= warm) & (F.col("epoch") - F.col("_last") >= patience)
    return seen.groupBy(run).agg(F.min(F.when(stop, F.col("epoch"))).alias("stopped_at"))


def reconcile(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """key, side: keys on one side only."""
    only = lambda x, y, s: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").withColumn("side", F.lit(s))
    return only(local, remote, "local").unionByName(only(remote, local, "remote"))


def leakage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")


def hash_split(ids: DataFrame, key: str, seed: str = "42", train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """key, split: exact floor(n * share) sizes in the order of seeded hashes.

    Hash-prefix counts give each row its rank: windows run over one prefix and over the prefixes.
    """
    h = F.sha2(F.concat_ws("\x01", F.lit(seed), F.col(key).cast("string")), 256)
    rows = ids.select(key, h.alias("h")).withColumn("p", F.substring("h", 1, 2))
    counts = rows.groupBy("p").agg(F.count("*").alias("c"))
    # at most 256 rows
    before = counts.select(
        "p",
        (F.sum("c").over(Window.orderBy("p")) - F.col("c")).alias("before"),
        F.sum("c").over(Window.partitionBy()).alias("n"),
    )
    rank = F.row_number().over(Window.partitionBy("p").orderBy("h", key)) + F.col("before")
    out = rows.join(F.broadcast(before), "p").withColumn("r", rank)
    first, second = F.floor(F.col("n") * F.lit(train)), F.floor(F.col("n") * F.lit(train)) + F.floor(F.col("n") * F.lit(validation))
    return out.select(key, F.when(F.col("r") <= first, "train").when(F.col("r") <= second, "validation").otherwise("test").alias("split"))
