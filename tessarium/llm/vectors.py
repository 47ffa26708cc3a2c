"""Vectors in shards and query blocks: the layout that the two vector searches share.

Rows are dealt by a hash of their id to shards of a bounded number of vectors; each shard is one
row of packed bytes, written once. Queries travel in blocks, and each pair of a block and a shard is
one small task, so neither side is ever held whole anywhere.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "shard int, ids binary, vectors binary, dim int"


def clean(rows: DataFrame, nonzero: bool) -> DataFrame:
    """vec_id, v (array of double): one row an id, without unusable vectors.

    Null ids, and vectors that are null, empty or hold null, NaN or infinite components take no
    part; neither do zero vectors where nonzero is set. Rows that repeat an id count once (the
    smallest vector stands).
    """
    v = F.col("embedding").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    keep = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.forall(v, fine)
    if nonzero:
        keep = keep & F.exists(v, lambda x: x != 0)
    return rows.filter(F.coalesce(keep, F.lit(False))).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(v).alias("v")
    )


def by_length(base: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """search() over the vectors (v) of each length by themselves: those of different lengths have no inner product."""
    lengths = sorted(r.n for r in base.select(F.size("v").alias("n")).distinct().collect())
    found = [search(base.filter(F.size("v") == n) if len(lengths) > 1 else base) for n in lengths or [0]]
    return reduce(DataFrame.unionByName, found)


def packed(rows: DataFrame, shards: int, kind: str = "f8") -> DataFrame:
    """One row a shard with its ids and vectors, in the order of ids."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = np.stack(pdf["v"].to_numpy()).astype(kind)
        ids = pdf["vec_id"].to_numpy().astype("<i8")
        return pd.DataFrame(
            {"shard": [int(pdf["shard"].iloc[0])], "ids": [ids.tobytes()], "vectors": [x.tobytes()], "dim": [x.shape[1]]}
        )

    return (
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(pack, PACKED)
    )


def meet(index: DataFrame, queries: DataFrame, shards: int) -> DataFrame:
    """Each block of queries beside each shard."""
    q = queries.select(
        F.col("shard").alias("block"),
        F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    return q.join(index, "shard")


def unpack(ids: bytes, vectors: bytes, dim: int, kind: str = "f8") -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(vectors, kind).reshape(-1, dim)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query over all shards: query_id, rank, vec_id, score."""
    from pyspark.sql import Window

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def searched(pairs: DataFrame, search: Callable, score: str) -> DataFrame:
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                yield search(row)

    return pairs.mapInPandas(run, f"query_id long, vec_id long, score {score}")
