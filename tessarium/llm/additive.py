"""Approximate nearest neighbours by additive quantisation.

A vector's direction (the vector over its norm, so that no outlier spoils the others' precision) is coded as a
sum of M codewords, one of each full-dimensional codebook; its norm is stored. The codebooks are
fitted on a bounded sample: residual k-means first, then rounds of beam-search encoding and a joint
least-squares fit. Every row is encoded by beam search (the `beam` best partial sums survive each
codebook; norms of partial sums make the comparison a table lookup). Equal vectors are indexed once, with
their k + 1 smallest ids, which is all that any query can need of them. The index keeps, per shard,
codes, the norm of each vector, the distance of its decoded direction from the true one (the code error), and the
original vectors. A query scores a shard by its lookup tables and the stored norms, and the `rerank` best of each shard are scored again exactly in double precision on the original vectors. The
k-th of these is the cut: every other vector that the code error may lift to it is scored exactly
too, so codes only rule out what cannot be among the k, and no answer is lost to them.

The sample bound is SAMPLE vectors of a length (those with the smallest hashes); everything else covers all rows.

Defined cases: see vectors.clean; fewer than k candidates give all; ties go to the smaller
vec_id; an empty table gives an empty result; extra columns are ignored; products and distances that leave the
range of doubles are infinite, as double precision has it, and tie.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .vectors import by_length, clean, meet, packed, ranked, searched, unpack

K, EVERY = 20, 20
BOOKS, WORDS, BEAM, ROUNDS, SAMPLE, SEED = 12, 128, 4, 1, 6000, 5
SHARD_ROWS, BLOCK_ROWS, RERANK = 8192, 512, 640
SALT = 1024
DISTINCT = "shard int, ids binary, vectors binary, dim int, members binary, counts binary"


class Codebooks:
    def __init__(self, words: np.ndarray):
        self.words = words.astype(np.float32)  # M x K x d
        m, k, d = words.shape
        flat = self.words.reshape(m * k, d)
        self.norms = np.einsum("ij,ij->i", flat, flat).reshape(m, k)
        self.cross = (flat @ flat.T).reshape(m, k, m, k)

    def encode(self, x: np.ndarray, beam: int = BEAM, step: int = 2048) -> np.ndarray:
        return np.concatenate([self._encode(x[at : at + step], beam) for at in range(0, len(x), step)])

    def _encode(self, x: np.ndarray, beam: int) -> np.ndarray:
        m, k, d = self.words.shape
        n = len(x)
        dots = np.einsum("nd,mkd->mnk", x.astype(np.float32), self.words, optimize=True)
        codes = np.zeros((n, 1, m), np.uint8 if k <= 256 else np.int32)
        error = np.zeros((n, 1), np.float32)
        for j in range(m):
            b = codes.shape[1]
            # |x - s - c|^2 - |x - s|^2 = |c|^2 - 2 x.c + 2 s.c, with s the sum so far
            grown = error[:, :, None] + (self.norms[j] - 2 * dots[j])[:, None, :]
            for i in range(j):
                grown += 2 * self.cross[i, :, j, :][codes[:, :, i]]
            grown = grown.reshape(n, b * k)
            keep = min(beam, b * k)
            best = np.argpartition(grown, keep - 1, axis=1)[:, :keep]
            error = np.take_along_axis(grown, best, 1)
            codes = np.take_along_axis(codes, (best // k)[:, :, None], 1).copy()
            codes[:, :, j] = best % k
        return codes[np.arange(n), error.argmin(1)]

    def decode(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), self.words.shape[2]), np.float32)
        for j in range(self.words.shape[0]):
            out += self.words[j][codes[:, j]]
        return out

    def lookup(self, q: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """q.x of every query and coded vector, from one table a codebook."""
        tables = np.einsum("nd,mkd->mnk", q.astype(np.float32), self.words, optimize=True)
        score = np.zeros((len(q), len(codes)), np.float32)
        for j in range(len(tables)):
            score += np.take(tables[j], codes[:, j], axis=1)
        return score


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = ROUNDS, seed: int = SEED) -> Codebooks:
    rng = np.random.default_rng(seed)
    x = x.astype(np.float32)
    n, d = x.shape
    words = min(words, max(1, n))
    rest, made = x.copy(), []
    for _ in range(books):
        c = rest[rng.choice(n, words, replace=False)].copy()
        for _ in range(6):
            near = (rest @ c.T * -2 + np.einsum("ij,ij->i", c, c)).argmin(1)
            count = np.bincount(near, minlength=words)
            total = np.eye(words, dtype=np.float32)[near].T @ rest
            used = count > 0
            c[used] = total[used] / count[used, None]
        made.append(c)
        rest = rest - c[(rest @ c.T * -2 + np.einsum("ij,ij->i", c, c)).argmin(1)]
    out = Codebooks(np.stack(made))
    for _ in range(rounds):
        codes = out.encode(x)
        at = codes.astype(np.int64) + np.arange(books) * words
        chosen = np.zeros((n, books * words), np.float32)
        np.put_along_axis(chosen, at, 1.0, axis=1)
        gram, right = chosen.T @ chosen, chosen.T @ x
        # ridge towards the present words keeps unused ones where they are
        ridge = np.float32(0.5)
        solved = np.linalg.solve(
            gram + ridge * np.eye(books * words, dtype=np.float32), right + ridge * out.words.reshape(-1, d)
        )
        out = Codebooks(solved.reshape(books, words, d))
    return out


def distinct(base: DataFrame, k: int) -> DataFrame:
    """vec_id (the smallest), v, members (the k + 1 smallest ids, in order) of each distinct vector."""
    least = lambda ids: F.slice(F.array_sort(ids), 1, k + 1)
    # ids of a common vector are cut in many groups first, so that no task holds them all
    parts = base.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(SALT)).alias("salt")).agg(least(F.collect_list("vec_id")).alias("members"))
    whole = parts.groupBy("v").agg(least(F.flatten(F.collect_list("members"))).alias("members"))
    return whole.select(F.col("members")[0].alias("vec_id"), "v", "members")


def _shards(rows: DataFrame, shards: int) -> DataFrame:
    """One row a shard with its distinct vectors and their members, in the order of ids."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = np.stack(pdf["v"].to_numpy()).astype("f8")
        members = [np.asarray(m, "<i8") for m in pdf["members"]]
        return pd.DataFrame(
            {
                "shard": [int(pdf["shard"].iloc[0])],
                "ids": [pdf["vec_id"].to_numpy().astype("<i8").tobytes()],
                "vectors": [x.tobytes()],
                "dim": [x.shape[1]],
                "members": [np.concatenate(members).tobytes()],
                "counts": [np.array([len(m) for m in members], "<i4").tobytes()],
            }
        )

    return (
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(pack, DISTINCT)
    )


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector over its norm, and the norms; the largest component goes first, so that squares stay in range."""
    most = np.abs(x).max(axis=1, keepdims=True)
    y = x / most
    n = np.sqrt(np.einsum("ij,ij->i", y, y))
    with np.errstate(over="ignore"):
        return y / n[:, None], n * most[:, 0]


def _index(books: Codebooks):
    def build(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                _, x = unpack(row.ids, row.vectors, row.dim)
                unit, norms = directions(x)
                codes = books.encode(unit)
                error = np.sqrt(np.square(unit - books.decode(codes)).sum(axis=1))
                yield pd.DataFrame(
                    {
                        **{c: [getattr(row, c)] for c in ("shard", "ids", "vectors", "dim", "members", "counts")},
                        "codes": [codes.tobytes()],
                        "norms": [norms.tobytes()],
                        "errors": [error.tobytes()],
                    }
                )

    return build


def _exact(x: np.ndarray, q: np.ndarray, at: np.ndarray, measure: str) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        if measure == "ip":
            # most of a shard costs less read in place than gathered
            s = (x @ q)[at] if 4 * len(at) > len(x) else x[at] @ q
        else:
            gap = x[at] - q
            s = -np.einsum("ij,ij->i", gap, gap)
    return np.where(np.isnan(s), -np.inf, s)


def _final(x: np.ndarray, q: np.ndarray, measure: str) -> np.ndarray:
    """The measure summed component by component, so that reruns, and other engines, give the same bits."""
    with np.errstate(over="ignore", invalid="ignore"):
        s = np.cumsum(x * q if measure == "ip" else -np.square(x - q), axis=1)[:, -1]
    return np.where(np.isnan(s), -np.inf, s)


def nearest(
    rows: DataFrame,
    scratch: Scratch,
    k: int = K,
    every: int = EVERY,
    measure: str = "ip",
    shard_rows: int = SHARD_ROWS,
    rerank: int = RERANK,
) -> DataFrame:
    """The k nearest found of each row whose id is divisible by `every`; measure ip or l2 (score: -distance^2)."""
    assert measure in ("ip", "l2")
    base = scratch.write(clean(rows, nonzero=True))
    return ranked(by_length(base, lambda own: _nearest(own, scratch, k, every, measure, shard_rows, rerank)), k)


def _nearest(base: DataFrame, scratch: Scratch, k: int, every: int, measure: str, shard_rows: int, rerank: int) -> DataFrame:
    """query_id, vec_id, score of the k best of each shard, of vectors of one length."""
    own = scratch.write(distinct(base, k))
    n, n_rows = own.count(), base.count()
    sample = own.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return scratch.spark.createDataFrame([], "query_id long, vec_id long, score double")
    books = fit(directions(np.array([r.v for r in sample]))[0])
    shards, blocks = -(-n // shard_rows), -(-n_rows // (every * BLOCK_ROWS))
    index = scratch.write(
        _shards(own, shards).mapInPandas(_index(books), DISTINCT + ", codes binary, norms binary, errors binary")
    )
    queries = packed(base.filter(F.col("vec_id") % every == 0), blocks)

    def search(row) -> pd.DataFrame:
        ids, x = unpack(row.ids, row.vectors, row.dim)
        q_ids, q = unpack(row.q_ids, row.q_vectors, row.dim)
        codes = np.frombuffer(row.codes, np.uint8).reshape(len(ids), -1)
        members, counts = np.frombuffer(row.members, "<i8"), np.frombuffer(row.counts, "<i4").astype(np.int64)
        start = np.cumsum(counts) - counts
        errors, norms = np.frombuffer(row.errors, "<f8"), np.frombuffer(row.norms, "<f8")
        unit, length = directions(q)
        # cosines, with what single precision of the tables may take from them
        cosine = books.lookup(unit, codes).astype(float)
        upper = np.minimum(cosine + errors + 1e-4, 1)
        with np.errstate(over="ignore", invalid="ignore"):
            if measure == "ip":
                rough, most = cosine * norms, upper * norms * length[:, None]
            else:
                # -|q - x|^2 = -(|q| - |x|)^2 - 2 |q| |x| (1 - cos)
                apart = np.square(length[:, None] - norms)
                twice = 2 * length[:, None] * norms
                rough, most = -apart - twice * (1 - cosine), -apart - twice * (1 - upper)
                rough, most = np.nan_to_num(rough, nan=-np.inf), np.nan_to_num(most, nan=np.inf)
        most = most + 1e-9 * np.abs(most)
        # one more than k, since the query's own vector may have no other member
        depth = min(max(rerank, k + 1), len(ids))
        best = np.argpartition(-rough, depth - 1, axis=1)[:, :depth]
        out = []
        for i in range(len(q_ids)):
            of = best[i]
            s = _exact(x, q[i], of, measure)
            if depth < len(ids):
                cut = np.partition(s, depth - k - 1)[depth - k - 1]
                more = most[i] >= cut
                more[of] = False
                more = np.flatnonzero(more)
                of, s = np.r_[of, more], np.r_[s, _exact(x, q[i], more, measure)]
            if len(of) > k + 1:
                # what may tie with the k + 1 best vectors, with their members
                least = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                fine = s >= least - 1e-9 * (np.abs(least) + length[i] * norms[of])
                of, s = of[fine], s[fine]
            s = _final(x[of], q[i], measure)
            at = np.repeat(start[of] - (np.cumsum(counts[of]) - counts[of]), counts[of]) + np.arange(counts[of].sum())
            v, s = members[at], np.repeat(s, counts[of])
            v, s = v[v != q_ids[i]], s[v != q_ids[i]]
            first = np.lexsort((v, -s))[:k]
            out.append((np.full(len(first), q_ids[i]), v[first], s[first]))
        a, b, c = (np.concatenate(z) for z in zip(*out, strict=True))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    return searched(meet(index, queries, shards), search, "double")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), Scratch(spark, "op6"))


#: Brute force: the answers are those of an exact search.
OP6_SQL = """
WITH g AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score FROM g q JOIN g c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
