"""Exact top-k search with M-trees.

Maximum inner product becomes nearest neighbour in a metric space by one more coordinate,
sqrt(M - |x|^2) with M the largest squared norm of the shard (0 for a query): then
|q - x|^2 = |q|^2 + M - 2 q.x. Each shard holds an M-tree of paged nodes: a node has a routing object,
a covering radius and its distance to the parent's routing object; leaf pages keep each member's
distance to the leaf's routing object. Best-first search takes nodes in the order of their lower
bounds. |d(q, parent) - d(node, parent)| - radius rules out nodes, and the same bound rules out
leaf members, before any distance to them is computed.

All component values are integers (floor(256 x)), so scores are exact; bounds carry a slack far
above the rounding of square roots. The trees are built once, one a shard, and written; searches read them.

Vectors with a component of 2**20 or more after scaling could leave the range in which doubles hold the sums of
their products: a shard keeps these aside of its tree and compares them as whole numbers of any size, as it
does for queries of that kind.

Defined cases: see vectors.clean; fewer than k candidates give all; ties go to the smaller
vec_id; an empty table gives an empty result; extra columns are ignored; a score beyond the range of long is
ranked by its true value and given as the nearest long.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, lean, n_parts, table
from .vectors import by_length, clean, packed, unpack

K, EVERY = 5, 50
SHARD_ROWS, BLOCK_ROWS, PAGE, FANOUT_SPLITS = 16384, 512, 256, 3
SLACK = 1e-6
#: Bytes of a row that holds part of a tree; blocks of queries that meet all shards at once.
PIECE, ROUND = 1 << 20, 32
#: Components below it have products whose sums doubles hold exactly, for up to 2**12 components.
HUGE, DIMENSIONS = 1 << 20, 1 << 12


class MTree:
    """An M-tree over integer vectors, bulk-loaded by halving along two far objects."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = PAGE):
        self.ids, self.x, self.page = ids, x, page
        norms = np.einsum("ij,ij->i", x, x)
        self.top = float(norms.max()) if len(x) else 0.0
        self.aug = np.sqrt(np.maximum(self.top - norms, 0.0))
        self.norms = norms
        # per node: routing object, covering radius, distance to parent, children or members
        self.routing: list[int] = []
        self.radius: list[float] = []
        self.to_parent: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray | None] = []
        self.member_dist: list[np.ndarray | None] = []
        self.root = self._build(np.arange(len(x)), None) if len(x) else -1
        # leaf pages hold their members one after another
        order = np.concatenate([m for m in self.members if m is not None]) if len(x) else np.arange(0)
        self.pages: list[np.ndarray | None] = [None if m is None else self.x[m] for m in self.members]
        self.page_ids: list[np.ndarray | None] = [None if m is None else ids[m] for m in self.members]
        assert len(order) == len(x)
        self.r_arr, self.p_arr = np.array(self.radius), np.array(self.to_parent)
        self.o_arr = np.array(self.routing, np.int64)
        self.visited = self.computed = 0

    def __getstate__(self) -> dict:
        """Pages are slices of x, whose values are whole numbers below HUGE."""
        return {**self.__dict__, "x": self.x.astype(np.int32), "pages": None, "page_ids": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.x = self.x.astype(float)
        self.pages = [None if m is None else self.x[m] for m in self.members]
        self.page_ids = [None if m is None else self.ids[m] for m in self.members]

    def _dist(self, i: int, of: np.ndarray) -> np.ndarray:
        d2 = self.top * 2 - 2 * (self.x[of] @ self.x[i] + self.aug[of] * self.aug[i])
        return np.sqrt(np.maximum(d2, 0.0))

    def _halves(self, of: np.ndarray, splits: int) -> list[np.ndarray]:
        if splits == 0 or len(of) <= self.page:
            return [of]
        a = of[int(np.argmax(self._dist(int(of[0]), of)))]
        da = self._dist(int(a), of)
        b = of[int(np.argmax(da))]
        order = np.argsort(da - self._dist(int(b), of), kind="stable")
        half = len(of) // 2
        return self._halves(of[order[:half]], splits - 1) + self._halves(of[order[half:]], splits - 1)

    def _build(self, of: np.ndarray, parent: int | None) -> int:
        centre = self.x[of].mean(0)
        r = int(of[int(np.argmax(self.x[of] @ centre + self.aug[of] * self.aug[of].mean()))])
        d = self._dist(r, of)
        node = len(self.routing)
        self.routing.append(r)
        self.radius.append(float(d.max()) + SLACK)
        self.to_parent.append(0.0 if parent is None else float(self._dist(parent, np.array([r]))[0]))
        self.children.append(None)
        self.members.append(None)
        self.member_dist.append(None)
        if len(of) <= self.page:
            self.members[node], self.member_dist[node] = of, d
        else:
            self.children[node] = np.array([self._build(part, r) for part in self._halves(of, FANOUT_SPLITS)])
        return node

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, vec_id), best first, without the query's own id."""
        if self.root < 0:
            return []
        qq = float(q @ q)
        far = lambda s: np.sqrt(np.maximum(qq + self.top - 2 * s, 0.0))
        best: list[tuple[int, int]] = []  # a heap of (score, -vec_id)
        limit = float("inf")
        d_root = float(far(float(self.x[self.routing[self.root]] @ q)))
        queue = [(0.0, self.root, d_root)]
        while queue:
            low, node, dq = heapq.heappop(queue)
            if low > limit:
                break
            self.visited += 1
            kids = self.children[node]
            if kids is not None:
                kids = kids[np.abs(dq - self.p_arr[kids]) - self.r_arr[kids] <= limit + SLACK]
                d = far(self.x[self.o_arr[kids]] @ q)
                self.computed += len(kids)
                for c, dc in zip(kids.tolist(), d.tolist(), strict=True):
                    bound = max(low, dc - self.radius[c] - SLACK)
                    if bound <= limit:
                        heapq.heappush(queue, (bound, c, dc))
                continue
            page, page_ids, d = self.pages[node], self.page_ids[node], self.member_dist[node]
            if limit < float("inf"):
                near = np.flatnonzero(np.abs(dq - d) <= limit + SLACK)
                if not len(near):
                    continue
                if 2 * len(near) < len(d):  # copying the few pays
                    page, page_ids = page[near], page_ids[near]
            self.computed += len(page)
            s = page @ q
            take = np.argsort(-s, kind="stable")[: k + 1] if len(best) < k else np.flatnonzero(s >= best[0][0])
            if len(best) < k and len(take) > k:  # ties at the edge count too
                take = np.flatnonzero(s >= s[take[-1]])
            for i in take.tolist():
                found = (int(s[i]), -int(page_ids[i]))
                if found[1] == -query_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                limit = float(far(best[0][0])) + SLACK
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def scaled(x: float) -> int:
    """floor(256 x), exact for every finite double."""
    return math.floor(x) * 256 + math.floor((x - math.floor(x)) * 256)


class Shard:
    """An M-tree of the usual vectors, and the huge ones as Python integers."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        huge = self.huge(x)
        self.tree = MTree(ids[~huge], np.floor(x[~huge] * 256))
        self.rest = [(int(i), [scaled(v) for v in row]) for i, row in zip(ids[huge], x[huge].tolist(), strict=True)]

    @staticmethod
    def huge(x: np.ndarray) -> np.ndarray:
        return (np.abs(x) >= HUGE / 256).any(axis=1) | (x.shape[1] > DIMENSIONS)

    def search(self, query_id: int, x: np.ndarray, k: int) -> list[tuple[int, int]]:
        if not self.huge(x[None])[0]:
            found = self.tree.search(query_id, np.floor(x * 256), k)
            others = self.rest
        else:
            found = []
            usual = self.tree.x.astype(np.int64).tolist() if len(self.tree.ids) else []
            others = [*zip(self.tree.ids.tolist(), usual, strict=True), *self.rest]
        if others:
            q = [scaled(v) for v in x.tolist()]
            found = found + [(sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in others if i != query_id]
        return heapq.nsmallest(k, found, key=lambda z: (-z[0], z[1]))


def _trees(own: DataFrame, shards: int) -> DataFrame:
    """The tree of each shard, in rows of PIECE bytes at most, in the order of part."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = np.stack(pdf["v"].to_numpy()).astype("f8")
        made = pickle.dumps(Shard(pdf["vec_id"].to_numpy().astype("<i8"), x), protocol=5)
        cuts = [made[at : at + PIECE] for at in range(0, len(made), PIECE)]
        return pd.DataFrame({"shard": pdf["shard"].iloc[0], "part": range(len(cuts)), "tree": cuts})

    dealt = own.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, "shard int, part int, tree binary")


FOUND = "query_id long, vec_id long, score long, size string"


def _size(score: int) -> str:
    """Orders scores that are the same as longs: by sign, number of digits, and digits (of negative ones their complements)."""
    if -(1 << 63) <= score < 1 << 63:
        return "1"
    digits = str(abs(score))
    text = f"{len(digits):04d}{digits}"
    return "2" + text if score > 0 else "0" + text.translate(str.maketrans("0123456789", "9876543210"))


def top_k(rows: DataFrame, scratch: Scratch, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k highest integer inner products of each row whose id is divisible by `every`, against all rows of its length."""
    base = scratch.write(clean(rows, nonzero=False))

    def one_length(own: DataFrame) -> DataFrame:
        n = own.count()
        shards, blocks = -(-n // shard_rows) or 1, -(-n // (every * BLOCK_ROWS)) or 1
        trees = scratch.write(_trees(own, shards))
        queries = scratch.write(packed(own.filter(F.col("vec_id") % every == 0), blocks).withColumnRenamed("shard", "block"))
        found = [
            scratch.write(_best(_met(trees, queries.filter(F.floor(F.col("block") / ROUND) == r), shards, k), k))
            for r in range(-(-blocks // ROUND))
        ]
        scratch.drop(trees, queries)
        return reduce(DataFrame.unionByName, found)

    return by_length(base, one_length)


def _met(trees: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """The k best of each query in each shard; a task reads a shard's tree once, then the blocks of queries dealt to it."""
    parts = n_parts(trees.sparkSession)
    salts = min(max(1, parts // shards), ROUND)
    nothing = F.lit(None).cast("binary")
    index = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "part", nothing.alias("ids"), F.col("tree").alias("x"), F.lit(0).alias("dim"))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        (F.col("block") % salts).alias("salt"),
        F.lit(1).alias("kind"),
        F.col("block").alias("part"),
        "ids",
        F.col("vectors").alias("x"),
        "dim",
    )
    rows = index.unionByName(asked).repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "kind", "part")
    return rows.mapInArrow(partial(_search, k=k), FOUND)


@lean
def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    at, pieces, tree = -1, [], None
    for batch in batches:
        for shard, kind, part, ids, x, dim in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "part", "ids", "x", "dim")), strict=True):
            if kind == 0:
                if part == 0:
                    at, pieces, tree = shard, [], None
                pieces.append(x)
                continue
            if at != shard:  # a shard without vectors
                continue
            if tree is None:
                tree, pieces = pickle.loads(b"".join(pieces)), []
            q_ids, q = unpack(ids, x, dim)
            found = [(int(i), v, s) for i, y in zip(q_ids, q, strict=True) for s, v in tree.search(int(i), y, k)]
            limit = [min(max(s, -(1 << 63)), (1 << 63) - 1) for _, _, s in found]
            columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array(limit, pa.int64()), pa.array([_size(f[2]) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "size"])


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("size"), "vec_id")
    ranks = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), Scratch(spark, "op2"))


OP2_SQL = """
WITH g AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM g q JOIN g c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
