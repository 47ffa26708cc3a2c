"""Near-duplicate detection: MinHash bands for candidates, odd sketches to check them, exact links.

1. Each whole text becomes its set of distinct word shingles (64-bit hashes; of
   4 words unless `width` says otherwise), 128 MinHash samples in
   32 bands of 4, and an odd sketch: the samples, each with its number, are folded into 512 parity
   bits. The XOR of two sketches is the sketch of the samples that differ, and its population count
   estimates how many do. A pair at similarity 0.8 shares no band with probability 5e-8.
2. Documents with the same set collapse to one node (smallest doc_id), so copies cost nothing more.
3. In each bucket every node is paired with the bucket's smallest node (a star, never all pairs).
   Pairs whose sketches agree well enough are verified on full sets: 100 * |A & B| >= 80 * |A | B|.
4. Verified links give components. Only buckets that still hold several components are searched
   further, in blocks of a bounded number of nodes. First each node's closest sketch in another
   component is verified, found in blocks of WIDE nodes with their sketches alone, which also rule out every
   node that agrees with none of another component. What remains is settled inside blocks of BLOCK nodes with full sets: every
   pair of different components whose sketches agree is compared, and one link a pair of components leaves
   the block. Links inside a component could not change it, and no link between components is left out;
   no pairs of a group are ever written out.

Sets are compared by 64-bit shingle hashes. The sketch bound lies five standard deviations of the
sample estimate and four of the parity count below the threshold.

Defined cases: null, empty and white-space texts have an empty set (n_shingles 0) and are linked
with nothing; fewer words than a shingle's make one shingle of all; equal texts are linked; rows that
share a doc_id are one node that links where any of its texts does. Rows with a null doc_id are documents of their
own, equal texts the same one; they come back with a null doc_id and the smallest doc_id that they reach, or, if they
reach none, a null component_id, and are kept where they stand for such a group (ids are taken to be below 2**62, where
the numbers that stand in for null begin). An empty table gives an empty result; extra columns, whatever their names,
are ignored by `near_duplicates` and kept by `deduplicate`. That covers every row: different texts of one doc_id are
different documents, rows equal in id and text (null ids too) count once, and documents without an id give way to
those with one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, Scratch, lean, table, text_chunks
from .components import components
from .curriculum import row_hash

SHINGLE, BANDS, ROWS, BITS = 4, 32, 4, 512
NUM, DEN = 80, 100
BLOCK, WIDE = 512, 4096
_RNG = np.random.default_rng(20240229)
_SAMPLES = BANDS * ROWS
_MUL = (_RNG.integers(0, 1 << 31, _SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _RNG.integers(0, 1 << 32, _SAMPLES, dtype=np.uint32)[:, None]
_ODD = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch_bound(threshold: float = NUM / DEN) -> int:
    """The most differing bits of a pair that may still reach the threshold."""
    low = threshold - 5 * math.sqrt(threshold * (1 - threshold) / _SAMPLES)
    bits = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * _SAMPLES * (1 - low)))
    return math.ceil(bits + 4 * math.sqrt(bits / 2))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(width, len(words))):
        out += mix(h[j : j + n] + _ODD[j]) * _ODD[j + 8]
    return np.unique(mix(out + np.uint64(min(width, len(words)))))


def signature(sets: np.ndarray) -> np.ndarray:
    """The least of each sample's hashes over the set.

    Each sample has a multiplier and an offset of its own, then mixes all bits into the top ones: linear hashes
    alone have minima that depend on each other, so that samples would agree or differ together.
    """
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.full(_SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        h = _MUL * x[at : at + 1024]
        h += _ADD
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        np.minimum(out, h.min(axis=1), out=out)
    return out


def fold(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (64 bits each) and odd sketches (8 words each) of many signatures."""
    s = sig.astype(np.uint64)
    by = s.reshape(len(s), BANDS, ROWS)
    keys = mix((by * _ODD[16 : 16 + ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[32])
    bit = (mix(s * _ODD[33] + np.arange(_SAMPLES, dtype=np.uint64) * _ODD[34]) >> np.uint64(40)) % np.uint64(BITS)
    parity = np.zeros((len(s), BITS), np.uint8)
    np.bitwise_xor.at(parity, (np.arange(len(s))[:, None], bit.astype(np.int64)), 1)
    words = np.packbits(parity, axis=1, bitorder="little").view("<u8")
    return keys.view(np.int64), words.view(np.int64)


#: From here on numbers stand in for null ids: after all ids.
NO_ID = 1 << 62
SKETCHED = "doc_id long, given boolean, n_shingles long, hi long, lo long, sketch array<long>, bands array<long>"


def _lists(x: np.ndarray) -> pa.ListArray:
    n, w = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * w + 1, w, dtype=np.int32)), pa.array(x.ravel()))


@lean
def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        sizes, marks, sigs = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingles(text, width)
            sizes.append(len(s))
            marks.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8"))
            sigs.append(signature(s))
        keys, words = fold(np.stack(sigs))
        mark = np.stack(marks)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("given"),
                pa.array(sizes, pa.int64()),
                pa.array(mark[:, 0]),
                pa.array(mark[:, 1]),
                _lists(words),
                _lists(keys),
            ],
            names=["doc_id", "given", "n_shingles", "hi", "lo", "sketch", "bands"],
        )


def linked(a: np.ndarray, b: np.ndarray, num: int = NUM, den: int = DEN) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


@lean
def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int, width: int) -> Iterator[pa.RecordBatch]:
    last_id, last = None, None
    for batch in batches:
        ids = [batch.column(c).to_pylist() for c in ("a", "b")]
        at, bt = batch.column("text_a"), batch.column("text_b")
        keep = []
        for i in range(batch.num_rows):
            text_b = bt[i].as_py()
            if (ids[1][i], text_b) != last_id:
                last_id, last = (ids[1][i], text_b), shingles(text_b, width)
            keep.append(linked(shingles(at[i].as_py(), width), last, num, den))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep)], names=["a", "b", "ok"])


def _by_cell(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of one cell after another; rows come sorted by cell."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        edge = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1), True])
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            now = tuple(cell[lo].tolist())
            if now != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width)


def _candidates(cell: pa.Table, bound: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, and differing bits, of the pairs of a cell that belong to different components and whose sketches agree."""
    node, comp, lead, side = (cell.column(c).to_numpy() for c in ("node", "component", "leader", "side"))
    sketch = _matrix(cell.column("sketch"), BITS // 64)
    left = np.flatnonzero(side == 0)
    alike = cell.column("ci")[0].as_py() == cell.column("cj")[0].as_py()
    right = left if alike else np.flatnonzero(side == 1)
    # pairs with the bucket's leader have been compared; inside one block each pair counts once
    left, right = left[lead[left] != node[left]], right[lead[right] != node[right]]
    for at in range(0, len(left), 128):
        some = left[at : at + 128]
        differ = comp[some][:, None] != comp[right][None, :]
        if alike:
            differ &= node[some][:, None] < node[right][None, :]
        if not differ.any():
            continue
        bits = np.zeros(differ.shape, np.uint16)
        for w in range(sketch.shape[1]):
            bits += np.bitwise_count(sketch[some, w][:, None] ^ sketch[right, w][None, :])
        i, j = np.nonzero(differ & (bits <= bound))
        if len(i):
            yield some[i], right[j], bits[i, j]


@lean
def _probe(batches: Iterator[pa.RecordBatch], bound: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a cell that agree with a node of another component; of those on the left side the closest such node."""
    for cell in _by_cell(batches, ("bh", "ci", "cj")):
        node = cell.column("node").to_numpy()
        found, near = np.zeros(cell.num_rows, bool), np.full(cell.num_rows, -1)
        for i, j, bits in _candidates(cell, bound):
            found[i] = found[j] = True
            order = np.lexsort((node[j], bits, i))
            first = order[np.r_[True, i[order][1:] != i[order][:-1]]]
            near[i[first]] = j[first]
        if found.any():
            at = np.flatnonzero(found)
            other = pa.array(node[near[at]], mask=near[at] < 0)
            yield pa.RecordBatch.from_arrays([cell.column("bh").take(pa.array(at)).combine_chunks(), pa.array(node[at]), other], names=["bh", "node", "other"])


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of many pairs among few sets."""
    rows = np.unique(np.r_[i, j])
    size = sum(len(sets[r]) for r in rows.tolist())
    if len(i) * (size / max(1, len(rows)) * 2e-8 + 2e-5) < size * len(rows) * 2e-10 + 1e-3:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist(), strict=True)])
    at = np.full(len(sets), -1)
    at[rows] = np.arange(len(rows))
    _, column = np.unique(np.concatenate([sets[r] for r in rows.tolist()]), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows.tolist()])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(rows), len(rows)), np.float32)
    width = 4096
    for c in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, [c, c + width])
        m = np.zeros((len(rows), width), np.float32)
        m[row[lo:hi], column[lo:hi] - c] = 1
        total += m @ m.T
    return total[at[i], at[j]].astype(np.int64)


@lean
def _links(batches: Iterator[pa.RecordBatch], bound: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """One link for each two components of a cell that have any; sets are compared in full."""
    for cell in _by_cell(batches, ("bh", "ci", "cj")):
        found = list(_candidates(cell, bound))
        if not found:
            continue
        i, j = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
        # a pair is compared in the first band that it shares
        bands, comp, node = _matrix(cell.column("bands"), BANDS), cell.column("component").to_numpy(), cell.column("node").to_numpy()
        here = cell.column("bh")[0].as_py()
        same = np.concatenate([bands[i[k : k + 65536]] == bands[j[k : k + 65536]] for k in range(0, len(i), 65536)])
        fine = bands[i, same.argmax(axis=1)] == here
        i, j = i[fine], j[fine]
        if not len(i):
            continue
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in cell.column("items")]
        n = np.array([len(x) for x in sets])
        both = _shared(sets, i, j)
        ok = den * both >= num * (n[i] + n[j] - both)
        if ok.any():
            a, b = node[i[ok]], node[j[ok]]
            ends = np.sort(np.stack([comp[i[ok]], comp[j[ok]]], axis=1), axis=1)
            _, one = np.unique(ends, axis=0, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(a[one]), pa.array(b[one])], names=["a", "b"])


@lean
def _items(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        sets = [shingles(t, width).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "items"])


def _agree(bound: int):
    bits = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return bits <= bound


class _Search:
    def __init__(self, docs: DataFrame, scratch: Scratch, num: int, den: int, width: int):
        self.scratch, self.num, self.den, self.width = scratch, num, den, width
        self.bound = sketch_bound(num / den)
        id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
        stand_in = F.lit(NO_ID) + F.pmod(F.xxhash64(text, F.lit("none")), F.lit(1 << 61))
        self.texts = docs.select(F.coalesce(id_, stand_in).alias("doc_id"), id_.isNotNull().alias("given"), text.alias("text"))
        self.rows = scratch.write(self.texts.mapInArrow(partial(_sketch, width=width), SKETCHED))
        full = self.rows.filter("n_shingles > 0")
        self.nodes = scratch.write(
            full.groupBy("hi", "lo").agg(
                F.min("doc_id").alias("node"),
                F.first("sketch").alias("sketch"),  # the same in all rows of a set
                F.first("bands").alias("bands"),
            )
        )
        self.edges = []
        self.checked: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> bool:
        """Checks pairs (a, b) on full sets; keeps the links, remembers what was checked, says if it found links."""
        # plain equi-joins, whose hot leaders Spark can split
        both = (
            pairs.join(self.texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(self.texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b")
        )
        done = self.scratch.write(both.mapInArrow(partial(_verify, num=self.num, den=self.den, width=self.width), "a long, b long, ok boolean"))
        links = done.filter("ok").select("a", "b")
        found = not links.isEmpty()
        if found or not self.edges:
            self.edges.append(links)
        seen = done.select("a", "b")
        self.checked = seen if self.checked is None else self.checked.unionByName(seen)
        return found

    def labels(self) -> DataFrame:
        """The components of all links; those found before stand for the links that made them."""
        out = components(reduce(DataFrame.unionByName, self.edges), self.scratch)
        self.edges = [out.select(F.col("node").alias("a"), F.col("component").alias("b"))]
        return out

    def run(self) -> DataFrame:
        """node, component of every node that has a link."""
        sketch = self.nodes.select("node", "sketch")
        bands = self.nodes.select("node", F.explode("bands").alias("bh"))
        # written, so that the join below is a plain one, whose hot buckets Spark can split
        shared = self.scratch.write(bands.groupBy("bh").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1"))
        rows = self.scratch.write(bands.join(shared, "bh").select("bh", "node", "leader", "n"))
        self.scratch.drop(shared)
        star = rows.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
        pairs = (
            star.join(sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
            .join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b")
            .filter(_agree(self.bound))
            .select("a", "b")
            .distinct()
        )
        self.verify(pairs)
        label = self.labels()
        rows = rows.filter("n > 2")
        wide = self.cells(rows, label, WIDE).join(sketch, "node")
        probed = self.scratch.write(self.spread(wide).mapInArrow(partial(_probe, bound=self.bound), "bh long, node long, other long"))
        pair = probed.filter("other IS NOT NULL").select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))
        if self.verify(pair.distinct().join(self.checked, ["a", "b"], "left_anti")):
            label = self.labels()
        cells = self.cells(rows.join(probed.select("bh", "node"), ["bh", "node"], "left_semi"), label, BLOCK)
        text = self.texts.select(F.col("doc_id").alias("node"), "text").join(
            cells.select("node").distinct(), "node", "left_semi"
        )
        # a node's texts differ only where rows share a doc_id; each brings its own set
        items = text.mapInArrow(partial(_items, width=self.width), "node long, items binary")
        full = cells.join(self.nodes.select("node", "sketch", "bands"), "node").join(self.scratch.write(items), "node")
        links = self.scratch.write(
            self.spread(full).mapInArrow(partial(_links, bound=self.bound, num=self.num, den=self.den), "a long, b long")
        )
        if not links.isEmpty():
            self.edges.append(links)
            label = self.labels()
        return label

    def cells(self, rows: DataFrame, label: DataFrame, size: int) -> DataFrame:
        """Buckets with several components as cells of two blocks: bh, ci, cj, side, node, component, leader.

        The nodes of the leader's component (blocks 0, 1, ...) meet only the others' blocks (-1, -2, ...),
        which also meet each other. A block holds about `size` nodes.
        """
        named = rows.select("bh", "node", "leader").join(label, "node", "left")
        named = self.scratch.write(named.withColumn("component", F.coalesce("component", "node")))
        split = self.scratch.write(
            named.groupBy("bh", "component").agg(F.count("*").alias("n"))
            .groupBy("bh").agg(F.min("component").alias("major"), F.min_by("n", "component").alias("n_major"), F.sum("n").alias("n"))
            .filter("n > n_major")
        )
        some = named.join(split, "bh").withColumn("minor", F.col("component") != F.col("major"))
        majors = F.ceil(F.col("n_major") / size).cast("long")
        minors = F.ceil((F.col("n") - F.col("n_major")) / size).cast("long")
        block = F.when(F.col("minor"), -1 - F.pmod(F.xxhash64("node"), minors)).otherwise(F.pmod(F.xxhash64("node"), majors))
        others = F.when(F.col("minor"), F.sequence(-minors, majors - 1)).otherwise(F.sequence(-minors, F.lit(-1).cast("long")))
        some = some.withColumn("block", block).withColumn("other", F.explode(others))
        ci, cj = F.least("block", "other"), F.greatest("block", "other")
        return self.scratch.write(
            some.select(
                "bh", ci.alias("ci"), cj.alias("cj"),
                F.when(F.col("block") == ci, 0).otherwise(1).alias("side"),
                "node", "component", "leader",
            )
        )

    @staticmethod
    def spread(cells: DataFrame) -> DataFrame:
        return cells.repartition("bh", "ci", "cj").sortWithinPartitions("bh", "ci", "cj")


def near_duplicates(docs: DataFrame, scratch: Scratch, num: int = NUM, den: int = DEN, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; linked where den * |A & B| >= num * |A | B|."""
    search = _Search(docs, scratch, num, den, width)
    label = search.run()
    classes = search.nodes.select("hi", "lo", "node")
    member = search.rows.filter("n_shingles > 0").join(classes, ["hi", "lo"]).select("doc_id", "given", "n_shingles", "node")
    member = member.join(label, "node", "left").select(
        "doc_id", "given", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    alone = search.rows.filter("n_shingles = 0").select("doc_id", "given", "n_shingles", F.col("doc_id").alias("component_id"))
    out = member.unionByName(alone)
    return out.select(
        F.when(F.col("given"), F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.when((F.col("component_id") < NO_ID) | (F.col("given") & (F.col("doc_id") == F.col("component_id"))), F.col("component_id")).alias("component_id"),
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id,
         unnest(CASE WHEN coalesce(len(words), 0) = 0 THEN []
                     WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                     ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), link AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark, "op1"))


def deduplicate(docs: DataFrame, scratch: Scratch, width: int = SHINGLE) -> DataFrame:
    """One row of each group, with its columns.

    A key of its own stands for each doc_id and text: the doc_id for the text with the smallest hash, a number
    from 2**62 up, made of both, for its other texts and for null ids.
    """
    text, id_ = F.col("text").cast("string"), F.col("doc_id").cast("long")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        row_hash(docs).alias("order"), id_.alias("id"), text.alias("text"), F.xxhash64(text).alias("mark"),
    )
    # ids with several texts are written, so that Spark knows how few they are
    several = rows.filter("id IS NOT NULL").groupBy("id").agg(F.min("mark").alias("first"), F.max("mark").alias("last"))
    several = scratch.write(several.filter("first <> last").select("id", "first"))
    stand_in = F.lit(NO_ID) + F.pmod(F.xxhash64("id", "mark"), F.lit(1 << 61))
    own = F.col("id").isNotNull() & (F.col("first").isNull() | (F.col("first") == F.col("mark")))
    keyed = rows.join(several, "id", "left").withColumn("key", F.when(own, F.col("id")).otherwise(stand_in))
    kept = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text"), scratch, width=width).filter("kept")
    keyed = keyed.select("key", "order", "row").join(scratch.write(kept.select(F.col("doc_id").alias("key")).distinct()), "key", "left_semi")
    # texts move once, by their keys
    one = Window.partitionBy("key").orderBy("order")
    return keyed.withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
