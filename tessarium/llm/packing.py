"""Best-fit packing by a grouping genetic algorithm on islands.

`pieces` cuts the token ids of each document into pieces of at most `capacity`; `pack` deals the
pieces to shards of some thousand pieces (their hash, with a running number, so that a repeated
doc_id spreads) and lets islands evolve packings of each shard. A packing is a list of bins. A child
takes well-filled whole bins from one parent, removes the other parent's bins that hold any of the
same pieces, exchanges pieces of the remaining bins for longer displaced ones that fill them better, and puts the
rest back by best fit. After each epoch the best packings migrate to the next island of the shard (a ring); the
best of all islands is the result. Islands differ in how much they shake their first packings and how much they
inject. They are Spark tasks, so a lost executor costs one epoch of its islands. An island rests once a packing
reaches the lower bound of Martello and Toth, since none can be better.

Defined cases: null and empty texts count as the single end id; a null doc_id is a document of its own; a piece of
exactly `capacity` fills a sequence alone; repeated rows are packed one by one; an empty table gives an empty result;
extra columns are ignored. Ties in fitness go to the smaller island.
"""

from __future__ import annotations

import json
import random
from bisect import bisect_right, insort
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEPT, Scratch, lean, table, text_chunks

CAPACITY = 2048
#: Sizes of the algorithm; results are complete whatever they are.
SHARD_PIECES, ISLANDS, POPULATION, CHILDREN, EPOCHS, SEED = 6000, 3, 8, 30, 3, 11
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
#: Words whose ids a worker keeps at most, between two chunks of texts.
WORDS_KEPT = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable Latin-1 as itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordIds(dict):
    """Token ids of words, as little-endian 32-bit bytes; encodes a word when it is first asked for.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its
    words split at ASCII white space. A word of plain Latin letters, marks and digits takes a short
    way: lower case, the tokenizer's own split into runs, and its model on each run. Every other
    word (special tokens, other scripts, other spaces) goes through the whole tokenizer.
    """

    PLAIN = re.compile(r"[!-~\xa1-\u012f\u0131-\u017f]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.runs: dict[str, bytes] = {}
        self.letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            split = json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split)

    def _run(self, run: str) -> bytes:
        text = run if run.isascii() else "".join(map(self.letters.__getitem__, run.encode()))
        ids = self.runs[run] = array("I", [t.id for t in self.model.tokenize(text)]).tobytes()
        return ids

    def __missing__(self, key: bytes) -> bytes:
        word = key.decode()
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            word = word.lower()
            if word.isalpha():
                parts = (word,)
            elif word[:-1].isalpha() and word[-1] in ".,;:!?|":
                parts = (word[:-1], word[-1])
            else:
                parts = self.split.findall(word)
            runs = self.runs
            ids = b"".join([runs.get(p) or self._run(p) for p in parts])
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
            ids = np.asarray(found, dtype="<u4").tobytes()
        self[key] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").encode().split()))

    def trim(self) -> None:
        """Bounds the memory between two chunks of texts."""
        if len(self) > WORDS_KEPT:
            self.clear()
        if len(self.runs) > WORDS_KEPT // 4:
            self.runs.clear()


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


KEPT[__name__] = _word_ids.cache_clear


@lean
def _cut(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    enc, end, salt = _word_ids(path), struct.pack("<I", end_id), 0
    for batch in text_chunks(batches):
        out: list[tuple] = []
        doc_ids = batch.column("doc_id").to_pylist()
        enc.trim()
        for doc_id, text in zip(doc_ids, batch.column("text").to_pylist(), strict=True):
            ids = enc.encode(text) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                salt += 1
                out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), salt))
        cols = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "start", "length", "ids_crc32", "salt")
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=list(names))


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, salt: the cut token ids of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(
        partial(_cut, path=path or default_tokenizer(), capacity=capacity, end_id=end_id), PIECE_SCHEMA
    )


# ---- the genetic algorithm on one shard: lengths sorted in descending order, bins as tuples of places

Packing = tuple[list[tuple[int, ...]], list[int]]


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Martello and Toth's second bound: pieces above capacity - k, above a half, and the rest from k on, for every k."""
    n = np.sort(np.asarray(lengths, np.int64))
    total = np.r_[0, np.cumsum(n)]
    best = -(-int(total[-1]) // capacity)
    for k in np.unique(n[n <= capacity // 2]).tolist():
        a, b, c = np.searchsorted(n, [capacity - k, capacity / 2], "right").tolist() + [int(np.searchsorted(n, k))]
        b = min(b, a)
        large, middle = len(n) - a, a - b
        room = middle * capacity - int(total[a] - total[b])
        best = max(best, large + middle + max(0, -(-(int(total[b] - total[c]) - room) // capacity)))
    return max(best, int((n > capacity // 2).sum()))


def _best_fit(lengths: list[int], items: list[int], bins: list[tuple[int, ...]], free: list[int], capacity: int) -> Packing:
    """Puts items (longest first) each into the bin with the least room that suffices, else a new one."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, f in enumerate(free):
        by_free[f].append(b)
        mask |= 1 << f
    added: dict[int, list[int]] = {}
    for i in items:
        n = lengths[i]
        above = mask >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = by_free[room].pop()
            if not by_free[room]:
                mask &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append(())
            free.append(0)
        added.setdefault(b, []).append(i)
        free[b] = room - n
        if not by_free[room - n]:
            mask |= 1 << (room - n)
        by_free[room - n].append(b)
    for b, more in added.items():
        bins[b] = (*bins[b], *more)
    return bins, free


def _fitness(free: list[int], capacity: int) -> float:
    return sum(((capacity - f) / capacity) ** 2 for f in free) / max(1, len(free))


def _rank(solution: Packing, capacity: int) -> tuple:
    return len(solution[0]), -_fitness(solution[1], capacity)


def _exchange(lengths: list[int], loose: list[int], bins: list[tuple[int, ...]], free: list[int], rng: random.Random) -> list[int]:
    """Fills bins better by giving one or two of their pieces for one or two longer loose ones; what is loose then."""
    stock = sorted((lengths[i], i) for i in loose)
    for b in rng.sample(range(len(bins)), len(bins)):
        if not stock:
            break
        if not free[b]:
            continue
        inside = bins[b] if len(bins[b]) <= 12 else tuple(rng.sample(bins[b], 12))
        gives = [(lengths[i], (i,)) for i in inside]
        gives += [(lengths[i] + lengths[j], (i, j)) for k, i in enumerate(inside) for j in inside[k + 1 :]]
        best = None
        for n, out in gives:
            room = n + free[b]
            # the longest loose piece that fits, alone, or with the longest other one beside it
            k = bisect_right(stock, (room, 1 << 62)) - 1
            if k < 0:
                continue
            takes = [(stock[k][0], (k,))]
            for first in {k, k // 2, rng.randrange(k + 1)}:
                rest = bisect_right(stock, (room - stock[first][0], 1 << 62)) - 1
                rest -= rest == first
                if rest >= 0:
                    takes.append((stock[first][0] + stock[rest][0], (first, rest)))
            got, taken = max(takes)
            if got > n and (best is None or got - n > best[0]):
                best = (got - n, out, taken)
                if best[0] == free[b]:
                    break
        if best:
            gain, out, taken = best
            new = [stock[k][1] for k in taken]
            for k in sorted(taken, reverse=True):
                del stock[k]
            for i in out:
                insort(stock, (lengths[i], i))
            bins[b] = (*(i for i in bins[b] if i not in out), *new)
            free[b] -= gain
    return sorted(i for _, i in stock)


def _child(a: Packing, b: Packing, lengths: list[int], capacity: int, rng: random.Random, most: float) -> Packing:
    """Crossover: whole well-filled bins of b enter a."""
    order = sorted(range(len(b[0])), key=lambda k: b[1][k] + rng.random() * 40)
    injected = order[: max(1, int(len(order) * rng.uniform(0.05, most)))]
    inside = set()
    for k in injected:
        inside.update(b[0][k])
    # beside bins with a duplicate, the child gives up a few of the emptiest bins (mutation)
    worst = sorted(range(len(a[0])), key=lambda k: -a[1][k])[: 3 + len(a[0]) // 10]
    loose = set(rng.sample(worst, min(len(worst), 2 + len(a[0]) // 30)))
    bins, free, displaced = [b[0][k] for k in injected], [b[1][k] for k in injected], []
    for k, items in enumerate(a[0]):
        if k in loose or not inside.isdisjoint(items):
            displaced += [i for i in items if i not in inside]
        else:
            bins.append(items)
            free.append(a[1][k])
    displaced = _exchange(lengths, displaced, bins, free, rng)
    return _best_fit(lengths, displaced, bins, free, capacity)


def _first(lengths: list[int], capacity: int, rng: random.Random | None = None, shake: float = 0.0) -> Packing:
    order = list(range(len(lengths)))
    if shake:
        order.sort(key=lambda i: -lengths[i] * rng.uniform(1 - shake, 1 + shake))
    return _best_fit(lengths, order, [], [], capacity)


def _genome(solution: Packing, n: int) -> bytes:
    of = np.zeros(n, "<i4")
    for b, items in enumerate(solution[0]):
        of[list(items)] = b
    return of.tobytes()


def _solution(genome: bytes, lengths: list[int], capacity: int) -> Packing:
    bins: list[list[int]] = []
    for i, b in enumerate(np.frombuffer(genome, "<i4").tolist()):
        while len(bins) <= b:
            bins.append([])
        bins[b].append(i)
    return [tuple(x) for x in bins], [capacity - sum(lengths[i] for i in x) for x in bins]


def evolve(lengths: list[int], elites: list[bytes], seed: int, capacity: int, population: int, children: int, island: int = 0) -> tuple[bytes, int, float]:
    """One epoch of one island: the best genome, its bins and its fitness."""
    rng = random.Random(seed)
    pool = [_solution(g, lengths, capacity) for g in elites]
    pool.append(_first(lengths, capacity))
    least = lower_bound(lengths, capacity)
    rank = partial(_rank, capacity=capacity)
    if min(len(s[0]) for s in pool) > least:  # else no packing can be better
        while len(pool) < population:
            pool.append(_first(lengths, capacity, rng, 0.05 + 0.1 * (island % 3)))
    pool.sort(key=rank)
    for _ in range(children):
        if len(pool[0][0]) <= least:
            break
        # the best parents of two draws; children enter whole bins of either into the other, and the worst packings go
        x, y = (pool[min(rng.randrange(len(pool)), rng.randrange(len(pool)))] for _ in range(2))
        pool.append(_child(x, y, lengths, capacity, rng, 0.3 + 0.2 * (island % 2)))
        pool.sort(key=rank)
        del pool[population:]
    return _genome(pool[0], len(lengths)), len(pool[0][0]), _fitness(pool[0][1], capacity)


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "doc_id", "piece", "ids_crc32", "salt"], ascending=[False, *[True] * 4], kind="stable")


def _epoch(capacity: int, population: int, children: int, epoch: int) -> Callable:
    def step(key: tuple, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        n = np.sort(items["length"].to_numpy())[::-1]
        lengths = n[n < capacity].tolist()
        seed = SEED + 1009 * shard + 31 * island + epoch
        genome, bins, fit = evolve(lengths, elites["genome"].tolist(), seed, capacity, population, children, island)
        return pd.DataFrame({"shard": [shard], "island": [island], "genome": [genome], "bins": [bins], "fitness": [fit]})

    return step


ELITE_SCHEMA = "shard long, island int, genome binary, bins int, fitness double"
PACKED_SCHEMA = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, from_child boolean"
)


def _place(capacity: int) -> Callable:
    def place(key: tuple, items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        items = _sorted(items)
        n = items["length"].to_numpy()
        whole = int((n >= capacity).sum())
        of = np.arange(len(n), dtype=np.int64)
        of[whole:] = whole + np.frombuffer(best["genome"].iloc[0], "<i4")
        lengths = n[whole:].tolist()
        plain = set(map(frozenset, _first(lengths, capacity)[0]))
        born = np.zeros(len(n), bool)
        for bin_ in _solution(best["genome"].iloc[0], lengths, capacity)[0]:
            born[[whole + i for i in bin_]] = frozenset(bin_) not in plain
        order = np.argsort(of, kind="stable")
        before = np.cumsum(n[order]) - n[order]
        first = np.r_[True, of[order][1:] != of[order][:-1]]
        offset = np.empty(len(n), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        items["sequence_id"] = (int(key[0]) << 32) + of
        items["offset"] = offset
        items["from_child"] = born
        return items[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "from_child"]]

    return place


def pack(
    cut: DataFrame,
    scratch: Scratch,
    capacity: int = CAPACITY,
    islands: int = ISLANDS,
    population: int = POPULATION,
    children: int = CHILDREN,
    epochs: int = EPOCHS,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Adds sequence_id and offset to every piece of a written table of pieces.

    from_child says whether the piece's sequence is one that best-fit decreasing alone does not make.
    """
    shards = max(1, round(cut.count() / shard_pieces))
    items = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(shards)))
    elites = scratch.spark.createDataFrame([], ELITE_SCHEMA)
    narrow = items.select("shard", "length", F.explode(F.expr(f"sequence(0, {islands - 1})")).alias("island"))
    for epoch in range(epochs):
        # an island starts from its own best packing and from that of its left neighbour
        moved = elites.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), "genome")
        start = elites.select("shard", "island", "genome").unionByName(moved) if epoch else moved
        elites = scratch.write(
            narrow.groupBy("shard", "island")
            .cogroup(start.groupBy("shard", "island"))
            .applyInPandas(_epoch(capacity, population, children, epoch), ELITE_SCHEMA)
        )
    best = elites.groupBy("shard").agg(
        F.min_by("genome", F.struct("bins", -F.col("fitness"), "island")).alias("genome")
    )
    return (
        items.groupBy("shard")
        .cogroup(best.groupBy("shard"))
        .applyInPandas(_place(capacity), PACKED_SCHEMA)
    )


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op10")
    return pack(scratch.write(pieces(table(spark, sf_dir, "documents"))), scratch)
