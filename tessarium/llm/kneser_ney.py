"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model is trained on trusted text: documents labelled good (quality 1, toxic 0). N-grams are counted in
Spark over the whole texts of all of them outside fold 0. The counts stay in tables: trigrams with their counts;
bigrams with their continuation counts and, as contexts, their totals and numbers of words seen once, twice and
more often. Each table is dealt to shards of a bounded number of n-grams.

Documents meet the counts in a sharded join. Whole texts are encoded in chunks; a chunk asks each shard
once for its distinct n-grams (sorted, as differences), the shard's task merges them with its counts, and the
answers, integers, go back to the chunk, which turns them into exact probabilities. A filter of FILTER_BITS bits
an n-gram, MOST_BITS at most, keeps n-grams that no table holds from being asked for; it only rules out. Askers of one shard
are salted, so a frequent n-gram's shard is no single task. Only tables of one row a vocabulary word (fewer
than 1 << BITS), counts by frequency, the filter and the thresholds pass through the driver.

Words seen less than MIN_COUNT times are replaced by their shape (runs of capitals, small letters,
digits, and the marks between them), so that unknown words of usual form cost little and unusual forms
cost much. Three measures are judged, each against its language's QUANTILE over all trusted documents outside
the training folds; a document is rejected where any exceeds it:

1. The perplexity of the whole text. Short texts say little: its log10 may exceed that of the threshold
   by ALLOWANCE / sqrt(tokens), about one standard error of its mean.
2. The mean cost of the worst WINDOW tokens in a row, for texts that are longer.
3. The strongest evidence that a word is foreign to trusted text. Every word of the whole corpus is counted
   by its different words before (copies of a passage add none). A word with c of them that no
   trusted document of the training folds holds, these being a share s of all documents, had the chance
   (1 - s) ** c to be missed; its evidence is -log10 of that, and counts from FOREIGN up. So an insult does
   not pass as one more rare word of usual shape. Foreign words are a sharded table too, asked by chunks.

Words before are counted in a bitmap of SLOTS bits a word, which tells about 1,500 apart: evidence is a
lower bound beyond that. Quantiles are read from counts of measures rounded up to 1 / GRID, so no task holds them all.

Defined cases: null, empty and white-space texts have perplexity null and are kept (nothing
speaks against them); a null or unseen language uses the quantile over all languages; without
trusted rows the model is uniform and nothing is rejected; rows that share a doc_id are judged by
their own texts, and a trusted id makes all of them trusted; rows with a null doc_id are judged and never trusted;
labels that repeat a doc_id count once (any bad label makes it untrusted); extra columns, whatever their names, are
kept by `filter_documents`; repeated rows share their verdict.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property, partial, reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import KEPT, LOWER, Scratch, chunks, give_back, lean, n_parts, table

MIN_COUNT, FOLDS = 2, 5
QUANTILE, ALLOWANCE, GRID = 0.99, 1.5, 1000
WINDOW, FOREIGN, SLOTS = 16, 2.0, 256
#: N-grams (or foreign words) of a shard, bytes of text of a chunk, bits of the filter an n-gram and in all.
SHARD_GRAMS, CHUNK, FILTER_BITS, MOST_BITS = 1 << 19, 4 << 20, 16, 1 << 27
#: Turns in which texts are scored at most, and bytes of text that are worth one.
TURNS, TURN = 8, 16 << 20
#: Different shapes that a task counts before it hands them on.
HELD_WORDS = 250_000
#: Unknown words with the slot of a word before each that a task holds before it hands them on.
HELD_MARKS = 600_000
_MARKS = b"".join(bytes([i]) for i in range(33, 127) if not chr(i).isalnum())
START, END, UNKNOWN = 0, 1, 2
BITS = 20  # of a word's id, so that a trigram is one exact 60-bit key
LOW, PAIR = (1 << BITS) - 1, (1 << 2 * BITS) - 1
_SHAPE = (
    (re.compile(rb"[A-Z]{2,}"), b"\x01"),
    (re.compile(rb"[A-Z]"), b"\x02"),
    (re.compile(rb"[a-z\x80-\xff]+"), b"\x03"),
    (re.compile(rb"[0-9]+"), b"\x04"),
    (re.compile(rb"([^\x01-\x04])\1+"), rb"\1\1"),
)
#: One character for all that _SHAPE does not tell apart: a word has the shape of what this makes of it.
_KINDS = bytes(65 if 65 <= i <= 90 else 97 if 97 <= i <= 122 or i > 127 else 48 if 48 <= i <= 57 else i for i in range(256))


def shape(word: bytes) -> bytes:
    for pattern, to in _SHAPE:
        word = pattern.sub(to, word)
    return b"\x00" + word


def core(word: bytes) -> bytes:
    """A word of small letters without the marks round it."""
    return word.strip(_MARKS)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, byte plane by byte plane."""
    parts = [(a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays]
    raw = pickle.dumps(parts, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    parts = pickle.loads(raw)
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind) for kind, n, x in parts]


def distinct(x: np.ndarray, ordered: bool = False) -> np.ndarray:
    """Like np.unique, by sorting, which is faster on whole numbers."""
    if not ordered:
        x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]][: len(x)]]


def places(x: np.ndarray, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in their order, and the place of each value among them."""
    order = slice(None) if ordered else np.argsort(x)
    s = x[order]
    new = np.r_[True, s[1:] != s[:-1]][: len(s)]
    at = np.empty(len(x), np.int64)
    at[order] = np.cumsum(new) - 1
    return s[new], at


def differences(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=keys[:1] * 0)


# ---- the model: word tables held by every task, n-gram counts in shards


def discounts(counts: list[int]) -> np.ndarray:
    """0, D1, D2, D3+ from the numbers of n-grams with counts 1, 2, 3 and 4 (Chen and Goodman)."""
    if min(counts) == 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = counts[0] / (counts[0] + 2 * counts[1])
    d = [k - (k + 1) * y * counts[k] / counts[k - 1] for k in (1, 2, 3)]
    return np.r_[0.0, np.clip(np.array(d), [0.05, 0.1, 0.1], [0.95, 1.9, 2.9])]


def _left(d: np.ndarray, total: np.ndarray, ones: np.ndarray, twos: np.ndarray, more: np.ndarray) -> np.ndarray:
    """What discounting leaves of contexts' mass; 1 for contexts never seen."""
    return np.where(total > 0, (d[1] * ones + d[2] * twos + d[3] * more) / np.maximum(total, 1), 1.0)


class Grid:
    """One bit position a key, and the bits that are set."""

    def __init__(self, n: int):
        self.bits = max(6, (max(1, min(n * FILTER_BITS, MOST_BITS)) - 1).bit_length())
        self.words = np.zeros(1 << self.bits - 6, np.int64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = positions(keys, self.bits)
        return (self.words[at >> 6] >> (at & 63)) & 1 == 1


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """The upper bits of a product with an odd number, all of whose bits count."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


class Words(Sequence):
    """Words in their order as one compressed blob, so that a vocabulary is small in the driver and in a broadcast."""

    def __init__(self, words: pa.LargeBinaryArray):
        ends = np.frombuffer(words.buffers()[1] or bytes(8), np.int64)[words.offset :][: len(words) + 1]
        flat = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        self.n, self.blob = len(words), pack(np.diff(ends).astype("<u4"), flat)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i):
        return self.unpacked()[i]

    def __iter__(self) -> Iterator[bytes]:
        return iter(self.unpacked())

    def __eq__(self, other) -> bool:
        return self.unpacked() == list(other)

    def unpacked(self) -> list[bytes]:
        lengths, flat = unpack(self.blob)
        ends = np.r_[0, np.cumsum(lengths.astype(np.int64))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(ends), pa.py_buffer(flat)]).to_numpy(zero_copy_only=False).tolist()


class Model:
    """The vocabulary with its tables, the discounts, the filter, and how n-grams are dealt to shards.

    It travels packed; a worker unpacks what it needs and keeps it from task to task.
    """

    def __init__(self, words: Words, d3: np.ndarray, d2: np.ndarray, pairs: tuple[np.ndarray, ...], shards: int, grid: Grid):
        self.words, self.d3, self.d2, self.shards, self.grid = words, d3, d2, shards, grid
        self.size, self.chunk = len(words) + UNKNOWN + 1, CHUNK
        # of each word: its count as the end of distinct bigrams; as a context: distinct bigrams by their counts
        self.pairs = pack(*(c.astype("<i8") for c in pairs))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("unigrams", "id", "cores")}

    @cached_property
    def unigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its probability; as a context: its total, and what discounting leaves of its mass."""
        n1, total, ones, twos, more = unpack(self.pairs)
        uniform = 1.0 / self.size
        if n1.sum():
            d1 = discounts([int((n1 == k).sum()) for k in (1, 2, 3, 4)])
            cut = d1[np.minimum(n1, 3)]
            p1 = (n1 - cut) / n1.sum() + cut.sum() / n1.sum() * uniform
        else:
            p1 = np.full(self.size, uniform)
        return p1, total, _left(self.d2, total, ones, twos, more)

    @cached_property
    def id(self) -> dict[bytes, int]:
        return {w: i + UNKNOWN + 1 for i, w in enumerate(self.words)}

    @cached_property
    def cores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each id: whether it is a word (no shape, start, end or UNKNOWN), and its core's slot; and the sorted hashes of the words' cores."""
        plain, slots, known = np.zeros(self.size, bool), np.zeros(self.size, np.int64), np.zeros(self.size, np.uint64)
        for w, i in self.id.items():
            if not w.startswith(b"\x00"):
                c = core(w.translate(LOWER))
                plain[i], slots[i], known[i] = True, xxhash.xxh32_intdigest(c) % SLOTS, xxhash.xxh64_intdigest(c)
        return plain, slots, distinct(known[plain])

    def foreign(self, words: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words with these ids: the hash of each one's core (48 bits; 0 if known or without letters or digits), and its slot."""
        plain, slots, known = self.cores
        hashes, slots = np.zeros(len(words), np.int64), slots[ids]
        odd = np.flatnonzero(~plain[ids])
        cores = [core(words[i].translate(LOWER)) for i in odd.tolist()]
        h = np.fromiter(map(xxhash.xxh64_intdigest, cores), np.uint64, len(cores))
        strange = np.fromiter(map(bool, cores), bool, len(cores))
        if len(known):
            strange &= known[np.minimum(np.searchsorted(known, h), len(known) - 1)] != h
        hashes[odd] = np.where(strange, h >> np.uint64(16), np.uint64(0)).astype(np.int64)
        slots[odd] = np.fromiter(map(xxhash.xxh32_intdigest, cores), np.int64, len(cores)) % SLOTS
        return hashes, slots

    def ids(self, words: list[bytes]) -> np.ndarray:
        """The ids of words of the vocabulary; other words have their shape's, or UNKNOWN."""
        get, shapes = self.id.get, _ShapeIds(self.id)
        return np.fromiter([get(w) or shapes[w.translate(_KINDS)] for w in words], np.int64, len(words))

    def logs(self, grams: np.ndarray, pairs: np.ndarray, count: np.ndarray, of: list[np.ndarray]) -> np.ndarray:
        """log10 P of the last word of each trigram, from its count and from the counts `of` the sorted bigrams."""
        c2, total, ones, twos, more = of
        (heads, first), (tails, last) = places(grams >> BITS, ordered=True), places(grams & PAIR)
        first, last = np.searchsorted(pairs, heads)[first], np.searchsorted(pairs, tails)[last]
        v, w = (grams >> BITS) & LOW, grams & LOW
        c2 = c2[last]
        p1, total2, left2 = self.unigrams
        p2 = np.where(c2 > 0, (c2 - self.d2[np.minimum(c2, 3)]) / np.maximum(total2[v], 1), 0.0) + left2[v] * p1[w]
        left3 = _left(self.d3, total, ones, twos, more)
        seen = np.where(count > 0, (count - self.d3[np.minimum(count, 3)]) / np.maximum(total[first], 1), 0.0)
        return np.log10(seen + left3[first] * p2)


#: The model of this worker by its token: Spark takes a broadcast away after each task that does not name it.
_MODEL: dict[str, Model] = {}
KEPT[__name__] = _MODEL.clear


def _model(held, token: str) -> Model:
    if token not in _MODEL:
        _MODEL.clear()
        _MODEL[token] = held.value
    return _MODEL[token]


class _ShapeIds(dict):
    """The ids of shapes by the words that _KINDS makes."""

    def __init__(self, id_: dict[bytes, int]):
        self.of = id_

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.of.get(shape(word), UNKNOWN)
        return n


# ---- training in Spark


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, fold of the documents labelled good; no text moves."""
    good = labels.groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")
    ).filter("q = 1 AND t = 0")
    ids = good.select("doc_id").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return ids.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def tokens(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, each text's words as places among them, and each text's number of words."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).combine_chunks().fill_null(""))
    flat, ends = split.values, split.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)  # blanks at a text's beginning or end leave empty words
    before = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    words = flat.filter(full).cast(pa.large_binary()).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.diff(before[ends])


@lean
def _words(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for texts in chunks(batches, size):
        words, flat, _ = tokens(texts.column("text"))
        yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(np.bincount(flat, minlength=len(words)))], names=["word", "n"])


@lean
def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()
    for batch in batches:
        count.update(map(shape, batch.column("word").to_pylist()))
        if len(count) > HELD_WORDS:
            yield _counted(count)
            count.clear()
    if count:
        yield _counted(count)


class Chunk:
    """Some whole texts: the distinct words, each text as places among them, and their ids with two starts and an end."""

    def __init__(self, texts: pa.ChunkedArray, ids: Callable[[list[bytes]], np.ndarray]):
        words, flat, n = tokens(texts)
        self.words, self.flat, self.n = words.to_numpy(zero_copy_only=False).tolist(), flat, n
        self.of = of = ids(self.words)
        self.ids = np.empty(len(flat) + 3 * len(n), np.int64)
        first = np.cumsum(n + 3) - (n + 3)
        inside = np.ones(len(self.ids), bool)
        for at, x in ((first, START), (first + 1, START), (first + n + 2, END)):
            self.ids[at], inside[at] = x, False
        self.ids[inside] = of[flat] if len(flat) else 0


def trigrams(ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The key of each token (words and end) of texts with n words."""
    keys = (ids[:-2] << 2 * BITS) | (ids[1:-1] << BITS) | ids[2:]
    inside = np.ones(len(keys), bool)
    ends = np.cumsum(n + 3)[:-1]
    inside[ends - 1] = inside[ends - 2] = False  # those that run into the next text
    return keys[inside]


def by_shard(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The stable order of rows by shard, and each shard with where its rows begin and end in it."""
    order = np.argsort(shard.astype("<u2" if len(shard) and shard.max() < 1 << 16 else "<u4"), kind="stable")
    s = shard[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]][: len(s)])
    return order, list(zip(s[first].tolist(), first.tolist(), [*first[1:].tolist(), len(s)], strict=False))


class Sums:
    """Columns summed by key; what is added is summed up whenever it has MOST rows more than the sums."""

    MOST = 1 << 21

    def __init__(self, columns: int):
        self.n, self.held, self.rows, self.kept = columns, [], 0, 0

    def add(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        self.held.append((keys, *columns))
        self.rows += len(keys)
        if self.rows > self.kept + self.MOST:
            self.held = [self.get()]
            self.rows = self.kept = len(self.held[0][0])

    def get(self) -> tuple[np.ndarray, ...]:
        """The distinct keys in their order, and the sums."""
        if not self.held:
            return tuple(np.zeros(0, np.int64) for _ in range(self.n + 1))
        keys, *columns = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        return keys[first], *(np.add.reduceat(c[order].astype(np.int64), first) if len(first) else c for c in columns)


#: Rows of packed keys and columns, dealt by shard.
BLOB = "kind int, shard int, x binary"
CONTEXTS, ENDS = 4, 5


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds, shards, xs = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(shards, pa.int32()), pa.array(xs, pa.binary())], names=["kind", "shard", "x"])


def _dealt(kind: int, keys: np.ndarray, shard: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and columns, a row a shard."""
    order, cuts = by_shard(shard)
    keys, columns = keys[order], [c[order].astype("<u4") for c in columns]
    return _blobs([(kind, s, pack(differences(keys[i:j]), *(c[i:j] for c in columns))) for s, i, j in cuts])


def _by_blob(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("kind", "shard", "x")), strict=True)


@lean
def _grams(batches: Iterator[pa.RecordBatch], held, token: str) -> Iterator[pa.RecordBatch]:
    """Trigrams of chunks with their counts, dealt by their first two words."""
    model = _model(held, token)
    for texts in chunks(batches, model.chunk):
        made = Chunk(texts.column("text"), model.ids)
        found, n = np.unique(trigrams(made.ids, made.n), return_counts=True)
        yield _dealt(GRAMS3, found, np.mod(found >> BITS, model.shards), n)


@lean
def _three(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard: each shard's trigrams, their contexts (of the same shard), and parts of the bigrams' counts as ends."""
    _MODEL.clear()  # that of _grams
    ends = Sums(1)
    for shard, rows in groupby(_by_blob(batches), key=lambda r: r[1]):
        sums = Sums(1)
        for _, _, x in rows:
            keys, n = unpack(x)
            sums.add(np.cumsum(keys), n)
        k, n = sums.get()
        pairs = k >> BITS
        first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)])
        of = [np.add.reduceat(c.astype(np.int64), first).astype("<u4") for c in (n, n == 1, n == 2, n > 2)]
        yield _blobs([(GRAMS3, shard, pack(differences(k), n.astype("<u4"))), (CONTEXTS, shard, pack(differences(pairs[first]), *of))])
        ends.add(k & PAIR, np.ones(len(k), np.int64))
        if ends.kept > Sums.MOST:
            q, n = ends.get()
            yield _dealt(ENDS, q, np.mod(q, shards), n)
            ends = Sums(1)
    q, n = ends.get()
    if len(q):
        yield _dealt(ENDS, q, np.mod(q, shards), n)


@lean
def _two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard: each shard's bigrams with their counts as ends and as contexts."""
    for shard, rows in groupby(_by_blob(batches), key=lambda r: r[1]):
        sums = Sums(5)
        for kind, _, x in rows:
            keys, *columns = unpack(x)
            no = np.zeros(len(keys), "<u4")
            sums.add(np.cumsum(keys), *(columns + [no] * 4 if kind == ENDS else [no, *columns]))
        k, *columns = sums.get()
        yield _blobs([(GRAMS2, shard, pack(differences(k), *(c.astype("<u4") for c in columns)))])


STATS = "w long, n long, total long, ones long, twos long, more long"


@lean
def _stats(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Of each word: bigrams that end in it, and as a context; at -3 and -2 the trigrams and bigrams, and those with counts of 1, 2, 3 and 4."""
    of = np.zeros((5, words), np.int64)
    few = {GRAMS3: np.zeros(5, np.int64), GRAMS2: np.zeros(5, np.int64)}
    for kind, _, x in _by_blob(batches):
        keys, n, *_ = unpack(x)
        few[kind] += [len(keys), *((n == c).sum() for c in (1, 2, 3, 4))]
        if kind == GRAMS2:
            k, n = np.cumsum(keys)[n > 0], n[n > 0].astype(np.int64)
            of[0] += np.bincount(k & LOW, minlength=words)
            for to, c in zip(of[1:], (n, n == 1, n == 2, n > 2), strict=True):
                to += np.bincount(k >> BITS, c, minlength=words).astype(np.int64)
    at = np.flatnonzero(of.any(axis=0))
    columns = np.concatenate([of[:, at], np.stack([few[GRAMS3], few[GRAMS2]], axis=1)], axis=1)
    w = np.r_[at, -GRAMS3, -GRAMS2]
    yield pa.RecordBatch.from_arrays([pa.array(w), *map(pa.array, columns)], names=[c.split(" ")[0] for c in STATS.split(", ")])


#: Bits of a slice of the filter, as a power of two.
SLICE = 22


@lean
def _bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The filter's bits, in slices."""

    def flush() -> pa.RecordBatch:
        bits = distinct(np.concatenate(held))
        held.clear()
        return _dealt(0, bits, bits >> SLICE)

    held: list[np.ndarray] = []
    have = 0
    for _, _, x in _by_blob(batches):
        keys = np.cumsum(unpack(x)[0])
        held.append(positions(keys, size))
        have += len(keys)
        if have > 6_000_000:
            yield flush()
            have = 0
    if held:
        yield flush()


@lean
def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for slice_, rows in groupby(_by_blob(batches), key=lambda r: r[1]):
        words = np.zeros(1 << SLICE - 6, np.int64)
        for _, _, x in rows:
            bits = np.cumsum(unpack(x)[0]) & (1 << SLICE) - 1
            at = bits >> 6
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
            words[at[first]] |= np.bitwise_or.reduceat(np.left_shift(1, bits & 63), first)
        yield _blobs([(0, slice_, words.tobytes())])


#: A table of counts, whose rows carry their keys and columns, or a request with its keys, or its answer.
ROW = "what int, shard int, kind int, chunk long, x binary"
GRAMS3, GRAMS2, WORD = 3, 2, 1
CONTEXT = ["total", "ones", "twos", "more"]


def dealt(rows: DataFrame, what: int, shards: int, columns: list[str], kind: str) -> DataFrame:
    """One row a shard of a table of keys k and columns."""

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        x = pack(differences(pdf["k"].to_numpy()), *(pdf[c].to_numpy().astype(kind) for c in columns))
        return pd.DataFrame({"what": [what], "shard": [int(pdf["shard"].iloc[0])], "kind": [0], "chunk": [-1], "x": [x]})

    return rows.withColumn("shard", F.pmod("k", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(packed, ROW)


def vocabulary(counted: DataFrame, scratch: Scratch) -> Words:
    """Words, and shapes of the others, that occur MIN_COUNT times or more; frequent ones first, since small ids compress well.

    Ids have BITS bits: where more words would do, those of the count at which they run out keep their shapes.
    """
    rare = counted.filter(F.col("n") < MIN_COUNT).select("word").mapInArrow(_shapes, "word binary, n long")
    shapes = rare.groupBy("word").agg(F.sum("n").alias("n"))
    usual = scratch.write(counted.unionByName(shapes).filter(F.col("n") >= MIN_COUNT))
    least, room = MIN_COUNT, (1 << BITS) - 8
    # one row a count, of which there are few
    for n, words in sorted(usual.groupBy("n").count().collect(), reverse=True):
        room -= words
        if room < 0:
            least = n + 1
            break
    kept = usual.filter(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    scratch.drop(usual)
    out = Words(kept.column("word").cast(pa.large_binary()).combine_chunks())
    del kept
    give_back()
    return out


def train(docs: DataFrame, good: DataFrame, scratch: Scratch) -> tuple[Model, DataFrame]:
    """The model, and its n-gram tables in shards, from the whole texts of all trusted documents in all folds but 0."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = scratch.write(rows.join(good.filter("fold <> 0").select("doc_id"), "doc_id", "left_semi").select("text"))
    counted = scratch.write(texts.mapInArrow(partial(_words, size=CHUNK), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    words = vocabulary(counted, scratch)
    n_words = len(words) + UNKNOWN + 1
    nothing = tuple(np.zeros(n_words, np.int64) for _ in range(5))
    # there are no more trigrams than tokens; odd, so that all of a key's bits decide
    shards = -(-(counted.agg(F.sum("n")).first()[0] or 0) // SHARD_GRAMS) | 1
    parts = n_parts(docs.sparkSession)
    scratch.drop(counted)
    bare = Model(words, discounts([0]), discounts([0]), nothing, shards, Grid(0))
    dealt_by = lambda rows: rows.repartition(parts, "shard").sortWithinPartitions("shard")
    held = docs.sparkSession.sparkContext.broadcast(bare)
    grams = texts.mapInArrow(partial(_grams, held=held, token=uuid.uuid4().hex), BLOB)
    made = scratch.write(dealt_by(grams).mapInArrow(partial(_three, shards=shards), BLOB), by="kind")
    held.destroy()
    scratch.drop(texts)
    kept = lambda df, *kinds: df.filter(F.col("kind").isin(*kinds)).select("kind", "shard", "x")
    two = scratch.write(dealt_by(kept(made, CONTEXTS, ENDS)).mapInArrow(_two, BLOB))
    for kind in (CONTEXTS, ENDS):
        scratch.drop_path(f"{made._scratch_path}/kind={kind}")
    both = kept(made, GRAMS3).unionByName(two)
    # one row a word of the vocabulary
    stats = scratch.write(both.mapInArrow(partial(_stats, words=n_words), STATS).groupBy("w").agg(*(F.sum(c).alias(c) for c in ("n", *CONTEXT))))
    got = stats.toArrow()
    w, columns = got.column("w").to_numpy(), [got.column(c).to_numpy() for c in ("n", *CONTEXT)]
    few = {k: [int(c[w == -k].sum()) for c in columns] for k in (GRAMS3, GRAMS2)}
    tables = [np.zeros(n_words, np.int64) for _ in range(5)]
    for to, c in zip(tables, columns, strict=True):
        to[w[w >= 0]] = c[w >= 0]
    del got, w, columns
    grid = Grid(few[GRAMS3][0] + few[GRAMS2][0])
    slices = scratch.write(dealt_by(both.mapInArrow(partial(_bits, size=grid.bits), BLOB)).mapInArrow(_slices, BLOB))
    # the filter, which has MOST_BITS bits at most
    for _, i, x in _by_blob(slices.toArrow().to_batches()):
        at = i << SLICE - 6
        to = grid.words[at : at + (1 << SLICE - 6)]
        to[:] = np.frombuffer(x, np.int64)[: len(to)]
    model = Model(words, discounts(few[GRAMS3][1:]), discounts(few[GRAMS2][1:]), tuple(tables), shards, grid)
    del tables
    give_back()
    scratch.drop(stats, slices)
    held = both.select(F.col("kind").alias("what"), "shard", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("chunk"), "x")
    held._made_of = (made, two)
    return model, held


# ---- one pass over all texts: encoded chunks, what they ask, and the words before unknown words

ENCODED = ", ".join([ROW, "h long", *(f"b{i} long" for i in range(SLOTS // 64)), "in_trusted boolean"])
TEXT, ASK, WORDS, ASK_WORDS = 1, 2, 3, 4


def asked(grams: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """Of a chunk with these distinct trigrams: they and the distinct bigrams, and which of both to ask for."""
    pairs = distinct(np.concatenate([distinct(grams >> BITS, ordered=True), distinct(grams & PAIR)]))
    return grams, pairs, model.grid.may_hold(grams), model.grid.may_hold(pairs)


def _empty(kind: str, n: int) -> pa.Array:
    return pa.nulls(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[kind])


def _batch(**columns) -> pa.RecordBatch:
    """A record batch of ENCODED; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    names = [c.split(" ") for c in ENCODED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], _empty(kind, 0).type) if c in columns else _empty(kind, n) for c, kind in names], names=[c for c, _ in names]
    )


@lean
def _encode(batches: Iterator[pa.RecordBatch], held, token: str, turn: int = 0) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    model = _model(held, token)
    uid = turn << 56 | TaskContext.get().partitionId() << 32
    # unknown words with a slot each, and those that trusted texts hold
    met: list[np.ndarray] = []
    seen: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        marks_ = distinct(np.concatenate(met))
        h, row = places(marks_ // SLOTS, ordered=True)
        maps, slot = np.zeros((len(h), SLOTS // 64), np.int64), marks_ % SLOTS
        np.bitwise_or.at(maps, (row, slot >> 6), np.left_shift(1, slot & 63))
        out = _batch(kind=[WORDS] * len(h), h=h, in_trusted=np.isin(h, np.concatenate(seen)), **{f"b{i}": maps[:, i].copy() for i in range(SLOTS // 64)})
        met.clear()
        seen.clear()
        return out

    for rows in chunks(batches, model.chunk):
        made = Chunk(rows.column("text"), model.ids)
        hashes, slots = model.foreign(made.words, made.of)
        strange = distinct(hashes[hashes != 0])
        # tokens that are unknown words: their hashes' places, the texts that hold them, the slots of the words before
        h = hashes[made.flat]
        at = np.flatnonzero(h)
        text_of = np.repeat(np.arange(len(made.n)), made.n)
        which = np.searchsorted(strange, hashes)[made.flat[at]]
        before = np.where(at > 0, slots[made.flat[at - 1]], 0) if len(at) else at
        starts = np.zeros(len(made.flat) + 1, bool)
        starts[np.cumsum(made.n) - made.n] = True
        before = np.where(starts[at], 0, before)
        met.append(distinct(h[at] * SLOTS + before))
        good = rows.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        seen.append(distinct(h[at][good[text_of[at]]]))
        if sum(map(len, met)) > HELD_MARKS:
            yield flush()
        holds = distinct(text_of[at] * (len(strange) + 1) + which)
        meta = pickle.dumps([rows.column(c).to_pylist() for c in ("doc_id", "lang", "m1", "m2")], protocol=5)
        # of unknown words the answers come in their order in each shard, so the shards are all that stays here
        where = np.mod(strange, model.shards).astype("<u4")
        x = pack(made.ids.astype("<u4"), made.n.astype("<u4"), differences(holds).astype("<i8"), where, np.frombuffer(meta, np.uint8))
        yield _batch(kind=[TEXT], chunk=[uid], what=[0], shard=[0], x=[x])
        grams, pairs, ask3, ask2 = asked(distinct(trigrams(made.ids, made.n)), model)
        for kind, what, keys, shard in (
            (ASK, GRAMS3, grams := grams[ask3], grams >> BITS),
            (ASK, GRAMS2, pairs := pairs[ask2], pairs),
            (ASK_WORDS, WORD, strange, strange),
        ):
            order, cuts = by_shard(np.mod(shard, model.shards))
            keys = keys[order]
            if cuts:
                xs = [pack(differences(keys[i:j])) for _, i, j in cuts]
                n = len(cuts)
                yield _batch(kind=[kind] * n, chunk=[uid] * n, what=[what] * n, shard=[s for s, _, _ in cuts], x=xs)
        uid += 1
    if met:
        yield flush()


def foreign_words(words: DataFrame, share: float) -> DataFrame:
    """k, e: evidence of the words that the corpus holds after many words and trusted text nowhere."""
    maps = [f"b{i}" for i in range(SLOTS // 64)]
    found = words.groupBy("h").agg(*(F.bit_or(b).alias(b) for b in maps), F.max("in_trusted").alias("in_trusted")).filter("NOT in_trusted")
    set_ = sum((F.bit_count(b) for b in maps), F.lit(0))
    free = F.greatest(F.lit(SLOTS) - set_, F.lit(0.5)) / SLOTS
    return found.select(F.col("h").alias("k"), (-F.log(free) * SLOTS * -math.log10(1 - share)).alias("e")).filter(F.col("e") >= FOREIGN)


# ---- the join: shards answer chunks, chunks read their answers


@lean
def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by table, shard and salt, a shard's counts before its requests."""
    at, keys, columns = None, np.zeros(0, np.int64), []
    for batch in batches:
        out = []
        for what, shard, kind, chunk, x in zip(*(batch.column(c).to_pylist() for c in ("what", "shard", "kind", "chunk", "x")), strict=True):
            if kind == 0:
                at = (what, shard)
                got, *columns = unpack(x)
                keys = np.cumsum(got)
                continue
            wanted = np.cumsum(unpack(x)[0])
            if at != (what, shard) or not len(keys):  # a shard that holds nothing
                continue
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[place] == wanted
            out.append((what, shard, kind, chunk, pack(*(np.where(hit, c[place], 0) for c in columns))))
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            cols = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["what", "shard", "kind", "chunk", "x"])


def answers(tables: DataFrame, requests: DataFrame, n: int) -> DataFrame:
    """The sharded join: each request beside the shard that it asks, of n in all; askers are dealt `salts` ways."""
    parts = n_parts(tables.sparkSession)
    salts = max(1, parts // max(1, n))
    salted = tables.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = salted.unionByName(requests.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int")))
    keys = ["what", "shard", "salt"]
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys, "kind").mapInArrow(_answer, ROW)


SCORED = "doc_id long, lang string, m1 long, m2 long, lp double, n_tokens long, worst double, strange double"


def measures(logs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[float | None]]:
    """Each text's log10 P and the worst window's mean cost; n counts the tokens of each text."""
    first = np.cumsum(n) - n
    worst: list[float | None] = [None] * len(n)
    long = np.flatnonzero(n > WINDOW)
    if len(long):
        total = np.r_[0.0, np.cumsum(-logs)]
        means = (total[WINDOW:] - total[:-WINDOW]) / WINDOW
        # the windows inside a text, then those that leave it, in turns
        cuts = np.stack([first[long], (first + n)[long] - WINDOW + 1], axis=1).ravel()
        for i, x in zip(long.tolist(), np.maximum.reduceat(np.r_[means, -np.inf], cuts)[::2].tolist(), strict=True):
            worst[i] = x
    return np.add.reduceat(logs, first), worst


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], dict[tuple[int, int], list[np.ndarray]]]]:
    """Rows come sorted by chunk, its own row first, then the answers of the shards: chunk, its arrays, the answers by table and shard."""
    at, own, got = None, None, {}
    for batch in batches:
        for what, shard, kind, chunk, x in zip(*(batch.column(c).to_pylist() for c in ("what", "shard", "kind", "chunk", "x")), strict=True):
            if kind == TEXT:
                if own is not None:
                    yield at, own, got
                at, own, got = chunk, unpack(x), {}
            else:
                got[what, shard] = unpack(x)
    if own is not None:
        yield at, own, got


def _filled(got: dict, what: int, shard: np.ndarray, columns: int, kind: str) -> list[np.ndarray]:
    """The answers of a table in the order of what was asked, by the shards asked."""
    out = [np.zeros(len(shard), kind) for _ in range(columns)]
    order, cuts = by_shard(shard)
    for s, i, j in cuts:
        for to, x in zip(out, got.get((what, s), []), strict=False):
            to[order[i:j]] = x
    return out


def _spread(ask: np.ndarray, columns: list[np.ndarray]) -> list[np.ndarray]:
    """Answers at what was asked, 0 elsewhere."""
    out = [np.zeros(len(ask), c.dtype) for c in columns]
    for to, c in zip(out, columns, strict=True):
        to[ask] = c
    return out


@lean
def _score(batches: Iterator[pa.RecordBatch], held, token: str) -> Iterator[pa.RecordBatch]:
    """Encoded texts become their scores, which wait in their chunk for the evidence of foreign words."""
    model = _model(held, token)
    for chunk, (ids, n, holds, where, meta), got in _chunks(batches):
        ids, n = ids.astype(np.int64), n.astype(np.int64)
        grams, at = places(trigrams(ids, n))
        grams, pairs, ask3, ask2 = asked(grams, model)
        count = _spread(ask3, _filled(got, GRAMS3, np.mod(grams[ask3] >> BITS, model.shards), 1, "<i8"))[0]
        of = _spread(ask2, _filled(got, GRAMS2, np.mod(pairs[ask2], model.shards), 5, "<i8"))
        logs = model.logs(grams, pairs, count, of)
        lp, worst = measures(logs[at], n + 1)
        x = pack(lp, n + 1, np.array(worst, float), holds, where, meta)  # None becomes NaN
        cols = [pa.array([c], k) for c, k in zip((0, 0, TEXT, chunk, x), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays(cols, names=["what", "shard", "kind", "chunk", "x"])


@lean
def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (lp, n, worst, holds, where, meta), got in _chunks(batches):
        holds = np.cumsum(holds)
        evidence = _filled(got, WORD, where, 1, "<f8")[0]
        far = np.zeros(len(n))
        np.maximum.at(far, holds // (len(where) + 1), evidence[holds % (len(where) + 1)] if len(holds) else 0.0)
        cols = [*(pa.array(c, k) for c, k in zip(pickle.loads(meta.tobytes()), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True))]
        cols += [pa.array(lp), pa.array(n), pa.array(worst, from_pandas=True), pa.array(far)]
        yield pa.RecordBatch.from_arrays(cols, names=[c.split(" ")[0] for c in SCORED.split(", ")])


def measure(docs: DataFrame, good: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, lang, m1 and m2 (marks of the text), lp (log10 P), n_tokens, worst and strange of every row, written.

    All rows are scored, in up to TURNS turns of about TURN bytes of text at least, each with a part of the rows by the hash of id and length;
    what a turn asks and is answered goes before the next. Foreign words are known, and asked for, after all turns.
    """
    spark = docs.sparkSession
    model, tables = train(docs, good, scratch)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"), *marks(text))
    # fold 0 stays outside, so that its documents show how often usual words look foreign
    flags = good.filter("fold <> 0").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("trusted"))
    n, size = docs.select(text.alias("text")).agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    share = min(flags.count() / max(1, n), 0.999)
    turns = max(1, min(TURNS, -(-(size or 0) // TURN)))
    held, token = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    cols = [c.split(" ")[0] for c in ROW.split(", ")]
    together = lambda a, b: a.select(*cols).unionByName(b).repartition(n_parts(spark), "chunk").sortWithinPartitions("chunk", "kind")
    encoded, scored = [], []
    for turn in range(turns):
        part = rows.filter(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(turns)) == turn)
        flagged = part.join(flags, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
        made = scratch.write(flagged.mapInArrow(partial(_encode, held=held, token=token, turn=turn), ENCODED), by="kind")
        replies = scratch.write(answers(tables, made.filter(F.col("kind") == ASK).select(*cols), 2 * model.shards))
        scratch.drop_path(f"{made._scratch_path}/kind={ASK}")
        scored.append(scratch.write(together(made.filter(F.col("kind") == TEXT), replies).mapInArrow(partial(_score, held=held, token=token), ROW)))
        scratch.drop_path(f"{made._scratch_path}/kind={TEXT}")
        scratch.drop(replies)
        encoded.append(made)
    scratch.drop(*tables._made_of)
    held.destroy()
    every = lambda frames: reduce(DataFrame.unionByName, frames)
    words = every([x.filter(F.col("kind") == WORDS) for x in encoded])
    found = scratch.write(foreign_words(words, share) if share else foreign_words(words, 0.5).filter("false"))
    foreign = scratch.write(dealt(found, WORD, model.shards, ["e"], "<f8"))
    wanted = every([x.filter(F.col("kind") == ASK_WORDS).select(*cols) for x in encoded])
    replies = scratch.write(answers(foreign, wanted, model.shards))
    out = scratch.write(together(every(scored), replies).mapInArrow(_finish, SCORED))
    scratch.drop(*encoded, *scored, found, foreign, replies)
    return out


def marks(text: Column) -> list[Column]:
    """Two hashes of a text, which together stand for it."""
    return [F.xxhash64(text).alias("m1"), F.xxhash64(F.lit("mark"), text).alias("m2")]


# ---- thresholds and verdicts

PERPLEXITY = "CASE WHEN n_tokens > 1 THEN pow(10D, -lp / n_tokens) END"
COST = "CASE WHEN n_tokens > 1 THEN -lp / n_tokens END"
LIMITS = {"cost": "most_cost", "worst": "most_worst", "strange": "most_strange"}


def quantiles(values: DataFrame, keys: list[str]) -> DataFrame:
    """keys, and of each measure the least multiple of 1 / GRID that QUANTILE of its values do not exceed."""
    one = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.ceil(F.col(c) * GRID).alias("bin")) for c in LIMITS)))
    counts = values.select(*keys, one.alias("v")).filter("v.bin IS NOT NULL").groupBy(*keys, "v.measure", "v.bin").count()
    group = Window.partitionBy(*keys, "measure")
    below = F.sum("count").over(group.orderBy("bin"))
    fit = counts.withColumn("below", below).withColumn("n", F.sum("count").over(group)).filter(F.col("below") >= QUANTILE * F.col("n"))
    limit = lambda c: (F.min(F.when(F.col("measure") == c, F.col("bin"))) / GRID).alias(LIMITS[c])
    return fit.groupBy(*keys).agg(*map(limit, LIMITS))


def thresholds(measured: DataFrame, good: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """lang and limits of the three measures from the trusted documents of fold 0; and those over all languages."""
    held = measured.join(good.filter("fold = 0").select("doc_id"), "doc_id", "left_semi").withColumn("cost", F.expr(COST)).filter("cost IS NOT NULL")
    overall = quantiles(held, []).first()
    overall = {c: math.inf if overall is None or overall[c] is None else overall[c] for c in LIMITS.values()}
    return quantiles(held.filter("lang IS NOT NULL"), ["lang"]), overall


def judged(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Every row's measures, limits and verdict (kept), with its doc_id, lang and the marks of its text."""
    good = scratch.write(trusted(docs, labels))
    measured = measure(docs, good, scratch)
    limits, overall = thresholds(measured, good)
    # languages are few, so Spark broadcasts their limits
    out = measured.join(scratch.write(limits), "lang", "left").withColumn("cost", F.expr(COST))
    out = out.withColumns({c: F.coalesce(c, F.lit(float(overall[c]))) for c in LIMITS.values()})
    usual = F.col("cost") <= F.col("most_cost") + F.lit(ALLOWANCE) / F.sqrt("n_tokens")
    even, known = F.col("worst") <= F.col("most_worst"), F.col("strange") <= F.col("most_strange")
    kept = F.col("cost").isNull() | (usual & F.coalesce(even, F.lit(True)) & known)
    return out.withColumn("kept", kept)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return judged(docs, labels, Scratch(spark, "op4")).select(
        "doc_id",
        "lang",
        "n_tokens",
        F.expr(PERPLEXITY).alias("perplexity"),
        F.pow(F.lit(10.0), "most_cost").alias("threshold"),
        "kept",
    )


def filter_documents(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents that the classifier keeps, with their columns.

    A verdict depends on the text and its language alone, so the few rejected ones are anti-joined by these.
    """
    text = F.col("text").cast("string")
    bad = scratch.write(judged(docs, labels, scratch).filter("NOT kept").select("m1", "m2", "lang").distinct())
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("lang").cast("string").alias("lang"), *marks(text)
    )
    same = (rows["m1"] == bad["m1"]) & (rows["m2"] == bad["m2"]) & rows["lang"].eqNullSafe(bad["lang"])
    return rows.join(bad, same, "left_anti").select("row.*")
