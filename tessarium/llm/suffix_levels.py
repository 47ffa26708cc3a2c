"""Suffix-array deduplication of long passages with a logarithmic index family.

A byte goes when some string of LENGTH bytes that covers it also starts earlier (in a smaller document or
before it in the same one). Sorting every suffix of a corpus would move many times its size, so
suffixes are sampled without loss first:

1. Of each window of LENGTH bytes the anchor is the smallest hash of its 32-byte strings (the first
   of equal ones). Equal windows have equal anchors, so windows that share an anchor, a run, stand
   or fall by comparing runs with the same anchor. Anchors only rule out: a run whose anchor is seen once in all
   texts repeats nothing. Inside a task, a run equal to an earlier one, byte for byte, is a repeat and leaves
   the task as a span, so copies of a passage leave a task once; an anchor leaves a task in one row.
2. All other runs go, by anchor, through the index family: their strings come in document order in batches;
   each batch gets its suffix array, is merge-scanned against the existing levels for matches of LENGTH bytes,
   and becomes a level; levels of equal size merge, so sizes grow geometrically. A level is text, the sorted
   places of its suffixes, and their first bytes; only bytes decide. A longer match is one of consecutive suffixes.

Shards follow from counts: of bytes for anchors, of runs for the index. An anchor that holds more than a small part of
all runs is split: its runs are cut into blocks of BLOCK windows, which equal windows share with all bytes that
the block's windows have in common, and the blocks are dealt by these bytes.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; a null doc_id comes before
all others (with the smallest long); equal rows count as one document, and each gets its result; different texts
with one doc_id (or with none) are different documents in the order of their hashes; an empty table gives an empty
result; extra columns, whatever their names, are ignored by `spans` and `report` and kept by `remove`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, lean, n_parts, table
from .kneser_ney import pack, unpack
from .minhash_odd import mix

LENGTH, GRAM = 100, 32
PIECE_BITS = 18
#: Suffixes of a batch; bytes of text of an anchor shard; runs of an index shard.
BATCH, SHARD_BYTES, SHARD_RUNS = 1 << 18, 128 << 20, 50_000
#: An anchor is hot with so many runs that at most HOT * partitions anchors are, and HOT_RUNS at least; windows of a block.
HOT, HOT_RUNS, BLOCK = 8, 4096, 8
_RNG = np.random.default_rng(8)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _geometric(ratio: int) -> np.ndarray:
    out = np.full((1 << PIECE_BITS) + 2, ratio, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSE = _geometric(_BASE), _geometric(pow(_BASE, -1, 1 << 64))

RUN = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("n", "u1")])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size, cur = 1, x
    while 2 * size <= width:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    if size < width:
        cur = np.minimum(cur[: len(cur) - (width - size)], cur[width - size :])
    return cur


def _runs(data: np.ndarray, valid: np.ndarray | None, length: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor hash and context hash of each run in one piece of bytes."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _POWERS[:n], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * _INVERSE[: n - GRAM + 1])
    low = np.uint64((1 << PIECE_BITS) - 1)
    best = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    at = (best & low).astype(np.int64)
    new = np.r_[True, at[1:] != at[:-1]]
    if valid is not None:
        new |= np.r_[True, valid[1:] != valid[:-1]]
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(at)])
        keep = valid[first]
        first, count = first[keep], count[keep]
    else:
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(at)])
    end = first + count - 1 + length
    anchor = grams[at[first]]
    where = (at[first] - first).astype(np.uint64)
    context = mix(mix((total[end] - total[first]) * _INVERSE[first]) + count.astype(np.uint64) * np.uint64(256) + where)
    return first, count, anchor, context


def runs_of(docs: list[int], texts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """The runs of many documents (given by number); small ones share a piece, long ones are cut into overlapping pieces."""
    out: list[np.ndarray] = []
    most = (1 << PIECE_BITS) - 1

    def piece(parts: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        sizes = np.array([len(p[2]) for p in parts])
        starts = np.cumsum(sizes) - sizes
        valid = None
        if len(parts) > 1:
            valid = np.ones(len(data) - length + 1, bool)
            for s in starts[1:].tolist():  # windows that run into the next document
                valid[s - length + 1 : s] = False
        first, count, anchor, context = _runs(data, valid, length)
        # a piece border ends a run even where two documents continue one anchor
        of = np.searchsorted(starts, first, side="right") - 1
        got = np.empty(len(first), RUN)
        got["anchor"], got["context"], got["n"] = anchor, context, count
        got["doc"] = np.array([p[0] for p in parts], np.int64)[of]
        got["at"] = first - starts[of] + np.array([p[1] for p in parts], np.int64)[of]
        out.append(got)

    held: list[tuple[int, int, bytes]] = []
    size = 0
    for doc, text in zip(docs, texts, strict=True):
        if len(text) < length:
            continue
        if len(text) > most:
            step = most - length + 1
            for at in range(0, len(text) - length + 1, step):
                piece([(doc, at, text[at : at + most])])
            continue
        if size + len(text) > most:
            piece(held)
            held, size = [], 0
        held.append((doc, 0, text))
        size += len(text)
    if held:
        piece(held)
    return np.concatenate(out) if out else np.empty(0, RUN)


#: What leaves the scan: of each shard the anchors of a task with their runs, and spans; then what leaves the shards.
SCANNED = "shard int, kind int, x binary"
ANCHORS, SPANS, RUNS = 0, 1, 2
FLAT_SQL = "doc long, sub long, s long, e long, anchor long, need boolean"
FLAT = pa.schema([("doc", pa.int64()), ("sub", pa.int64()), ("s", pa.int64()), ("e", pa.int64()), ("anchor", pa.int64()), ("need", pa.bool_())])


def _flat(doc: np.ndarray, sub: np.ndarray, s: np.ndarray, e: np.ndarray, anchor: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Spans [s, e) of bytes; with an anchor their windows are still to be compared."""
    for k in range(0, len(doc), 65536):
        part = [x[k : k + 65536].astype(np.int64) for x in (doc, sub, s, e, np.zeros(len(doc), np.int64) if anchor is None else anchor.view(np.int64))]
        yield pa.RecordBatch.from_arrays([*map(pa.array, part), pa.array(np.full(len(part[0]), anchor is not None))], schema=FLAT)


class Unit:
    """Some texts in one buffer, with their documents (doc, sub) and the runs in them."""

    def __init__(self, docs: list[int], subs: list[int], texts: list[bytes], length: int):
        self.doc, self.sub, self.length = np.array(docs, np.int64), np.array(subs, np.int64), length
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.base = np.cumsum(sizes) - sizes
        self.runs = runs_of(list(range(len(texts))), texts, length)

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs by anchor, context, document and place, those of repeated rows once; and which equal an earlier one."""
        _, rank = np.unique(np.stack([self.doc, self.sub], axis=1), axis=0, return_inverse=True)
        runs = self.runs
        order = np.lexsort((runs["at"], rank.ravel()[runs["doc"]], runs["context"], runs["anchor"]))
        runs, rank = runs[order], rank.ravel()[runs["doc"][order]]
        head = np.r_[True, (runs["anchor"][1:] != runs["anchor"][:-1]) | (runs["context"][1:] != runs["context"][:-1])][: len(runs)]
        same = np.r_[False, (rank[1:] == rank[:-1]) & (runs["at"][1:] == runs["at"][:-1]) & ~head[1:]][: len(runs)]
        runs, head = runs[~same], head[~same]
        again = np.flatnonzero(~head)
        first = np.maximum.accumulate(np.where(head, np.arange(len(runs)), 0))[again]
        equal = np.zeros(len(runs), bool)
        where = self.base[runs["doc"]] + runs["at"]
        width = np.arange(int(runs["n"].max(initial=1)) - 1 + self.length)
        for k in range(0, len(again), 8192):
            i, j = again[k : k + 8192], first[k : k + 8192]
            a, b = (self.data[np.minimum(where[x][:, None] + width, len(self.data) - 1)] for x in (i, j))
            beyond = width >= (runs["n"][i].astype(np.int64) - 1 + self.length)[:, None]
            equal[i] = ((a == b) | beyond).all(axis=1)
        return runs, equal

    def columns(self, runs: np.ndarray) -> tuple[np.ndarray, ...]:
        s = runs["at"].astype(np.int64)
        return self.doc[runs["doc"]], self.sub[runs["doc"]], s, s + runs["n"] - 1 + self.length


@lean
def _scan(batches: Iterator[pa.RecordBatch], shards: int, length: int) -> Iterator[pa.RecordBatch]:
    """By shard, the anchors of the task, one row each: one run, and whether others with the anchor differ from it.

    Beside them, spread over the shards: spans that repeat earlier ones of the task, and the runs of anchors with several.
    """
    from pyspark import TaskContext

    kind = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("x", pa.binary())])
    spread = TaskContext.get().partitionId()

    def rows(some: list[int], what: int, x: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([what] * len(some), pa.int32()), pa.array(x, pa.binary())], schema=kind)

    def flush(unit: Unit) -> Iterator[pa.RecordBatch]:
        nonlocal spread
        if not len(unit.runs):
            return
        runs, equal = unit.sorted()
        again, runs = runs[equal], runs[~equal]
        first = np.r_[True, runs["anchor"][1:] != runs["anchor"][:-1]]
        edge = np.flatnonzero(first)
        several = np.diff(np.r_[edge, len(runs)]) > 1
        heads, many = runs[edge], np.repeat(several, np.diff(np.r_[edge, len(runs)]))
        for what, x in ((SPANS, again), (RUNS, runs[many])):
            x = x[np.lexsort((x["at"], x["doc"]))]
            for at in range(0, len(x), 16384):
                part = x[at : at + 16384]
                doc, sub, s, e = unit.columns(part)
                spread += 104_729
                yield rows([spread % shards], what, [pack(doc, sub, s, e, part["anchor"] if what == RUNS else part["anchor"][:0])])
        shard = (heads["anchor"] >> np.uint64(32)) % np.uint64(shards)
        order = np.lexsort((heads["at"], heads["doc"], shard))
        heads, several, shard = heads[order], several[order], shard[order]
        doc, sub, s, _ = unit.columns(heads)
        cut = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        for k in range(0, shards, 64):
            some = [j for j in range(k, min(k + 64, shards)) if cut[j + 1] > cut[j]]
            parts = (slice(cut[j], cut[j + 1]) for j in some)
            if some:
                x = [pack(heads["anchor"][p], np.diff(doc[p], prepend=doc[p][:1] * 0), sub[p], s[p], heads["n"][p], several[p].astype(np.uint8)) for p in parts]
                yield rows(some, ANCHORS, x)

    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for batch in batches:
        for doc, sub, text in zip(*(batch.column(c) for c in ("doc", "sub", "text")), strict=True):
            data = (text.as_py() or "").encode()
            if len(data) < length:
                continue
            for to, x in zip(held, (doc.as_py(), sub.as_py(), data), strict=True):
                to.append(x)
            size += len(data)
            if size > 24 << 20:  # some megabytes of text at a time
                yield from flush(Unit(*held, length))
                held, size = ([], [], []), 0
    if size:
        yield from flush(Unit(*held, length))


@lean
def _settle(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of each shard (rows come sorted by it) the runs whose anchor has others; spans and runs of single tasks pass through."""
    held: list[list[np.ndarray]] = []
    shard = None

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        anchor, doc, sub, s, n, several = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(anchor)
        edge = np.flatnonzero(np.r_[True, anchor[order][1:] != anchor[order][:-1]])
        size = np.diff(np.r_[edge, len(order)])
        keep = order[np.repeat(size, size) > 1]
        if not len(keep):
            return
        anchor, doc, sub, s, n, several = (x[keep] for x in (anchor, doc, sub, s, n, several))
        # rows that repeat a document bring its runs again: once is enough, and alone they repeat nothing
        order = np.lexsort((several, s, sub, doc, anchor))
        anchor, doc, sub, s, n, several = (x[order] for x in (anchor, doc, sub, s, n, several))
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (s[1:] != s[:-1])]
        edge = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        per = lambda how, x: np.repeat(how.reduceat(x, edge), np.diff(np.r_[edge, len(anchor)]))
        fine = new & (several == 0) & ((per(np.add, new.astype(int)) > 1) | (per(np.maximum, several) > 0))
        yield from _flat(doc[fine], sub[fine], s[fine], s[fine] + n[fine] - 1 + length, anchor[fine])

    for batch in batches:
        for k, kind, x in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "x")), strict=True):
            if k != shard:
                yield from close()
                shard = k
            got = unpack(x)
            if kind == ANCHORS:
                got[1] = np.cumsum(got[1])
                held.append(got)
            else:
                yield from _flat(*got[:4], got[4] if kind == RUNS else None)
    yield from close()


# ---- the index family


class SuffixArray:
    """Text, the places of some suffixes of LENGTH bytes and more in the order of those bytes, and their first 8 bytes."""

    def __init__(self, text: np.ndarray, places: np.ndarray, heads: np.ndarray, length: int):
        self.text, self.places, self.heads, self.length = text, places, heads, length

    @classmethod
    def build(cls, text: np.ndarray, places: np.ndarray, length: int) -> tuple[SuffixArray, np.ndarray, np.ndarray]:
        """The array of the first of equal suffixes; the order of all places, and which of them in it are first ones."""
        keys = cls.bytes_at(text, places, length)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.r_[True, ordered[1:] != ordered[:-1]][: len(order)]
        made = cls(text, places[order[first]], cls.heads_of(ordered[first], length), length)
        return made, order, first

    @staticmethod
    def bytes_at(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        rows = np.lib.stride_tricks.sliding_window_view(text, length)[places]
        return np.ascontiguousarray(rows).view(f"S{length}").ravel()

    @staticmethod
    def heads_of(keys: np.ndarray, length: int) -> np.ndarray:
        raw = keys.view(np.uint8).reshape(len(keys), length)[:, :8]
        wide = np.zeros((len(keys), 8), np.uint8)
        wide[:, : raw.shape[1]] = raw
        return wide.view(">u8").ravel().astype(np.uint64)

    def __len__(self) -> int:
        return len(self.places)

    def keys(self, part: slice = slice(None)) -> np.ndarray:
        return self.bytes_at(self.text, self.places[part], self.length)

    def find(self, keys: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted suffixes belong in this array, and whether it holds them: first bytes are merged, ties compared whole."""
        low, high = np.searchsorted(self.heads, heads, "left"), np.searchsorted(self.heads, heads, "right")
        todo = np.flatnonzero(low < high)
        while len(todo):
            middle = (low[todo] + high[todo]) // 2
            less = self.bytes_at(self.text, self.places[middle], self.length) < keys[todo]
            low[todo[less]] = middle[less] + 1
            high[todo[~less]] = middle[~less]
            todo = todo[low[todo] < high[todo]]
        hit = np.zeros(len(keys), bool)
        inside = np.flatnonzero(low < len(self.places))
        inside = inside[self.heads[low[inside]] == heads[inside]]
        hit[inside] = self.bytes_at(self.text, self.places[low[inside]], self.length) == keys[inside]
        return low, hit

    def merged(self, other: SuffixArray) -> SuffixArray:
        # whole suffixes are written out for some of them at a time
        parts = [slice(k, k + 65536) for k in range(0, len(other), 65536)]
        at = np.concatenate([self.find(other.keys(p), other.heads[p])[0] for p in parts]) if parts else np.zeros(0, np.int64)
        return SuffixArray(
            np.concatenate([self.text, other.text]),
            np.insert(self.places, at, other.places + len(self.text)),
            np.insert(self.heads, at, other.heads),
            self.length,
        )


class Levels:
    """The index family of one shard: suffix arrays of distinct suffixes, whose sizes grow geometrically."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.levels: list[SuffixArray] = []

    def add(self, text: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of a batch's suffixes (places in document order) were seen before, in it or in any level."""
        batch, order, first = SuffixArray.build(text, places, self.length)
        keys = batch.keys()
        seen = np.zeros(len(batch), bool)
        for level in self.levels:
            todo = np.flatnonzero(~seen)
            seen[todo] = level.find(keys[todo], batch.heads[todo])[1]
        again = ~first
        again[first] = seen
        out = np.empty(len(places), bool)
        out[order] = again
        level = SuffixArray(text, batch.places[~seen], batch.heads[~seen], self.length)
        while self.levels and len(self.levels[-1]) <= 2 * len(level):
            level = self.levels.pop().merged(level)
        if len(level):
            self.levels.append(level)
        return out


@lean
def _strings(batches: Iterator[pa.RecordBatch], shards: int, hot: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each run that needs a comparison, with the shard of its anchor; hot ones in blocks by their bytes."""
    for batch in batches:
        out: dict[str, list] = {"shard": [], "doc": [], "sub": [], "at": [], "x": []}
        size = 0

        def done(out: dict[str, list]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds, strict=True)], names=list(out))

        for doc, sub, text, need in zip(*(batch.column(c) for c in ("doc", "sub", "text", "need")), strict=True):
            data, d, u = (text.as_py() or "").encode(), doc.as_py(), sub.as_py()
            need = need.as_py()
            anchors = np.array([r["anchor"] for r in need], np.int64)
            split = np.isin(anchors, hot)
            where = ((anchors.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)).tolist()
            for r, of, cut in zip(need, where, split.tolist(), strict=True):
                s, e = r["s"], r["e"]
                cuts = [(s, e, of)]
                if cut:
                    cuts = list(_blocks(data, s, e, r["anchor"], shards, length))
                for a, b, of in cuts:
                    for c, v in zip(out.values(), (of, d, u, a, data[a:b]), strict=True):
                        c.append(v)
                    size += b - a
            if size > 4 << 20:
                yield done(out)
                out, size = {c: [] for c in out}, 0
        yield done(out)


def _blocks(data: bytes, s: int, e: int, anchor: int, shards: int, length: int) -> Iterator[tuple[int, int, int]]:
    """A hot anchor's run in blocks of windows at the same distances before the anchor, with the shard of their common bytes."""
    at = s + _anchor_in(data[s:e], length)
    for d in range(0, length - GRAM + 1, BLOCK):
        # windows that start d .. d + BLOCK - 1 bytes before the anchor
        low, high = max(s, at - d - BLOCK + 1), min(e - length, at - d)
        if low <= high:
            # what every window of the whole block holds; a run's first and last blocks may have fewer windows
            common = data[at - d : at - d - BLOCK + 1 + length]
            key = hashlib.blake2b(common + anchor.to_bytes(8, "little", signed=True) + bytes([d]), digest_size=8).digest()
            yield low, high + length, int.from_bytes(key, "little") % shards


def _anchor_in(data: bytes, length: int) -> int:
    """The place of the anchor of a run's first window."""
    x = np.frombuffer(data[:length], np.uint8)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(_BYTE[x] * _POWERS[: len(x)], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * _INVERSE[: len(x) - GRAM + 1])
    return int(np.argmin((grams & ~np.uint64((1 << PIECE_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)))


@lean
def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows; rows come sorted by shard, document and place.

    A string that equals an earlier one of the shard as a whole repeats all of its windows; the others go to the index.
    """
    shard, levels = None, Levels(length)
    held: list[tuple] = []
    copies: list[tuple[int, int, int, int]] = []
    strings: set[bytes] = set()
    size = 0

    def settled() -> Iterator[pa.RecordBatch]:
        if copies:
            yield from _flat(*(np.array(c, np.int64) for c in zip(*copies, strict=True)))
            copies.clear()

    def work() -> Iterator[pa.RecordBatch]:
        nonlocal size
        size = 0
        if not held:
            return
        text = np.frombuffer(b"".join(h[3] for h in held), np.uint8)
        sizes = np.array([len(h[3]) for h in held])
        n = sizes - length + 1
        first = np.repeat(np.cumsum(sizes) - sizes, n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        again = levels.add(text, first + inner)
        doc, sub, at = (np.repeat(np.array([h[i] for h in held], np.int64), n)[again] for i in range(3))
        at = at + inner[again]
        held.clear()
        if not len(at):
            return
        edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (at[1:] != at[:-1] + 1)])
        last = np.r_[edge[1:], len(at)] - 1
        yield from _flat(doc[edge], sub[edge], at[edge], at[last] + length)

    before = None
    for batch in batches:
        for k, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc", "sub", "at", "x")), strict=True):
            if k != shard:
                yield from work()
                shard, levels, before = k, Levels(length), None
                strings.clear()
            if before == row:  # the same string of a repeated row
                continue
            before = row
            if row[3] in strings:
                doc, sub, at, x = row
                copies.append((doc, sub, at, at + len(x)))
                continue
            strings.add(row[3])
            held.append(row)
            size += len(row[3]) - length + 1
            if size > BATCH:
                yield from work()
        yield from settled()
    yield from work()


# ---- the operator


def _merge(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or []):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def keyed(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """row (all columns), text, and doc and sub, which order documents: by doc_id, and by the text's hash where an id has several texts."""
    text = F.col("text").cast("string")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"), id_.alias("doc"), F.xxhash64(text).alias("mark"))
    several = rows.groupBy("doc").agg(F.min("mark").alias("a"), F.max("mark").alias("b")).filter("a <> b")
    # written, so that Spark knows how few they are
    several = scratch.write(several.select("doc", F.lit(True).alias("many")))
    return rows.join(several, "doc", "left").withColumn("sub", F.when(F.col("many"), F.col("mark")).otherwise(0)).drop("many", "mark")


def spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """doc, sub, spans: one row a document (with `doc`, `sub` and `text`) that loses bytes; spans may overlap."""
    parts = n_parts(docs.sparkSession)
    narrow = docs.select("doc", "sub", "text")
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(parts, -(-size // SHARD_BYTES))
    found = scratch.write(
        narrow.mapInArrow(partial(_scan, shards=shards, length=length), SCANNED)
        .repartition(parts, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(partial(_settle, length=length), FLAT_SQL)
    )
    need = found.filter("need")
    n = need.count()
    # at most HOT * parts anchors
    per = need.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > max(HOT_RUNS, n // (HOT * parts)))
    hot = np.array([r.anchor for r in per.select("anchor").collect()], np.int64)
    lists = need.groupBy("doc", "sub").agg(F.collect_list(F.struct("s", "e", "anchor")).alias("need"))
    strings = partial(_strings, shards=max(4 * parts, -(-n // SHARD_RUNS)), hot=hot, length=length)
    compared = scratch.write(
        narrow.join(lists, ["doc", "sub"])
        .dropDuplicates(["doc", "sub"])
        .mapInArrow(strings, "shard int, doc long, sub long, at long, x binary")
        .repartition(parts, "shard")
        .sortWithinPartitions("shard", "doc", "sub", "at")
        .mapInArrow(partial(_compare, length=length), FLAT_SQL)
    )
    every = found.filter("NOT need").select("doc", "sub", "s", "e").unionByName(compared.select("doc", "sub", "s", "e"))
    return every.groupBy("doc", "sub").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


@lean
def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, found in zip(*(batch.column(c) for c in ("doc_id", "text", "spans")), strict=True):
            data = (text.as_py() or "").encode()
            cut = _merge(found.as_py())
            kept, at = hashlib.sha256(), 0
            for s, e in cut:
                kept.update(data[at:s])
                at = e
            kept.update(data[at:])
            out.append((doc_id.as_py(), len(data), sum(e - s for s, e in cut), len(cut), kept.hexdigest()))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def report(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scratch)
    joined = docs.join(spans(docs, scratch, length), ["doc", "sub"], "left").select("row.doc_id", "text", "spans")
    return joined.mapInArrow(_report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_out(text: str, found: list[tuple[int, int]]) -> str:
    """A text without spans of its bytes; a character goes when all of its bytes do."""
    data, at, parts = text.encode(), 0, []
    inside = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    for s, e in found:
        while inside(s):  # the character that the span starts inside of stays whole
            s += 1
        while e > s and inside(e):
            e -= 1
        if e > s:
            parts.append(data[at:s])
            at = e
    return b"".join([*parts, data[at:]]).decode()


@lean
def _kept_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, was = [], []
        for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
            cut = _merge(found.as_py())
            out.append(cut_out(text.as_py(), cut) if cut else text.as_py())
            was.append(bool(cut))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string()), pa.array(was)], names=["row", "text", "cut"])


def remove(docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """The documents with repeated passages cut out of their texts (n_chars follows); emptied ones go."""
    wide = keyed(docs, scratch)
    out = wide.join(spans(wide, scratch, length), ["doc", "sub"], "left").select("row", "text", "spans")
    schema = T.StructType([out.schema["row"], T.StructField("text", T.StringType()), T.StructField("cut", T.BooleanType())])
    cut = out.mapInArrow(_kept_text, schema).filter("NOT cut OR text <> ''")
    kinds = dict(docs.dtypes)

    def column(c: str):
        own = F.col(f"row.`{c}`")
        if c == "text":
            own = F.when(F.col("cut"), F.col("text").cast(kinds[c])).otherwise(own)
        elif c == "n_chars":
            own = F.when(F.col("cut"), F.length("text").cast(kinds[c])).otherwise(own)
        return own.alias(c)

    return cut.select(*map(column, docs.columns))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), Scratch(spark, "op8"))


#: Windows are compared by their md5; texts as hexadecimal digits, since DuckDB cuts strings by characters.
OP8_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d)
), r AS (
  SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
), g AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM r
), k AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g
), runs AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM k GROUP BY doc_id, run
), cut AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
), kept AS (
  SELECT cut.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS h,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM cut JOIN d USING (doc_id) GROUP BY cut.doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
