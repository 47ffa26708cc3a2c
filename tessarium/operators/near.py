"""Numeric kernels of the exact similarity join of texts by their character k-grams.

Two sets at Jaccard similarity t differ by (1 - t) / (1 + t) of their joint size at most. Grams are dealt by their
hashes to one part more than that number, so one part at least is the same in both sets. A set's parts are each summed up
in a signature, and sets with an equal signature of the same part are candidates, which are verified on full sets.

Set sizes fall into bands, such that sets of a pair lie in the same band or in neighbouring ones. A band fixes the number
of parts for pairs whose larger set it holds; so each set has signatures for its own band and for the next.

Parts are dealt to groups. In one group at least a pair differs by no more than the group's share of all that it may
differ by, and there a part is the same. A signature's last byte holds the parities of eight slots of its part, so that
the parts of a group tell a number by which two sets differ at least; candidates beyond the share are ruled out there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SIGNED = "band int, deal int, key long, n int, parts binary"
PAIRS = "a long, b long, na long, nb long"
FOUND = "a long, b long, jaccard double"
#: Groups to which a band's parts are dealt at least; grams of a block of texts; pairs held before they are made distinct.
DEALT, BLOCK, HELD = 8, 1 << 21, 1 << 21
#: Bytes kept of a signature, the last its parities: equal ones by chance make a candidate more, which is verified.
KEPT = 5
BLANK = " \t\n\x0b\x0c\r"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-grams of the text's stripped lines; of the text itself where it is shorter."""
    flat = " ".join(x for line in text.split("\n") if (x := line.strip(BLANK)))
    chars = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    n = max(1, len(chars) - k + 1)
    h = np.full(n, len(chars) if len(chars) < k else k, np.uint64)
    for i in range(min(k, len(chars))):
        h = _mixed(h + chars[i : i + n]) if i == 0 else h * np.uint64(0x9E3779B97F4A7C15) + chars[i : i + n]
    h = np.sort(_mixed(h))
    return h[np.r_[True, h[1:] != h[:-1]]]


def bands(threshold: float, most: int) -> list[int]:
    """The least size of each band, up to three beyond the one that holds `most`."""
    out = [1]
    beyond = 0
    while beyond < 3:
        beyond += out[-1] > most
        out.append(int(out[-1] / threshold + 1e-9) + 1)
    return out


def n_parts(threshold: float, end: int) -> int:
    """Parts for pairs whose larger set has fewer than `end` grams."""
    return int((1 - threshold) / (1 + threshold) * 2 * (end - 1) + 1e-9) + 1


def signatures(batches: Iterator[pa.RecordBatch], k: int, threshold: float, dealt: int) -> Iterator[pa.RecordBatch]:
    """Of each text and each of its two bands: the signatures of its parts, in groups of every dealt-th part."""
    ends = bands(threshold, 1 << 10)
    out: list[tuple[int, int, int, int, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["band", "deal", "key", "n", "parts"])
        out.clear()
        return made

    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
            g = grams(text.as_py(), k)
            n = len(g)
            if n >= ends[-4]:
                ends = bands(threshold, 2 * n)
            own = int(np.searchsorted(ends, n, side="right")) - 1
            for band in (own, own + 1):
                m = n_parts(threshold, ends[band + 1])
                part = (g >> np.uint64(32)) % np.uint64(m)
                # sums modulo 2 ** 64 of mixed hashes stand for sets, whatever the order
                total = np.zeros(m, np.uint64)
                np.add.at(total, part.astype(np.intp), _mixed(g ^ np.uint64(0x5851F42D4C957F2D)))
                slot = part.astype(np.intp) * 8 + ((g >> np.uint64(29)) & np.uint64(7)).astype(np.intp)
                odd = np.packbits((np.bincount(slot, minlength=8 * m) & 1).astype(np.uint8).reshape(m, 8), axis=1)
                low = np.hstack([total.view(np.uint8).reshape(m, 8)[:, : KEPT - 1], odd])
                for d in range(min(dealt, m)):
                    out.append((band, d, key, n, low[d::dealt].tobytes()))
                size += m * KEPT + 30 * min(dealt, m)
            if size > 4 << 20:
                yield flush()
                size = 0
    if out:
        yield flush()


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Runs of rows that agree in the keys, of rows sorted by them."""
    at, held = None, []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(c).to_numpy() for c in keys]
        new = np.zeros(n, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist()]
        for first, last in zip(starts, [*starts[1:], n], strict=True):
            here = tuple(int(c[first]) for c in cols)
            if here != at:
                if held:
                    yield at, held
                at, held = here, []
            held.append(batch.slice(first, last - first))
    if held:
        yield at, held


def _distinct(codes: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)


def least_differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """By how many grams the parts of each pair (pair, part, byte) differ at least."""
    apart = x ^ y
    odd = np.bitwise_count(apart[:, :, -1]).astype(np.int64)
    return np.where(odd > 0, odd, 2 * apart.any(axis=2)).sum(axis=1)


def candidates(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of sets that share a signature and whose sizes allow the threshold; those of a group of parts once."""
    for (band, _), held in _groups(batches, ["band", "deal"]):
        rows = pa.Table.from_batches(held)
        key, n = rows.column("key").to_numpy(), rows.column("n").to_numpy().astype(np.int64)
        if len(key) < 2:
            continue
        ends = bands(threshold, int(n.max()))
        start, share = ends[band], (1 - threshold) / (1 + threshold) / n_parts(threshold, ends[band + 1])
        each = len(rows.column("parts")[0].as_py()) // KEPT
        parts = np.frombuffer(b"".join(rows.column("parts").to_pylist()), np.uint8).reshape(len(key), each, KEPT)
        codes: list[np.ndarray] = []
        have = 0
        for p in range(each):
            wide = np.zeros((len(key), 8), np.uint8)
            wide[:, :KEPT] = parts[:, p]
            sig = wide.view("<u8").ravel()
            order = np.argsort(sig, kind="stable")
            sig = sig[order]
            first, d = np.arange(len(sig) - 1), 1
            while len(first):
                first = first[first + d < len(sig)]
                first = first[sig[first] == sig[first + d]]
                i, j = order[first], order[first + d]
                # pairs below this band meet in their own
                fit = ((n[i] >= start) | (n[j] >= start)) & (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9)
                i, j = i[fit], j[fit]
                codes.append(np.minimum(i, j) * len(key) + np.maximum(i, j))
                have += len(i)
                if have > HELD:
                    codes = [_distinct(codes)]
                    have = len(codes[0]) // 2
                d += 1
        code = _distinct(codes)
        step = max(1, (4 << 20) // (each * KEPT))
        for at in range(0, len(code), step):
            i, j = np.divmod(code[at : at + step], len(key))
            fit = least_differences(parts[i], parts[j]) <= share * each * (n[i] + n[j]) + 1e-6
            i, j = i[fit], j[fit]
            swap = key[i] > key[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[i], key[j], n[i], n[j])], names=["a", "b", "na", "nb"])


def verified(batches: Iterator[pa.RecordBatch], k: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """The pairs of each block that reach the threshold; a block's texts come before its pairs."""
    for _, held in _groups(batches, ["block"]):
        sets: dict[int, np.ndarray] = {}
        for batch in held:
            asked = batch.filter(batch.column("b").is_valid())
            texts = batch.filter(batch.column("b").is_null())
            for key, text in zip(texts.column("a").to_pylist(), texts.column("text"), strict=True):
                sets[key] = grams(text.as_py(), k)
            out = []
            for a, b in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist(), strict=True):
                x, y = sets[a], sets[b]
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                jaccard = same / (len(x) + len(y) - same)
                if jaccard >= threshold:
                    out.append((a, b, jaccard))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["a", "b", "jaccard"])
