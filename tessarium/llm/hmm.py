"""LM scoring with a hidden Markov model over words.

Training documents are those whose crc32(doc_id as text) mod 7 is not 2. Every distinct word of all
of them is counted (words are identified by 64-bit hashes). The EMITTED most frequent words are
emission symbols of their own; any other word belongs to one of CLASSES classes by its ending, and
has probability (c + 1) / (C + V + 1) within the class, with C tokens and V words in the class and
one more place for unseen words. So P(text) is a proper sum over state paths, and the scaled forward
recursion gives it exactly for the whole text.

Baum-Welch starts from a model fitted to a bounded sample (whole texts with the smallest hashes) and then runs over
all training tokens until the likelihood gains less than SETTLED of itself, ROUNDS times at most. Each partition
adds up its expected counts, one row a symbol; Spark sums them by symbol, with no task that reads more than its
share of the symbols; the driver normalises one table of STATES x symbols. Texts are never cut: one of several
PIECEs is the product of its pieces' transfer matrices, from which forward vectors enter each piece and backward
vectors leave it, so that pieces run side by side, counts are exact, and memory is bounded for any length.

Counts of the KNOWN most frequent words travel to the workers (a bounded table); the rarer words of
each document are joined to the full count table in Spark and added to its scores.

Defined cases: null text is empty (one end token); a null doc_id counts as the empty text for the
hash; rows that repeat are scored one by one; without training rows every count is 0 (N = V = 0)
and score is the uniform start model's; an empty table gives an empty result; extra columns are
ignored. Ties in frequency go to the smaller hash. The sums are in double precision, so that scores do not depend on
how rows are dealt to partitions but for its rounding.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Numbers, Scratch, chunks, lean, table

STATES, ROUNDS, SETTLED, PIECE = 12, 4, 1e-2, 2048
EMITTED, CLASSES, KNOWN = 32_768, 1024, 1_000_000
#: The start model's sample: at most so many texts, of at most so many tokens each, and so many tokens in all.
SEED_TEXTS, SEED_LONGEST, SEED_TOKENS, SEED_ROUNDS, SEED = 2000, 20_000, 150_000, 40, 3
#: Tokens whose texts, and tokens whose pieces, a task holds at a time.
HELD, STEP = 1_600_000, 800_000
END_WORD = b"\n"  # no word holds white space
_END = np.uint64(xxhash.xxh64_intdigest(END_WORD))
_MARKS = b".,;:!?|\"'()[]-"


def word_class(word: bytes, classes: int) -> int:
    core = word.rstrip(_MARKS)
    return xxhash.xxh32_intdigest(core[-3:] + b"\x00" + word[len(core) : len(core) + 1]) % classes


class Chunk:
    """The distinct words of some texts, and each text as places among them; every text ends in the end word."""

    def __init__(self, texts: list[str | None]):
        place = Numbers({END_WORD: 0})
        flat: list[int] = []
        self.n = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            words = (t or "").encode().translate(LOWER).split()
            flat.extend(map(place.__getitem__, words))
            flat.append(0)
            self.n[i] = len(words) + 1
        self.flat = np.array(flat, np.int64)
        self.words = list(place)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))


@lean
def _count(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    """(h, cls, n) of the words of a partition, pre-aggregated as far as memory allows."""
    total: dict[int, list] = {}

    def flush() -> pa.RecordBatch:
        h = np.fromiter(total, np.uint64, len(total)).view(np.int64)
        cls, n = (np.array(x, np.int64) for x in zip(*total.values(), strict=True))
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(cls.astype(np.int32)), pa.array(n)], names=["h", "cls", "n"])

    for batch in chunks(batches, 8 << 20):
        texts = batch.column("text").to_pylist()
        found: Counter = Counter()
        for t in texts:
            found.update((t or "").encode().translate(LOWER).split())
        found[END_WORD] = len(texts)
        for w, k in found.items():
            h = xxhash.xxh64_intdigest(w)
            if h in total:
                total[h][1] += k
            else:
                total[h] = [word_class(w, classes), k]
        if len(total) > 250_000:
            yield flush()
    if total:
        yield flush()


class Lexicon:
    """Counts and symbols of the known words, class totals, N and V."""

    def __init__(self, h: np.ndarray, cls: np.ndarray, n: np.ndarray, class_n: np.ndarray, class_v: np.ndarray):
        order = np.argsort(h)
        self.h, cls, self.n = h[order], cls[order], n[order]
        self.N, self.V = int(class_n.sum()), int(class_v.sum())
        self.emitted, self.classes = EMITTED, len(class_n)
        own = np.lexsort((self.h, -self.n))[: self.emitted]
        self.symbol = (1 + self.emitted + cls).astype(np.int32)
        self.symbol[own] = 1 + np.arange(len(own), dtype=np.int32)
        # the end token is symbol 0, whatever its rank
        c, v = class_n.astype(float), class_v.astype(float)
        np.subtract.at(c, cls[own], self.n[own])
        np.subtract.at(v, cls[own], 1)
        self.class_total = c + v + 1
        self.end_n = 0
        if len(self.h) and (at := np.searchsorted(self.h, _END)) < len(self.h) and self.h[at] == _END:
            self.symbol[at], self.end_n = 0, int(self.n[at])
            if at not in own:
                self.class_total[cls[at]] -= self.end_n + 1

    def look_up(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each distinct word: symbol, count (0 if not known here), whether it is known here."""
        if len(self.h):
            at = np.searchsorted(self.h, chunk.hashes)
            at[at == len(self.h)] = 0
            hit = self.h[at] == chunk.hashes
            symbol, n = self.symbol[at], np.where(hit, self.n[at], 0)
        else:
            hit = np.zeros(len(chunk.words), bool)
            symbol, n = np.zeros(len(hit), np.int32), np.zeros(len(hit), np.int64)
        for i in np.flatnonzero(~hit).tolist():
            symbol[i] = 0 if i == 0 else 1 + self.emitted + word_class(chunk.words[i], self.classes)
        hit = hit.copy()
        hit[0] = True
        return symbol, n, hit


@lean
def _encode(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """Symbols of each document with the parts of its scores that need no further join."""
    from pyspark import TaskContext

    lex: Lexicon = held.value
    uid = TaskContext.get().partitionId() << 40
    log_all = np.log10(lex.N + lex.V + 1.0)
    for batch in chunks(batches, 6 << 20):
        chunk = Chunk(batch.column("text").to_pylist())
        symbol, n, hit = lex.look_up(chunk)
        base = np.where(hit, np.log10(n + 1.0) - log_all, -log_all)
        classed = symbol > lex.emitted
        total = np.log10(lex.class_total[np.where(classed, symbol - 1 - lex.emitted, 0)])
        inner = np.where(classed, np.where(hit, np.log10(n + 1.0), 0.0) - total, 0.0)
        start = np.cumsum(chunk.n) - chunk.n
        sums = lambda x: np.add.reduceat(x[chunk.flat], start)
        ids = symbol[chunk.flat].astype("<i4")
        miss = ~hit[chunk.flat]
        # unknown words of each text, one list after another
        ends = np.r_[0, np.cumsum(miss)][np.r_[start, len(chunk.flat)]]
        rare = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(chunk.hashes[chunk.flat[miss]].view(np.int64)))
        m = len(chunk.n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(uid, uid + m)),
                batch.column("doc_id").combine_chunks(),
                batch.column("held_out").combine_chunks(),
                pa.array(chunk.n),
                pa.array(sums((n > 0).astype(np.int64))),
                pa.array(sums(base)),
                pa.array(sums(inner)),
                pa.array([ids[a : a + k].tobytes() for a, k in zip(start.tolist(), chunk.n.tolist(), strict=True)], pa.binary()),
                rare,
            ],
            names=["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "inner", "ids", "rare"],
        )
        uid += m


ENCODED = (
    "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
    "ids binary, rare array<long>"
)


class Hmm:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # emit: symbols x states
        self.piece, self.step = PIECE, STEP

    def forward(self, seqs: list[np.ndarray]) -> np.ndarray:
        """log10 P of each symbol sequence by the scaled forward recursion, longest sequences first inside."""
        n = np.array([len(s) for s in seqs])
        order = np.argsort(-n, kind="stable")
        out = np.zeros(len(seqs))
        if not len(seqs):
            return out
        lengths = n[order]
        flat = np.concatenate([seqs[i] for i in order])
        first = np.cumsum(lengths) - lengths
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        logs = np.zeros(len(seqs))
        a = np.broadcast_to(self.start, (len(seqs), len(self.start)))
        for t in range(int(lengths[0])):
            k = int(alive[t])
            a = (a[:k] if t == 0 else a[:k] @ self.move) * self.emit[flat[first[:k] + t]]
            scale = a.sum(axis=1)
            a = a / scale[:, None]
            logs[:k] += np.log10(scale)
        out[order] = logs
        return out

    def _transfer(self, flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of each piece (longest first) the matrix from the states before its first token to those at its end, scaled."""
        s = len(self.start)
        x = np.broadcast_to(np.eye(s), (len(n), s, s)).copy()
        alive = np.searchsorted(-n, -np.arange(n[0]), side="left")
        for t in range(int(n[0])):
            k = int(alive[t])
            y = x[:k] if t == 0 else (x[:k].reshape(-1, s) @ self.move).reshape(k, s, s)
            y = y * self.emit[flat[first[:k] + t]][:, None, :]
            if t % 8 == 7:
                y /= y.sum(axis=(1, 2), keepdims=True)
            x[:k] = y
        return x / x.sum(axis=(1, 2), keepdims=True)

    def _borders(self, flat: np.ndarray, first: np.ndarray, n: np.ndarray, of: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The forward vector before each piece (that at the end of the piece before) and the backward one at its end."""
        s = len(self.start)
        before, after = np.zeros((len(n), s)), np.ones((len(n), s))
        many = np.flatnonzero((nth > 0) | np.r_[nth[1:] > 0, False])
        if not len(many):
            return before, after
        order = many[np.argsort(-n[many], kind="stable")]
        matrix = np.empty((len(n), s, s)) if len(many) == len(n) else {}
        for at in range(0, len(order), 1024):
            some = order[at : at + 1024]
            for i, m in zip(some.tolist(), self._transfer(flat, first[some], n[some]), strict=True):
                matrix[i] = m
        last = 0
        for k in range(int(nth.max()) + 1):
            for i in np.flatnonzero(nth == k).tolist() if k else ():
                enter = self.start if k == 1 else before[i - 1] @ self.move
                x = enter @ matrix[i - 1]
                before[i] = x / x.sum()
            last = k
        for k in range(last, 0, -1):
            for i in np.flatnonzero(nth == k).tolist():
                x = self.move @ (matrix[i] @ after[i])
                after[i - 1] = x / x.sum()
        return before, after

    def expect(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of starts, moves and emissions of whole sequences (Baum-Welch), and their log10 P."""
        s = len(self.start)
        starts, moves, logs = np.zeros(s), np.zeros((s, s)), 0.0
        emitted = np.zeros((len(self.emit), s))
        size = np.array([len(x) for x in seqs])
        flat = np.concatenate(seqs)
        per = -(-size // self.piece)
        of = np.repeat(np.arange(len(seqs)), per)
        nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        first = np.repeat(np.cumsum(size) - size, per) + nth * self.piece
        n = np.minimum(np.repeat(size, per) - nth * self.piece, self.piece)
        before, after = self._borders(flat, first, n, of, nth)
        order = np.argsort(-n, kind="stable")
        cuts = np.searchsorted(np.cumsum(n[order]), np.arange(self.step, int(n.sum()) + self.step, self.step))
        for some in np.split(order, np.unique(cuts + 1)):
            if len(some):
                logs += self._pieces(flat, first[some], n[some], nth[some] == 0, before[some], after[some], starts, moves, emitted)
        return starts, moves, emitted, logs

    def _pieces(self, flat, first, n, opens, before, after, starts, moves, emitted) -> float:
        """Adds what pieces (longest first) expect, given the vectors at their borders."""
        s, steps = len(self.start), int(n[0])
        alive = np.searchsorted(-n, -np.arange(steps), side="left")
        at = np.concatenate([first[: int(k)] + t for t, k in enumerate(alive)])
        rows = np.cumsum(alive) - alive
        symbol = flat[at]
        alpha, scale, ones = np.empty((len(at), s)), np.empty((len(at), 1)), np.ones((s, 1))
        for t in range(steps):
            k, r = int(alive[t]), int(rows[t])
            enter = np.where(opens[:, None], self.start, before @ self.move) if t == 0 else alpha[int(rows[t - 1]) :][:k] @ self.move
            x = np.multiply(enter, self.emit[symbol[r : r + k]], out=alpha[r : r + k])
            c = np.matmul(x, ones, out=scale[r : r + k])
            x /= c
        logs = float(np.log10(scale).sum())
        beta = np.zeros((0, s))
        back = np.ascontiguousarray(self.move.T)
        for t in range(steps - 1, -1, -1):
            k, r = int(alive[t]), int(rows[t])
            a = alpha[r : r + k]
            if len(beta) < k:
                new = after[len(beta) : k]
                new = new / (a[len(beta) :] * new).sum(axis=1, keepdims=True)
                beta = np.concatenate([beta, new])
            z = self.emit[symbol[r : r + k]] * beta
            z /= scale[r : r + k]
            a *= beta  # from here on the state's probabilities given the whole text
            if t:
                moves += self.move * (alpha[int(rows[t - 1]) :][:k].T @ z)
                beta = z @ back
            else:
                starts += a[opens].sum(axis=0)
                moves += self.move * (before[~opens].T @ z[~opens])
        for j in range(s):
            emitted[:, j] += np.bincount(symbol, weights=alpha[:, j], minlength=len(emitted))
        return logs


def maximise(starts: np.ndarray, moves: np.ndarray, emitted: np.ndarray, usual: np.ndarray) -> Hmm:
    """Normalised counts; each state's emissions keep a little of the symbols' overall shares."""
    start = starts + 0.1
    move = moves + 1.0
    emit = emitted + 20.0 * usual[:, None]
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def seed_model(sample: list[bytes], usual: np.ndarray, states: int) -> Hmm:
    """A model fitted to a bounded sample from a random start."""
    rng = np.random.default_rng(SEED)
    move = np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
    emit = usual[:, None] * rng.uniform(0.3, 1.7, (len(usual), states))
    model = Hmm(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(axis=0))
    seqs = [np.frombuffer(ids, "<i4") for ids in sample]
    for _ in range(SEED_ROUNDS if seqs else 0):
        model = maximise(*model.expect(seqs)[:3], usual)
    return model


#: Rows of a partition's sums that belong to no symbol: log10 P and tokens, starts, then moves from each state.
LIKELIHOOD, STARTS, MOVES = -1, -2, -3


@lean
def _expected(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """The expected counts of a partition: one row a symbol that it holds, and a row a state."""
    model: Hmm = held.value
    s = len(model.start)
    sums = [np.zeros(s), np.zeros((s, s)), np.zeros((len(model.emit), s))]
    logs, size, tokens = 0.0, 0, 0
    todo: list[np.ndarray] = []

    def work() -> None:
        nonlocal logs, size
        *got, more = model.expect(todo)
        for to, x in zip(sums, got, strict=True):
            to += x
        logs += more
        todo.clear()
        size = 0

    for batch in batches:
        for ids in batch.column("ids"):
            todo.append(np.frombuffer(ids.as_py(), "<i4"))
            size += len(todo[-1])
            tokens += len(todo[-1])
            if size > HELD:
                work()
    if todo:
        work()
    if not tokens:
        return
    some = np.flatnonzero(sums[2].sum(axis=1))
    whole = np.zeros((1, s))
    whole[0, :2] = logs, tokens
    keys = np.r_[LIKELIHOOD, STARTS, MOVES - np.arange(s), some]
    rows = np.concatenate([whole, sums[0][None], sums[1], sums[2][some]])
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys.astype(np.int32)), *(pa.array(rows[:, j].copy()) for j in range(s))], names=["symbol", *(f"s{j}" for j in range(s))]
    )


def fit(encoded: DataFrame, usual: np.ndarray, rounds: int, states: int) -> Hmm:
    assert states > 1
    train = encoded.filter("NOT held_out").select("ids")
    short = encoded.filter(f"NOT held_out AND n_tokens <= {SEED_LONGEST}").select("uid", "n_tokens", F.xxhash64("ids").alias("h"))
    uids, size = [], 0
    # the same texts however rows are dealt; only numbers are ordered, then those texts fetched
    for row in short.orderBy("h", "n_tokens", "uid").limit(SEED_TEXTS).collect():
        uids.append(row.uid)
        size += row.n_tokens
        if size > SEED_TOKENS:
            break
    chosen = encoded.filter(F.col("uid").isin(uids)).select("ids", F.xxhash64("ids").alias("h")).collect()
    sample = [bytes(r.ids) for r in sorted(chosen, key=lambda r: (r.h, r.ids))]
    model, last = seed_model(sample, usual, states), None
    cols = [f"s{j}" for j in range(states)]
    schema = ", ".join(["symbol int", *(f"{c} double" for c in cols)])
    for _ in range(rounds):
        held = encoded.sparkSession.sparkContext.broadcast(model)
        sums = train.mapInArrow(partial(_expected, held=held), schema).groupBy("symbol").agg(*(F.sum(c).alias(c) for c in cols))
        got = sums.toArrow()  # one row a symbol
        held.unpersist()
        if not got.num_rows:
            break
        key = got.column("symbol").to_numpy()
        x = np.stack([got.column(c).to_numpy() for c in cols], axis=1)
        emitted = np.zeros((len(usual), states))
        emitted[key[key >= 0]] = x[key >= 0]
        row = {int(k): v for k, v in zip(key[key < 0], x[key < 0], strict=True)}
        logs, tokens = row[LIKELIHOOD][:2]
        model = maximise(row[STARTS], np.stack([row[MOVES - j] for j in range(states)]), emitted, usual)
        if last is not None and logs - last < SETTLED * abs(last):
            break
        last = logs
    return model


@lean
def _score(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model: Hmm = held.value
    for batch in batches:
        seqs = [np.frombuffer(x.as_py(), "<i4") for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(model.forward(seqs))], names=["uid", "path"])


def learn(
    docs: DataFrame, scratch: Scratch, rounds: int = ROUNDS, states: int = STATES, known: int = KNOWN
) -> tuple[DataFrame, DataFrame, Lexicon, Hmm]:
    """Encoded documents, the counts that travel to no worker, the lexicon and the model."""
    spark = docs.sparkSession
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    counts = scratch.write(
        docs.filter("NOT held_out").select("text").mapInArrow(partial(_count, classes=CLASSES), "h long, cls int, n long")
        .groupBy("h").agg(F.first("cls").alias("cls"), F.sum("n").alias("n"))
    )
    # words by size class of their counts; the classes from `cut` on hold at most `known` words
    size = F.floor(F.log2("n") * 8).cast("int")
    per = np.zeros(8 * 64 + 2, np.int64)
    for r in counts.groupBy(size.alias("b")).count().collect():
        per[r.b] = r["count"]
    cut = int(np.flatnonzero(np.cumsum(per[::-1])[::-1] <= known)[0])
    end = F.col("h") == F.lit(int(_END.view(np.int64)))  # always known, however few words are
    head = (size >= cut) | end
    top = counts.filter(head)
    got = top.toArrow()
    h, cls, n = (got.column(c).to_numpy() for c in ("h", "cls", "n"))
    class_n, class_v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        class_n[r.cls], class_v[r.cls] = r.n, r.v
    lex = Lexicon(h.astype(np.int64).view(np.uint64), cls, n, class_n, class_v)
    usual = np.full(1 + EMITTED + CLASSES, 1e-9)
    np.add.at(usual, lex.symbol, lex.n / max(1, lex.N))
    usual[1 + EMITTED :] += lex.class_total / max(1.0, lex.class_total.sum()) * max(0.0, 1 - usual.sum())
    usual += 1e-7
    usual /= usual.sum()

    held = spark.sparkContext.broadcast(lex)
    encoded = scratch.write(docs.select("doc_id", "held_out", "text").mapInArrow(partial(_encode, held=held), ENCODED))
    return encoded, counts.filter(~head).select("h", "n"), lex, fit(encoded, usual, rounds, states)


def score(docs: DataFrame, scratch: Scratch, rounds: int = ROUNDS, states: int = STATES, known: int = KNOWN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    encoded, rarer, lex, model = learn(docs, scratch, rounds, states, known)
    path = encoded.select("uid", "ids").mapInArrow(
        partial(_score, held=spark.sparkContext.broadcast(model)), "uid long, path double"
    )
    rare = (
        encoded.select("uid", F.explode("rare").alias("h"))
        .join(rarer, "h")
        .groupBy("uid")
        .agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("more"))
    )
    zero = F.lit(0.0)
    return (
        encoded.drop("ids", "rare")
        .join(path, "uid")
        .join(rare, "uid", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(lex.N).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
            (F.col("path") + F.col("inner") + F.coalesce("more", zero)).alias("score"),
        )
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), Scratch(spark, "op7"))
