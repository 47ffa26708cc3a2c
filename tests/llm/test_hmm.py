"""op7 against textbook loops: Baum-Welch over whole texts, scores end to end, and how rows are dealt."""

import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessarium.llm import hmm
from tessarium.llm.common import LOWER, Scratch


def model(states, symbols, seed=0):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states), rng.random((states, states)), rng.random((symbols, states)) ** 3
    return hmm.Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def naive(m, seq):
    s = len(m.start)
    alpha = [m.start * m.emit[seq[0]]]
    for x in seq[1:]:
        alpha.append((alpha[-1] @ m.move) * m.emit[x])
    beta = [np.ones(s)]
    for x in seq[:0:-1]:
        beta.insert(0, m.move @ (m.emit[x] * beta[0]))
    p = alpha[-1].sum()
    gamma = [a * b / p for a, b in zip(alpha, beta, strict=True)]
    moves, emitted = np.zeros((s, s)), np.zeros((len(m.emit), s))
    for t in range(1, len(seq)):
        moves += alpha[t - 1][:, None] * m.move * (m.emit[seq[t]] * beta[t])[None] / p
    for t, x in enumerate(seq):
        emitted[x] += gamma[t]
    return gamma[0], moves, emitted, np.log10(p)


@pytest.mark.parametrize(("piece", "step"), [(1024, 300_000), (4, 10), (1, 7), (5, 1)])
def test_expected_counts_of_whole_texts(monkeypatch, piece, step):
    monkeypatch.setattr(hmm, "PIECE", piece)
    monkeypatch.setattr(hmm, "STEP", step)
    rng = np.random.default_rng(1)
    m = model(3, 6)
    seqs = [rng.integers(0, 6, n) for n in (1, 4, 5, 23, 8, 9, 40, 2)]
    got = m.expect(seqs)
    want = [sum(x) for x in zip(*(naive(m, q) for q in seqs), strict=True)]
    for a, b in zip(got, want, strict=True):
        assert np.allclose(a, b, atol=1e-9)
    assert np.allclose(m.forward(seqs), [naive(m, q)[3] for q in seqs])


def documents(n=80):
    rng = np.random.default_rng(9)
    vocab = [f"w{i}" for i in range(60)] + ["The", "straße.", "x,y"]
    weights = 1 / np.arange(1, len(vocab) + 1)
    rows = [(i, " ".join(rng.choice(vocab, int(rng.integers(0, 60)), p=weights / weights.sum())) + f" once{i}") for i in range(n)]
    return [*rows, (None, "the w1"), (None, None), (200, None), (201, " \n"), (202, "w1 " * 900), (5, rows[5][1]), (5, "other words")]


def test_scores_end_to_end(spark, monkeypatch):
    for name, value in (("EMITTED", 20), ("CLASSES", 8), ("PIECE", 16)):
        monkeypatch.setattr(hmm, name, value)
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS uid", "2 AS ids", "3 AS h").repartition(3)
    tokens = [[*(t or "").encode().translate(LOWER).split(), b"\n"] for _, t in rows]
    out = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for t, held in zip(tokens, out, strict=True) if not held for w in t)
    rank = sorted(count, key=lambda w: (-count[w], xxhash.xxh64_intdigest(w)))
    own = {w: 1 + k for k, w in enumerate(rank[:20])}
    own[b"\n"] = 0
    total = Counter({c: 1 for c in range(8)})
    for w, n in count.items():
        if w not in own:
            total[hmm.word_class(w, 8)] += n + 1
    for known in (1_000_000, 30):
        encoded, _, _, m = hmm.learn(df, Scratch(spark, "t"), rounds=2, states=3, known=known)
        got = Counter()
        for r in hmm.score(df, Scratch(spark, "t"), rounds=2, states=3, known=known).collect():
            got[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)] += 1
        want = Counter()
        n, v = sum(count.values()), len(count)
        for (i, _), t, held in zip(rows, tokens, out, strict=True):
            symbols = [own.get(w, 21 + hmm.word_class(w, 8)) for w in t]
            a, score = m.start, 0.0
            for k, x in enumerate(symbols):
                a = (a if k == 0 else a @ m.move) * m.emit[x]
                score += np.log10(a.sum())
                a = a / a.sum()
            score += sum(np.log10((count[w] + 1) / total[hmm.word_class(w, 8)]) for w in t if w not in own)
            base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in t)
            want[i, held, len(t), sum(count[w] > 0 for w in t), n, round(float(base), 6), round(float(score), 6)] += 1
        assert got == want


def test_scores_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(documents(150), "doc_id long, text string")
    runs = []
    for n in (1, 6):
        found = hmm.score(df.repartition(n), Scratch(spark, "t"), rounds=3, states=4).collect()
        runs.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in found))
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 for a, b in zip(*runs, strict=True))


def test_model_beats_the_base_on_held_out_documents(spark):
    """Runs of words of one subject after another, which latent states can tell apart."""
    rng = np.random.default_rng(2)
    groups = [[f"{g}{i}" for i in range(12)] for g in "abcd"]
    text = lambda: " ".join(str(rng.choice(groups[k // 10 % 4])) for k in range(int(rng.integers(20, 80))))
    df = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    got = hmm.score(df, Scratch(spark, "t"), states=6).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first().asDict()
    assert got["sum(score)"] > 0.9 * got["sum(base_score)"]
