"""op4 against an independent interpolated modified Kneser-Ney model on dictionaries, and its defined cases."""

import math
import pathlib
import pickle
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessarium.llm import kneser_ney as kn
from tessarium.llm.common import KEPT, Scratch, lean


def corpus(n=140, seed=3):
    rng = np.random.default_rng(seed)
    vocab = ["the", "of", "Und", "straße", "x.", "A1", *(f"w{i}" for i in range(40))]
    weights = 1 / np.arange(1, len(vocab) + 1)
    make = lambda k: " ".join(rng.choice(vocab, k, p=weights / weights.sum()))
    texts = [make(int(rng.integers(1, 60))) + (f" Rare{chr(97 + i % 26)}{chr(97 + i // 26)}" if i % 3 else "") for i in range(n)]
    return [(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts)]


class Brute:
    """Interpolated modified Kneser-Ney as the textbook has it, one dictionary an order."""

    def __init__(self, texts):
        count = Counter(w for t in texts for w in t.split())
        shapes = Counter(kn.shape(w.encode()) for w, c in count.items() if c < 2)
        self.words = {w for w, c in count.items() if c >= 2} | {s for s, c in shapes.items() if c >= 2}
        three = Counter()
        for t in texts:
            x = ["<s>", "<s>", *map(self.token, t.split()), "</s>"]
            three.update(zip(x, x[1:], x[2:], strict=False))
        two = Counter((v, w) for _, v, w in three)
        one = Counter((w,) for _, w in two)
        self.orders = []
        for grams in (one, two, three):
            n = [sum(c == k for c in grams.values()) for k in (1, 2, 3, 4)]
            d = [0.5, 0.75, 0.9]
            if min(n):
                y = n[0] / (n[0] + 2 * n[1])
                d = [min(max(k - (k + 1) * y * n[k] / n[k - 1], lo), hi) for k, lo, hi in ((1, 0.05, 0.95), (2, 0.1, 1.9), (3, 0.1, 2.9))]
            after = defaultdict(Counter)
            for g, c in grams.items():
                after[g[:-1]][g[-1]] = c
            self.orders.append((d, after))

    def token(self, w):
        if w in self.words:
            return w
        s = kn.shape(w.encode())
        return s if s in self.words else "<unk>"

    def p(self, context, w):
        if len(context) == 0:
            lower = 1 / (len(self.words) + 3)
        else:
            lower = self.p(context[1:], w)
        d, after = self.orders[len(context)]
        seen = after.get(tuple(context))
        if not seen:
            return lower
        total = sum(seen.values())
        left = sum(d[min(c, 3) - 1] for c in seen.values()) / total
        c = seen.get(w, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total + left * lower

    def log10(self, text):
        x = ["<s>", "<s>", *map(self.token, text.split()), "</s>"]
        return [math.log10(self.p((u, v), w)) for u, v, w in zip(x, x[1:], x[2:], strict=False)]


@pytest.mark.parametrize(("shard", "chunk"), [(1 << 19, 4 << 20), (50, 700)])
def test_perplexity_and_verdicts_are_those_of_brute_force(spark, monkeypatch, shard, chunk):
    monkeypatch.setattr(kn, "SHARD_GRAMS", shard)
    monkeypatch.setattr(kn, "CHUNK", chunk)
    rows = corpus()
    junk = [(500, "ZZ QQ !!## " * 9, "en"), (501, "of the", "fr"), (502, None, "en"), (503, " \n", None), (None, "the of the of", "de")]
    df = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(120)] + [(7, 0, 0), (9, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    s = Scratch(spark, "t")
    good = {r.doc_id: r.fold for r in kn.trusted(df, labels).collect()}
    assert set(good) == set(range(120)) - {7, 9}
    model = Brute([t for i, t, _ in rows if good.get(i, 0) != 0])
    got = {(r.doc_id, r.lang): r for r in kn.judged(df, labels, s).collect()}
    assert len(got) == len(rows) + len(junk)
    held = defaultdict(list)
    for i, t, lang in rows + junk:
        r = got[i, lang]
        logs = model.log10(t or "")
        assert r.n_tokens == len(logs)
        assert abs(r.lp - sum(logs)) < 1e-9
        windows = [-sum(logs[k : k + kn.WINDOW]) / kn.WINDOW for k in range(len(logs) - kn.WINDOW + 1)] if len(logs) > kn.WINDOW else []
        assert (r.worst is None) == (not windows) and (not windows or abs(r.worst - max(windows)) < 1e-9)
        if good.get(i) == 0:
            for of in (lang, "all"):
                held[of].append(-sum(logs) / len(logs))
    for (_, lang), r in got.items():
        costs = sorted(held[lang] if lang in held and lang is not None else held["all"])
        limit = math.ceil(costs[math.ceil(kn.QUANTILE * len(costs)) - 1] * kn.GRID) / kn.GRID
        assert abs(r.most_cost - limit) < 1e-9
        if r.n_tokens == 1:
            assert r.kept
        elif -r.lp / r.n_tokens > limit + kn.ALLOWANCE / math.sqrt(r.n_tokens):
            assert not r.kept
    assert not got[500, "en"].kept


def test_probabilities_sum_to_one():
    brute = Brute(["a b a c", "a b b", "c a b a", "b a"])
    vocabulary = [*brute.words, "</s>", "<s>", "<unk>"]
    for context in (("<s>", "<s>"), ("a", "b"), ("b", "c"), ("<unk>", "a")):
        assert abs(sum(brute.p(context, w) for w in vocabulary) - 1) < 1e-9


def test_clashing_columns_and_repeated_rows_are_kept(spark):
    rows = [(i % 60, "the cat sat on the mat " * 4 + f"w{i % 7}", "en", i, i, 0.5, "x") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lp int, n_tokens int, kept double, row string")
    df = df.selectExpr("*", "1 AS m1", "2 AS m2", "3 AS chunk", "4 AS worst", "5 AS strange", "6 AS trusted", "7 AS `a.b`")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    out = kn.filter_documents(df, labels, Scratch(spark, "t"))
    assert out.columns == df.columns and Counter(out.collect()) == Counter(df.collect())


def test_one_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(kn, "CHUNK", 500)
    rows = [(i, "the cat sat on the mat " * 3, "en") for i in range(50)] + [(99, "the cat sat on the mat " * 3000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kn.judged(df, labels, Scratch(spark, "t")).collect()}
    assert got[99].n_tokens == 18001 and got[99].kept


def test_every_trusted_document_is_counted(spark):
    rows = [(i, f"the cat w{i % 900} sat", "en") for i in range(6000)] + [(6001, "a b c d e " * 320_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = df.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    good = kn.trusted(df, labels).withColumn("fold", F.when(F.col("doc_id") == 6001, 1).otherwise(F.col("fold")))
    trained = {r.doc_id for r in good.filter("fold <> 0").collect()}
    model, tables = kn.train(df, good, Scratch(spark, "t"))
    counts = [kn.unpack(r.x)[1] for r in tables.filter(F.col("what") == kn.GRAMS3).collect()]
    assert sum(int(c.sum()) for c in counts) == sum(len(t.split()) + 1 for i, t, _ in rows if i in trained)
    assert {b"the", b"cat", b"sat", b"a", b"e"} <= set(model.words)


def test_vocabulary_ends_at_the_count_at_which_ids_run_out(spark, monkeypatch):
    counted = spark.createDataFrame([(f"w{i}".encode(), 9 - i // 2) for i in range(10)] + [(b"Ab", 1), (b"Cd", 1)], "word binary, n long")
    assert kn.vocabulary(counted, Scratch(spark, "t")) == [*(f"w{i}".encode() for i in range(10)), kn.shape(b"Ab")]
    monkeypatch.setattr(kn, "BITS", 4)
    assert kn.vocabulary(counted, Scratch(spark, "t")) == [f"w{i}".encode() for i in range(8)]


def test_turns_agree_and_leave_only_the_result(spark, monkeypatch):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    good, found = kn.trusted(df, labels), []
    for turn in (1 << 30, 12_000):
        monkeypatch.setattr(kn, "TURN", turn)
        s = Scratch(spark, "t")
        out = kn.measure(df, good, s)
        found.append(sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in out.collect()))
        assert [p.name for p in pathlib.Path(s.root.removeprefix("file:")).iterdir()] == [out._scratch_path.rpartition("/")[2]]
    assert len(found[0]) == 140 and found[0] == found[1]


def test_sums_are_those_of_a_counter(monkeypatch):
    monkeypatch.setattr(kn.Sums, "MOST", 50)
    rng, want, sums = np.random.default_rng(4), Counter(), kn.Sums(1)
    for _ in range(40):
        keys, n = rng.integers(0, 90, 20), rng.integers(1, 5, 20)
        sums.add(keys, n)
        for k, c in zip(keys.tolist(), n.tolist(), strict=True):
            want[k] += c
    assert list(zip(*(x.tolist() for x in sums.get()), strict=True)) == sorted(want.items())


def test_tokens_are_those_of_bytes_split():
    rng = np.random.default_rng(5)
    signs = list("aB0 \t\n\x0b\x0c\r\x1c\x1f\x85\xa0　é!")
    texts = [None, "", " \n", *("".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(500))]
    words, flat, n = kn.tokens(pa.chunked_array([texts[:100], [], texts[100:]], pa.string()))
    words, ends = words.to_pylist(), np.cumsum(n)
    for t, end, k in zip(texts, ends.tolist(), n.tolist(), strict=True):
        assert [words[i] for i in flat[end - k : end]] == (t or "").encode().split()


def test_a_large_vocabulary_travels_small():
    words = [f"w{i}".encode() for i in range(200_000)]
    counts = np.bincount(np.r_[np.arange(3, 200_003), np.arange(3, 50_000)], minlength=200_003)
    model = kn.Model(kn.Words(pa.array(words, pa.large_binary())), kn.discounts([0]), kn.discounts([0]), (counts,) * 5, 1, kn.Grid(0))
    sent = pickle.dumps(model)
    assert len(sent) < 2_000_000  # 200,000 objects and three arrays of 8 bytes a word took 7 MB
    assert model.ids([b"w7", b"w199999", b"never"]).tolist() == [10, 200_002, kn.UNKNOWN] and pickle.dumps(model) == sent
    assert list(pickle.loads(sent).words) == words


def test_foreign_words_are_those_whose_core_no_word_of_the_vocabulary_has():
    vocabulary = [b"the", b"Kot,", b"(end)", b"--", b"\x00\x03", b"\x00\x02\x03"]
    zero = np.zeros(len(vocabulary) + 3, np.int64)
    model = kn.Model(kn.Words(pa.array(vocabulary, pa.large_binary())), kn.discounts([0]), kn.discounts([0]), (zero,) * 5, 1, kn.Grid(0))
    words = [*vocabulary, b"THE!", b"kot", b"Ende", b"...", b"new", b"New", "stra\u00dfe".encode()]
    hashes, slots = model.foreign(words, model.ids(words))
    known = {kn.core(w.translate(kn.LOWER)) for w in vocabulary if not w.startswith(b"\x00")}
    cores = [kn.core(w.translate(kn.LOWER)) for w in words]
    assert hashes.tolist() == [0 if not c or c in known else kn.xxhash.xxh64_intdigest(c) >> 16 for c in cores]
    assert slots.tolist() == [kn.xxhash.xxh32_intdigest(c) % kn.SLOTS for c in cores]


def test_a_worker_looks_once_through_what_it_has_imported(spark):
    @lean
    def aside(batches):
        import gc

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gc.get_freeze_count()])], names=["n"])

    run = lambda: max(r.n for r in spark.range(4).coalesce(1).mapInArrow(aside, "n long").collect())
    assert run() >= 0 and max(run() for _ in range(3)) > 1000


def test_a_worker_keeps_one_model():
    class Held:
        value = "first"

    assert kn._model(Held, "a") == "first" and kn._model(None, "a") == "first"
    Held.value = "second"
    assert kn._model(Held, "b") == "second" and list(kn._MODEL) == ["b"]
    KEPT[kn.__name__]()
    assert not kn._MODEL


def test_filter_and_shapes():
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 1 << 60, 20_000))
    grid = kn.Grid(len(keys))
    at = kn.positions(keys, grid.bits)
    np.bitwise_or.at(grid.words, at >> 6, np.left_shift(1, at & 63))
    assert grid.may_hold(keys).all() and grid.may_hold(rng.integers(0, 1 << 60, 20_000)).mean() < 0.1
    for _ in range(3000):
        word = bytes(rng.choice([1, 2, 3, 4, 33, 45, 48, 57, 65, 90, 97, 122, 128, 255], rng.integers(1, 9)).tolist())
        assert kn.shape(word) == kn.shape(word.translate(kn._KINDS))
