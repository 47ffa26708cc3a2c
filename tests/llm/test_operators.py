"""The training-data operators against brute force, with nulls, empty and long texts, ties, repeats, extra columns."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from tessarium.llm import additive, curriculum, hmm, kneser_ney, linkgraph, minhash_odd, mtree, packing, quotes, suffix_levels
from tessarium.llm.common import LOWER, Scratch

DOCS = "doc_id long, text string, source string, lang string, hi int, n long"


def words(t):
    return (t or "").encode().translate(LOWER).split()


def corpus(seed=1, n=60):
    rng = np.random.default_rng(seed)
    vocab = ["the", "of", "und", "straße", "Éa", "x.", "Kot,", *(f"w{i}" for i in range(60))]
    make = lambda k: " ".join(rng.choice(vocab, k))
    texts = [make(int(rng.integers(1, 90))) for _ in range(n)]
    for i in range(5, n, 6):  # near copies, copies, and shared passages
        base = texts[i - 5].split()
        if len(base) > 40:
            base[3] = "changed"
        texts[i] = " ".join(base)
    for i in range(3, n, 9):
        texts[i] += " " + "a passage that many documents share " * 4
    texts += [None, "", "  \n", "one two", "One  TWO", make(6000), texts[0], texts[0]]
    src = [None if i % 11 == 0 else f"s{i % 4}" if i % 3 else "hot" for i in range(len(texts))]
    return [(i, t, s, "en" if i % 2 else "de", i, i * i) for i, (t, s) in enumerate(zip(texts, src, strict=True))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(t):
    w = words(t)
    return set() if not w else {tuple(w)} if len(w) < 4 else {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def test_near_duplicates(spark, docs, none):
    rows = corpus()
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_odd.near_duplicates(docs, Scratch(spark, "t")).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert minhash_odd.near_duplicates(none, Scratch(spark, "t")).count() == 0
    kept = minhash_odd.deduplicate(docs, Scratch(spark, "t"))
    assert kept.columns == docs.columns and kept.count() == sum(v[2] for v in got.values())


def test_deduplicate_takes_the_width_of_shingles(spark):
    """Five words against brute force on five-word sets, with pairs that only four words link."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(40):
        base = [f"v{i}-{k}" for k in range(66)]
        rows.append((2 * i, " ".join(base)))
        for k in rng.choice(range(8, 58), 1 + i % 3, replace=False):
            base[k] = f"e{i}-{k}"
        rows.append((2 * i + 1, " ".join(base)))
    five = lambda t: {tuple(t.split()[k : k + 5]) for k in range(62)}
    jaccard = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    apart = {2 * i for i in range(40) if not jaccard(five(rows[2 * i][1]), five(rows[2 * i + 1][1]))}
    only_four = {i for i in apart if jaccard(shingle_set(rows[i][1]), shingle_set(rows[i + 1][1]))}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in minhash_odd.deduplicate(df, Scratch(spark, "t"), width=5).collect()}
    assert kept == set(range(0, 80, 2)) | {i + 1 for i in apart} and only_four


def test_deduplicate_keeps_null_ids_and_drops_repeated_rows(spark):
    text = lambda k: " ".join(f"t{k}-{i}" for i in range(40))
    rows = [
        (None, text(0)), (None, text(1)), (None, text(1)), (1, text(2)), (None, text(2) + " more"),
        (2, text(3)), (2, text(3)), (3, text(4)), (3, text(5)), (3, text(5) + " end"), (4, text(5) + " tail"), (5, ""), (6, None), (None, None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in minhash_odd.deduplicate(df, Scratch(spark, "t")).collect())
    fixed = [(None, text(0)), (None, text(1)), (1, text(2)), (2, text(3)), (5, ""), (6, None), (None, None)]
    assert all(got.pop(r) == 1 for r in fixed)
    # of document 3 its two texts that differ stand once each
    assert sum(got.values()) == 2 and sum(r[1] == text(4) for r in got) == 1


def test_near_duplicates_in_large_groups(spark):
    """Many edited copies of one text: components are those of all pairs, though no bucket pairs all of its nodes."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(60, int(rng.integers(0, 5)), replace=False):
            w[k] = f"e{i}-{k}"
        rows.append((i, " ".join(w)))
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(150))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(150):
        for b in range(a + 1, 150):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_odd.near_duplicates(df, Scratch(spark, "t")).collect()}
    assert got == {i: find(i) for i in range(150)}


def test_near_duplicates_return_rows_without_ids(spark):
    text = lambda k: " ".join(f"t{k}-{i}" for i in range(40))
    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (1, text(2)), (None, text(2) + " more"), (None, None), (2, text(3)), (2, text(4)), (None, text(4))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS given", "3 AS hi", "4 AS bands")
    got = Counter(tuple(r) for r in minhash_odd.near_duplicates(df, Scratch(spark, "t")).collect())
    assert got == Counter({
        (None, 37, None, True): 3, (1, 37, 1, True): 1, (None, 38, 1, False): 1, (None, 0, None, True): 1, (2, 37, 2, True): 2, (None, 37, 2, False): 1,
    })


def test_deduplicate_keeps_clashing_columns(spark):
    rows = [(i, f"a b c d e f g {i // 2}", i) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    df = df.selectExpr("*", "1 AS row", "2 AS id", "3 AS mark", "4 AS first", "5 AS `order`", "6 AS n", "7 AS _key", "8 AS component_id", "map('a', 1) AS m")
    out = minhash_odd.deduplicate(df, Scratch(spark, "t"))
    assert out.columns == df.columns
    got = out.collect()
    assert {r.doc_id for r in got} == {0, 2, 4, 6} and all((r.key, r.row, r.n, r.m) == (r.doc_id, 1, 6, {"a": 1}) for r in got)


def test_odd_sketch_estimates_differences():
    a = minhash_odd.shingles(" ".join(f"w{i}" for i in range(500)))
    b = minhash_odd.shingles(" ".join(f"w{i}" for i in range(25, 525)))
    _, sketch = minhash_odd.fold(np.stack([minhash_odd.signature(a), minhash_odd.signature(b), minhash_odd.signature(a)]))
    bits = [int(np.bitwise_count(sketch[0] ^ s).sum()) for s in sketch]
    assert bits[0] == bits[2] == 0 and 0 < bits[1] <= minhash_odd.sketch_bound()


def vectors(n=400):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 8)).round(3)
    x[50:90] = x[50]  # ties
    out = [(i, [float(v) for v in row], i) for i, row in enumerate(x)]
    out[7] = (7, None, 0)
    out[8] = (8, [None, *out[8][1][1:]], 0)
    out[9] = (9, [float("nan"), *out[9][1][1:]], 0)
    out[10] = (10, [0.0] * 8, 0)
    return [*out, out[50], (None, out[1][1], 0)]


EMB = "vec_id long, embedding array<float>, score int"


def test_mtree_top_k(spark):
    df = spark.createDataFrame(vectors(), EMB)
    x = {i: np.floor(256 * np.array(v, np.float32).astype(float)) for i, v, _ in vectors() if i is not None and i not in (7, 8, 9)}
    want = set()
    for q in x:
        if q % 50 == 0:
            best = sorted(((-int(x[q] @ x[c]), c) for c in x if c != q))[:5]
            want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    got = {tuple(r) for r in mtree.top_k(df, Scratch(spark, "t"), shard_rows=150).collect()}
    assert got == want
    few = spark.createDataFrame([(50, [1.0], 0), (1, [2.0], 0)], EMB)
    assert [tuple(r) for r in mtree.top_k(few, Scratch(spark, "t")).collect()] == [(50, 1, 1, 256 * 512)]
    assert mtree.top_k(df.limit(0), Scratch(spark, "t")).count() == 0


def test_mtree_rows_are_bounded_and_rounds_meet_all(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIECE", 3000)
    monkeypatch.setattr(mtree, "ROUND", 2)
    monkeypatch.setattr(mtree, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(900)] + [(1000, [1e9, 1.0, 2.0, -1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    trees = mtree._trees(mtree.clean(df, nonzero=False), 4)
    assert max(len(r.tree) for r in trees.collect()) <= 3000 and trees.count() > 8
    whole = {i: [mtree.scaled(v) for v in x] for i, x in rows}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in mtree.top_k(df, Scratch(spark, "t"), shard_rows=40).collect()) == sorted(want)


def test_mtree_rules_out_pages():
    rng = np.random.default_rng(0)
    centres = rng.integers(-200, 200, (40, 3))
    x = np.concatenate([c + rng.integers(-3, 4, (50, 3)) for c in centres]).astype(float)
    tree = mtree.MTree(np.arange(len(x)), x, page=50)
    for q in range(0, 2000, 97):
        s = x @ x[q]
        best = sorted((-int(s[i]), i) for i in range(len(x)) if i != q)[:5]
        assert tree.search(q, x[q], 5) == [(-a, b) for a, b in best]
    assert tree.computed < 0.7 * 21 * len(x)


def test_additive_quantisation_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 16))
    df = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], EMB)
    got = additive.nearest(df, Scratch(spark, "t"), rerank=150, shard_rows=700).collect()
    y = x.astype(np.float32).astype(float)
    hits, by = 0, {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, found in by.items():
        s = y @ y[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & {v for _, v, _ in found})
        assert [k for k, _, _ in sorted(found)] == list(range(1, 21))
        assert all(abs(s[v] - sc) < 1e-9 for _, v, sc in found)
    assert len(by) == 60 and hits / (60 * 20) >= 0.9
    odd = additive.nearest(spark.createDataFrame(vectors(60), EMB), Scratch(spark, "t")).collect()
    ids = {r.vec_id for r in odd}
    assert not ids & {7, 8, 9, 10} and {r.query_id for r in odd} == {0, 20, 40}
    assert additive.nearest(df.limit(0), Scratch(spark, "t")).count() == 0


def test_additive_quantisation_of_copies(spark):
    """A group of copies and one of near copies larger than the rerank depth: ids and ties as in brute force."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[rng.permutation(1500)[:500]] = x[0]
    near = rng.permutation(1500)[:400]
    x[near] = x[1] + rng.normal(size=(400, 16)).astype(np.float32) * np.float32(1e-3)
    df = spark.createDataFrame([(i, [float(v) for v in r], 0) for i, r in enumerate(x)], EMB)
    y = x.astype(float)
    for measure in ("ip", "l2"):
        got = {}
        for r in additive.nearest(df, Scratch(spark, "t"), measure=measure, rerank=40, shard_rows=2000).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        for q in range(0, 1500, 20):
            s = (y * y[q]).sum(1) if measure == "ip" else -np.square(y - y[q]).sum(1)
            want = sorted((-round(v, 9), i) for i, v in enumerate(s.tolist()) if i != q)[:20]
            assert [v for _, v in sorted(got[q])] == [i for _, i in want], (measure, q)


def test_quotation_linking(spark):
    data = [
        (1, 1, "user", "Hello there\nI like  Cats", 0), (1, 2, "assistant", "> hello THERE\nHi!", 0), (1, 3, "user", "nope", 0),
        (1, 4, "user", ">> Hello there\n> Hi!\nok", 0), (1, 5, "user", "> i like cats\nsame", 0), (1, 6, "user", "next", 0),
        (2, 1, "user", "> nope\nx", 0), (2, None, None, None, 0), (None, 1, "user", "> \n>  ", 0),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, n int")
    out = quotes.conversations(df, Scratch(spark, "t")).collect()
    one = [(r.n, r.reply_to, r.thread, r.n_quotes, r.n_linked, r.text) for r in out if r.conv_id == 1]
    assert one == [
        (1, None, 1, 0, 0, "Hello there\nI like  Cats"), (2, 1, 1, 1, 1, "Hi!"), (3, 2, 1, 0, 0, "nope"),
        (4, 2, 4, 2, 2, "ok"), (5, 1, 5, 1, 1, "same"), (6, 5, 5, 0, 0, "next"),
    ]
    two = [(r.n, r.turn, r.n_linked, r.text) for r in out if r.conv_id == 2]
    assert two == [(1, None, 0, ""), (2, 1, 1, "x")]
    assert len(out) == len(data) and quotes.conversations(df.limit(0), Scratch(spark, "t")).count() == 0


def test_quotation_linking_of_runs_and_other_conversations(spark):
    text = "First line\nsecond  line\n\nthird line\nfourth"
    data = [
        (1, 1, "user", text), (1, 2, "user", "between"), (1, 3, "user", "> second line\n> Third line\nyes"), (1, 4, "user", "> second line\n> fourth\nno"),
        # the first occurrence is a later turn of the quoting conversation; another conversation holds it too
        (2, 1, "user", "> later words\nquoted first"), (2, 2, "user", "later words"), (3, 1, "user", "later words"),
        # a null conversation holds it, and another one
        (None, 1, "user", "> shared words\nx"), (None, 2, "user", "shared words"), (4, 1, "user", "shared words"), (5, 1, "user", "> shared words\ny"),
        (None, 3, "user", "between"), (None, 4, "user", "> shared words\nback"),
    ]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.n): (r.reply_to, r.n_linked) for r in quotes.conversations(df, Scratch(spark, "t")).collect()}
    assert len(out) == len(data)
    assert out[1, 3] == (1, 1) and out[1, 4] == (3, 0)
    assert out[2, 1] == (None, 1) and out[5, 1] == (None, 1)
    assert out[None, 1] == (None, 1) and out[None, 4] == (2, 1)


def test_quotation_linking_equals_its_sql(spark):
    """Deep chains, repeated turns, lines that all share, long messages, in any partitioning: the rows of the SQL."""
    import duckdb
    import pandas as pd

    rng = np.random.default_rng(11)
    lines = [f"line {i} of words" for i in range(12)] + ["Yes", "  yes ", ""]
    data = []
    for conv in [None, *range(7)]:
        said = []
        for turn in range(1, 45):
            own = [str(x) for x in rng.choice(lines, int(rng.integers(1, 5)))]
            quoted = []
            for _ in range(int(rng.integers(0, 3))):
                of = said[int(rng.integers(0, len(said)))] if said and rng.random() < 0.8 else own
                at = int(rng.integers(0, len(of)))
                quoted += [">" * int(rng.integers(1, 4)) + " " * int(rng.integers(0, 2)) + x for x in of[at : at + 2]]
            said.append(own)
            data.append((conv, turn if rng.random() < 0.97 else None, "user", "\n".join([*quoted, *own])))
    data += [(50, t, "user", f"> m{t - 2}\nm{t}") for t in range(1, 200)] + [(50, 7, None, None), (50, 7, "a", "m7"), (51, 1, "u", "> q\r\n>> r\r" + "long line\n" * 3000)]
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = Counter(con.execute(f"SELECT * FROM ({quotes.OP3_SQL})").fetchall())
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS hash", "3 AS k")
    got = Counter(tuple(r) for r in quotes.conversations(df.repartition(3), Scratch(spark, "t")).collect())
    assert got == want


def test_kneser_ney_rejects_junk(spark, none):
    good = [(i, t, "s", "en", 0, 0) for i, t in enumerate(("the cat sat on the mat " * 6 + f"w{i}") for i in range(120))]
    bad = [(1000 + i, "XX!! QQZ## $$%% " * 20, "s", "en", 0, 0) for i in range(5)]
    odd = [(2000, None, None, None, 0, 0), (2001, "", None, "xx", 0, 0), (2002, "the cat sat on the mat", None, None, 0, 0)]
    df = spark.createDataFrame(good + bad + odd, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(1000, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    kept = kneser_ney.filter_documents(df, labels, Scratch(spark, "t"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in good + odd}
    assert kneser_ney.filter_documents(none, labels, Scratch(spark, "t")).count() == 0
    assert kneser_ney.filter_documents(df, labels.limit(0), Scratch(spark, "t")).count() == df.count()


def test_kneser_ney_rejects_foreign_words_and_bad_windows(spark):
    """An insult that trusted text never holds, and junk inside a long fluent text, are rejected; copies and names are not."""
    rng = np.random.default_rng(6)
    vocab = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    name = lambda: "N" + "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 6))
    make = lambda k: [*(str(w) for w in rng.choice(vocab, k // 2)), name(), *(str(w) for w in rng.choice(vocab, k - k // 2 - 1))]
    rows = [(i, " ".join(make(80))) for i in range(300)]
    rude = make(80)
    for i in range(300, 340):
        text = make(80)
        text[40] = "Scoundrel,"
        rows.append((i, " ".join(text)))
    rude[40] = "Nickname"  # in one text and its copies: no evidence
    rows += [(i, " ".join(rude)) for i in range(340, 380)]
    junk = make(900)
    junk[450:466] = ["QX##Z%%"] * 16
    rows.append((400, " ".join(junk)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(250)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in kneser_ney.filter_documents(df, labels, Scratch(spark, "t")).collect()}
    assert not kept & {*range(300, 340), 400} and set(range(340, 380)) <= kept
    assert len(kept & set(range(300))) >= 290


def test_curriculum(spark, docs, none):
    rows = corpus()
    size = {r[0]: len(words(r[1])) for r in rows}
    per = Counter()
    for r in rows:
        per[r[2]] += size[r[0]]
    order = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(per.values())
    while open_:  # water filling, step by step
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * per[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = 2.0 * per[s]
            left -= 2 * per[s]
        open_ -= full
    got = curriculum.plan(docs, Scratch(spark, "t")).collect()
    taken = Counter()
    for r in got:
        assert r.size == size[r.doc_id] and abs(r.target - target[r.source]) < 1e-6 and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= max(size[r[0]] for r in rows if r[2] == s)
    again = {(r.doc_id, r.taken, r.first_position) for r in curriculum.plan(docs.repartition(7), Scratch(spark, "t")).collect()}
    assert again == {(r.doc_id, r.taken, r.first_position) for r in got}
    mixed = curriculum.mix(docs, Scratch(spark, "t"))
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert curriculum.plan(none, Scratch(spark, "t")).count() == 0 and curriculum.mix(none, Scratch(spark, "t")).count() == 0


def test_hidden_markov_model(spark, docs, none):
    rng = np.random.default_rng(0)
    model = hmm.Hmm(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), np.array([[0.5, 0.1], [0.3, 0.3], [0.2, 0.6]]))
    seqs = [rng.integers(0, 3, n) for n in (1, 5, 3, 7)]
    for seq, got in zip(seqs, model.forward(seqs), strict=True):
        a = model.start * model.emit[seq[0]]
        for x in seq[1:]:
            a = (a @ model.move) * model.emit[x]
        assert abs(np.log10(a.sum()) - got) < 1e-9
    usual = np.ones(3) / 3
    before = model.forward(seqs).sum()
    for _ in range(5):
        s, m, e, logs = model.expect(seqs)
        assert abs(s.sum() - 4) < 1e-9 and abs(e.sum() - 16) < 1e-9 and abs(m.sum() - 12) < 1e-9
        assert abs(logs - model.forward(seqs).sum()) < 1e-9
        model = hmm.maximise(s, m, e, usual * 1e-6)
    assert model.forward(seqs).sum() > before
    rows = corpus()
    tok = {r[0]: [*words(r[1]), b"\n"] for r in rows}
    c = Counter()
    for i, w in tok.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for known in (1_000_000, 20):  # all counts travel to the workers, or most are joined
        got = hmm.score(docs, Scratch(spark, "t"), rounds=1, states=3, known=known).collect()
        assert len(got) == len(rows)
        for r in got:
            w = tok[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
            assert abs(r.base_score - sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 and r.score < 0
    assert hmm.score(none, Scratch(spark, "t"), rounds=1).count() == 0


def brute_removed(rows, length=100):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        mask = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                mask[p : p + length] = True
            seen.add(w)
        runs = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        out[i] = (len(b), int(mask.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest())
    return out


def test_suffix_levels(spark, docs, none):
    rows = [(r[0], r[1]) for r in corpus()]
    rows += [(100, "z" * 350), (101, "ab" * 300 + "é" * 90), (102, "é" * 120 + "q"), (103, "y" * 20 + "é" * 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_levels.report(df, Scratch(spark, "t")).collect()}
    assert got == brute_removed(rows)
    assert suffix_levels.report(none, Scratch(spark, "t")).count() == 0
    cut = suffix_levels.remove(docs, Scratch(spark, "t"))
    assert cut.columns == docs.columns
    twice = df.union(df.filter("doc_id = 5"))  # an equal row is the same document
    again = suffix_levels.report(twice, Scratch(spark, "t")).collect()
    assert len(again) == len(rows) + 1 and {r.doc_id: tuple(r)[1:] for r in again} == got
    same_id = spark.createDataFrame([(1, "k" * 150), (1, "m" * 150 + "k" * 120)], "doc_id long, text string")
    assert sorted(r.n_removed > 0 for r in suffix_levels.report(same_id, Scratch(spark, "t")).collect())[-1]


def test_levels_grow_geometrically():
    rng = np.random.default_rng(1)
    family, seen = suffix_levels.Levels(4), set()
    for _ in range(30):
        strings = [rng.integers(97, 102, int(rng.integers(4, 12))).astype(np.uint8).tobytes() for _ in range(8)]
        text, places, want = b"".join(strings), [], []
        for k, x in enumerate(strings):
            for i in range(len(x) - 3):
                places.append(sum(map(len, strings[:k])) + i)
                want.append(x[i : i + 4] in seen)
                seen.add(x[i : i + 4])
        assert family.add(np.frombuffer(text, np.uint8), np.array(places)).tolist() == want
    sizes = [len(x) for x in family.levels]
    assert sum(sizes) == len(seen) and all(a > 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    for level in family.levels:  # suffixes in order
        keys = level.keys().tolist()
        assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_suffix_levels_with_clashing_names_and_missing_ids(spark):
    passage = "a passage of more than one hundred bytes that several documents share, word for word, from here to its end. "
    texts = ["x1 " + passage, passage + "y2", "z3 " + passage + "z4", None, passage, passage]
    rows = [(None, t, i, "s", 1, 2) for i, t in enumerate(texts)] + [(1 << 62, passage + "q", 9, "s", 1, 2), (1 << 62, "other " + passage, 9, "s", 1, 2), (-(1 << 62), "short", 9, "s", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int, row string, doc long, sub int").selectExpr("*", "3 AS _n", "4 AS _text", "5 AS _x", "6 AS need", "7 AS mark", "8 AS many", "9 AS cut")
    report = suffix_levels.report(df, Scratch(spark, "t")).collect()
    assert len(report) == len(rows) and len({r.n_bytes for r in report if r.n_removed}) == 5  # of six texts with the passage one comes first
    out = suffix_levels.remove(df, Scratch(spark, "t"))
    assert out.columns == df.columns
    got = {(r.doc_id, r.spans, r.text) for r in out.collect()}
    assert (None, 3, None) in got and (-(1 << 62), 9, "short") in got
    assert all((r.row, r.doc, r.sub, r._n, r._text, r._x, r.need, r.mark, r.many, r.cut) == ("s", 1, 2, 3, 4, 5, 6, 7, 8, 9) for r in out.collect())


@pytest.mark.parametrize("hot", [False, True])
def test_suffix_levels_at_many_places(spark, monkeypatch, hot):
    """A line that most documents hold between different words, long texts, and small shards: the same as brute force."""
    if hot:
        monkeypatch.setattr(suffix_levels, "HOT_RUNS", 3)
        monkeypatch.setattr(suffix_levels, "HOT", 50)
    monkeypatch.setattr(suffix_levels, "SHARD_RUNS", 40)
    rng = np.random.default_rng(12)
    word = lambda: "".join(chr(97 + int(x)) for x in rng.integers(0, 4, int(rng.integers(2, 9))))
    line = " ".join(word() for _ in range(12))
    make = lambda k: " ".join(word() for _ in range(k))
    rows = [(i, f"{make(int(rng.integers(0, 30)))} {line} {make(int(rng.integers(0, 30)))}") for i in range(150)]
    long = make(60_000)
    rows += [(200, long), (201, long[1000:200_000] + "é" + long[:500]), (202, "\x00" * 250), (203, "\x00" * 120 + "b" + "\x00" * 99), (204, rows[3][1] + rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_levels.report(df, Scratch(spark, "t")).collect()}
    assert got == brute_removed(rows)


def test_link_graph(spark):
    page = lambda *to: "".join(f'<a href="http://{h}/x">x</a>' for h in to)
    data = [
        (1, "http://WWW.Example.com/en/1?x#y", "", 0), (2, "https://a.example.com/en/", page("b.org"), 0), (3, "http://bad.net/es/", None, 0),
        (4, "http://bad.net/de/", "", 0), (5, "http://fan.org/p", page("bad.net", "bad.net"), 0), (6, "http://b.org", page("com"), 0),
        (7, None, None, 0), (8, "nothing", "", 0), (9, "http://example.com", "", 0), (9, "http://example.com", "", 0),
    ]
    df = spark.createDataFrame(data, "page_id long, url string, html string, rule int")
    out = {r.page_id: tuple(r)[1:] for r in linkgraph.judge(df, Scratch(spark, "t"), linkgraph.rule_table(spark)).collect()}
    assert out[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert out[2] == ("a.example.com", "/en/", "example.com/en/", "block") and out[3][2:] == ("net/es/", "block")
    assert out[4] == ("bad.net", "/de/", None, "block")  # half of its host's pages are blocked by rule
    assert out[5][2:] == (None, "allow") and out[6] == ("b.org", "", None, "allow")
    assert out[7] == out[8] == ("", "", None, "allow") and out[9] == ("example.com", "", None, "allow")
    assert linkgraph.judge(df.limit(0), Scratch(spark, "t"), linkgraph.rule_table(spark)).count() == 0
    seeds = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("c", 0.0)], "host string, v double")
    graph = spark.createDataFrame([("a", "b", 1), ("b", "c", 3), ("b", "a", 1)], "src string, dst string, n long")
    got = {r.host: r.score for r in linkgraph.propagate(seeds, graph, Scratch(spark, "t"), tolerance=1e-4).collect()}
    m = np.array([[0, 1, 0], [0.25, 0, 0.75], [0, 0, 0]])
    want = np.linalg.solve(np.eye(3) - 0.85 * m.T, 0.15 * np.array([1.0, 0, 0]))
    assert np.allclose([got["a"], got["b"], got["c"]], want, atol=1e-4)


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    cap = 64
    cut = packing.pieces(docs, capacity=cap)
    s = Scratch(spark, "t")
    got = packing.pack(s.write(cut), s, capacity=cap, shard_pieces=100).collect()
    want = {}
    for r in corpus():
        ids = np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), cap):
            want[(r[0], k // cap)] = (k, len(ids[k : k + cap]), zlib.crc32(ids[k : k + cap].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= cap
    assert len(bins) <= -(-sum(r.length for r in got) // cap) + len({r.sequence_id >> 32 for r in got}) + 1
    s = Scratch(spark, "t")
    assert packing.pack(s.write(packing.pieces(none)), s).count() == 0


def test_word_ids_equal_the_tokenizer():
    ids = packing.WordIds(packing.default_tokenizer())
    cases = ["a<|endoftext|>b c", "don't it's we're I'll 12a3 x--y", "Été ĲŒ İstanbul ΣΑΣ x́ ẞ", "a\x1cb\x85c\xa0d", "日本 text", "", "'S 'T!!'re <| foo", "ﬁ ß ª²³¼"]
    for x in cases:
        assert ids.encode(x) == np.asarray(ids.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), x


def test_genetic_algorithm_keeps_every_piece_once():
    import random

    rng = random.Random(5)
    lengths = sorted((rng.randrange(200, 900) for _ in range(200)), reverse=True)
    genome, bins, _ = packing.evolve(lengths, [], 1, 1000, 6, 40)
    found, free = packing._solution(genome, lengths, 1000)
    assert sorted(i for b in found for i in b) == list(range(200)) and min(free) >= 0 and len(found) == bins
    assert bins <= len(packing._first(lengths, 1000)[0])


def triplets(n, capacity, seed):
    """Lengths that fill n bins exactly, three in each, which best-fit decreasing does not find."""
    import random

    rng, out = random.Random(seed), []
    for _ in range(n):
        a = rng.randrange(capacity // 3 + 10, capacity // 2)
        b = rng.randrange(capacity // 4, capacity // 3)
        out += [a, b, capacity - a - b]
    return sorted(out, reverse=True)


def test_children_beat_best_fit_decreasing(spark):
    lengths = triplets(40, 1000, 3)
    plain = len(packing._first(lengths, 1000)[0])
    rows = [(i, 0, 0, n, i, i) for i, n in enumerate(lengths)] + [(None, 0, 0, 1000, 1, 1), (None, 0, 0, 1000, 1, 2)]
    s = Scratch(spark, "t")
    got = packing.pack(s.write(spark.createDataFrame(rows, packing.PIECE_SCHEMA)), s, capacity=1000).collect()
    assert len(got) == len(rows)
    per = Counter()
    for r in got:
        per[r.sequence_id] += r.length
    assert max(per.values()) <= 1000 and len(per) - 2 >= 40
    assert len(per) - 2 <= plain - 2  # children save sequences
    assert len({r.sequence_id for r in got if r.from_child}) > 10


def test_lower_bound_of_packings():
    assert packing.lower_bound([600, 600, 600, 500], 1000) == 4 and packing.lower_bound([500] * 4, 1000) == 2
    assert packing.lower_bound([], 1000) == 0 and packing.lower_bound([1] * 1001, 1000) == 2
    for seed in range(5):
        lengths = triplets(12, 1000, seed)
        assert packing.lower_bound(lengths, 1000) == 12 <= len(packing._first(lengths, 1000)[0])


def test_packing_of_repeated_rows_null_ids_and_long_texts(spark):
    rows = [(None, "a b c"), (None, "a b c"), (1, "w " * 30_000), (1, "w " * 30_000), (2, None), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS shard", "3 AS piece")
    s = Scratch(spark, "t")
    got = packing.pack(s.write(packing.pieces(df)), s).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, _ in rows)
    assert sum(r.length for r in got if r.doc_id == 1) == 2 * 30_001
    assert all(r.length == 1 for r in got if r.doc_id in (2, 3))
