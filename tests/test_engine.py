"""Operators on inline rows: the behaviour that the engine promises."""

from datetime import date

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessarium.functions import dates, html, text, urls
from tessarium.operators import corpus, deliberation, metrics, near, relational, retrieval, sft


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_entry_imports_without_session():
    import __spark_entry__ as e

    assert "bm25_topk" in e.queries() and set(e.oracle_sql()) <= set(e.queries())


def test_bm25_ranks_and_facets(spark):
    recs = spark.createDataFrame([("a", "privacy policy for users"), ("b", "policy text"), ("c", "other words")], "record_id string, text string")
    asked = spark.createDataFrame([(1, "privacy policy")], "qid int, text string")
    got = retrieval.top_k(recs, asked).collect()
    assert [r.record_id for r in got] == ["a", "b"] and got[0].score > got[1].score > 0
    only = spark.createDataFrame([(1, "b")], "qid int, record_id string")
    assert [r.record_id for r in retrieval.top_k(recs, asked, allowed=only).collect()] == ["b"]
    assert retrieval.top_k(recs, asked, k=0).count() == 0


def test_normalize_and_segments(spark):
    df = spark.createDataFrame([(1, " A\r\n\r\n B "), (2, "ﬁne x")], "doc_id int, text string")
    assert rows(corpus.normalized(df), "doc_id") == [(1, "A\n\nB"), (2, "fine x")]
    df = spark.createDataFrame([("one\n\ntwo two\n\nthree",)], "text string")
    got = df.select(F.explode(text.segments(F.col("text"), 8)).alias("s")).select("s.*").collect()
    joined = "one\n\ntwo two\n\nthree"
    assert [r.text for r in got] == ["one\n\ntwo two", "three"]
    assert all(joined[r.char_start : r.char_end] == r.text for r in got)


def test_near_pairs_match_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and runs through the quiet forest at night"
    texts = [base, base + "!", base.replace("quiet", "loud"), "entirely different words here", "ab", "", base]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def grams(t, k=5):
        return {t[i : i + k] for i in range(len(t) - k + 1)} if len(t) >= k else {t}

    want = set()
    for i, x in enumerate(texts[:6]):
        for j in range(i + 1, 6):
            a, b = grams(x), grams(texts[j])
            if len(a & b) / len(a | b) >= 0.6:
                want.add((i, j))
    pairs = corpus.near_pairs(df, threshold=0.6)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert rows(corpus.text_classes(df).filter("doc_id <> class_id"), "doc_id") == [(6, 0)]


@pytest.mark.parametrize("threshold", [0.9, 0.7])
def test_near_pairs_of_near_copies_and_short_texts_match_brute_force(spark, threshold):
    rng = np.random.default_rng(5)
    texts = ["", " ", "a", "ab\u00e9", "abcde", "abcde ", "\U0001f600x" * 9, "aaaaaaa"]
    for n in (4, 7, 9, 11, 20, 60, 200, 900):
        base = "".join(rng.choice(list("abcd \u00df\n"), n))
        for edits in (0, 1, 1, 2, 3, 6, 15):
            chars = list(base)
            for at in rng.integers(0, n, edits):
                chars[at] = chr(rng.integers(97, 103))
            texts.append("".join(chars) + "xyz"[: rng.integers(0, 4)])
    first = {t: i for i, t in reversed(list(enumerate(texts)))}

    def grams(t, k=5):
        t = " ".join(x for line in t.split("\n") if (x := line.strip(" \t\n\x0b\x0c\r")))
        return {t[i : i + k] for i in range(len(t) - k + 1)} if len(t) >= k else {t}

    sets = {i: grams(t) for t, i in first.items()}
    want = {(a, b): len(x & y) / len(x | y) for a, x in sets.items() for b, y in sets.items() if a < b and len(x & y) / len(x | y) >= threshold}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = corpus.near_pairs(df, threshold=threshold).collect()
    assert len(got) == len(want) > 15 and {(r.a, r.b): r.jaccard for r in got} == want


def test_near_duplicates_move_fewer_bytes_than_their_grams():
    texts = ["".join(np.random.default_rng(i).choice(list("abcdefgh "), 3000)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], names=["key", "text"])
    made = pa.Table.from_batches(near.signatures(iter([batch]), 5, 0.9, near.DEALT))
    assert made.nbytes < 1.6 * batch.nbytes


def test_greedy_resolution_names_the_first_accepted(spark, tmp_path):
    classes = spark.createDataFrame([(i, i) for i in range(5)] + [(7, 1)], "doc_id long, class_id long")
    pairs = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "a long, b long")
    got = dict(rows(corpus.greedy_resolve(classes, pairs, str(tmp_path)), "doc_id"))
    assert got == {0: None, 1: 0, 2: None, 3: 2, 4: None, 7: 0}


def test_urls(spark):
    df = spark.createDataFrame([("HTTPS://Example.COM:443/a?b=2&utm_source=x&a=1&c=#top",)], "url string")
    u = F.col("url")
    got = df.select(urls.canonical(u), urls.host(u), urls.valid(u), urls.resolve(u, F.lit("../x"))).first()
    assert got[0] == "https://example.com/a?a=1&b=2" and got[1] == "example.com" and got[2]
    reg = spark.createDataFrame([(0, "s0", ["b.example.com"]), (1, "s1", ["example.com"])], "registry_order int, source_id string, domains array<string>")
    hosts = spark.createDataFrame([(1, "x.b.example.com"), (2, "example.com"), (3, "notexample.com")], "id int, h string")
    assert rows(relational.classify_by_suffix(hosts, "id", F.col("h"), reg), "id") == [(1, "s0"), (2, "s1")]


def test_dates(spark):
    cases = [
        ('<meta name="dc.date" content="2020-03-04T10:00:00Z">', "", "", date(2020, 3, 4), "high"),
        ('<meta name="dc.date" content="2031-03-04">', "", "", None, "none"),
        ("", "https://a.org/2019/05/06/x", "", date(2019, 5, 6), "medium"),
        ("", "https://a.org/2018/x", "", date(2018, 7, 1), "low"),
        ("", "https://a.org/1985/x", "", None, "none"),
        ("", "https://a.org/2025-2028/x", "", None, "none"),
        ("", "", "Published on: 12 January 2024 by us", date(2024, 1, 12), "medium"),
        ("", "", "nothing", None, "none"),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, html string, url string, text string")
    d = dates.provenance(F.col("html"), F.col("url"), F.col("text"), as_of_year=2026)
    got = rows(df.select("i", d["published_at"].alias("d"), d["date_confidence"].alias("c")), "i")
    assert [g[1:] for g in got] == [c[3:] for c in cases]
    many = ["2024-02-03", "2024/02/03", "3 February 2024", "February 3, 2024", "February 2024", "2024-02", "2024", "x"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(many)], "i int, s string")
    assert [g[1] for g in rows(df.select("i", dates.parse(F.col("s"))), "i")] == [date(2024, 2, 3)] * 4 + [date(2024, 2, 1)] * 2 + [date(2024, 1, 1), None]


def test_html_text():
    page = "<html><head><title>T</title><style>x</style></head><body><p>A <b>b<p>c<script>var t='</p>'</script></body>"
    assert html.page_text(page) == "T\nA\nb\nc" and html.page_text(None) is None


def test_candidates_and_spans(spark):
    df = spark.createDataFrame([(1, "We support this because evidence shows it."), (2, "Nothing here")], "segment_id int, text string")
    got = {(r.segment_id, r.candidate_type) for r in deliberation.candidates(df).collect()}
    assert got == {(1, "position"), (1, "argument"), (1, "evidence")}
    s = deliberation.spans(df, {r"\bbecause\b": 0.9}).first()
    assert (s.position, s.keyword) == (16, "because")
    docs = spark.createDataFrame([(1, "It is so because we said. Later it changed. Then. Finally done.")], "doc_id int, text string")
    assert rows(deliberation.argument_claims(docs), "doc_id") == [(1, "It is so", "we said.")]
    t = rows(deliberation.temporal_positions(docs), "ordinal")
    assert [(x[2], x[4]) for x in t] == [("later", None), ("finally", "Later it changed.")]


def test_deliberation_keeps_missing_groups(spark):
    q = spark.createDataFrame([("q", ["x", "y", "z"]), ("r", ["x"])], "question_id string, required_stakeholder_groups array<string>")
    p = spark.createDataFrame([("q", "x", "Open  It", ["1"]), ("q", "y", "open it", ["2", "1"])], "question_id string, stakeholder_group string, position string, evidence_record_ids array<string>")
    a, b = deliberation.deliberate(q, p).orderBy("question_id").collect()
    assert (a.represented, a.missing, a.agreements, a.disagreement, a.evidence_record_ids) == (["x", "y"], ["z"], ["open it"], False, ["1", "2"])
    assert (b.represented, b.missing, b.agreements) == ([], ["x"], [])
    n = spark.range(1).select(deliberation.negate(F.lit("We should support it"))).first()[0]
    assert n == "We not should support oppose support it"  # the verb rules apply one after another


def test_organisations(spark):
    m = spark.createDataFrame([(1, "ICANN"), (1, "United Nations"), (1, "Internet Architecture Board"), (2, "Internet Engineering Task Force")], "doc_id int, mention string")
    r = deliberation.resolve_organisations(m, spark)
    assert {(x.mention, x.canonical) for x in r.collect()} == {("ICANN", "ICANN"), ("United Nations", "UN"), ("Internet Engineering Task Force", "IETF")}
    assert rows(deliberation.organisation_network(r), "a") == [("ICANN", "UN", 1), ("UN", "ICANN", 1)]


def test_metrics(spark):
    df = spark.createDataFrame([(["a", "b"], ["b"]), (["a"], [])], "got array<string>, want array<string>")
    got = df.select(metrics.recall_at("got", "want", 2), metrics.precision_at("got", "want", 2), metrics.reciprocal_rank("got", "want"), metrics.evidence_recall(F.col("got"), F.col("want"))).collect()
    assert [tuple(r) for r in got] == [(1.0, 0.5, 0.5, 1.0), (1.0, 0.0, 0.0, 0.0)]


def test_relational(spark):
    seg = spark.createDataFrame([("g", 1, 0.0, 10.0), ("g", 2, 50.0, 60.0)], "group string, seg int, start double, end double")
    turn = spark.createDataFrame([("g", 1, "A", -5.0, 4.0), ("g", 2, "B", 4.0, 30.0)], "group string, turn int, speaker string, start double, end double")
    assert rows(relational.speaker_of(seg, turn, 7.0), "seg") == [("g", 1, "B"), ("g", 2, None)]
    ids = spark.range(1000).withColumnRenamed("id", "k")
    sizes = {r.split: r["count"] for r in relational.hash_split(ids, "k").groupBy("split").count().collect()}
    assert sizes == {"train": 800, "validation": 100, "test": 100}
    losses = spark.createDataFrame([(1, e, 1.0 / e if e < 9 else 1.0) for e in range(1, 15)], "run int, epoch int, loss double")
    assert relational.early_stop(losses, "run").first().stopped_at == 10


def test_sft(spark):
    df = spark.createDataFrame([([("user", "a question"), ("assistant", "I think so.\nEvidence: it states x.\nTherefore yes.")],)], "messages array<struct<role:string,content:string>>")
    assert df.select(sft.example_errors("messages")).first()[0] == []
    r = df.select(sft.clean_reasoning(sft.content("messages", "assistant")).alias("r")).select("r.*").first()
    assert (r.evidence_summary, r.policy_analysis, r.justification) == ("Evidence: it states x.", None, "Therefore yes.")
    assert df.select(sft.chat_text("messages")).first()[0].startswith("<|im_start|>user\na question<|im_end|>\n<|im_start|>assistant")


def test_quality_score(spark):
    df = spark.createDataFrame([("",), ("x" * 100,), ("x" * 399 + "�",), ("short",)], "t string")
    got = [tuple(r[0]) for r in df.select(text.quality_score(F.col("t"))).collect()]
    assert got == [("failed", 0.0), ("passed", 0.5), ("passed", 0.75), ("failed", 0.025)]
