"""Discovery, instruction data, suites, inference, sinks and readers on small fixtures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tessarium.functions import casts, dates, languages
from tessarium.operators import deliberation, engine, inference, ingest, metrics, plugins, relational, sft, suites
from tessarium.operators.corpus import merge_index
from tessarium.plans.catalogue import QUERIES
from tessarium.sources import capture, discovery, readers, sinks

SF = "/root/testdata/sf0.001"


def test_discovery_chain(spark):
    sources = [
        {"id": "one", "domains": ["one.org"], "discovery": {"seed_urls": ["https://one.org/a", "https://one.org/a"], "sitemap_urls": "https://one.org/sitemap.xml", "paths": ["/more"]}},
        {"id": "two", "domains": ["two.org"]},
        {"id": "shut", "domains": ["shut.org"], "discovery": {"urls": ["https://shut.org/x"]}},
        {"id": "down", "domains": ["down.org"], "discovery": {"urls": ["https://down.org/x"]}},
    ]
    wanted = discovery.candidates(spark, sources)
    by = {}
    for r in wanted.orderBy("source_id", "ordinal").collect():
        by.setdefault(r.source_id, []).append(r.url)
    assert by["one"] == ["https://one.org/a", "https://one.org/sitemap.xml", "https://one.org/more"]
    assert by["two"] == ["https://two.org/" + p for p in ("", "sitemap.xml", "feed", "rss.xml", "atom.xml")]
    page = '<a class="x" href="/p1">1</a><a href="#top">t</a><a href="https://one.org/p1/">again</a><a href="mailto:x@y">m</a>'
    captures = [
        ("https://one.org/a", 200, True, "text/html; charset=utf-8", page),
        ("https://one.org/sitemap.xml", 200, True, "application/xml", "<urlset><url><loc> https://one.org/p2 </loc></url></urlset>"),
        ("https://one.org/more", 404, True, None, None),
        ("https://two.org/rss.xml", 200, True, "application/rss+xml", "<rss><item><link>https://two.org/n1</link></item></rss>"),
        ("https://shut.org/x", 200, False, None, None), ("https://down.org/x", 503, True, None, None),
    ]
    held = spark.createDataFrame(captures, "url string, http_status int, robots_allowed boolean, content_type string, body string")
    found, health = discovery.discover(wanted, held)
    assert {(r.source_id, r.url) for r in found.collect()} == {("one", "https://one.org/p1"), ("one", "https://one.org/p2"), ("two", "https://two.org/n1")}
    got = {r.source_id: (r.status, r.n_captured, r.n_failed, r.n_missing, r.discovered) for r in health.collect()}
    assert got == {"one": ("reachable", 2, 1, 0, 2), "two": ("reachable", 1, 0, 4, 1), "shut": ("blocked", 0, 0, 0, 0), "down": ("degraded", 0, 1, 0, 0)}
    index = discovery.health_index(health).first()
    assert (index.sources, index.discovered, index.by_status) == (4, 3, {"blocked": 1, "degraded": 1, "reachable": 2})
    assert discovery.adapter("ietf", max_pages=1).candidates() == [("ietf", 0, "https://www.ietf.org/sitemap.xml")]
    discovery.register("one", lambda name, **kw: discovery.Adapter(name, seeds=["https://one.org/a", "https://one.org/more"], **kw))
    with pytest.raises(KeyError):
        discovery.adapter("none")
    urls_, per = discovery.discover_all(spark, held, {"one": {"max_pages": 1}})
    assert urls_.count() == 1 and per.first().n_captured == 1
    docs = spark.createDataFrame([("d1", "https://one.org/p2/"), ("d2", "https://else.org")], "document_id string, source_url string")
    assert discovery.rows_of(found, docs).first().document_ids == ["d1"]


def test_discovery_writes_its_index(spark, tmp_path):
    rows = spark.createDataFrame([("a", "reachable", 3), ("b", "blocked", 0)], "source_id string, status string, discovered long")
    discovery.write_health(rows, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/index").first().sources == 2 and spark.read.json(f"{tmp_path}/sources").count() == 2


EX = (
    "id int, task_type string, messages array<struct<role:string,content:string>>, source_document_ids array<string>, source_hashes array<string>, "
    "evidence array<struct<quote_or_excerpt:string>>, stakeholder_perspectives array<string>"
)


def test_validators(spark):
    two = [("user", "what is said here?"), ("assistant", "something that is long enough")]
    rows = [
        (1, "summarise", two, ["d"], ["h"], [("q",)], ["p"]), (2, "other", [("user", "short")], [], None, [("",)], []),
        (3, None, None, None, None, None, None), (4, "policy_analysis", [*two, ("user", "  ")], [], ["h"], [], ["p"]), (5, "summarise", two, ["d"], ["h"], [("q",)], ["p"]),
    ]
    df = spark.createDataFrame(rows, EX)
    out = {r.id: r for r in df.select("id", sft.full_errors().alias("full"), sft.perspective_example_errors().alias("views"), sft.task_errors().alias("task"), sft.schema_error_count().alias("n")).collect()}
    assert out[1].full == out[1].views == out[1].task == [] and out[1].n == 0
    assert out[2].full == ["missing assistant message", "missing source_document_ids", "missing source_hashes", "invalid task_type: other", "user message too short (5 chars)", "evidence exists but no valid entries"]
    assert out[2].views == ["messages must be a list with at least 2 entries", "stakeholder_perspectives is required"] and out[2].n == 1
    assert out[3].full == ["missing messages", "missing source_document_ids", "missing source_hashes", "missing evidence", "invalid task_type: None"]
    assert out[3].task == ["missing messages"] and out[3].n == 1 and out[3].views[0] == "messages is required"
    assert out[4].task == [] and out[4].n == 1
    again = {r.id: r.errors for r in sft.with_duplicates(df, sft.task_errors(), "id").collect()}
    assert again[5] == ["DUPLICATE"] and again[1] == []


def test_teacher_replies_and_dispatch(spark):
    good = json.dumps({"question": "What is said in it?", "answer": "Enough to be accepted as an answer.", "evidence": []})
    replies = [("a", "t", "the text", f"```\n{good}\n```"), ("b", "t", "x", "```json\n{}\n```"), ("c", "t", "x", '{"skip": true, "question": "q"}'), ("d", "t", "x", None)]
    got = {r.document_id: r for r in sft.accepted(spark.createDataFrame(replies, "document_id string, task_type string, text string, reply string")).collect()}
    assert got["a"].rejected is None and got["a"].example.evidence[0].quote_or_excerpt == "the text"
    assert [got[k].rejected for k in "bcd"] == ["not parsed", "skipped", "empty"]
    template = spark.createDataFrame([("a", "t", [("user", "q")]), ("b", "t", [("user", "q")]), ("z", "t", [("user", "q")])], "document_id string, task_type string, messages array<struct<role:string,content:string>>")
    made, why = sft.dispatch(template, sft.accepted(spark.createDataFrame(replies, "document_id string, task_type string, text string, reply string")))
    assert {r.document_id for r in made.collect()} == {"a", "z"} and {r["rejected"]: r["count"] for r in why.collect()} == {"not parsed": 1, "skipped": 1, "empty": 1}
    prompt = spark.range(1).select(sft.teacher_prompt(F.lit("t"), F.lit(None).cast("string"), F.lit("u"), F.lit("x" * 9000)).alias("p")).first().p
    assert "untitled (u)" in prompt and prompt.count("x") == 8000 + prompt.replace("x" * 8000, "").count("x")


def test_examples_are_appended_once_and_kinds_are_named(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "example_id string, v string")
    b = spark.createDataFrame([("2", "z"), ("3", "w"), ("3", "w")], "example_id string, v string")
    assert sorted(map(tuple, sft.append_fixed(a, b).collect())) == [("1", "x"), ("2", "y"), ("3", "w")]
    few = spark.createDataFrame([("d", "", "u", "text")], "document_id string, title string, source_url string, text string")
    assert sft.instruction_examples(few).count() == 0 and sft.instruction_examples(few, least=1).count() == 2
    kinds = spark.createDataFrame([("using supplied evidence",), ("else",)], "s string").select(sft.prompt_kind(F.col("s"))).collect()
    assert [r[0] for r in kinds] == ["v1_template", "unknown"]


def test_suites(spark, tmp_path):
    (tmp_path / "multilingual_cases.json").write_text(json.dumps([{"case_id": "m1", "text": "x", "expected_language": "en", "expected_supported": True}, {"case_id": "m2", "text": "y", "expected_language": "xx", "expected_supported": True}]))
    cases = suites.read_cases(spark, str(tmp_path), "multilingual")
    out = suites.results("multilingual", cases.withColumn("got", F.col("expected_language")), suites.language(F.col("expected_language"), F.col("got"), F.col("expected_supported"), ("en",)))
    assert {r.case_id: r.passed for r in out.collect()} == {"m1": True, "m2": False}
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.expr("CAST(array() AS array<string>)")
    assert one(suites.transcript(F.lit("a b c d"), F.lit("A b c"))) and not one(suites.transcript(F.lit(""), F.lit("x"))) and one(suites.transcript(F.lit(""), F.lit(" ")))
    assert one(suites.covered(arr("a", "b"), arr("b"))) and not one(suites.covered(arr("a", "b", "c"), arr("c"))) and one(suites.covered(arr(), arr())) and not one(suites.covered(arr(), arr("x")))
    assert one(suites.any_as_expected(arr(), arr())) and not one(suites.any_as_expected(arr("x"), arr()))
    assert one(suites.confidence_match(F.lit(" a "), F.lit("a"), F.lit(0.9), F.lit(0.8)))
    scores = F.array(F.lit(0.1), F.lit(0.9), F.lit(0.9))
    assert one(suites.top_recall(scores, F.array(F.lit(1)))) and not one(suites.top_recall(scores, F.array(F.lit(0)))) and one(suites.top_recall(scores, F.expr("CAST(array() AS array<int>)")))
    bad = spark.createDataFrame([("a", "s", None), ("b", "s", True)], "case_id string, suite string, passed boolean")
    assert [r.missing for r in suites.result_errors(bad).collect()] == [["passed"]]
    made = suites.generated_cases(spark, ("{x} said {y}", "{y}"), {"x": ("A", "B"), "y": ("one", "two")}, 20)
    again = suites.generated_cases(spark, ("{x} said {y}", "{y}"), {"x": ("A", "B"), "y": ("one", "two")}, 20)
    assert made.collect() == again.collect() and made.filter("text LIKE '%{%'").isEmpty() and made.select("text").distinct().count() > 2
    suites.write_cases(made, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 20
    runs = spark.createDataFrame([(["a", "b"], ["b"], ["e"], ["e"], ["g"], ["g", "h"]), (["c"], ["d"], [], [], [], [])], "got array<string>, want array<string>, evidence_got array<string>, evidence_want array<string>, represented array<string>, expected array<string>")
    r = suites.run_evaluation(runs)
    assert tuple(r.first()) == (2, 0.5, 0.25, 0.25, 0.5, 0.75)
    assert one(suites.capped(F.array(*map(F.lit, range(5))), 3)).asDict() == {"shown": [0, 1, 2], "more": 2}
    assert one(metrics.evidence_recall(arr(), arr())) == 0.0


def test_inference(spark):
    text = "The Internet Society must act. Jane Doe, the chief officer, spoke. Members may vote! The council supports open access."
    seg = spark.createDataFrame([("s1", text), ("s2", None)], "segment_id string, text string")
    found = {(r.mention, r.kind, r.role) for r in inference.entities(seg).collect()}
    assert ("Jane Doe", "person", "chief officer") in found and any(k == "organization" for _, k, _ in found)
    assert [(r.factor, r.ordinal) for r in inference.policy_factors(seg).orderBy("ordinal").collect()] == [("requirement", 0), ("permission", 2)]
    svo = inference.svo_positions(seg).collect()
    assert [(r.subject, r.verb, r.object) for r in svo] == [("The council", "supports", "open access")]

    def call(texts):
        if any("bad" in t for t in texts):
            raise ValueError("no")
        return [{"translation": t.upper()} for t in texts]

    rows = spark.createDataFrame([("1", "good", 0.0), ("2", "bad", 1.0)], "segment_id string, text string, start double")
    got = {r.segment_id: r for r in inference.translate(rows, call).collect()}
    assert (got["1"].translation, got["1"].confidence, got["1"].error, got["1"].start) == ("GOOD", 0.9, None, 0.0)
    assert got["2"].translation is None and got["2"].confidence is None and got["2"].error.startswith("ValueError")
    img = spark.createDataFrame([("p", b"x")], "path string, content binary")
    assert inference.ocr(img, lambda xs: [{"text": "t", "confidence": 0.5} for _ in xs]).first().confidence == 0.5
    said = inference.transcribe(img, lambda xs: [{"language": "en", "segments": [{"start": 0.0, "end": 1.0, "text": "a"}, {"start": 1.0, "end": 2.0, "text": "b"}]} for _ in xs]).collect()
    assert [(r.ordinal, r.text) for r in said] == [(0, "a"), (1, "b")]
    frames = spark.createDataFrame([("v", 0, "A"), ("v", 25, "A"), ("v", 50, "B")], "path string, frame int, text string")
    line = [(r.start, r.end, r.text, r.frames) for r in inference.frame_timeline(frames, F.lit(25.0)).orderBy("start").collect()]
    assert line == [(0.0, 1.0, "A", 2), (2.0, 2.0, "B", 1)]
    assert spark.range(1).select(inference.edge_confidence(F.lit(5), F.lit(10))).first()[0] == 0.5


def test_argument_rules_with_the_fixed_words(spark):
    docs = spark.createDataFrame([(1, "We act because it helps. It is late, therefore we go. We must go. Nothing.")], "doc_id int, text string")
    assert [(r.claim, r.justification) for r in deliberation.argument_claims(docs).collect()] == [("We act", "it helps.")]
    assert [r.ordinal for r in deliberation.modal_positions(docs).collect()] == [2]
    pair = spark.createDataFrame([("They argue for it", "fine"), ("a", "However not"), ("a", "b")], "m string, c string")
    assert [r[0] for r in pair.select(deliberation.is_counterargument(F.col("m"), F.col("c"))).collect()] == [True, True, False]
    seg = spark.createDataFrame([("s", "The Open Data Institute said so."), ("t", "nobody")], "segment_id string, text string")
    assert [(r.segment_id, r.mention) for r in deliberation.stakeholders(seg).collect()] == [("s", "The Open Data Institute")]


def test_engine_statuses(spark):
    recs = spark.createDataFrame([("r1", "rights of users", "civil"), ("r2", "rights of firms", "industry"), ("r3", "rights rights", "")], "record_id string, text string, g string")
    asked = spark.createDataFrame([(1, "rights", ["civil", "government"]), (2, "zebra", ["civil"])], "question_id int, text string, required_stakeholder_groups array<string>")
    got = {r.question_id: r for r in engine.analyze(recs, asked, group="g").collect()}
    assert got[1].status == "needs_review" and got[1].missing == ["government"] and got[1].represented == ["civil", "industry"]
    assert got[1].errors == ["stakeholder_group is required"] and got[1].unresolved[0] == "perspective missing: government" and len(got[1].limitations) == 3
    assert got[2].status == "needs_evidence" and got[2].evidence == [] and got[2].synthesis is None and deliberation.NOTHING in got[2].limitations
    assert "[r3] (score " in got[1].prompt and got[2].prompt.endswith("Evidence:\nnone")
    own = spark.createDataFrame([(1, "civil", "Yes.", ["r1"], 0.5)], "question_id int, stakeholder_group string, position string, evidence_record_ids array<string>, confidence double")
    one = engine.answer(recs, asked, group="g", perspectives=own, make=plugins.Echo).filter("question_id = 1").first()
    assert one.represented == ["civil"] and one.status == "model_synthesis_complete" and one.synthesis.startswith("[no model]")

    class Broken:
        def generate(self, prompt, context):
            raise RuntimeError("down")

    two = engine.analyze(recs, asked, group="g", perspectives=own, make=Broken).filter("question_id = 1").first()
    assert two.status == "ready_for_model_synthesis" and two.limitations[-1] == "No synthesis: RuntimeError: down"


def test_sinks_and_readers(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "text " * 200, "u", [("s", 1)]), ("d2", "b", None, [])], "document_id string, text string, source_url string, segments array<struct<a:string,b:int>>")
    sinks.json_documents(docs, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    sinks.export_corpus(docs.withColumn("more", F.array(F.lit(1))), f"{tmp_path}/e")
    assert spark.read.parquet(f"{tmp_path}/e/parquet").columns == ["document_id", "source_url", "more"]
    sinks.hub_dataset(docs, docs.select("document_id", "text"), f"{tmp_path}/h")
    assert spark.read.parquet(f"{tmp_path}/h/flat").agg(F.max(F.length("text"))).first()[0] == 500
    ex = spark.createDataFrame([("train", "t", [("user", "q")]), ("test", "t", [("user", "q")])], "split string, task_type string, messages array<struct<role:string,content:string>>")
    sinks.sft_splits(ex, f"{tmp_path}/s", revision="r1")
    assert {(r.split, r.n, r.revision) for r in spark.read.json(f"{tmp_path}/s/metadata").collect()} == {("train", 1, "r1"), ("test", 1, "r1")}
    sinks.dataset_folder({"train": ex.filter("split = 'train'")}, f"{tmp_path}/d", "A set")
    assert spark.read.text(f"{tmp_path}/d/readme").first()[0] == "# A set" and spark.read.json(f"{tmp_path}/d/info").first().n == 1
    sinks.alias_corpus(docs, spark.createDataFrame([("x", "d1")], "alias_id string, canonical_id string"), f"{tmp_path}/a")
    assert spark.read.json(f"{tmp_path}/a/aliases").first().canonical_id == "d1"
    files = spark.createDataFrame([("b", 1, "h2"), ("a", 1, "h1")], "path string, bytes long, sha256 string")
    assert not sinks.gated_manifest(files, ex, f"{tmp_path}/m") and sinks.gated_manifest(files, ex.limit(0), f"{tmp_path}/m")
    assert [r.path for r in spark.read.json(f"{tmp_path}/m").collect()] == ["a", "b"]
    (tmp_path / "train.jsonl").write_text(json.dumps({"task_type": "t", "messages": [{"role": "user", "content": "q"}, {"content": None}]}) + "\n\n")
    read = readers.sft_jsonl(spark, f"{tmp_path}/train.jsonl")
    assert [(r.split, r.task_type) for r in read.collect()] == [("train", "t")]
    assert [tuple(m) for m in readers.messages_only(read).first().messages] == [("user", "q"), ("user", "")]
    (tmp_path / "c.yaml").write_text("a: 1\n")
    assert readers.yaml_config(str(tmp_path / "c.yaml")) == {"a": 1}
    (tmp_path / "l.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        readers.yaml_config(str(tmp_path / "l.yaml"))
    assert [r.ordinal for r in readers.url_list(spark, ["u1", "u2"], "s").collect()] == [0, 1]
    kind = "document_id string, metadata struct<title:string,language:string,published_at:string>, source_url string, final_url string, source_id string, artifact_sha256 string"
    meta = readers.document_meta(spark.createDataFrame([("d", (" ", None, "2020"), "u", None, None, None)], kind)).first()
    assert (meta.title, meta.language, meta.source_id, meta.source_hash) == ("u", "und", "unknown", "")
    doc = spark.createDataFrame([("d", "s1", [("e", "t", "me", "now")])], "document_id string, source_id string, provenance_events array<struct<event_id:string,event_type:string,agent:string,timestamp:string>>")
    src = spark.createDataFrame([("s1", "N", "F", 1), ("s1", "M", "F", 0)], "source_id string, name string, family string, registry_order int")
    hub = sinks.hub_records(doc, src).first()
    assert hub.name == "M" and hub.provenance_events[0].actor == "me" and hub.json_bytes > 10


def test_ingestion_chain(spark, tmp_path):
    long = "A paragraph about rules of the open network, long enough to count. " * 4
    for name, data in (("a.txt", long), ("b.txt", long), ("c.html", f"<html><body><p>{long} more</p></body></html>"), ("d.txt", "tiny"), ("e.bin", "x" * 40), ("f.txt", "known text " * 9)):
        (tmp_path / name).write_text(data)
    found = readers.artifacts(spark, str(tmp_path))
    known = found.filter("path LIKE '%f.txt'").select("sha256")
    out = ingest.ingest(found, known)
    got = {r.path.rsplit("/", 1)[1]: (r.status, r.reason) for r in out.collect()}
    assert got["a.txt"] == ("accepted", None) and got["b.txt"] == ("duplicate", "known content") and got["c.html"][0] == "accepted"
    assert got["d.txt"] == ("rejected", "too little text") and got["e.bin"][0] == "failed" and got["f.txt"][0] == "duplicate"
    one = out.filter("path LIKE '%a.txt'").first()
    assert one.segments[0].char_start == 0 and one.word_count == 48 and one.quality.status == "passed" and one.reading_minutes == 1
    near = {r.path.rsplit("/", 1)[1]: r.reason for r in ingest.without_near_duplicates(out, None, f"{tmp_path}/rounds").collect()}
    assert near["c.html"] == "near duplicate" and near["a.txt"] is None
    log = ingest.events(out, "me", "2024-01-01").collect()
    assert len(log) == 6 and len({e.event_id for e in log}) == 6 and {e.event_type for e in log} == {"FILE_ACCEPTED", "FILE_DUPLICATE", "FILE_FAILED", "FILE_REJECTED"}


def test_providers_in_a_chain_and_error_codes(spark):
    def broken(message):
        class Broken:
            def generate(self, prompt, context):
                raise RuntimeError(message)

        return Broken

    codes = {"HTTP 401": "auth_error", "429 slow down": "rate_limited", "503": "model_loading", "Timeout": "timeout", "404 not found": "model_not_found", "boom": "inference_failed"}
    assert {m: plugins.error_code(m) for m in codes} == codes and plugins.error_code("x", True) == "bad_response"
    chain = plugins.Chain(broken("503"), plugins.Echo)
    assert chain.generate("hello", [])["failures"] == [("model_loading", "503")] and plugins.Chain(broken("x")).generate("p", [])["error"] == "ALL_BACKENDS_UNAVAILABLE"
    rows = spark.createDataFrame([("1", "p")], "id string, prompt string")
    assert plugins.generate(rows, broken("429")).first().code == "rate_limited"
    claims = spark.createDataFrame([("c", "We should act", ["e"])], "claim_id string, claim string, evidence array<string>")
    plain = deliberation.argue(claims).first()
    assert (plain.pro_confidence, plain.contra_confidence, plain.method, round(plain.consensus, 6)) == (0.8, 0.6, "rule_based_fallback", 0.7) and plain.contra == "We not should act"

    class Model:
        def generate(self, prompt, context):
            return {"output": 'Sure: {"pro_argument": "a", "pro_confidence": 0.9, "contra_argument": "b", "contra_confidence": 0.5}'}

    said = deliberation.argue(claims, Model).first()
    assert (said.pro, said.contra, said.method, round(said.consensus, 6)) == ("a", "b", "provider_model", 0.8)
    assert deliberation.argue(claims, plugins.Echo).first().method == "rule_based_fallback"


def test_final_validation_and_build(spark):
    m = "array<struct<role:string,content:string>>"
    rows = [("train", [("user", "a")], ["d1"], ["h1"], None), ("test", [("user", "a")], ["d1"], ["zz"], "r" * 600), ("validation", [("user", "b")], ["d2"], [], "")]
    df = spark.createDataFrame(rows, f"split string, messages {m}, source_document_ids array<string>, source_hashes array<string>, reasoning string")
    got = sft.validate_final(df, spark.createDataFrame([("d1", "h1"), ("d2", "h2")], "document_id string, sha256 string")).first()
    assert (got.train_test, got.train_validation, got.duplicates, got.missing_provenance, got.private_fields, got.hash_mismatches, got.valid) == (1, 0, 1, 1, 1, 1, False)
    docs = spark.createDataFrame([(i, "x " * 300, "s", "en") for i in range(12)], "doc_id long, text string, source string, lang string")
    splits = spark.createDataFrame([(i, "train") for i in range(12)], "doc_id long, split string")
    assert sft.build(docs, splits)[1] == "READY" and sft.build(docs, splits)[0].count() == 24 and sft.build(docs.limit(3), splits)[1] == "BLOCKED"


def test_casts_and_page_readers(spark):
    row = spark.createDataFrame([([1, 2], "7", "x", bytearray(b"a\xffb"))], "a array<int>, n string, t string, b binary")
    got = row.select(casts.as_text(F.col("a"), "array<int>"), casts.as_count(F.col("a"), "array<int>"), casts.as_count(F.col("n"), "string"), casts.as_count(F.col("t"), "string"), casts.decoded(F.col("b"))).first()
    assert tuple(got) == ("[1,2]", 2, 7, 0, "a\ufffdb")
    assert capture.pdf_text(b"", ["a", "b"]) == "a\n\nb" and capture.pdf_text(b"x", ["", " "]) == ""
    capture.PAGE_READERS.append(lambda data: data.decode())
    assert capture.pdf_text(b"scan", [""]) == "scan"
    capture.PAGE_READERS.clear()


def test_small_helpers(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert {(r.k, r.v) for r in relational.last_by(rows, ["k"], "v", F.col("n")).collect()} == {("a", "y"), ("b", "z")}
    assert [r.k for r in relational.leakage(rows, rows.filter("n = 2"), "k").collect()] == ["a"]
    assert {(r.k, r.v) for r in merge_index(rows.filter("n = 1"), rows.filter("n = 2"), "k", "n").collect()} == {("a", "y"), ("b", "z")}
    chat = spark.createDataFrame([([("user", "q"), ("assistant", "a")],)], "m array<struct<role:string,content:string>>")
    assert [tuple(m) for m in chat.select(plugins.assistant_only("m")).first()[0]] == [("assistant", "a")]
    made = json.loads(plugins.experiment_manifest("e", "r", {"d": "1"}, {"x": 2}, "2024-01-01"))
    assert made["config"] == {"x": 2} and made["generated_at"] == "2024-01-01"
    titles = spark.createDataFrame([("Report 2019",), ("RFC 2019",), ("none",)], "t string").select(dates.title_year(F.col("t"), 2030)).collect()
    assert [str(r[0]) if r[0] else None for r in titles] == ["2019-07-01", None, None]
    codes = spark.createDataFrame([("de",), ("xx",)], "l string").select(languages.ocr_code(F.col("l")), languages.asr_model(F.col("l"))).collect()
    assert [tuple(r) for r in codes] == [("deu", "de"), ("eng", "base")]


def test_languages_are_detected(spark):
    out = QUERIES["lang_profile"](spark, SF)
    good = out.agg(F.avg((F.col("lang") == F.col("guess")).cast("int"))).first()[0]
    assert good >= 0.95
    none = spark.createDataFrame([(1, ""), (2, None), (3, "12 34")], "doc_id int, text string")
    assert {r.guess for r in languages.detect(none, languages.profile(spark.createDataFrame([("en", "the of")], "lang string, text string")), "doc_id").collect()} == {"und"}


def test_manifest_covers_the_whole_folder(spark):
    import os

    got = {r.name: (r.bytes, r.sha256, r.problem) for r in QUERIES["manifest_verify"](spark, SF).collect()}
    want = {}
    for name in os.listdir(SF):
        data = open(f"{SF}/{name}", "rb").read()
        want[name] = (len(data), hashlib.sha256(data).hexdigest(), "")
    assert got == want
