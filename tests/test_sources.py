"""Sources, sinks, plug-ins and streams on small files."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tessarium.operators import plugins
from tessarium.sources import capture, readers, sinks
from tessarium.streaming import streams


def test_corpus_json_skips_broken_and_short(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"document_id": "a", "text": "x" * 250}))
    (tmp_path / "b.json").write_text(json.dumps({"document_id": "b", "text": "short"}))
    (tmp_path / "c.json").write_text("{broken")
    assert [r.document_id for r in readers.corpus_json(spark, str(tmp_path)).collect()] == ["a"]


def test_registry_checks_domains(spark):
    with pytest.raises(ValueError):
        readers.registry(spark, [{"id": "x", "domains": ["a/b"]}])
    assert readers.registry(spark, [{"id": "x", "domains": ["A.org"]}]).first().domains == ["a.org"]


def test_content_addressed_store_and_manifest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "p.html").write_text("<p>Hi</p>")
    (src / "q.txt").write_text("plain")
    found = readers.artifacts(spark, str(src))
    store = str(tmp_path / "store")
    assert sinks.content_addressed(found, store, spark).count() == 2
    assert spark.read.parquet(store).count() == 2
    sinks.content_addressed(found, store, spark)
    assert spark.read.parquet(store).count() == 2
    good = sinks.manifest(found)
    assert sinks.verify_manifest(found, good).count() == 0
    bad = good.withColumn("sha256", F.lit("0"))
    assert {r.problem for r in sinks.verify_manifest(found, bad).collect()} == {"hash mismatch"}
    text = {r.path.rsplit("/", 1)[1]: r.text for r in capture.extract(found).collect()}
    assert text == {"p.html": "Hi", "q.txt": "plain"}


def test_docx():
    data = io.BytesIO()
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{ns}"><w:p><w:t>A</w:t><w:t>b</w:t></w:p><w:p/><w:p><w:t>C</w:t></w:p></w:document>')
    assert capture.docx_text(data.getvalue()) == "Ab\nC"


def test_robots_and_options(spark):
    urls = spark.createDataFrame([("http://a.org/x",), ("http://a.org/private/x",), ("http://b.org/",), ("http://c.org/",), ("http://d.org/",)], "url string")
    robots = spark.createDataFrame([("a.org", 200, "User-agent: *\nDisallow: /private"), ("b.org", 404, None), ("c.org", 503, "x")], "host string, http_status int, body string")
    got = {r.url: r.allowed for r in capture.robots_allowed(urls, robots).collect()}
    assert got == {"http://a.org/x": True, "http://a.org/private/x": False, "http://b.org/": True, "http://c.org/": False, "http://d.org/": False}
    with pytest.raises(ValueError):
        capture.capture_options(max_bytes=1, max_download_mb=1)
    assert capture.capture_options()["timeout_s"] == 30
    plan = spark.createDataFrame([("s", 1, "http://a/1"), ("s", 2, "http://a/2"), ("s", 3, "http://b/1")], "source_id string, k int, url string")
    assert [r.wait_s for r in capture.rate_plan(plan, "k").orderBy("k").collect()] == [0.0, 1.0, 0.0]


def test_plugins(spark):
    df = spark.createDataFrame([("1", "hello\nworld")], "id string, prompt string")
    assert plugins.generate(df, plugins.Echo).first().output == "[no model] hello"

    class Broken:
        def generate(self, prompt, context):
            raise RuntimeError("down")

    assert plugins.generate(df, Broken).first().error == "RuntimeError: down"
    with pytest.raises(ValueError):
        plugins.provider("none")
    seg = spark.createDataFrame([("s", "t")], "segment_id string, text string")
    got = plugins.model_candidates(seg, lambda texts: [{"segment_index": 0, "candidate_type": "argument", "text": "x"}, {"segment_index": 9, "candidate_type": "y", "text": "z"}])
    assert {tuple(r) for r in got.collect()} == {("s", "argument", "x"), ("", "y", "z")}
    one = spark.range(1).select(plugins.json_in(F.lit('so {"a": 1} end'), "a int")["a"], plugins.frame_rate(F.lit("30/4")), plugins.frame_rate(F.lit("3/0"))).first()
    assert tuple(one) == (1, 7.5, None)


def test_links(spark):
    site = "<urlset><url><loc> http://a/1 </loc></url></urlset>"
    feed = "<rss><item><title>x</title><link>http://a/2</link></item></rss>"
    page = '<a href="/x">x</a><a href="#top">t</a>'
    got = spark.range(1).select(*[readers.discovered_links(k, F.lit(t)) for k, t in (("sitemap", site), ("feed", feed), ("html", page))]).first()
    assert [list(x) for x in got] == [["http://a/1"], ["http://a/2"], ["/x"]]


def test_streams(spark, tmp_path):
    src = tmp_path / "src"
    spark.createDataFrame([("a", 1), ("b", 2)], "sha256 string, v int").write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    assert streams.sync(streams.file_stream(spark, str(src), schema), str(tmp_path / "s"), "sha256").count() == 2
    spark.createDataFrame([("b", 9), ("c", 3)], "sha256 string, v int").write.mode("append").parquet(str(src))
    again = streams.sync(streams.file_stream(spark, str(src), schema), str(tmp_path / "s"), "sha256")
    assert sorted((r.sha256, r.v) for r in again.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    q = spark.createDataFrame([(1, "x", "put"), (2, "y", "put"), (3, "x", "pop")], "seq int, review_id string, op string")
    assert streams.review_queue(q).first().review_id == "y"
