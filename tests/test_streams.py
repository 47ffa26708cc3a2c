"""Stores that batches add to: replays, replacement, postings, near duplicates."""

from pyspark.sql import functions as F

from tessarium.operators import retrieval
from tessarium.streaming import streams


def batches(spark, folder, kind, *parts):
    """A stream of one batch a part: files are taken one at a time, in order."""
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder / f"in/part={k}"))
    schema = spark.createDataFrame(parts[0], kind).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").parquet(str(folder / "in/*"))


def again(folder):
    """Forgets that the last batch was committed, as if the driver had died right after its write."""
    commits = sorted((folder / "s/sync-checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (folder / "s/sync-checkpoint/commits").glob(".*.crc"):
        crc.unlink()


def test_sync_adds_once_and_replays_leave_the_store(spark, tmp_path):
    kind = "k string, v int"
    src = batches(spark, tmp_path, kind, [("a", 1), ("b", 2)], [("b", 9), ("c", 3), ("c", 3)])
    store = str(tmp_path / "s")
    first = sorted(map(tuple, streams.sync(src, store, "k").select("k", "v").collect()))
    assert [r[0] for r in first] == ["a", "b", "c"]
    again(tmp_path)
    assert sorted(map(tuple, streams.sync(src, store, "k").select("k", "v").collect())) == first


def test_sync_replaces_rows_of_a_key(spark, tmp_path):
    src = batches(spark, tmp_path, "k string, v int", [("a", 1), ("b", 2)], [("b", 9), ("c", 3)])
    got = streams.sync(src, str(tmp_path / "s"), "k", replace=True).select("k", "v").collect()
    last = {r.k: r.v for r in got}
    assert len(got) == 3 and last["a"] == 1 and last["c"] == 3 and last["b"] in (2, 9)
    again(tmp_path)
    assert {r.k: r.v for r in streams.sync(src, str(tmp_path / "s"), "k", replace=True).collect()} == last


def test_postings_through_a_stream_equal_postings_of_all(spark, tmp_path):
    kind = "record_id string, text string"
    parts = [[("r1", "alpha beta beta"), ("r2", "gamma")], [("r3", "beta delta"), ("r4", None)]]
    src = batches(spark, tmp_path, kind, *parts)
    got = streams.sync(src, str(tmp_path / "s"), "record_id", prepare=retrieval.postings, replace=True)
    cols = ["record_id", "term", "tf", "dl"]
    want = retrieval.postings(spark.createDataFrame([r for p in parts for r in p], kind))
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    newer = spark.createDataFrame([("r1", "epsilon")], kind)
    merged = retrieval.append_postings(got.select(cols), newer)
    assert {(r.record_id, r.term) for r in merged.collect()} == {("r1", "epsilon"), ("r2", "gamma"), ("r3", "beta"), ("r3", "delta")}
    rows = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], "record_id string, n int, text string")
    assert {(r.record_id, r.text) for r in retrieval.latest(rows, "n").collect()} == {("a", "new"), ("b", "x")}


def test_near_duplicates_in_a_stream(spark, tmp_path):
    base = " ".join(f"word{i} of the long text" for i in range(30))
    other = " ".join(f"different{i} words here" for i in range(30))
    kind = "doc_id long, text string"
    src = batches(spark, tmp_path, kind, [(5, base), (6, other)], [(1, base + " more"), (2, "short and new"), (3, other)], [(4, base + " again"), (7, "short and new!")])
    got = streams.near_duplicate_sync(src, str(tmp_path / "s"))
    ids = {r.doc_id for r in got.collect()}
    # which batch comes first is the file source's choice; one of each group is kept whatever it is
    assert len(ids & {5, 1, 4}) == 1 and len(ids & {6, 3}) == 1 and ids & {2, 7}
    again(tmp_path)
    assert {r.doc_id for r in streams.near_duplicate_sync(src, str(tmp_path / "s")).collect()} == ids


def test_term_counts_are_counted_in_the_row(spark):
    from tessarium.functions.text import term_counts

    rows = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (["x"],)], "w array<string>")
    got = [[tuple(x) for x in r[0]] for r in rows.select(term_counts(F.col("w"))).collect()]
    assert got == [[("a", 1), ("b", 3)], [], [("x", 1)]]


def test_retrieval_paths_agree(spark, monkeypatch):
    recs = spark.createDataFrame([(i, f"alpha beta {'gamma ' * (i % 4)}w{i % 5}", ["t%d" % (i % 3)]) for i in range(40)], "record_id long, text string, topics array<string>")
    asked = spark.createDataFrame([(1, "alpha gamma", ["t1"]), (2, "w3 beta beta", []), (3, "nothing", ["t0"])], "qid long, text string, topics array<string>")
    small = sorted(map(tuple, retrieval.top_k(recs, asked, k=5).select("qid", "rank", "record_id", "score").collect()))
    some = sorted(map(tuple, retrieval.top_k(recs, asked, k=5, facets=("topics",)).select("qid", "record_id").collect()))
    assert {r for q, r in some if q == 1} <= {i for i in range(40) if i % 3 == 1} and {q for q, _ in some} == {1, 2}
    only = retrieval.top_k(recs, asked, k=5, where=F.col("record_id") < 10).collect()
    assert only and all(r.record_id < 10 for r in only)
    monkeypatch.setattr(retrieval, "VOCABULARY", 2)
    assert sorted(map(tuple, retrieval.top_k(recs, asked, k=5).select("qid", "rank", "record_id", "score").collect())) == small
    found = {r.qid: r for r in retrieval.retrieve_evidence(recs.drop("topics"), asked, k=2).collect()}
    assert len(found[1].evidence) == 2 and found[3].evidence == [] and not found[3].found
