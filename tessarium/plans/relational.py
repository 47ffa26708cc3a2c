"""Queries on joins, set operations, windows and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import relational as op
from ..sources.readers import parquet
from .corpus import docs
from .registry import query


@query(
    "join_docs_sources",
    """WITH r AS (SELECT n_regionkey, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation)
    SELECT r_regionkey, r_name, n_name FROM region JOIN r ON r_regionkey = n_regionkey AND k = 1""",
)
def join_docs_sources(spark, sf_dir):
    """Each left row with the first right row of its key."""
    left = parquet(spark, sf_dir, "region").withColumn("key", F.col("r_regionkey"))
    right = parquet(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("key"), "n_nationkey", "n_name")
    return op.first_match(left, right, "key", ["n_nationkey"]).select("r_regionkey", "r_name", "n_name")


@query(
    "lookup_default",
    "SELECT d.doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def lookup_default(spark, sf_dir):
    labels = parquet(spark, sf_dir, "labels").select("doc_id", "quality")
    return op.lookup(docs(spark, sf_dir).select("doc_id"), labels, "doc_id", {"quality": -1})


@query("coverage_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def coverage_anti(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id").join(parquet(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query(
    "anti_new_artifacts",
    "SELECT doc_id FROM documents WHERE lang = 'en' AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang <> 'en')",
)
def anti_new_artifacts(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "lang", F.sha2("text", 256).alias("sha256"))
    held = rows.filter("lang <> 'en'").select("sha256").distinct()
    return rows.filter("lang = 'en'").join(held, "sha256", "left_anti").select("doc_id")


@query(
    "corpus_sync",
    "SELECT doc_id FROM documents WHERE length(text) >= 100 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def corpus_sync(spark, sf_dir):
    held = parquet(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return docs(spark, sf_dir).filter(F.length("text") >= 100).select("doc_id").join(held, "doc_id", "left_anti")


@query("split_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def split_semi(spark, sf_dir):
    good = parquet(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return docs(spark, sf_dir).select("doc_id", "lang").join(good, "doc_id", "left_semi")


@query(
    "reconcile",
    """SELECT doc_id, 'local' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'remote' FROM (SELECT DISTINCT doc_id FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def reconcile(spark, sf_dir):
    return op.reconcile(docs(spark, sf_dir), parquet(spark, sf_dir, "labels"), "doc_id")


_SPLIT = """r AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('42' || chr(1) || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents),
sp AS (SELECT doc_id, CASE WHEN k <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN k <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM r)"""


@query("doc_split", f"WITH {_SPLIT} SELECT doc_id, split FROM sp")
def doc_split(spark, sf_dir):
    return op.hash_split(docs(spark, sf_dir), "doc_id")


@query(
    "split_leakage",
    f"""WITH {_SPLIT}, h AS (SELECT DISTINCT split, sha256(text) AS sha256 FROM documents JOIN sp USING (doc_id))
    SELECT a.split AS a, b.split AS b, count(*) AS n FROM h a JOIN h b USING (sha256) WHERE a.split < b.split GROUP BY ALL""",
)
def split_leakage(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("sha256")).join(op.hash_split(docs(spark, sf_dir), "doc_id"), "doc_id")
    h = rows.select("split", "sha256").distinct()
    return (
        h.select(F.col("split").alias("a"), "sha256")
        .join(h.select(F.col("split").alias("b"), "sha256"), "sha256")
        .filter("a < b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"))
    )


# speakers: events of a user as spoken turns of ten minutes, transcript segments of seven minutes each five
_TURNS = """t AS (SELECT user_id, event_id AS turn, event_type AS speaker, epoch(ts) AS s, epoch(ts) + 600 AS e FROM events),
g AS (SELECT user_id, event_id AS seg, epoch(ts) + 300 AS s, epoch(ts) + 720 AS e FROM events)"""


def seconds(ts):
    """Seconds since 1970 of a timestamp without zone, whatever the session's zone."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, ts) / F.lit(1e6)


def _turns(spark, sf_dir):
    ts = seconds(F.col("ts"))
    e = parquet(spark, sf_dir, "events")
    turns = e.select(F.col("user_id").alias("group"), F.col("event_id").alias("turn"), F.col("event_type").alias("speaker"), ts.alias("start"), (ts + 600).alias("end"))
    segs = e.select(F.col("user_id").alias("group"), F.col("event_id").alias("seg"), (ts + 300).alias("start"), (ts + 720).alias("end"))
    return turns, segs


@query(
    "interval_speaker",
    f"""WITH {_TURNS}, o AS (SELECT g.user_id, seg, turn, speaker, least(g.e, t.e) - greatest(g.s, t.s) AS v FROM g JOIN t ON g.user_id = t.user_id AND t.s < g.e AND g.s < t.e)
    SELECT g.user_id, g.seg, (SELECT arg_min(speaker, (-v, turn)) FROM o WHERE o.user_id = g.user_id AND o.seg = g.seg) AS speaker FROM g""",
)
def interval_speaker(spark, sf_dir):
    turns, segs = _turns(spark, sf_dir)
    return op.speaker_of(segs, turns, bucket=1200.0).select(F.col("group").alias("user_id"), "seg", "speaker")


@query(
    "overlap_score",
    f"""WITH {_TURNS} SELECT g.user_id, round(coalesce(sum(greatest(least(g.e, t.e) - greatest(g.s, t.s), 0)), 0) / (count(DISTINCT seg) * 420.0::DOUBLE), 6) AS score
    FROM g LEFT JOIN t ON g.user_id = t.user_id AND t.s < g.e AND g.s < t.e GROUP BY g.user_id""",
)
def overlap_score(spark, sf_dir):
    turns, segs = _turns(spark, sf_dir)
    return M.overlap_score(segs, turns, bucket=1200.0).select(F.col("group").alias("user_id"), F.round("score", 6).alias("score"))


@query(
    "islands",
    """WITH m AS (SELECT user_id, event_id, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS i FROM events),
    c AS (SELECT *, CASE WHEN i <> coalesce(lag(i) OVER w, 0) THEN 1 ELSE 0 END AS ch FROM m WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM c)
    SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r WHERE i = 1 GROUP BY user_id, run""",
)
def islands(spark, sf_dir):
    return op.islands(parquet(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], "event_id", F.col("value") >= 50)


@query(
    "early_stop",
    """WITH l AS (SELECT o_custkey AS run, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS epoch, CAST(o_totalprice AS DOUBLE) AS loss FROM orders),
    b AS (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM l),
    s AS (SELECT *, max(CASE WHEN best IS NULL OR loss < best THEN epoch END) OVER (PARTITION BY run ORDER BY epoch) AS seen FROM b)
    SELECT run, CAST(coalesce(min(CASE WHEN epoch >= 10 AND epoch - seen >= 2 THEN epoch END), -1) AS INTEGER) AS stopped_at FROM s GROUP BY run""",
)
def early_stop(spark, sf_dir):
    epoch = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    losses = parquet(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), epoch.alias("epoch"), F.col("o_totalprice").cast("double").alias("loss"))
    return op.early_stop(losses, "run").fillna(-1, ["stopped_at"])  # -1: never


@query(
    "ir_metrics",
    """WITH q AS (SELECT l_orderkey AS qid, list(l_partkey ORDER BY l_linenumber, l_partkey) AS got, list(DISTINCT l_partkey) FILTER (l_quantity >= 25) AS want FROM lineitem GROUP BY 1),
    k AS (SELECT qid, got, coalesce(want, []) AS want, list_distinct(got[1:3]) AS top, got[1:3] AS cut FROM q)
    SELECT qid, round(CASE WHEN len(want) = 0 THEN 1.0 ELSE len(list_intersect(top, want)) / len(want) END, 6)::DOUBLE AS recall,
      round(len(list_filter(cut, lambda x: list_contains(want, x))) / len(cut), 6)::DOUBLE AS precision,
      round(coalesce(1.0 / list_min(list_filter(list_transform(got, lambda x, i: CASE WHEN list_contains(want, x) THEN i END), lambda x: x IS NOT NULL)), 0), 6)::DOUBLE AS rr FROM k""",
)
def ir_metrics(spark, sf_dir):
    rows = parquet(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("qid")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("got"),
        F.collect_set(F.when(F.col("l_quantity") >= 25, F.col("l_partkey"))).alias("want"),
    )
    return rows.select(
        "qid",
        F.round(M.recall_at("got", "want", 3), 6).alias("recall"),
        F.round(M.precision_at("got", "want", 3), 6).alias("precision"),
        F.round(M.reciprocal_rank("got", "want"), 6).alias("rr"),
    )


_WORDS = r"list_distinct(regexp_extract_all(lower({0}), '\S+'))"


@query(
    "set_wer",
    f"""SELECT a.conv_id, a.turn, round(1 - len(list_intersect({_WORDS.format('a.text')}, {_WORDS.format('b.text')})) / greatest(len({_WORDS.format('a.text')}), 1), 6) AS wer
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
)
def set_wer(spark, sf_dir):
    c = parquet(spark, sf_dir, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("got"))
    return c.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", F.round(M.set_wer(F.col("text"), F.col("got")), 6).alias("wer"))


@query(
    "suite_rates",
    "SELECT event_type AS suite, count(*) AS total, count(*) FILTER (value >= 30) AS passed, round(count(*) FILTER (value >= 30) / count(*), 6) AS rate FROM events GROUP BY 1",
)
def suite_rates(spark, sf_dir):
    rows = parquet(spark, sf_dir, "events").select(F.col("event_type").alias("suite"), (F.col("value") >= 30).alias("passed"))
    return M.pass_rates(rows).withColumn("rate", F.round("rate", 6))


@query("support_rate", "SELECT source, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY source")
def support_rate(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", "source").join(parquet(spark, sf_dir, "labels"), "doc_id")
    return rows.groupBy("source").agg(F.round(F.avg((F.col("quality") == 1).cast("double")), 6).alias("rate"))


@query(
    "hallucination",
    """SELECT conv_id, turn, NOT (turn % 2 = 1) AND trim(text) <> '' AND NOT (contains(lower(text), 'the') OR contains(lower(text), 'que')) AS fabricated FROM conversations""",
)
def hallucination(spark, sf_dir):
    c = parquet(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", M.fabricated(F.col("text"), F.col("turn") % 2, ("the", "que")).alias("fabricated"))


@query(
    "loss_summary",
    """WITH v AS (SELECT l_returnflag AS suite, list_sort(list(CAST(l_discount AS DOUBLE))) AS x FROM lineitem GROUP BY 1)
    SELECT suite, round(list_avg(x), 6) AS mean, x[1 + len(x) // 2] AS median, x[1] AS low, x[len(x)] AS high, round(list_avg(list_transform(x, lambda y: exp(y))), 6) AS perplexity FROM v""",
)
def loss_summary(spark, sf_dir):
    rows = parquet(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("suite"), F.col("l_discount").cast("double").alias("loss"))
    return M.loss_summary(rows, "suite").select("suite", F.round("mean", 6).alias("mean"), "median", "low", "high", F.round("perplexity", 6).alias("perplexity"))


@query(
    "events_session",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
    SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS started, count(*) AS n FROM s GROUP BY user_id, k""",
)
def events_session(spark, sf_dir):
    w = F.session_window("ts", "30 minutes")
    out = parquet(spark, sf_dir, "events").groupBy("user_id", w.alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.floor(seconds(F.col("w.start"))).alias("started"), "n")
