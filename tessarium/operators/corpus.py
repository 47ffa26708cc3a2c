"""Corpus operators: gates, reasons, exact and near duplicates, aliases, reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _nfkc, needs_nfkc, normalize
from . import near


def normalized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Normalised texts; only rows that hold other than ASCII pass through the Arrow function."""
    ascii_only = docs.filter(~F.coalesce(needs_nfkc(F.col(text)), F.lit(False)))
    others = docs.filter(needs_nfkc(F.col(text))).withColumn(text, _nfkc(F.col(text)))
    return ascii_only.unionByName(others).withColumn(text, normalize(F.col(text)))


def invalid_reason(text: Column) -> Column:
    """Why a short text is no document: by length, then overridden by its words."""
    n, low = F.length(text), F.lower(text)
    by_length = F.when(n < 20, "empty").when(n < 60, "navigation_page").otherwise("insufficient_extraction")
    return F.when(
        n < 200,
        F.when(F.contains(low, F.lit("signing in")) | F.contains(low, F.lit("sign in")), "authentication_page")
        .when(F.contains(low, F.lit("cookie")), "cookie_page")
        .otherwise(by_length),
    )


def stub_reason(text: Column) -> Column:
    """The finer labels of the validation report, in their own order."""
    n, low = F.length(text), F.lower(text)
    has = lambda x: F.contains(low, F.lit(x))
    return (
        F.when(has("signing in") | has("sign in"), "authentication_page")
        .when(n < 20, "empty_or_near_empty")
        .when(has("cookie") & (n < 200), "cookie_page")
        .when(n < 60, "navigation_stub")
        .when(has("privacy policy") & (n < 200), "legal_stub")
        .when(n < 200, "insufficient_extraction")
        .otherwise("unknown")
    )


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keeps the first row of each key in an explicit order."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def resolve_duplicates(docs: DataFrame, min_chars: int = 200) -> tuple[DataFrame, DataFrame]:
    """Survivors (smallest doc_id of each text hash) and aliases (alias_id, canonical_id, reason)."""
    hashed = docs.filter(F.length("text") >= min_chars).withColumn("sha256", F.sha2("text", 256))
    canonical = hashed.groupBy("sha256").agg(F.min("doc_id").alias("canonical_id"))
    named = hashed.join(canonical, "sha256")
    aliases = named.filter("doc_id <> canonical_id").select(
        F.col("doc_id").alias("alias_id"), "canonical_id", F.lit("identical_content").alias("reason")
    )
    return named.filter("doc_id = canonical_id").drop("canonical_id"), aliases


def written(df: DataFrame, path: str) -> DataFrame:
    """The table, written and read again; shuffle files of a written step go with it."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def near_pairs(docs: DataFrame, k: int = 5, threshold: float = 0.9, folder: str | None = None) -> DataFrame:
    """a, b, jaccard: all pairs a < b of text classes whose character k-gram sets reach the threshold.

    Exact, by the pigeonhole principle (operators.near). Equal texts collapse to one class first (its smallest
    doc_id; see text_classes), so copies do not multiply. Classes are told apart by 60 bits of their hash, and
    candidates are verified on full sets of 64-bit shingle hashes. Texts and candidates are written under `folder`, so
    that their shuffle files don't add up; without one the plan is lazy throughout.
    """
    spark = docs.sparkSession
    kept = lambda df, name: df if folder is None else written(df, f"{folder}/{name}")
    rows = docs.select("doc_id", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long").alias("key"), "text")
    classes = kept(rows.filter("text IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("c"), F.first("text").alias("text")), "texts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = max(near.DEALT, parts // 16)
    signed = classes.select("key", "text").mapInArrow(partial(near.signatures, k=k, threshold=threshold, dealt=dealt), near.SIGNED)
    met = signed.repartition(parts, "band", "deal").sortWithinPartitions("band", "deal")
    pairs = kept(met.mapInArrow(partial(near.candidates, threshold=threshold), near.PAIRS).distinct(), "candidates")
    # candidates meet in blocks of texts that share their smallest neighbour, so that a text moves once a block
    ends = pairs.select(F.explode(F.array(*(F.struct(F.col(x).alias("x"), F.col(n).alias("n"), F.col(y).alias("y")) for x, n, y in (("a", "na", "b"), ("b", "nb", "a"))))).alias("e"))
    hub = ends.groupBy("e.x", "e.n").agg(F.min("e.y").alias("y")).select("x", "n", F.least("x", "y").alias("hub"))
    size = hub.groupBy("hub").agg(F.ceil(F.sum("n") / near.BLOCK).alias("blocks"))
    block = hub.join(size, "hub").select("x", F.xxhash64("hub", F.pmod(F.xxhash64("x"), F.col("blocks"))).alias("block"))
    placed = (
        pairs.join(block.select(F.col("x").alias("a"), F.col("block").alias("block_a")), "a")
        .join(block.select(F.col("x").alias("b"), F.col("block").alias("block_b")), "b")
        .select(F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).alias("block"), "a", "b")
    )
    needed = placed.select("block", F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = needed.join(classes.select("key", "text"), "key").select("block", F.col("key").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    asked = placed.select("block", "a", "b", F.lit(None).cast("string").alias("text"))
    both = texts.unionByName(asked).repartition(parts, "block").sortWithinPartitions("block", F.col("b").asc_nulls_first())
    found = both.mapInArrow(partial(near.verified, k=k, threshold=threshold), near.FOUND)
    named = found.join(classes.select(F.col("key").alias("a"), F.col("c").alias("ca")), "a").join(classes.select(F.col("key").alias("b"), F.col("c").alias("cb")), "b")
    return named.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "jaccard")


def text_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id: documents with equal texts share the smallest doc_id among them."""
    rows = docs.filter("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("h"))
    return rows.join(rows.groupBy("h").agg(F.min("doc_id").alias("class_id")), "h").select("doc_id", "class_id")


def greedy_resolve(classes: DataFrame, pairs: DataFrame, folder: str) -> DataFrame:
    """doc_id, duplicate_of: a document goes iff it is near an accepted earlier one, the first of which is named.

    Rounds over the classes: one without undecided or accepted earlier neighbours is accepted; later
    neighbours of accepted ones go. Each round is written, so the plan stays short; the edges are few.
    A copy of an accepted text names that text, a copy of a rejected one what rejected it.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        return written(df, f"{folder}/{name}")

    edges = kept(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "edges")
    state = kept(edges.select(F.col("a").alias("d")).union(edges.select("b")).distinct().withColumn("s", F.lit(0)), "state0")
    k = 0
    while not state.filter("s = 0").isEmpty():
        k += 1
        early = (
            edges.join(state.select(F.col("d").alias("a"), F.col("s").alias("sa")), "a")
            .groupBy(F.col("b").alias("d"))
            .agg(F.max((F.col("sa") == 1).cast("int")).alias("acc"), F.max((F.col("sa") == 0).cast("int")).alias("open"))
        )
        decided = (
            F.when(F.col("s") != 0, F.col("s"))
            .when(F.col("acc") == 1, -1)
            .when(F.coalesce("open", F.lit(0)) == 0, 1)
            .otherwise(0)
        )
        state = kept(state.join(early, "d", "left").select("d", decided.alias("s")), f"state{k}")
    named = (
        edges.join(state.filter("s = 1").select(F.col("d").alias("a")), "a", "left_semi")
        .groupBy(F.col("b").alias("class_id"))
        .agg(F.min("a").alias("first"))
        .join(state.filter("s = -1").select(F.col("d").alias("class_id")), "class_id", "left_semi")
    )
    own = F.when(F.col("doc_id") != F.col("class_id"), F.col("class_id"))
    return classes.join(named, "class_id", "left").select("doc_id", F.coalesce("first", own).alias("duplicate_of"))


def near_firsts(new: DataFrame, accepted: DataFrame | None, folder: str, threshold: float = 0.9) -> DataFrame:
    """The rows of new (doc_id, text) that are near no accepted text and no accepted earlier row of their own."""
    turn = lambda rows, n: rows.select(F.struct(F.lit(n).alias("turn"), F.col("doc_id").alias("id")).alias("doc_id"), "text")
    both = turn(new, 1) if accepted is None else turn(accepted, 0).unionByName(turn(new, 1))
    named = greedy_resolve(text_classes(both), near_pairs(both, threshold=threshold, folder=folder), folder)
    fine = named.filter("duplicate_of IS NULL AND doc_id.turn = 1").select(F.col("doc_id.id").alias("doc_id"))
    return new.join(fine, "doc_id", "left_semi")


def merge_index(index: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """Last write wins for each key."""
    last = Window.partitionBy(key).orderBy(F.desc(order))
    both = index.unionByName(batch)
    return both.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def counted(rows: DataFrame, *keys: str) -> DataFrame:
    """Ordered group counts; ties by the keys."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)


def list_percentile(values: DataFrame, column: str, ps: dict[str, float]) -> DataFrame:
    """For each p the value at place floor(n * p) of the sorted list (upper median for 0.5), exactly."""
    total = values.agg(F.count(column).alias("total"))
    by_value = values.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    # one row a distinct value
    below = F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = by_value.withColumn("upto", below).crossJoin(F.broadcast(total))
    place = lambda p: F.least(F.floor(F.col("total") * F.lit(p)), F.col("total") - 1)
    return ranked.agg(*[F.min(F.when(F.col("upto") > place(p), F.col("v"))).alias(name) for name, p in ps.items()])
