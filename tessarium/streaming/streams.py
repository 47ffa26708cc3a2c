"""Stateful operators on Structured Streaming, each with an availableNow trigger for bounded runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def dedup(stream: DataFrame, key: str = "sha256") -> DataFrame:
    """Artifacts whose hash was not seen before."""
    return stream.dropDuplicates([key])


def windowed_counts(stream: DataFrame, ts: str, kind: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by window and type; rows later than the watermark are left out."""
    marked = stream.withWatermark(ts, late)
    return marked.groupBy(F.window(ts, window).alias("w"), kind).agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, folder: str, name: str, mode: str = "append") -> DataFrame:
    """Drains what is there into Parquet, and reads it."""
    spark = stream.sparkSession
    out = f"{folder}/{name}"
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/{name}-checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).outputMode("append").start().awaitTermination()
    else:
        writer.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return spark.read.parquet(out)


def sync(
    stream: DataFrame,
    folder: str,
    key: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    replace: bool = False,
    within: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
) -> DataFrame:
    """A store that batches add to: corpus sync, index registration, postings.

    Each batch is a folder of its own, which a replayed batch writes again, so retries leave the store as it is.
    Rows whose key an earlier batch holds are left out, or, with replace, take the older rows' place when the store is
    read: the last batch of a key counts. `within` picks a batch's rows with the store at hand; `prepare` makes what is
    stored of them (with the key).
    """
    spark = stream.sparkSession
    store = f"{folder}/store"

    def add(batch: DataFrame, n: int) -> None:
        held = stored(spark, store)
        held = None if held is None else held.filter(F.col("batch") < n)
        if within is not None:
            batch = within(batch, held)
        else:
            batch = batch.dropDuplicates([key])
            if not replace and held is not None:
                batch = batch.join(held.select(key), key, "left_anti")
        rows = prepare(batch) if prepare else batch
        rows.write.mode("overwrite").parquet(f"{store}/batch={n}")

    stream.writeStream.option("checkpointLocation", f"{folder}/sync-checkpoint").trigger(availableNow=True).foreachBatch(add).start().awaitTermination()
    held = stored(spark, store)
    if replace:
        last = held.groupBy(key).agg(F.max("batch").alias("batch"))
        held = held.join(last, [key, "batch"], "left_semi")
    return held.drop("batch")


def stored(spark: SparkSession, store: str) -> DataFrame | None:
    """The batches of a store, null before the first."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(store)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path) or not files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{store}/batch=*")):
        return None
    return spark.read.parquet(store)


def near_duplicate_sync(stream: DataFrame, folder: str, threshold: float = 0.9) -> DataFrame:
    """Documents (doc_id, text) that are no near duplicates of accepted earlier ones: doc_id, text, duplicate_of (null).

    Earlier is an earlier batch, then the smaller doc_id. Accepted texts are the store; a batch is compared with
    itself and with them.
    """
    from ..operators.corpus import near_firsts

    def accept(batch: DataFrame, held: DataFrame | None) -> DataFrame:
        new = batch.dropDuplicates(["doc_id"]).select("doc_id", "text")
        if held is not None:
            new = new.join(held.select("doc_id"), "doc_id", "left_anti")
        return near_firsts(new, held, f"{folder}/rounds", threshold)

    return sync(stream, folder, "doc_id", within=accept)


def review_queue(events: DataFrame) -> DataFrame:
    """The head of a first-in-first-out queue: enqueued items (seq, review_id, op = put) not yet popped (op = pop)."""
    puts, pops = events.filter("op = 'put'"), events.filter("op = 'pop'").select("review_id")
    return puts.join(pops, "review_id", "left_anti").orderBy("seq").limit(1)
