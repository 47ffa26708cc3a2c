"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

WORD = r"[^\x20\x09-\x0D]+"
#: Maps A-Z to a-z and keeps every other byte.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset, a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tessarium-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


class Scratch:
    """Tables written under the shared folder to cut lineage; each is read back with its schema.

    Executors can be lost at any time: a written table has no lineage to recompute. drop()
    deletes tables that no later step reads. The settings of a write hold for the session while any is
    running, whatever thread started it.
    """

    _lock, _users, _before = threading.Lock(), 0, {}

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.settings = {
            # shuffle files of a written step have no further use, so Spark removes them with the query
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
            # whole texts and sets travel in these batches: bytes bound the workers' memory, whatever a row holds
            "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
            "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
        }

    def _hold(self) -> None:
        with Scratch._lock:
            if not Scratch._users:
                Scratch._before = {k: self.spark.conf.get(k, None) for k in self.settings}
                for k, v in self.settings.items():
                    self.spark.conf.set(k, v)
            Scratch._users += 1

    def _release(self) -> None:
        with Scratch._lock:
            Scratch._users -= 1
            for k, v in Scratch._before.items() if not Scratch._users else ():
                if v is None:
                    self.spark.conf.unset(k)
                else:
                    self.spark.conf.set(k, v)

    def write(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """The written table; `by`: a column whose values get a folder each, so that some can be dropped."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        self._hold()
        try:
            writer = df.write.option("compression", "zstd")
            (writer.partitionBy(by) if by else writer).parquet(path)
        finally:
            self._release()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self.drop_path(df._scratch_path)

    def drop_path(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


#: What modules keep in a worker from task to task, by module, and how each is let go.
KEPT: dict[str, Callable[[], None]] = {}


def lean(f: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function of batches after which the worker gives free memory back; what other modules keep goes first.

    Workers live on from stage to stage, and their allocators hold what a stage needed at most. What a worker has
    imported is set aside after its first task: to look through it for garbage again took 0.1 CPU seconds a task.
    """

    @functools.wraps(f)
    def run(*args, **options) -> Iterator:
        for owner, let_go in KEPT.items():
            if owner != f.__module__:
                let_go()
        try:
            yield from f(*args, **options)
        finally:
            give_back()
            set_aside()

    return run


_ASIDE: list[int] = []


def set_aside() -> None:
    """Keeps the objects of this worker out of later collections, once; they still go when nothing refers to them."""
    if not _ASIDE:
        gc.freeze()
        _ASIDE.append(gc.get_freeze_count())


def give_back() -> None:
    """Gives free memory of this process back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc() -> ctypes.CDLL | None:
    try:
        found = ctypes.CDLL("libc.so.6")
        return found if hasattr(found, "malloc_trim") else None
    except OSError:  # another C library, which has no such call
        return None


_LIBC = _libc()


class Numbers(dict):
    """Numbers words in the order in which they are first asked for; words seen before cost one look-up."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def text_chunks(
    batches: Iterator[pa.RecordBatch], max_bytes: int = 2 << 20, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that the texts of each piece take about max_bytes at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = col.nbytes
        if size <= max_bytes or n == 1:
            yield batch
            continue
        step = max(1, int(n * max_bytes / size))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows with about `size` bytes of text each (one row at least)."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        n = pc.binary_length(batch.column("text")).fill_null(0).to_numpy()
        ends = np.cumsum(n)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(batch.num_rows, max(at + 1, int(np.searchsorted(ends, before + size - have, side="right"))))
            held.append(batch.slice(at, to - at))
            have += int(ends[to - 1]) - before
            at = to
            if have >= 0.9 * size:
                yield pa.Table.from_batches(held)
                held, have = [], 0
    if held:
        yield pa.Table.from_batches(held)


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
