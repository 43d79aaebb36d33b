"""What the operators share: reading, shared scratch tables, and Arrow text slices."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 6 << 20


def release() -> None:
    """Gives memory that Python has freed back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, giving back what its task has freed, as Spark keeps the worker for later stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; one is made only in a local run that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        named = context.getCheckpointDir()
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not named:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="pagewright-"))
            named = context.getCheckpointDir()
    return named.rstrip("/")


class Kept:
    """Tables written to the shared folder: they cut lineage, and a lost executor can't take them along."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at, self.n = spark, f"{scratch(spark)}/pagewright-{uuid.uuid4().hex}", 0
        self.made: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        self.n += 1
        path = f"{self.at}/{self.n}"
        df.write.parquet(path, compression=compression)
        release()  # so that shuffle files go that nothing reads any more
        self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Only for tables that no later result reads."""
        jvm = self.spark._jvm
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.made.pop(id(df))[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep_only(self, *tables: DataFrame) -> None:
        """Drops all tables but those that the result reads."""
        left = {id(df) for df in tables}
        self.drop(*[df for at, (df, _) in self.made.items() if at not in left])


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, rows go to Python in batches of at most so many; for wide rows, in jobs that run at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def uncoalesced(spark: SparkSession) -> Iterator[None]:
    """While it lasts, rows of few bytes and much work stay in all of a shuffle's tasks; in jobs that run at once."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of text; a longer text is a piece of its own, whole."""
    if not batch.num_rows:
        return
    at = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(at), "")
    batch = batch.set_column(at, column, texts)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between the six ASCII white spaces, A-Z lower-cased, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.concatenate([[0], np.cumsum(full)])
    counts = kept[ends[1:]] - kept[ends[:-1]]
    return (words if full.all() else words.filter(pa.array(full))), counts


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """Just the named columns, so that others can't clash with an operator's own."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def documents_only(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="long", text="string")


def rows_where(docs: DataFrame, decide: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all their columns, for which ``decide`` says so; it gets slices of filled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for piece in text_slices(batch.select(["text"])):
                yield batch.slice(start, piece.num_rows).filter(pa.array(decide(piece)))
                start += piece.num_rows

    return docs.mapInArrow(released(run), docs.schema)
