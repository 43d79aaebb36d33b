"""Documents as they arrive: the batch transforms inside each micro-batch, loaded per document."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagewright.operators import segment, sinks
from pagewright.sources.staging import shared_folder


def chunk_rows(docs: DataFrame) -> DataFrame:
    made = segment.with_ids(segment.word_stream(docs), docs)
    return made.select("chunk_id", "source_doc_id", "doc_id", "page_num", "chunk_index", "chunk_text", "n_words", "case_ref")


def start(spark: SparkSession, source: str, target: str, checkpoint: str, schema, **trigger) -> StreamingQuery:
    """Loads every new file of ``source`` into ``target``. Of a document that comes more than once, the newest file's counts, and
    one that comes again replaces itself, so that a
    batch which is run again after a failure changes nothing; no state outlives a page."""

    def load(batch: DataFrame, _: int) -> None:
        newest = sinks.last_by_id(batch, "doc_id", F.struct("__written", "__file", F.xxhash64("text")))
        sinks.write_documents(chunk_rows(newest.drop("__written", "__file")), target)

    at = spark._jvm.org.apache.hadoop.fs.Path(source)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # a stream reads folders
        source, reader = at.getParent().toString(), reader.option("pathGlobFilter", at.getName())
    stream = reader.parquet(source).select("*", F.col("_metadata.file_modification_time").alias("__written"), F.col("_metadata.file_path").alias("__file"))
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ingest_available(spark: SparkSession, source: str) -> DataFrame:
    """All that ``source`` holds now, through the stream, as a table of counts per case."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(source).schema
    start(spark, source, f"{at}/chunks", f"{at}/state", schema).awaitTermination()
    return spark.read.parquet(f"{at}/chunks").groupBy("case_ref").agg(F.count("*").alias("n_chunks"), F.countDistinct("source_doc_id").alias("n_documents"), F.sum("n_words").alias("n_words"))
