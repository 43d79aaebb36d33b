"""Stored OCR responses: blocks as rows, and the links between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.schemas import OCR


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per response; each file holds one, with the schema declared and so never inferred."""
    return spark.read.schema(OCR).json(path, multiLine=True).withColumn("file", F.col("_metadata.file_path"))


def accepted(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Responses whose job succeeded and that have pages; and the others, with the reason."""
    reason = F.when(~F.coalesce(F.col("JobStatus") == "SUCCEEDED", F.lit(False)), F.concat(F.lit("job status "), F.coalesce("JobStatus", F.lit("unknown")))).when(F.coalesce(F.col("DocumentMetadata.Pages"), F.lit(0)) <= 0, "no pages")
    marked = responses.withColumn("error", reason)
    return marked.filter("error IS NULL").drop("error"), marked.filter("error IS NOT NULL")


def blocks(responses: DataFrame) -> DataFrame:
    """file, block_pos, id, type, text, kind of text, confidence, page and box of every block."""
    each = responses.select("file", F.posexplode("Blocks").alias("block_pos", "b"))
    box = F.col("b.Geometry.BoundingBox")
    return each.select("file", "block_pos", F.col("b.Id").alias("block_id"), F.col("b.BlockType").alias("block_type"), F.col("b.Text").alias("text"), F.col("b.TextType").alias("text_type"), F.col("b.Confidence").alias("confidence"), F.col("b.Page").alias("page_num"), *[box[n].alias(n.lower()) for n in ("Left", "Top", "Width", "Height")])


def links(responses: DataFrame) -> DataFrame:
    """file, parent_id, child_id, ordinal of every CHILD link."""
    each = responses.select("file", F.explode("Blocks").alias("b")).select("file", F.col("b.Id").alias("parent_id"), F.explode("b.Relationships").alias("r")).filter("r.Type = 'CHILD'")
    return each.select("file", "parent_id", F.posexplode("r.Ids").alias("ordinal", "child_id"))


def sample(lines: DataFrame) -> DataFrame:
    """Responses made from lines, one per document, written as JSON and parsed as a stored response is."""
    box = F.struct(F.struct(*[((b - a) / 1000.0).alias(n) for n, a, b in (("Width", F.col("left"), F.col("right")), ("Height", F.col("top"), F.col("bottom")))], (F.col("left") / 1000.0).alias("Left"), (F.col("top") / 1000.0).alias("Top")).alias("BoundingBox"))
    block = F.struct(F.concat_ws("-", "page_num", "line_pos").alias("Id"), F.lit("LINE").alias("BlockType"), F.col("text").alias("Text"), F.lit("PRINTED").alias("TextType"), F.col("confidence").alias("Confidence"), F.col("page_num").alias("Page"), box.alias("Geometry"))
    made = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_num", "line_pos", block.alias("b")))).alias("x"), F.max("page_num").alias("n"))
    whole = F.to_json(F.struct(F.lit("SUCCEEDED").alias("JobStatus"), F.struct(F.col("n").alias("Pages")).alias("DocumentMetadata"), F.transform("x", lambda x: x["b"]).alias("Blocks")))
    return made.select(F.col("doc_id").cast("string").alias("file"), F.from_json(whole, OCR).alias("r")).select("file", "r.*")
