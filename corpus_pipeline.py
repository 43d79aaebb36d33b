"""A corpus from ``documents``: each stage works on all rows that the one before it kept.

Every stage but the last returns the columns of its input. Stages are written as Parquet in the shared folder and
read again, so that a lost executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, table
from pagewright.llm.decontam import clean
from pagewright.llm.line_dedup import dedup
from pagewright.llm.near_dedup import group
from pagewright.llm.packing import pack
from pagewright.llm.toxicity import not_toxic, train


def _matched(docs: DataFrame, found: DataFrame, keep) -> DataFrame:
    """Rows of ``docs`` whose own row of ``found`` says so; both have a row number."""
    names = [c for c in docs.columns if c != "__row"]
    return docs.join(found.filter(keep).select("__row"), "__row", "left_semi").select(*names)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number that stays, as it is written along with them."""
    return Kept(docs.sparkSession).write(docs.withColumn("__row", F.monotonically_increasing_id()))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the cut. The machine is trained on the labelled rows of ``documents`` that aren't held out."""
    return not_toxic(docs, train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand elsewhere; a document all of whose lines go is a copy, and goes."""
    left = dedup(docs)
    return left.filter(F.col("dropped").isNull() | (F.length(F.trim("text")) > 0)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group of near copies that has the smallest doc_id."""
    rows = _numbered(docs)
    return _matched(rows, group(rows, row="__row").withColumnRenamed("row", "__row"), F.col("stays"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: No SQL: a trained machine and a tokenizer are in it. tests/llm holds it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = Kept(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        after = kept.write(stage(spark, docs, sf_dir))
        if i:
            kept.drop(docs)
        docs = after
    return docs
