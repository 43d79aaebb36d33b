"""Loading per document: replace, delete, set aside; and summaries of what failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def delete_documents(target: DataFrame, gone: DataFrame, key: str = "source_doc_id") -> DataFrame:
    return target.join(gone.select(key).distinct(), key, "left_anti")


def last_by_id(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """Of rows with one id, the last."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))).filter("__n = 1").drop("__n")


def upsert_documents(target: DataFrame, batch: DataFrame, key: str = "source_doc_id") -> DataFrame:
    """Every document of the batch replaces all its rows; loading a batch again changes nothing."""
    return delete_documents(target, batch, key).unionByName(batch, allowMissingColumns=True)


def write_documents(batch: DataFrame, path: str, key: str = "source_doc_id", buckets: int = 32) -> None:
    """The same for a Parquet table in buckets of documents: only the buckets of the batch are read and replaced.

    They are written beside the table first, so that a failure leaves the table as it was."""
    spark = batch.sparkSession
    own = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    touched = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    merged = own
    if at.getFileSystem(conf).exists(at):
        old = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
        merged = upsert_documents(old, own, key)
    staged = f"{path.rstrip('/')}.staged"
    merged.write.mode("overwrite").partitionBy("bucket").parquet(staged)
    spark.read.parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    aside = jvm.org.apache.hadoop.fs.Path(staged)
    aside.getFileSystem(conf).delete(aside, True)


def quarantine(rows: DataFrame, problems: dict[str, Column]) -> DataFrame:
    """Rows with ``error``: the first problem that holds, or null."""
    found = F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in problems.items()])
    return rows.withColumn("error", found)


def top_causes(errors: DataFrame, fields: list[str], n: int = 3) -> DataFrame:
    """The most frequent combinations as one line."""
    known = [F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias(f) for f in fields]
    top = errors.select(*known).groupBy(*fields).count().orderBy(F.desc("count"), *fields).limit(n)
    said = F.concat(F.col("count").cast("string"), F.lit("x("), F.concat_ws(", ", *[F.concat(F.lit(f"{f}="), F.col(f)) for f in fields]), F.lit(")"))
    order = F.struct((-F.col("count")).alias("c"), *fields, said.alias("said"))
    return top.agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["said"]), "; ").alias("summary"))
