"""Files around an evaluation: search terms, expected chunks, runs, the log of runs, and sweeps.

All go through Spark's readers and writers, so that any store that Spark reads will do. A table is a folder of CSV or JSON
files; what is one row in a run, such as its configuration, is a table of one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns that come by another name in files, and those that state how a file of expected chunks was made.
RENAMED = {"manual identifications": "manual_identifications", "acceptable associated terms": "acceptable_terms"}
METADATA = ("chunks_generated_with_date_variants", "chunks_generated_with_stemming", "chunking_strategy")
#: Columns that the log of runs doesn't keep, and those that stand first in it.
UNLOGGED, LOGGED_FIRST = ("fuzziness", "max_expansions", "queries_with_expected_chunk"), ("timestamp", "search_type")


def read_terms(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, bool | str]]:
    """The terms, all columns trimmed strings with blanks for nulls; and the metadata that their first row states."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    rows = raw.withColumnsRenamed(RENAMED)
    rows = rows.select(*[F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(c) for c in rows.columns])
    first = rows.select(*[c for c in METADATA if c in rows.columns]).limit(1).collect() if set(METADATA) & set(rows.columns) else []
    said = first[0].asDict() if first else {}
    return rows, {k: {"true": True, "false": False}.get(v.lower(), v) for k, v in said.items() if v}


def write_expected_chunks(rows: DataFrame, path: str, order: str, use_date_variants: bool = False, use_stemming: bool = False, strategy: str = "") -> None:
    """The terms with their expected chunks, as one CSV file by ``order``; the metadata stand in its first row alone."""
    stated = dict(zip(METADATA, (str(use_date_variants), str(use_stemming), strategy), strict=True))
    first = F.row_number().over(Window.orderBy(order)) == 1  # one file of terms
    marked = rows.withColumn("__first", first)
    for name, value in stated.items():
        marked = marked.withColumn(name, F.when(F.col("__first"), F.lit(value)).otherwise(F.lit("")))
    marked.drop("__first").coalesce(1).sortWithinPartitions(order).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_run(results: DataFrame, config: DataFrame, summary: DataFrame, path: str) -> None:
    """A run: its configuration and summary, of one row each, and its results, beside each other."""
    for name, part in (("config", config), ("summary", summary), ("results", results)):
        part.write.mode("errorifexists").csv(f"{path.rstrip('/')}/{name}", header=True, quote='"', escape='"')


def append_log(config: DataFrame, summary: DataFrame, path: str) -> None:
    """One more row of the log: configuration and summary, without some columns, the time and the type first."""
    row = config.crossJoin(summary).drop(*UNLOGGED)  # one row each
    names = [c for c in LOGGED_FIRST if c in row.columns]
    row.select(*names, *[c for c in row.columns if c not in names]).coalesce(1).write.mode("append").csv(path, header=True)


def write_sweep(trials: DataFrame, boosts: list[str], path: str, study: str, stamp: str) -> None:
    """A sweep's summary and all its trials as JSON under its stamp, and ``latest``, which names the stamp.

    trials: trial, score and a column for each boost. A score of 0 is written as null, as is one that is missing.
    """
    params = F.struct(*[F.bround(b, 4).alias(b) for b in boosts])
    best = F.max_by(F.struct("trial", "score", params.alias("params")), F.struct("score", (-F.col("trial")).alias("t")))
    summary = trials.agg(F.count("*").alias("n_trials"), best.alias("best")).select(
        F.lit(study).alias("study_name"), F.lit(stamp).alias("timestamp"), "n_trials", F.col("best.trial").alias("best_trial_number"), F.bround("best.score", 4).alias("best_score"), F.col("best.params").alias("best_params")
    )
    at = f"{path.rstrip('/')}/{stamp}"
    summary.write.mode("overwrite").json(f"{at}/summary")
    trials.select(F.col("trial").alias("number"), F.nullif(F.bround("score", 4), F.lit(0.0)).alias("value"), params.alias("params"), F.lit("COMPLETE").alias("state")).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{at}/trial_history")
    summary.select("timestamp").write.mode("overwrite").json(f"{path.rstrip('/')}/latest")
