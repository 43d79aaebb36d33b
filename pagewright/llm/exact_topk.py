"""Exact top-k search by a vector-approximation file.

Every part of a vector is quantised to one of 256 cells of a grid over its dimension, and the cells are written as a
file of their own, a byte a part. For a block of queries, one scan of that file gives each vector the lowest and the
highest score that its cells allow; what can't reach the kth lowest bound is out. Exact vectors are then read in the
order of their highest scores: first a few for each query, then those that can still reach its kth exact score, which makes the
result certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, released, table

#: Queries that one scan of the cells answers; each task and the driver hold as many, whatever the table's size.
QUERY_BLOCK = 2048
CELLS = 256
#: Vectors that a task bounds at a time, and exact vectors that a query reads first, for each result.
VECTOR_BLOCK, FIRST = 4096, 4
#: What rounding may take from a bound, as a share of the largest sum it could be.
SLACK = 1e-12
CELL_FILE = "row long, vec_id long, size int, cells binary"
BOUNDED = "query long, row long, vec_id long, least double, most double"
Grids = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def whole(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row (a number of its own), vec_id and the vector as whole numbers; vectors null, empty, or with null or non-finite
    parts are left out."""
    at = F.transform(F.col("embedding").cast("array<double>"), lambda x: x)
    good = F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), at.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
        .filter(good.eqNullSafe(True))
        .select("row", "vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("long")).alias("vector"))
    )


def grids(vectors: DataFrame, cells: int = CELLS) -> Grids:
    """Of each length of vectors and each dimension, the grid's start, its cells' width and its end."""
    parts = vectors.select(F.size("vector").alias("size"), F.posexplode("vector").alias("at", "x")).groupBy("size", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    found: dict[int, list] = {}
    for r in parts.orderBy("size", "at").collect():
        found.setdefault(r["size"], []).append((r["low"], r["high"]))
    out = {}
    for size, ends in found.items():
        low, high = np.array(ends, np.int64).T
        out[size] = low, np.maximum(1, -(-(high - low + 1) // cells)), high
    return out


def by_size(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length, the places of its vectors, and the vectors as rows."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        own = sizes == size
        yield size, np.flatnonzero(own), vectors.filter(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def quantised(vectors: np.ndarray, grid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    low, width, _ = grid
    return ((vectors - low) // width).astype(np.uint8)


def bounds(queries: np.ndarray, cells: np.ndarray, grid: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and the highest inner product of each query with a vector in each row's cells."""
    low, width, high = grid
    floor = (low + cells * width).astype(np.float64)
    top = np.minimum(floor + width - 1, high).astype(np.float64)
    positive, negative = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    slack = SLACK * (np.abs(queries).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)).astype(np.float64))[:, None]
    return positive @ floor.T + negative @ top.T - slack, positive @ top.T + negative @ floor.T + slack


def _cells(vectors: DataFrame, held: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, own in by_size(batch.column("vector")):
                data = quantised(own, held.value[size])
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([some.column("row"), some.column("vec_id"), pa.array(np.full(len(at), size), pa.int32()), pa.array([x.tobytes() for x in data], pa.binary())], names=["row", "vec_id", "size", "cells"])

    return vectors.mapInArrow(released(run), CELL_FILE)


def _scan(cells: DataFrame, held: Broadcast, k: int) -> DataFrame:
    """Of each query, every row that can be among its k best as far as its task has seen, with the bounds of its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, asked = held.value
        best = {size: np.full((len(rows), k), -np.inf) for size, (rows, _) in asked.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, VECTOR_BLOCK):
                piece = batch.slice(start, VECTOR_BLOCK)
                sizes = piece.column("size").to_numpy(zero_copy_only=False)
                for size in np.unique(sizes).tolist():
                    if size not in asked:
                        continue
                    queries, vectors = asked[size]
                    some = piece.take(pa.array(np.flatnonzero(sizes == size)))
                    rows, ids = (some.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id"))
                    codes = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in some.column("cells")), np.uint8).reshape(-1, size)
                    least, most = bounds(vectors, codes, grid[size])
                    itself = queries[:, None] == rows
                    least[itself], most[itself] = -np.inf, -np.inf
                    best[size] = -np.sort(-np.hstack([best[size], least]), axis=1)[:, :k]
                    q, v = np.nonzero((most >= best[size][:, -1:]) & ~itself)
                    yield pa.RecordBatch.from_arrays([pa.array(queries[q]), pa.array(rows[v]), pa.array(ids[v]), pa.array(least[q, v]), pa.array(most[q, v])], names=["query", "row", "vec_id", "least", "most"])

    return cells.mapInArrow(released(run), BOUNDED)


def _scored(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """The pairs with their exact scores."""
    met = pairs.select("query", "row", "vec_id").join(vectors.select("row", "vector"), "row").join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("vector").alias("asked")), "query")
    product = F.aggregate(F.zip_with("vector", "asked", lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x)
    return met.select("query", "query_id", "row", "vec_id", product.alias("score"))


def _answers(kept: Kept, bounded: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of a block of queries, from the bounds of their candidates."""
    by_least = Window.partitionBy("query").orderBy(F.desc("least"), "row")
    kth = bounded.withColumn("place", F.row_number().over(by_least)).filter(F.col("place") == k).select("query", F.col("least").alias("floor"))
    possible = kept.write(bounded.join(kth, "query", "left").filter(F.col("floor").isNull() | (F.col("most") >= F.col("floor"))).drop("floor"))
    by_most = Window.partitionBy("query").orderBy(F.desc("most"), "row")
    ordered = possible.withColumn("place", F.row_number().over(by_most))
    first = kept.write(_scored(ordered.filter(F.col("place") <= FIRST * k), vectors, queries))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    certain = first.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == k).select("query", "score")
    rest = ordered.filter(F.col("place") > FIRST * k).join(certain, "query").filter(F.col("most") >= F.col("score")).drop("score")
    every = first.unionByName(_scored(rest, vectors, queries))
    return every.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, block: int = QUERY_BLOCK) -> DataFrame:
    """The k highest whole-number inner products of each query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``, against every other row; they are taken in blocks of
    ``block``, one scan of the cells each. Rows that repeat a vec_id, or a whole row, are rows of their own: each is a
    candidate, and a query if its vec_id says so. Only vectors as long as the query meet it. Vectors of null id, and
    those that are null, empty, or hold null or non-finite parts take no part; an empty table gives no rows. Vectors
    may be of any length; other columns aren't read.
    """
    spark = vectors.sparkSession
    kept = Kept(spark)
    exact = kept.write(whole(vectors, scale))
    grid = grids(exact)
    cells = kept.write(_cells(exact, spark.sparkContext.broadcast(grid)))
    queries = kept.write(exact.filter(F.col("vec_id") % every == 0).sort("row"))
    parts, after = [], None
    while True:
        rest = queries if after is None else queries.filter(F.col("row") > after)
        rows = rest.orderBy("row").limit(block).collect()
        if not rows:
            break
        asked = {}
        for n in {len(r["vector"]) for r in rows}:
            own = [r for r in rows if len(r["vector"]) == n]
            asked[n] = np.array([r["row"] for r in own], np.int64), np.array([r["vector"] for r in own], np.int64)
        held = spark.sparkContext.broadcast((grid, asked))
        own = queries.filter(F.col("row").between(rows[0]["row"], rows[-1]["row"]))
        parts.append(kept.write(_answers(kept, kept.write(_scan(cells, held, k)), exact, own, k)))
        held.unpersist()
        after = rows[-1]["row"]
    found = parts[0] if parts else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.n <> c.n AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
