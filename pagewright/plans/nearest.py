"""The nearest of all candidates to each of many queries, exactly: products of whole blocks instead of pairs as rows."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries of a block, about, and candidates that it meets at a time.
QUERIES, CANDIDATES = 8192, 512
#: Scores are rounded to steps of a millionth. Products added in another order differ by far less than this part of a step.
STEPS, NEAR = 1_000_000, 1e-4
#: Where a score isn't a number, which comes first; where it is null, which comes last; where there is no candidate yet.
NO_NUMBER, NO_SCORE, NO_ROW = 1 << 40, -(1 << 40), -(1 << 41)


def _sized(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, filled up with zeros, and their sizes; -1 where a vector or a part of it is null."""
    size = np.array(rows.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False))
    flat = rows.flatten()
    if len(size) and size[0] > 0 and (size == size[0]).all() and not flat.null_count:
        return flat.to_numpy(zero_copy_only=False).reshape(-1, size[0]), size
    out = np.zeros((len(size), max([1, *size.tolist()])))
    for i, own in enumerate(rows.to_pylist()):
        if own is None or None in own:
            size[i] = -1
        else:
            out[i, : len(own)] = own
    return out, size


def _exact(x: np.ndarray, y: np.ndarray) -> int:
    """The step of one pair's score, its products added in order, as ``cosine_score`` adds and rounds them."""
    dot = 0.0
    for a, b in zip(x.tolist(), y.tolist(), strict=True):
        dot += a * b
    return int((Decimal(repr((1 + dot) / 2)) * STEPS).quantize(Decimal(1), ROUND_HALF_UP))


def _kth(score: np.ndarray, k: int) -> np.ndarray:
    return np.partition(score, score.shape[1] - k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(score), -np.inf)


class Block:
    """The best candidates so far of a block of queries. Candidates come in the order in which equal scores go."""

    def __init__(self, ids: pa.Array, vectors: pa.Array, k: int):
        self.ids, (self.vectors, self.sizes), self.k = ids, _sized(vectors), k
        self.score, self.place = np.full((len(ids), k), NO_ROW, np.int64), np.full((len(ids), k), -1, np.int64)
        self.keys: list[pa.Array] = []
        self.seen = 0

    def meet(self, keys: pa.Array, vectors: pa.Array) -> None:
        y, sizes = _sized(vectors)
        x, wide = self.vectors, max(self.vectors.shape[1], y.shape[1])
        x, y = (np.pad(z, ((0, 0), (0, wide - z.shape[1]))) if z.shape[1] < wide else z for z in (x, y))
        near = x @ y.T
        near += 1
        near *= STEPS / 2
        odd = np.isnan(near) if np.isnan(near.sum()) else None
        if odd is not None:
            near[odd] = NO_NUMBER
        if not (self.sizes == self.sizes[0]).all() or not (sizes == self.sizes[0]).all() or self.sizes[0] < 0:
            near[(self.sizes[:, None] != sizes) | (self.sizes[:, None] < 0)] = NO_SCORE
        last = self.score[:, -1].astype(np.float64)
        bar = last + 0.5 - NEAR  # an equal score comes later, and so is behind
        if (last == NO_ROW).any():
            bar = np.maximum(bar, _kth(near, self.k) - 2)
        q, c = np.nonzero(near >= bar[:, None])
        rough = near[q, c]
        step = np.floor(rough + 0.5).astype(np.int64)
        number = (rough > NO_SCORE) & (rough < NO_NUMBER)
        for i in np.flatnonzero(number & (np.abs(rough - np.floor(rough) - 0.5) < NEAR)).tolist():
            step[i] = _exact(x[q[i]], y[c[i]])
        self._merge(q, step, self.seen + c)
        self.keys.append(keys)
        self.seen += len(keys)

    def _merge(self, q: np.ndarray, step: np.ndarray, place: np.ndarray) -> None:
        some, at, counts = np.unique(q, return_inverse=True, return_counts=True)
        if not len(some):
            return
        k, within = self.k, np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
        score = np.full((len(some), k + int(counts.max())), NO_ROW, np.int64)
        where = np.full(score.shape, -1, np.int64)
        score[:, :k], where[:, :k] = self.score[some], self.place[some]
        score[at, k + within], where[at, k + within] = step, place
        order = np.argsort(-score, axis=1, kind="stable")[:, :k]
        self.score[some], self.place[some] = np.take_along_axis(score, order, 1), np.take_along_axis(where, order, 1)

    def rows(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        q, at = np.nonzero(self.place >= 0)
        step, keys = self.score[q, at], pa.concat_arrays(self.keys)
        score = np.where(step == NO_NUMBER, np.nan, step / STEPS)
        yield pa.RecordBatch.from_arrays([self.ids.take(pa.array(q)), keys.take(pa.array(self.place[q, at])), pa.array(score, mask=step == NO_SCORE)], names=names)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Stretches of rows of one scope, part and side, and whether a new scope or part starts."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = np.zeros(batch.num_rows - 1, bool)
        for name in ("scope", "part", "side"):
            column = batch.column(name)
            changes |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        ends = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for start, stop in zip(ends[:-1], ends[1:], strict=True):
            piece = batch.slice(start, stop - start)
            now = piece.column("scope")[0].as_py(), piece.column("part")[0].as_py()
            yield now != last, piece
            last = now


def knn_every(queries: DataFrame, candidates: DataFrame, scope: str, key: str, k: int = 40) -> DataFrame:
    """As ``retrieval.knn``, with the same rows, where queries are many: query_id, key, score, rank.

    Queries of a scope are dealt into blocks, and each block meets all candidates of its scope, a slice at a time, so that a pair is
    neither a row nor leaves its task. Null vectors, those with null parts and those of another size have null scores, and come last.
    query_id and key are of one type.
    """
    spark, found = queries.sparkSession, queries.schema["query_id"].dataType.simpleString()
    vector = lambda name: F.col(name).cast("array<double>").alias("vector")
    asked = queries.select(F.col(scope).alias("scope"), F.col("query_id").alias("id"), vector("vector"), F.monotonically_increasing_id().alias("n"))
    parts = asked.filter("scope IS NOT NULL").groupBy("scope").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    one = asked.join(parts, "scope").select("scope", F.pmod("n", "parts").cast("int").alias("part"), F.lit(0).alias("side"), "id", "vector")
    own = candidates.select(F.col(scope).alias("scope"), F.col(key).alias("id"), vector("embedding")).join(parts, "scope")
    two = own.select("scope", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("side"), "id", "vector")
    # few bytes and much work, so they are dealt out by their number
    dealt = one.unionByName(two).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "scope", "part").sortWithinPartitions("scope", "part", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, blocks, asked = ["query_id", key, "score"], [], []
        for new, piece in _groups(batches):
            if new:
                for block in blocks:
                    yield from block.rows(names)
                blocks, asked = [], []
            if piece.column("side")[0].as_py() == 0:
                asked.append(piece)
                continue
            if asked:
                ids, vectors = (pa.concat_arrays([a.column(c) for a in asked]) for c in ("id", "vector"))
                blocks, asked = [Block(ids.slice(i, QUERIES), vectors.slice(i, QUERIES), k) for i in range(0, len(ids), QUERIES)], []
            for start in range(0, piece.num_rows, CANDIDATES):
                some = piece.slice(start, CANDIDATES)
                for block in blocks:
                    block.meet(some.column("id"), some.column("vector"))
        for block in blocks:
            yield from block.rows(names)

    scored = dealt.mapInArrow(run, f"query_id {found}, `{key}` {found}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), key)  # where an id repeats, its rows are ranked together
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
