"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full shingle sets, union-find groups.

SuperMinHash gives every shingle one random permutation of the signature's places and a rising rank along it, so
that a document's places are filled by correlated ranks of lower variance, and a step at which every place holds a
rank below the next one ends the work early. Documents with equal sets are one class from the start. Classes that
share a band are checked against the band's first class; only where that leaves several groups in a band are the
pairs across its groups checked too, in large bands block by block on whole sets. So a band full of copies costs its
number of classes, and no link is lost that shares a band: at a similarity of 0.75 all bands miss with a chance below 1e-4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, ascii_words, batches_of, released, table, text_slices
from pagewright.llm.links import resolve

WORDS, NEAR = 5, (75, 100)
BANDS, ROWS = 48, 6
PLACES = BANDS * ROWS
#: Shingles whose permutations are held at a time, and bytes of text that are sketched at a time.
HELD, SLICE = 20_000, 2 << 20
_M1, _M2, _GOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_R, _LOW = np.uint64(33), np.uint64(0xFFFFFFFF)
#: Up to so many classes, some 80 bytes each, are sent to every task; more are joined where they lie.
FEW = 50_000
#: Texts, or pairs of sets, that a task passes on at once.
ROWS_AT_ONCE = 500
#: Pairs of blocks of sets that a task reads at once.
BLOCKS_AT_ONCE = 4
SKETCH = "row long, doc_id long, text_key string, n_shingles long, set_key string, bands array<long>"


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _R)
    x *= _M1
    x ^= x >> _R
    x *= _M2
    x ^= x >> _R
    return x


def shingles(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending, texts in a row, and where each text's end. A text with
    fewer words has one shingle, of all its words; one without words has none."""
    words, per = ascii_words(texts)
    coded = words.dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    each = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)
    stops = np.cumsum(per)
    starts = stops - per
    counts = np.where(per >= size, per - size + 1, (per > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])
    padded = np.concatenate([each, np.zeros(size, np.uint64)])
    out = np.full(len(at), size, np.uint64)
    for j in range(size):
        out = out * _M1 + padded[at + j]
    for i in np.flatnonzero((per > 0) & (per < size)).tolist():
        value = np.uint64(per[i])
        with np.errstate(over="ignore"):
            for word in each[starts[i] : stops[i]]:
                value = value * _M1 + word
        out[ends[i]] = value
    out = mix(out)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        out[a:b].sort()
    if len(out):
        new = np.ones(len(out), bool)
        new[1:] = out[1:] != out[:-1]
        new[ends[:-1][counts > 0]] = True
        ends = np.concatenate([[0], np.cumsum(new)])[ends]
        out = out[new]
    return out, ends


def _draw(hashes: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The rank of this step, as step and 52 random bits, and the place to swap with."""
    with np.errstate(over="ignore"):
        x = mix(hashes + np.uint64(step + 1) * _GOLD)
    rank = (np.uint64(step) << np.uint64(52)) | (x >> np.uint64(12))
    swap = (((x * _GOLD) >> np.uint64(32)) & _LOW) * np.uint64(PLACES - step) >> np.uint64(32)
    return rank, swap.astype(np.int16) + np.int16(step)


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of places per text; texts without shingles keep the highest rank everywhere."""
    n = len(ends) - 1
    out = np.full((n, PLACES), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.diff(ends)
    doc, open_, own = np.repeat(np.arange(n), sizes), sizes > 0, hashes
    swaps: list[np.ndarray] = []
    values: list[np.ndarray] = []
    for step in range(6):  # long texts end here, with the few swaps of each shingle looked up
        rank, swap = _draw(own, step)
        place, moved = swap.copy(), np.full(len(own), step, np.int16)
        for k, v in zip(swaps, values, strict=True):
            np.copyto(place, v, where=k == swap)
            np.copyto(moved, v, where=k == step)
        np.minimum.at(out.reshape(-1), doc * PLACES + place, rank)
        swaps.append(swap)
        values.append(moved)
        open_ &= (out >> np.uint64(52)).max(1) > step
        left = open_[doc]
        if not left.all():
            own, doc = own[left], doc[left]
            swaps, values = [s[left] for s in swaps], [v[left] for v in values]
        if not len(own):
            return out
    rest = np.flatnonzero(open_)
    cut = np.searchsorted(np.cumsum(sizes[rest]), np.arange(HELD, int(sizes[rest].sum()) + HELD, HELD))
    for some in np.split(rest, np.unique(np.minimum(cut, len(rest)))):
        _finish(hashes, ends, some, out)
    return out


def _finish(hashes: np.ndarray, ends: np.ndarray, some: np.ndarray, out: np.ndarray) -> None:
    """Short texts from their first step on, each shingle with its whole permutation."""
    if not len(some):
        return
    sizes = ends[some + 1] - ends[some]
    own = np.concatenate([hashes[ends[i] : ends[i + 1]] for i in some.tolist()])
    doc = np.repeat(some, sizes)
    order = np.tile(np.arange(PLACES, dtype=np.int16), (len(own), 1))
    for step in range(PLACES):
        rank, swap = _draw(own, step)
        line = np.arange(len(own))
        place = order[line, swap].astype(np.int64)
        order[line, swap] = order[:, step]
        np.minimum.at(out.reshape(-1), doc * PLACES + place, rank)
        if step % 8 == 7:
            closed = (out[some] >> np.uint64(52)).max(1) <= step
            if closed.any():
                some = some[~closed]
                left = np.isin(doc, some)
                own, doc, order = own[left], doc[left], order[left]
                if not len(own):
                    return


def bands(signature: np.ndarray) -> np.ndarray:
    """A key per band, different from band to band."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), 1))
    for j in range(ROWS):
        key = mix(key * _M1 + parts[:, :, j])
    return key.view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_slices(batch, limit=SLICE):
            hashes, ends = shingles(piece.column("text"))
            sizes = np.diff(ends)
            keys = [xxhash.xxh3_128_hexdigest(hashes[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            signature = signatures(hashes, ends)[sizes > 0]
            made = bands(signature)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]), pa.int32()), pa.array(made.reshape(-1)))
            yield pa.RecordBatch.from_arrays([piece.column("row"), piece.column("doc_id"), piece.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), lists], names=["row", "doc_id", "text_key", "n_shingles", "set_key", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in text_slices(batch, limit=SLICE):
            hashes, ends = shingles(piece.column("text"))
            data = pa.array([hashes[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("node"), data], names=["node", "shingles"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each outsider and each other group in its block, one member that is near, by counts over the block's postings."""
    low, high = NEAR
    for batch in batches:
        pairs: list[np.ndarray] = []
        for outsiders, members in zip(batch.column("outsiders"), batch.column("members"), strict=True):
            theirs = members.values
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in theirs.field("load")]
            nodes, roots = (theirs.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root"))
            sizes = np.array([len(x) for x in own], np.int64)
            flat, where = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
            order = np.argsort(flat, kind="stable")
            names, starts = np.unique(flat[order], return_index=True)
            where, ends = where[order], np.append(starts[1:], len(flat))
            for one in outsiders.values.to_pylist():
                mine = np.frombuffer(one["load"], np.uint64)
                at = np.searchsorted(names, mine)
                at = at[names[np.minimum(at, len(names) - 1)] == mine]
                counts = ends[at] - starts[at]
                places = np.repeat(starts[at] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
                shared = np.bincount(where[places], minlength=len(own))
                near = np.flatnonzero((high * shared >= low * (sizes + len(mine) - shared)) & (roots != one["root"]))
                near = near[np.unique(roots[near], return_index=True)[1]]
                if len(near):
                    pairs.append(np.stack([np.full(len(near), one["node"]), nodes[near]]))
        a, b = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose full sets are near."""
    low, high = NEAR
    for batch in batches:
        good = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.concatenate([one, two])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            good.append(high * shared >= low * (len(both) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as a union-find forest: each node but the roots, with its root."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, root(x)) for x in list(parent) if root(x) != x]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["a", "b"])


def _text_key(row: str | None):
    """The row's number if it has one that stays; else the text and its id, so that copies of one text don't meet."""
    if row:
        return F.col("row").cast("string")
    return F.concat_ws(":", F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.col("doc_id").cast("string"))


def group(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Every document's set size and group: row, doc_id, n_shingles, component_id, kept, stays.

    component_id is the smallest doc_id of the group, kept says whether it is the document's own, and ``stays`` is
    true for exactly one row of each group. Words are runs between the six ASCII white spaces, A-Z lower-cased. A
    null, empty or blank text has no shingles and stays alone. Repeated rows are one group; a null doc_id counts as
    larger than any other, and a group of null ids has a null component_id. An empty table gives no rows. A very long
    text is read whole, in a slice of its own. Only doc_id and text are read, and ``row``, if a column numbers the rows and is written along with them.
    """
    spark = docs.sparkSession
    kept = Kept(spark)
    number = F.col(row).cast("long") if row else F.monotonically_increasing_id()
    own = docs.select(number.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = own.select("row", "doc_id", _text_key(row).alias("text_key"), "text")
    with batches_of(spark, ROWS_AT_ONCE):
        sketched = kept.write(rows.mapInArrow(released(_sketch), SKETCH))
    full = sketched.filter("n_shingles > 0")
    classes = kept.write(full.groupBy("set_key").agg(F.min("row").alias("class"), F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")).alias("first")))

    heads = full.select("row", "text_key", "n_shingles", "bands").join(classes.select(F.col("class").alias("row")), "row")
    keyed = heads.select(F.explode("bands").alias("key"), F.col("row").alias("node"), F.col("n_shingles").alias("trait"))
    low, high = NEAR

    def sets_of(nodes: DataFrame) -> DataFrame:
        texts = own.select(_text_key(row).alias("text_key"), "text").filter("text IS NOT NULL")
        wanted = full.select(F.col("row").alias("node"), "text_key").join(nodes, "node", "left_semi")
        wanted = F.broadcast(wanted) if nodes.limit(FEW + 1).count() <= FEW else wanted.hint("shuffle_hash")
        with batches_of(spark, ROWS_AT_ONCE):
            sets = kept.write(texts.join(wanted, "text_key").select("node", "text").mapInArrow(released(_sets), "node long, shingles binary"))
        if sets.count() > nodes.count():  # rows that repeat give a set more than once
            sets = kept.write(sets.dropDuplicates(["node"]))
        return sets

    def loads(nodes: DataFrame) -> DataFrame:
        return sets_of(nodes).withColumnRenamed("shingles", "load")

    def in_blocks(blocks: DataFrame) -> DataFrame:
        with batches_of(spark, BLOCKS_AT_ONCE):
            return kept.write(blocks.mapInArrow(released(_across), "a long, b long"))

    def links(pairs: DataFrame) -> DataFrame:
        sets = sets_of(kept.write(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()))
        two = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        with batches_of(spark, ROWS_AT_ONCE):
            near = kept.write(two.select("a", "b", "x", "y").mapInArrow(released(_verify), "a long, b long"))
        return near.mapInArrow(released(_union), "a long, b long")

    final = kept.write(resolve(kept, keyed, lambda n, m: high * F.least(n, m) >= low * F.greatest(n, m), links, loads, in_blocks))
    placed = classes.join(final.select(F.col("node").alias("class"), "root"), "class", "left").select("set_key", "first", F.coalesce("root", "class").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("first").alias("lowest"))
    by_set = kept.write(placed.join(lowest, "root").select("set_key", F.col("lowest.doc_id").alias("component_id"), F.col("lowest.row").alias("stay")))
    kept.keep_only(sketched, by_set)
    fixed = ["row", "doc_id", "n_shingles"]
    grouped = full.select(*fixed, "set_key").join(by_set, "set_key").select(*fixed, "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), (F.col("row") == F.col("stay")).alias("stays"))
    alone = sketched.filter("n_shingles = 0").select(*fixed, F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), F.lit(True).alias("stays"))
    return grouped.unionByName(alone)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
