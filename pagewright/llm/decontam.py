"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark item is read as overlapping windows of letters and digits. A place within the edit budget of a window
shares at least a known number of q-grams with it, all near one diagonal. So q-grams that both share are counted in
overlapping bands of diagonals, bands that reach the number are kept, and a banded alignment verifies them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, documents_only, released, rows_where, table, text_slices

Q, WINDOW, STRIDE, BUDGET = 8, 96, 48, 0.08
#: Items with fewer letters and digits are too short for windows: they are held by texts of which they are a whole line.
LEAST = 24
#: Items of one pass over the documents; each task holds as many, whatever the benchmark's size.
ITEM_BLOCK = 20_000
BAND = 8
#: Shared q-grams that are counted at once, about; letters that a region can reach over, at most.
HITS, REACH = 4 << 20, WINDOW + 64
_TABLE_BITS = 22
_MULTIPLY = np.uint32(0x9E3779B1)
#: Letters and digits, A-Z as a-z; other ASCII is dropped.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 0 for c in range(256))
SCHEMA = "row long, doc_id long, items array<long>, letters array<long>"


def plain(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' letters and digits in a row, as bytes of UTF-8 lower case, and where each text's end."""
    low = pc.utf8_lower(texts)
    sizes = pc.binary_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in low).translate(_KEEP), np.uint8)
    full = data != 0
    return data[full], np.concatenate([[0], np.cumsum(full)])[np.concatenate([[0], np.cumsum(sizes)])]


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of the q-gram that starts at each place."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint32) + np.uint32(1)
        for step in (1, 2, 4):
            h = h[:-step] * np.uint32(pow(0x01000193, step, 1 << 32)) + h[step:]
    return h


def exact(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The q-grams at these places, as numbers."""
    out = np.zeros(len(at), np.uint64)
    for j in range(Q):
        out = (out << np.uint64(8)) | data[at + j]
    return out


class Index:
    """Windows of a block of items, and their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.windows = [], []
        self.lines: dict[bytes, list[int]] = {}
        for item_id, text in items:
            letters, _ = plain(pa.array([text]))
            n = len(letters)
            if n < LEAST:
                if n:
                    self.lines.setdefault(letters.tobytes(), []).append(item_id)
                continue
            starts = [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]
            for start in starts:
                self.item.append(item_id)
                self.windows.append(letters[start : start + WINDOW])
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        self.edits = np.floor(self.sizes * BUDGET).astype(np.int64)
        self.edits = np.minimum(self.edits, (self.sizes - Q) // Q - 1).clip(0)
        self.needed = self.sizes + 1 - Q * (self.edits + 1)
        flat = np.concatenate([*self.windows, np.zeros(Q, np.uint8)]) if self.windows else np.zeros(Q, np.uint8)
        starts = np.cumsum(self.sizes) - self.sizes
        counts = np.maximum(self.sizes - Q + 1, 0)
        window = np.repeat(np.arange(len(self.windows)), counts)
        place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[window] + place
        value = exact(flat, at)
        order = np.argsort(value, kind="stable")
        self.values, first = np.unique(value[order], return_index=True)
        self.first = np.concatenate([first, [len(value)]])
        self.window, self.place = window[order], place[order]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        if len(at):
            self.table[self._slot(grams(flat)[at])] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes * _MULTIPLY) >> np.uint32(32 - _TABLE_BITS)

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the data where a q-gram of a window starts, ascending, and the q-gram's number."""
        if len(data) < Q or not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[self._slot(grams(data))])
        value = exact(data, at)
        slot = np.minimum(np.searchsorted(self.values, value), len(self.values) - 1)
        met = self.values[slot] == value
        return at[met], slot[met]

    def regions(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal of the bands of 2 x BAND diagonals that reach the window's number of q-grams.

        Bands overlap by half, and edits move a match by less than half, so every match lies whole in one of them. The data
        is gone through in stretches of about ``HITS`` shared q-grams, each of which starts ``REACH`` letters before the
        last one's end, so that every match lies whole in one of them, too.
        """
        at, slot = self.shared(data)
        sums = np.concatenate([[0], np.cumsum(self.first[slot + 1] - self.first[slot])])
        found, start = [np.zeros(0, np.int64)], 0
        while start < len(at):
            stop = max(int(np.searchsorted(sums, sums[start] + HITS, "right")) - 1, int(np.searchsorted(at, at[start] + 2 * REACH)))
            found.append(self._bands(at[start:stop], slot[start:stop]))
            if stop >= len(at):
                break
            start = int(np.searchsorted(at, at[stop] - REACH + 1))
        low = np.unique(np.concatenate(found))
        return low >> 40, ((low & ((1 << 40) - 1)) - (1 << 30)) * BAND

    def _bands(self, at: np.ndarray, slot: np.ndarray) -> np.ndarray:
        counts = self.first[slot + 1] - self.first[slot]
        posting = np.repeat(self.first[slot] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        window, diagonal = self.window[posting], np.repeat(at, counts) - self.place[posting]
        key, count = np.unique((window << 40) + (diagonal // BAND + (1 << 30)), return_counts=True)
        both = count.copy()
        after = key[1:] == key[:-1] + 1
        both[:-1][after] += count[1:][after]
        low = np.concatenate([key, key - 1])
        both = np.concatenate([both, count])
        return low[both >= self.needed[low >> 40]] if len(low) else low

    def whole_lines(self, texts: pa.Array) -> Iterator[tuple[int, int]]:
        """Text and item of every line that is a short item."""
        for n, text in enumerate(texts.to_pylist() if self.lines else ()):
            lines = text.splitlines()
            data, ends = plain(pa.array(lines, pa.string()))
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                for item in self.lines.get(data[a:b].tobytes(), ()) if b - a < LEAST else ():
                    yield n, item

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, window and first place of every verified region; a region never leaves its text."""
        window, diagonal = self.regions(data)
        empty = np.zeros(0, np.int64)
        found = [(empty, empty, empty)]
        for size in np.unique(self.sizes[window]).tolist():
            own = np.flatnonzero(self.sizes[window] == size)
            for some in np.array_split(own, max(1, len(own) // 4096)):
                w, d = window[some], diagonal[some]
                # the text is that of the region's middle; characters of others match nothing
                doc = np.searchsorted(ends, np.clip(d + BAND + size // 2, 0, max(0, len(data) - 1)), "right") - 1
                k = self.edits[w]
                good = aligned(data, ends[doc], ends[doc + 1], np.stack([self.windows[i] for i in w.tolist()]), d, int(k.max())) <= k
                found.append((doc[good], w[good], np.maximum(d[good], ends[doc[good]])))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def aligned(data: np.ndarray, low: np.ndarray, high: np.ndarray, windows: np.ndarray, diagonal: np.ndarray, edits: int) -> np.ndarray:
    """The fewest edits that turn each window into a stretch of the data between low and high, on diagonals from
    ``diagonal`` less the edits to 2 x BAND further and the edits more; all windows advance together, a letter at a time."""
    width = 2 * BAND + 2 * edits + 1
    offset = np.arange(width)
    base = diagonal - edits
    cost = np.zeros((len(windows), width), np.int16)
    for i in range(windows.shape[1]):
        at = base[:, None] + offset + i
        inside = (at >= low[:, None]) & (at < high[:, None])
        letters = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
        step = cost + (letters != windows[:, i : i + 1])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        cost = (np.minimum.accumulate(step - offset, axis=1) + offset).astype(np.int16)
    return cost.min(1)


def _search(docs: DataFrame, held: Broadcast) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        item = np.array(index.item, np.int64)
        for batch in batches:
            for piece in text_slices(batch):
                data, ends = plain(piece.column("text"))
                doc, window, place = index.matches(data, ends)
                items: list = [[] for _ in range(piece.num_rows)]
                letters: list = [[] for _ in range(piece.num_rows)]
                order = np.lexsort((place, doc))
                for d, w, p in zip(doc[order].tolist(), window[order].tolist(), (place - ends[doc])[order].tolist(), strict=True):
                    items[d].append(int(item[w]))
                    letters[d].append(p)
                for d, own in index.whole_lines(piece.column("text")):
                    items[d].append(own)
                items = [sorted(set(x)) for x in items]
                yield pa.RecordBatch.from_arrays([piece.column("row"), piece.column("doc_id"), pa.array(items, pa.list_(pa.int64())), pa.array([x[:1] for x in letters], pa.list_(pa.int64()))], names=["row", "doc_id", "items", "letters"])

    return docs.mapInArrow(released(run), SCHEMA)


def indexes_of(benchmark: DataFrame, block: int = ITEM_BLOCK) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's items in blocks, each as an index that every task gets, and whether it is the last. One is made at a
    time, and goes when the next is asked for; an empty one if there is no item."""
    context = benchmark.sparkSession.sparkContext
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    after, last = None, False
    while not last:
        rest = known if after is None else known.filter((F.col("item_id") > after[0]) | (F.col("item_id") == after[0]) & (F.col("text") > after[1]))
        rows = rest.orderBy("item_id", "text").limit(block + 1).collect()
        last = len(rows) <= block
        held = context.broadcast(Index([(r["item_id"], r["text"]) for r in rows[:block]]))
        after = tuple(rows[block - 1]) if not last else None
        yield held, last
        held.unpersist()


def find(docs: DataFrame, benchmark: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """A row per document: doc_id, items (ids of the benchmark items that it holds, ascending), and first_letter (where
    the first window of one may start, among the text's letters and digits).

    A window of up to 96 letters and digits counts as held if at most 8 % of it is edited; case, blanks and marks
    don't count. An item of fewer than 24 letters and digits is held by a text that has it as a whole line. Items of
    null ids, or without any letter or digit, take no part; repeated items are one. The benchmark is a query set: it is
    read in blocks of ``block`` items, one pass over the documents each. A null or empty text holds nothing, a very long
    one is read whole; repeated rows each get a row; an empty table on either side gives no items.
    """
    rows = documents_only(docs).withColumn("row", F.monotonically_increasing_id())
    kept = Kept(docs.sparkSession)
    parts = []
    for held, last in indexes_of(benchmark, block):
        if last and not parts:
            return _search(rows, held).select("doc_id", "items", F.get("letters", F.lit(0)).alias("first_letter"))
        rows = rows if parts else kept.write(rows)
        parts.append(kept.write(_search(rows, held).filter(F.size("items") > 0).select("row", "items", "letters")))
    found = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_min(F.flatten(F.collect_list("letters"))).alias("first_letter"))
    return rows.select("row", "doc_id").join(found, "row", "left").select("doc_id", F.coalesce("items", F.array().cast("array<long>")).alias("items"), "first_letter")


def clean(docs: DataFrame, benchmark: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item; blocks of items after each other."""
    kept = Kept(docs.sparkSession)
    for held, last in indexes_of(benchmark, block):
        docs = _clean(docs, held)
        if last:
            return docs
        docs = kept.write(docs)
    raise AssertionError("the last index ends the loop")


def _clean(docs: DataFrame, held: Broadcast) -> DataFrame:
    def decide(piece: pa.RecordBatch) -> np.ndarray:
        out = np.ones(piece.num_rows, bool)
        out[held.value.matches(*plain(piece.column("text")))[0]] = False
        out[[d for d, _ in held.value.whole_lines(piece.column("text"))]] = False
        return out

    return rows_where(docs, decide)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"), F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), "first_letter")
