"""Packs token ids into near-equal sequences by Karmarkar-Karp multiway differencing.

Every task streams its documents once: texts become ids (words seen before come from a table of words),
whole windows are cut off, and what is left of a block of documents is differenced into near-equal windows.
No row is shuffled, and a task holds one block at a time, whatever the input's size.
"""

from __future__ import annotations

import heapq
import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.base import documents_only, released, table, text_slices

WINDOW = 2048
#: Leftovers are cut to this, so that differencing has several parts for each window.
PART = 256
#: Documents and ids that one block holds at most, before it is packed.
BLOCK_PARTS, BLOCK_IDS = 4096, 4 << 20
WORDS_KEPT = 400_000
#: The vocabulary's pieces break between a letter or digit and these: all ASCII marks but the apostrophe, which letters may follow.
TAIL = string.punctuation.replace("'", "")
#: The letters that a vocabulary of bytes has for bytes, where they aren't those of Latin-1.
BYTES = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def difference(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each part. The two partial partitions with the largest spread are merged, the largest
    sums of one onto the smallest of the other, until one is left; sums of zero aren't stored."""
    count = len(lengths)
    left, right = [-1] * count, [-1] * count
    heap = [(-int(n), i, np.array([n], np.int64), np.array([i], np.int64)) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    turn = count
    while len(heap) > 1:
        _, _, a_sums, a_nodes = heapq.heappop(heap)
        _, _, b_sums, b_nodes = heapq.heappop(heap)
        shared = max(0, len(a_sums) + len(b_sums) - windows)
        if shared:
            at = len(a_sums) - shared
            both = a_nodes[at:], b_nodes[len(b_sums) - shared :][::-1]
            made = np.arange(len(left), len(left) + shared)
            left.extend(both[0].tolist())
            right.extend(both[1].tolist())
            sums = np.concatenate([a_sums[:at], a_sums[at:] + b_sums[len(b_sums) - shared :][::-1], b_sums[: len(b_sums) - shared]])
            nodes = np.concatenate([a_nodes[:at], made, b_nodes[: len(b_sums) - shared]])
        else:
            sums, nodes = np.concatenate([a_sums, b_sums]), np.concatenate([a_nodes, b_nodes])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0] - (sums[-1] if len(sums) == windows else 0))
        heapq.heappush(heap, (-spread, turn, sums, nodes))
        turn += 1
    out = np.zeros(count, np.int64)
    for window, node in enumerate(heap[0][3].tolist() if heap else []):
        stack = [node]
        while stack:
            node = stack.pop()
            if node < count:
                out[node] = window
            else:
                stack += [left[node], right[node]]
    return out


def windows_of(lengths: np.ndarray, capacity: int = WINDOW) -> tuple[np.ndarray, int]:
    """Windows of near-equal sums, none over the capacity; their number rises until that holds."""
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return np.zeros(0, np.int64), 0
    if lengths.max() > capacity:
        raise ValueError("a part is longer than the capacity")
    total = int(lengths.sum())
    count = max(1, -(-total // capacity))
    while True:
        at = difference(lengths, count)
        if np.bincount(at, lengths, count).max() <= capacity:
            return at, count
        count += 1 + count // 256


class Ids:
    """Ids of texts. The vocabulary's pieces never cross ASCII white space, so words stand for themselves."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.seen = Tokenizer.from_file(path), {}
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.tail = "".join(c for c in TAIL if c not in {content[-1] for content in added})  # so that no such token is cut
        self.model = self.tokenizer.model
        self.whole = self._whole() and not any(content.isalpha() for content in added)

    def _pieces(self, word: str) -> list[int]:
        """The ids of a word of letters below U+0100, which is one piece: by the model alone, as normalising and splitting leave it."""
        word = word.lower()
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(BYTES))]

    def _whole(self) -> bool:
        """Whether this vocabulary takes words of letters as they are, in lower case and byte by byte."""
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        words = [*letters, *map("".join, zip(letters, letters[1:], strict=False)), "".join(letters)]
        return all(made.ids == self._pieces(w) for w, made in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True))

    def _learn(self, words: list[str]) -> None:
        letters, others = [], []
        for word in words:
            (letters if self.whole and word.isalpha() and (word.isascii() or max(word) < "\u0100") else others).append(word)
        for word, made in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.seen[word] = array("I", made.ids).tobytes()
        for word in letters:
            self.seen[word] = array("I", self._pieces(word)).tobytes()

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of these distinct words in a row, each one's start, and its number of ids."""
        if len(self.seen) > WORDS_KEPT:
            self.seen = {}
        seen = self.seen
        parts = list(map(seen.get, words))
        split, new = [], set()
        for i in [i for i, made in enumerate(parts) if made is None]:
            word = core = words[i]
            tail = ""
            if word[-1:] in self.tail:
                core = word.rstrip(self.tail)
                if core and core[-1].isalnum() and core[-1] < "\u0100":
                    tail = word[len(core) :]
                    if tail not in seen:
                        new.add(tail)
                else:
                    core = word
            split.append((i, core, tail))
            if core not in seen:
                new.add(core)
        self._learn(list(new))
        seen[""] = b""
        for i, core, tail in split:
            parts[i] = seen[core] + seen[tail]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes, sizes

    def texts(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each text closed by ``end``, and each text's number of ids."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = lists.flatten().dictionary_encode()
        flat, starts, sizes = self.words(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        # a mark after each text's words, at the place of an extra word that holds the end id
        flat, starts, sizes = np.append(flat, np.uint32(end)), np.append(starts, len(flat)), np.append(sizes, 1)
        per = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.insert(words.indices.to_numpy(zero_copy_only=False), np.cumsum(per), len(starts) - 1)
        each = sizes[codes]
        ends = np.cumsum(each)
        at = np.repeat(starts[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
        per_text = np.diff(np.concatenate([[0], ends[np.cumsum(per + 1) - 1]]))
        return flat[at], per_text


class Block:
    """Pieces of documents that wait to be packed."""

    def __init__(self, capacity: int, part: int):
        self.capacity, self.part = capacity, part
        self.full: list[tuple] = []
        self.rest: list[tuple] = []
        self.ids = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole, size = len(ids) // self.capacity * self.capacity, len(ids)
        for start in range(0, whole, self.capacity):
            self.full.append((doc_id, start, self.capacity, zlib.crc32(ids[start : start + self.capacity].tobytes()), size))
        for start in range(whole, size, self.part):
            piece = ids[start : start + self.part]
            self.rest.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), size))
        self.ids += size

    def packed(self, first: int) -> tuple[pa.RecordBatch, int]:
        at, count = windows_of(np.array([r[2] for r in self.rest], np.int64), self.capacity)
        rows = [(*r, first + count + i, 0) for i, r in enumerate(self.full)]
        filled = [0] * count
        for row, window in zip(self.rest, at.tolist(), strict=True):
            rows.append((*row, first + window, filled[window]))
            filled[window] += row[2]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_FIELDS)
        after = first + count + len(self.full)
        self.full, self.rest, self.ids = [], [], 0
        return batch, after


def pack(docs: DataFrame, path: str | None = None, capacity: int = WINDOW, part: int = PART, end: int = 1) -> DataFrame:
    """A row per piece: which ids of which document lie where in which sequence.

    A null or empty text is the end id alone. Repeated rows and doc_ids are packed like any others; a null
    doc_id stays null. An empty table has no pieces. Only doc_id and text are read. The ids of a document are
    cut at whole windows and its leftover into parts of ``part``; each id lies in exactly one piece.
    """
    path = path or vocabulary_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, block, at = Ids(path), Block(capacity, part), TaskContext.get().partitionId() << 36
        for batch in batches:
            for piece in text_slices(batch):
                flat, sizes = ids.texts(piece.column("text"), end)
                ends = np.cumsum(sizes).tolist()
                for doc_id, stop, size in zip(piece.column("doc_id").to_pylist(), ends, sizes.tolist(), strict=True):
                    block.add(doc_id, flat[stop - size : stop])
                    if len(block.rest) >= BLOCK_PARTS or block.ids >= BLOCK_IDS:
                        out, at = block.packed(at)
                        yield out
        out, at = block.packed(at)
        yield out

    return documents_only(docs).mapInArrow(released(run), SCHEMA)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
