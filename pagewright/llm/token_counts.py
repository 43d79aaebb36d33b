"""Token counts by a linear longest-match automaton over a vocabulary trie.

Each node that no vocabulary piece continues has a failure link and the number of pieces popped on taking it, so
that a word's greedy longest-match count is read off in one pass, without building its pieces.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.base import ascii_words, documents_only, released, table, text_slices

SCHEMA = "doc_id long, n_words long, n_tokens long"
WORDS_KEPT = 1_000_000


def byte_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file; its printable stand-ins are turned back into bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    return [bytes(back[c] for c in piece) for piece in pieces if all(c in back for c in piece)]


class Automaton:
    """Every single byte must be a piece, so that matching never fails."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in {*pieces, *(bytes([b]) for b in range(256))}:
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(False)
                node = children[node][byte]
            ends[node] = True
        size = len(children)
        self.fail, self.pops = np.zeros(size, np.int64), np.zeros(size, np.int64)
        queue = deque([0])
        while queue:
            above = queue.popleft()
            for byte, node in children[above].items():
                queue.append(node)
                if ends[node]:
                    self.fail[node], self.pops[node] = 0, 1
                else:
                    popped, to = int(self.pops[above]), int(self.fail[above])
                    while byte not in children[to]:
                        popped, to = popped + int(self.pops[to]), int(self.fail[to])
                    self.fail[node], self.pops[node] = children[to][byte], popped
        edges = sorted((node * 256 + byte, to) for node, below in enumerate(children) for byte, to in below.items())
        self.edges, self.to = np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The states after these bytes; the pieces popped on the way are added to ``count``."""
        out, left = np.zeros_like(state), np.arange(len(state))
        while len(left):
            key = state[left] * 256 + byte[left]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            met = self.edges[at] == key
            out[left[met]] = self.to[at[met]]
            left = left[~met]
            count[left] += self.pops[state[left]]
            state[left] = self.fail[state[left]]
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """The greedy longest-match pieces of each word; all words advance together, a byte at a time."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        sizes, starts = sizes[order], starts[order]
        state, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for at in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -at, "left"))  # the longest come first
            state[:live] = self.step(state[:live].copy(), data[starts[:live] + at], count[:live])
        while len(left := np.flatnonzero(state)):
            count[left] += self.pops[state[left]]
            state[left] = self.fail[state[left]]
        out = np.empty_like(count)
        out[order] = count
        return out


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per document: its words between ASCII white space (A-Z lower-cased) and their longest-match pieces.

    A word is matched with one blank before it, as the vocabulary marks starts of words. A null or empty text has
    0 of both. Repeated rows each get a row, a null doc_id stays null, an empty table gives no rows; other columns
    aren't read.
    """
    path = path or vocabulary_file()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, seen = Automaton(byte_pieces(path)), {}
        for batch in batches:
            for piece in text_slices(batch):
                words, per = ascii_words(piece.column("text"))
                coded = words.dictionary_encode()
                names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                found = list(map(seen.get, names))
                new = [i for i, x in enumerate(found) if x is None]
                for i, made in zip(new, automaton.counts([b" " + names[i].encode() for i in new]).tolist(), strict=True):
                    found[i] = seen[names[i]] = made
                if len(seen) > WORDS_KEPT:
                    seen.clear()
                each = np.array(found, np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(per)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(per, pa.int64()), pa.array(np.diff(np.concatenate([[0], ends])), pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return documents_only(docs).mapInArrow(released(run), SCHEMA)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
