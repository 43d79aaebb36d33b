"""Licence scan: an Aho-Corasick automaton finds tags and notice phrases, a shunting-yard parser reads expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.base import documents_only, released, table, text_slices

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: The scanner's own notice phrases, their labels, and how sure each makes it.
NOTICES = {
    "permission is hereby granted free of charge": ("mit", 0.9),
    "licensed under the apache license version 2 0": ("apache-2.0", 0.95),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd license": ("bsd", 0.7),
    "gnu lesser general public license": ("lgpl", 0.9),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "isc license": ("isc", 0.7),
    "released into the public domain": ("public-domain", 0.7),
    "all rights reserved": ("reserved", 0.5),
}
TAG = "spdx license identifier"
BASE_SURE, EXPRESSION_SURE = 0.6, 0.95
#: Identifier families of expressions, by the part before the first digit or sign: 1 for terms that may be met freely.
#: Other identifiers are labels too, but never count as free.
FAMILIES = {"mit": 1, "apache": 1, "bsd": 1, "isc": 1, "unlicense": 1, "zlib": 1, "cc": 1, "mpl": 0, "lgpl": 0, "gpl": 0, "agpl": 0, "epl": 0, "artistic": 0, "cddl": 0, "eupl": 0, "osl": 0, "sspl": 0}
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean"
_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9](?:[A-Za-z0-9.+:_-]*[A-Za-z0-9+])?)")
_TAG = re.compile(r"spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier[ \t]*:?", re.IGNORECASE)
#: An identifier that isn't of a known family has a capital letter, a digit or a hyphen, unlike a word of a sentence.
_NAMED = re.compile(r"[A-Z0-9-]")
_RANK = {"or": 1, "and": 2, "with": 3}
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _family(token: str) -> str | None:
    found = re.match(r"[a-z]+", token.lower())
    return found[0] if found and found[0] in FAMILIES else None


def _prefix(text: str, start: int) -> list[str]:
    """The tokens of the longest expression that stands at ``start``; each is looked at once."""
    tokens, whole, depth, operand = [], 0, 0, True
    while m := _TOKEN.match(text, start):
        token, start = m[1], m.end()
        if token.lower() in _RANK or token == ")":
            if operand or token == ")" and not depth:
                break
            depth -= token == ")"
            operand = token != ")"
        elif not operand or token != "(" and not (_family(token) or _NAMED.search(token)):
            break
        else:
            depth += token == "("
            operand = token == "("
        tokens.append(token)
        if not operand and not depth:
            whole = len(tokens)
    return tokens[:whole]


def expression(text: str, start: int = 0) -> tuple[set[str], bool] | None:
    """The identifiers of the longest licence expression that stands at ``start``, and whether it can be met by
    permissive terms alone: ``or`` needs one side, ``and`` both, ``with`` weighs its left side, an identifier of no known
    family isn't permissive. None: no expression."""
    out: list[tuple[set[str], bool]] = []
    signs: list[str] = []

    def reduce() -> None:
        sign = signs.pop()
        (right, may_right), (left, may_left) = out.pop(), out.pop()
        may = {"or": may_left or may_right, "and": may_left and may_right, "with": may_left}[sign]
        left.update(right if sign != "with" else ())
        out.append((left, may))

    for token in _prefix(text, start):
        sign = token.lower()
        if sign in _RANK:
            while signs and signs[-1] != "(" and _RANK[signs[-1]] >= _RANK[sign]:
                reduce()
            signs.append(sign)
        elif token == "(":
            signs.append(token)
        elif token == ")":
            while signs[-1] != "(":
                reduce()
            signs.pop()
        else:
            out.append(({sign}, bool(FAMILIES.get(_family(token) or "", 0))))
    while signs:
        reduce()
    return out[0] if out else None


def automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = automaton()
    for batch in batches:
        for piece in text_slices(batch):
            texts = piece.column("text")
            raw = [x.as_buffer().to_pybytes() for x in texts]
            # each text is closed by a zero byte; words keep one blank before and after them
            data = np.frombuffer(b"".join([b" \x00 ".join(x.translate(_LETTERS) for x in raw), b" \x00 "]), np.uint8)
            blank = data == 32
            keep = ~blank
            keep[1:] |= ~blank[:-1]
            data = data[keep]
            closes = np.flatnonzero(data == 0)
            blanks = np.flatnonzero(data == 32)
            # words end at blanks that follow neither a zero byte nor the start
            ends = blanks[(blanks > 0) & (data[np.maximum(blanks - 1, 0)] != 0)]
            until = np.searchsorted(ends, closes)
            n_words = np.diff(np.concatenate([[0], until]))
            hits: dict[int, list[tuple[str, int]]] = {}
            for stop, phrase in found.iter(" " + data.tobytes().decode("latin-1")):
                start = stop - len(phrase) - 1  # of the first word, without the blank put before all
                doc = int(np.searchsorted(closes, start))
                word = int(np.searchsorted(ends, start)) - int(until[doc - 1] if doc else 0)
                hits.setdefault(doc, []).append((phrase, word))
            n = len(raw)
            columns: dict[str, list] = {k: [None] * n for k in ("first_word", "last_word")} | {"n_base": [0] * n, "base_labels": [""] * n, "labels": [""] * n, "score": [0.0] * n, "permissive": [None] * n}
            for doc, places in hits.items():
                base = [(phrase, word) for phrase, word in places if phrase in BASE]
                labels, doubt = {BASE[phrase] for phrase, _ in base}, (1 - BASE_SURE) if base else 1.0
                if base:
                    columns["n_base"][doc] = len(base)
                    columns["first_word"][doc] = min(word for _, word in base)
                    columns["last_word"][doc] = max(word for _, word in base)
                    columns["base_labels"][doc] = ",".join(sorted(labels))
                for phrase in {p for p, _ in places if p in NOTICES}:
                    labels.add(NOTICES[phrase][0])
                    doubt *= 1 - NOTICES[phrase][1]
                if any(phrase == TAG for phrase, _ in places):
                    for tag in _TAG.finditer(texts[doc].as_py()):
                        if (read := expression(tag.string, tag.end())) is not None:
                            labels |= read[0]
                            doubt *= 1 - EXPRESSION_SURE
                            columns["permissive"][doc] = read[1] and columns["permissive"][doc] is not False
                columns["labels"][doc] = ",".join(sorted(labels))
                columns["score"][doc] = 1 - doubt
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    *[pa.array(columns[k], pa.int64()) for k in ("n_base", "first_word", "last_word")],
                    *[pa.array(columns[k], pa.string()) for k in ("base_labels", "labels")],
                    pa.array(columns["score"], pa.float64()),
                    pa.array(columns["permissive"], pa.bool_()),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"],
            )


def scan(docs: DataFrame) -> DataFrame:
    """A row per document: its words, base phrases, labels and how sure they are.

    A null or empty text has no words, no labels, and score 0; a very long one is read whole, and so is an expression. Repeated rows each get a row, a null doc_id stays
    null, an empty table gives no rows; other columns of ``docs`` aren't read. ``permissive`` is null without an
    expression; of several, all must be permissive.
    """
    return documents_only(docs).mapInArrow(released(_scan), SCHEMA)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
