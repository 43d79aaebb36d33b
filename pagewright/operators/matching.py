"""Whether a term stands in a text: exact, wildcard, stemmed, fuzzy, and any of them."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text

METHODS = ("exact", "wildcard", "stemmed", "fuzzy", "semantic_only")
FUZZY = 85


def exact(term: Column, body: Column) -> Column:
    """Any word of the term that isn't a stop word stands in the text as a word."""
    return F.arrays_overlap(text.without(text.tokens(term), text.STOP_WORDS), text.tokens(body))


def wildcard(term: Column, body: Column) -> Column:
    return F.contains(F.lower(body), F.lower(term))


_VOWELS = "aeiouy"
#: Fixed values of the English stemmer: whole words, then suffixes by step.
_SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
_KEPT = frozenset("inning outing canning herring earring proceed exceed succeed".split())
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "entli": "ent", "abli": "able", "fulli": "ful", "lessli": "less"}
_STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = sorted("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize".split(), key=len, reverse=True)


def _region(word: str, start: int) -> int:
    """Where the part after the first non-vowel that follows a vowel begins."""
    for i in range(start + 1, len(word)):
        if word[i] not in _VOWELS and word[i - 1] in _VOWELS:
            return i + 1
    return len(word)


def _short_syllable(word: str) -> bool:
    if len(word) == 2:
        return word[0] in _VOWELS and word[1] not in _VOWELS
    return len(word) > 2 and word[-1] not in _VOWELS + "wxY" and word[-2] in _VOWELS and word[-3] not in _VOWELS


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of an English word, by the published Porter2 rules."""
    if len(word) <= 2:
        return word
    if word in _SPECIAL:
        return _SPECIAL[word]
    w = word.lstrip("'") if word.startswith("'") else word
    w = "".join("Y" if c == "y" and (i == 0 or w[i - 1] in _VOWELS) else c for i, c in enumerate(w))
    r1 = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = _region(w, 0) if r1 is None else r1
    r2 = _region(w, r1)
    w = re.sub(r"('s'|'s|')$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and any(c in _VOWELS for c in w[:-2]):
        w = w[:-1]
    if w in _KEPT:
        return w.lower()
    for suffix in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            if suffix in ("eed", "eedly"):
                if len(rest) >= r1:
                    w = rest + "ee"
            elif any(c in _VOWELS for c in rest):
                w = rest
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif w.endswith(("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")):
                    w = w[:-1]
                elif r1 >= len(w) and _short_syllable(w):
                    w += "e"
            break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    for suffix in sorted([*_STEP2, "ogi", "li"], key=len, reverse=True):
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            if len(rest) >= r1:
                if suffix == "ogi":
                    w = rest + "og" if rest.endswith("l") else w
                elif suffix == "li":
                    w = rest if rest[-1:] and rest[-1] in "cdeghkmnrt" else w
                else:
                    w = rest + _STEP2[suffix]
            break
    for suffix in sorted([*_STEP3, "ative"], key=len, reverse=True):
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            if suffix == "ative":
                w = rest if len(rest) >= r2 else w
            elif len(rest) >= r1:
                w = rest + _STEP3[suffix]
            break
    for suffix in sorted([*_STEP4, "ion"], key=len, reverse=True):
        if w.endswith(suffix):
            rest = w[: -len(suffix)]
            if len(rest) >= r2 and (suffix != "ion" or rest[-1:] in ("s", "t")):
                w = rest
            break
    if w.endswith("e"):
        if len(w) - 1 >= r2 or len(w) - 1 >= r1 and not _short_syllable(w[:-1]):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


def stems(words: DataFrame) -> DataFrame:
    """(word, stem) of distinct words; the stemmer runs once for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([stem(w) for w in batch.column(0).to_pylist()], pa.string())], names=["word", "stem"])

    return words.select("word").filter("word IS NOT NULL").distinct().mapInArrow(run, "word string, stem string")


def stemmed(terms: DataFrame, bodies: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(query_id, chunk_id) where any stem of the term's words, stop words left out, is a stem of the text.

    terms: query_id, case_ref, search_term; bodies: chunk_id, case_ref, chunk_text. Words meet by equality of stems,
    so that no text is compared with every term. ``keep`` may write the words whose stems are asked for: where these are few, Spark then
    knows before it shuffles the words of all texts.
    """
    asked = terms.select("query_id", "case_ref", F.explode(text.without(text.tokens(F.col("search_term")), text.STOP_WORDS)).alias("word"))
    held = bodies.select("chunk_id", "case_ref", F.explode(F.array_distinct(text.tokens(F.col("chunk_text")))).alias("word"))
    known = stems(asked.select("word").unionByName(held.select("word")))
    left = asked.join(known, "word").select("query_id", "case_ref", "stem").distinct()
    right = held.join(keep(known.join(left.select("stem").distinct(), "stem", "left_semi")), "word").select("chunk_id", "case_ref", "stem")
    return left.join(right, ["case_ref", "stem"]).select("query_id", "chunk_id").distinct()


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with rows as bits of a number."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    s = full = (1 << len(a)) - 1
    for c in b:
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    """100 times the share of characters that stay when one becomes the other by inserting and deleting."""
    return 100.0 if not a and not b else 200.0 * _common(a, b) / (len(a) + len(b))


def partial_ratio(short: str, long: str, enough: float = 100.0) -> float:
    """The best ratio of the shorter text against any stretch of the longer one that is as long, or cut by an end."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    n, best, letters = len(short), 0.0, set(short)
    for i in range(1 - n, len(long)):
        part = long[max(0, i) : i + n]
        if part[-1] in letters or part[0] in letters:
            best = max(best, ratio(short, part))
            if best >= enough:
                break
    return best


def fuzzy_match(term: str, body: str, least: float = FUZZY) -> bool:
    words = [w for w in term.lower().split() if w not in text.STOP_WORDS]
    if not words:
        return False
    body = body.lower()
    if partial_ratio(" ".join(words), body, least) >= least:
        return True
    held = set(body.split())
    return any(2 * min(len(w), len(h)) * 100 >= least * (len(w) + len(h)) and ratio(w, h) >= least for w in words if len(w) > 5 for h in held)


class Fuzzy:
    """``fuzzy_match`` for many pairs: what terms and texts have in common with others is found once.

    Words are compared once for each two of them. Stretches of a text are compared only where they hold enough of the term's
    letters, each as often as the term at most, which no common subsequence exceeds.
    """

    #: Words that are remembered, and letters of a text whose counts are; a longer text is counted in parts.
    WORDS, PART = 1_000_000, 1 << 16

    def __init__(self, least: float = FUZZY):
        self.least, self.seen, self.near, self.known = least, {}, {}, 0
        self.term = lru_cache(maxsize=10_000)(self._term)
        self.words = lru_cache(maxsize=1_000)(lambda body: frozenset(body.split()))
        self.codes = lru_cache(maxsize=1_000)(lambda body: np.frombuffer(body.encode("utf-32-le", "surrogatepass"), np.uint32))

    @staticmethod
    def _term(term: str) -> tuple[list[str], str, list[tuple[int, int]]]:
        words = [w for w in term.lower().split() if w not in text.STOP_WORDS]
        short = " ".join(words)
        return [w for w in dict.fromkeys(words) if len(w) > 5], short, [(ord(c), n) for c, n in Counter(short).items()]

    def _has_word(self, words: list[str], held: frozenset[str]) -> bool:
        for w in words:
            if self.known > self.WORDS:
                self.seen, self.near, self.known = {}, {}, 0
            seen, near = self.seen.setdefault(w, set()), self.near.setdefault(w, set())
            new = held - seen
            near.update(h for h in new if 2 * min(len(w), len(h)) * 100 >= self.least * (len(w) + len(h)) and ratio(w, h) >= self.least)
            seen |= new
            self.known += len(new)
            if not near.isdisjoint(held):
                return True
        return False

    def _has_stretch(self, short: str, letters: list[tuple[int, int]], body: str) -> bool:
        n, codes = len(short), self.codes(body)
        for first in range(1 - n, len(body), self.PART):
            starts = np.arange(first, min(first + self.PART, len(body)))
            low, high = np.maximum(starts, 0), np.minimum(starts + n, len(body))
            at, part = low[0], codes[low[0] : high[-1]]
            held = np.zeros(len(starts), np.int64)
            for code, most in letters:
                sums = np.concatenate([[0], np.cumsum(part == code)])
                held += np.minimum(sums[high - at] - sums[low - at], most)
            for i in np.flatnonzero(200 * held >= self.least * (n + high - low)):
                if ratio(short, body[low[i] : high[i]]) >= self.least:
                    return True
        return False

    def __call__(self, term: str, body: str) -> bool:
        words, short, letters = self.term(term)
        if not short:
            return False
        body = body.lower()
        if short in body or self._has_word(words, self.words(body)):
            return True
        if len(short) > len(body):
            return partial_ratio(short, body, self.least) >= self.least
        return self._has_stretch(short, letters, body)


class FuzzyBlock:
    """``fuzzy_match`` of some terms with many texts at once.

    Each distinct word of the texts is compared with the terms' words once. The letters of all stretches are counted by sums over
    the texts laid end to end, with room between them that belongs to none, and the common subsequences of the
    stretches with enough letters are found together, as in ``_common``.
    """

    #: Characters of texts that are laid end to end (a longer one is matched by itself), of terms, whose places are the bits of a
    #: number, and words that are remembered.
    CHARS, TERM, WORDS = 1 << 20, 63, 200_000

    def __init__(self, terms: list[str], least: float = FUZZY):
        self.least, self.terms, self.alone, self.near = least, terms, Fuzzy(least), {}
        own = [Fuzzy._term(t) for t in terms]
        self.shorts = [short for _, short, _ in own]
        self.long = {}
        for n, (words, _, _) in enumerate(own):
            for w in words:
                self.long[w] = self.long.get(w, 0) | 1 << n
        self.by_windows = [n for n, short in enumerate(self.shorts) if 0 < len(short) <= self.TERM]
        self.letters = sorted({ord(c) for n in self.by_windows for c in self.shorts[n]})
        self.room = max((len(self.shorts[n]) for n in self.by_windows), default=0)

    def _near(self, held: str) -> int:
        """The terms, as bits, that have a long word near this one."""
        found, letters = 0, set(held)
        for w, terms in self.long.items():
            both = len(w) + len(held)
            if 2 * min(len(w), len(held)) * 100 >= self.least * both and 200 * sum(c in letters for c in w) >= self.least * both and ratio(w, held) >= self.least:
                found |= terms
        return found

    def _by_word(self, body: str) -> int:
        found = 0
        for h in set(body.split()):
            bits = self.near.get(h)
            if bits is None:
                if len(self.near) >= self.WORDS:
                    self.near.clear()
                bits = self.near[h] = self._near(h)
            found |= bits
        return found

    def _by_stretch(self, bodies: list[str], matched: np.ndarray) -> None:
        """Sets ``matched`` where a stretch of the text, as long as the term or cut by an end, is near."""
        pad = chr(0) * self.room
        codes = np.frombuffer((pad + pad.join(bodies) + pad * 2).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(b) for b in bodies])
        starts = np.cumsum(sizes + self.room) - sizes
        inside = np.zeros(len(codes) + 1, np.int8)
        np.add.at(inside, starts, 1)
        np.add.at(inside, starts + sizes, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        place = np.zeros(len(codes), np.uint16)
        sums = {}
        # differences of sums are right modulo 2^16, as a stretch is shorter
        summed = lambda flags: np.concatenate([np.zeros(1, np.uint16), np.cumsum(flags, dtype=np.uint16)])
        for i, code in enumerate(self.letters):
            here = (codes == code) & inside
            place[here] = i + 1
            sums[code] = summed(here)
        lengths = summed(inside)
        for n in self.by_windows:
            short = self.shorts[n]
            size = len(short)
            if matched[:, n].all():
                continue
            length = lengths[size:] - lengths[:-size]
            held = np.zeros(len(length), np.uint16)
            for c, most in Counter(short).items():
                one = sums[ord(c)]
                held += np.minimum(one[size:] - one[:-size], np.uint16(most))
            need = np.array([next((h for h in range(size + 1) if 200.0 * h / (size + x) >= self.least), size + 1) for x in range(size + 1)], np.uint16)
            at = np.flatnonzero(held >= need[length])
            whose = np.searchsorted(starts - size, at, "right") - 1
            # a text that is shorter than the term is matched the other way round
            at, whose = (x[~matched[whose, n] & (sizes[whose] >= size) & (length[at] > 0)] for x in (at, whose))
            masks = np.zeros(len(self.letters) + 1, np.uint64)
            for i, c in enumerate(short):
                masks[self.letters.index(ord(c)) + 1] |= np.uint64(1 << i)
            full = np.uint64((1 << size) - 1)
            left = np.full(len(at), full)
            for j in range(size):
                u = left & masks[place[at + j]]
                left = ((left + u) | (left - u)) & full
            common = size - np.bitwise_count(left).astype(np.int64)
            matched[whose[common >= need[length[at]]], n] = True

    def __call__(self, bodies: list[str]) -> np.ndarray:
        """A row for each text, with a flag for each term."""
        lower = [b.lower() for b in bodies]
        matched = np.zeros((len(bodies), len(self.terms)), bool)
        for i, body in enumerate(lower):
            bits = self._by_word(body)
            while bits:
                n = bits.bit_length() - 1
                matched[i, n] = True
                bits ^= 1 << n
        group, held = [], 0
        for i, body in enumerate([*lower, None]):
            if group and (body is None or held + len(body) > self.CHARS):
                part = matched[group]
                self._by_stretch([lower[g] for g in group], part)
                matched[group] = part
                group, held = [], 0
            if body is not None and self.by_windows and len(body) <= self.CHARS:
                group.append(i)
                held += len(body) + self.room
        for i, body in enumerate(lower):
            for n, short in enumerate(self.shorts):
                if short and not matched[i, n] and (len(body) < len(short) or len(short) > self.TERM or len(body) > self.CHARS):
                    matched[i, n] = self.alone(self.terms[n], bodies[i])
        return matched


#: Terms of a case that are matched with a text at once.
TERMS = 64


def fuzzy_in_cases(terms: DataFrame, bodies: DataFrame, least: float = FUZZY) -> DataFrame:
    """query_id, chunk_id, matched of every term and text of a case: a text is read once for ``TERMS`` terms of its case.

    terms: query_id, case_ref, search_term; bodies: chunk_id, case_ref, chunk_text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = lambda asked: ([t.get("query_id") for t in asked], FuzzyBlock([t.get("search_term") or "" for t in asked], least))
        known = lru_cache(maxsize=64)(lambda asked: block(json.loads(asked)))
        for batch in batches:
            rows: dict[str, list[int]] = {}
            for i, asked in enumerate(batch.column("asked").to_pylist()):
                rows.setdefault(asked, []).append(i)
            texts = batch.column("chunk_text").to_pylist()
            for asked, own in rows.items():
                ids, match = known(asked)
                matched = match([texts[i] or "" for i in own])
                chunk = batch.column("chunk_id").take(pa.array(np.repeat(own, len(ids))))
                yield pa.RecordBatch.from_arrays([pa.array(ids * len(own), pa.int64()), chunk, pa.array(matched.ravel())], names=["query_id", "chunk_id", "matched"])

    number = F.row_number().over(Window.partitionBy("case_ref").orderBy("query_id", "search_term")) - 1
    blocks = terms.select("case_ref", F.col("query_id").cast("long").alias("query_id"), "search_term").withColumn("block", F.floor(number / TERMS))
    asked = blocks.groupBy("case_ref", "block").agg(F.to_json(F.sort_array(F.collect_list(F.struct("query_id", "search_term")))).alias("asked")).select("case_ref", "asked")
    return bodies.select("chunk_id", "case_ref", "chunk_text").join(asked, "case_ref").select("chunk_id", "chunk_text", "asked").mapInArrow(run, "query_id long, chunk_id string, matched boolean")


def fuzzy(pairs: DataFrame, least: float = FUZZY) -> DataFrame:
    """pairs (query_id, chunk_id, search_term, chunk_text) with ``matched``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Fuzzy(least)
        for batch in batches:
            good = [match(t or "", b or "") for t, b in zip(batch.column("search_term").to_pylist(), batch.column("chunk_text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("chunk_id"), pa.array(good)], names=["query_id", "chunk_id", "matched"])

    return pairs.select("query_id", "chunk_id", "search_term", "chunk_text").mapInArrow(run, "query_id long, chunk_id string, matched boolean")


def any_method(term: Column, body: Column, methods: list[str]) -> Column:
    """Exact and wildcard as one expression; an unknown method counts as exact, semantic_only matches nothing.

    Stemmed and fuzzy need rows, not expressions, and are an error here; ``any_rows`` has all methods.
    """
    out = F.lit(False)
    for method in methods:
        if method in ("stemmed", "fuzzy"):
            raise ValueError(f"{method} matching takes rows: use any_rows")
        if method == "wildcard":
            out = out | wildcard(term, body)
        elif method != "semantic_only":
            out = out | exact(term, body)
    return out


def any_rows(pairs: DataFrame, methods: list[str]) -> DataFrame:
    """(query_id, chunk_id), distinct, of pairs (query_id, chunk_id, search_term, chunk_text) that match by any of the methods.

    A query may come with several terms; it matches by any of them.
    """
    plain = any_method(F.col("search_term"), F.col("chunk_text"), [m for m in methods if m not in ("stemmed", "fuzzy")])
    found = pairs.filter(plain).select("query_id", "chunk_id")
    if "stemmed" in methods:
        # a query's own chunks are its case, so that only pairs that are asked for meet
        asked = pairs.select("query_id", F.col("query_id").alias("case_ref"), "search_term").distinct()
        held = pairs.select("chunk_id", F.col("query_id").alias("case_ref"), "chunk_text").distinct()
        found = found.unionByName(stemmed(asked, held))
    if "fuzzy" in methods:
        found = found.unionByName(fuzzy(pairs.filter(~F.coalesce(plain, F.lit(False)))).filter("matched").select("query_id", "chunk_id"))
    return found.distinct()


def any_in_cases(terms: DataFrame, bodies: DataFrame, methods: list[str], keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``any_rows`` of every term and text of a case, by tables of both: no text is shuffled, and none repeated for the stems.

    terms: query_id, case_ref, search_term; bodies: chunk_id, case_ref, chunk_text. ``keep`` is that of ``stemmed``.
    """
    plain = any_method(F.col("search_term"), F.col("chunk_text"), [m for m in methods if m not in ("stemmed", "fuzzy")])
    found = terms.join(bodies, "case_ref").filter(plain).select("query_id", "chunk_id")
    if "stemmed" in methods:
        found = found.unionByName(stemmed(terms, bodies, keep))
    if "fuzzy" in methods:
        found = found.unionByName(fuzzy_in_cases(terms, bodies).filter("matched").select("query_id", "chunk_id"))
    return found.distinct()
