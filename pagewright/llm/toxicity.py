"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

Two words are as alike as the letter triples they share in order, gaps weighing less; so an insult with inserted
or missing letters stays close to the insult. Landmark words make the kernel's features, a linear machine on them
separates words of toxic documents from those of clean ones, and a document's worst words make its score. As the
kernel has one explicit axis per triple, the landmarks' part of the machine folds into one weight per triple.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import documents_only, released, rows_where, table, text_slices

#: Longest reach of a triple, the weight of each letter skipped, and the machine's size.
REACH, DECAY, LANDMARKS = 6, 0.6, 128
#: Labelled rows of either class that training reads at most, and words of a class.
ROWS, WORDS = 1000, 6000
CUT = 0.7
#: Words whose triples are held at a time.
AT_ONCE = 20_000
START, END, AXES = 27, 28, 32**3
SCHEMA = "doc_id long, score double, worst array<string>"
_PAIRS = [(a, b) for b in range(2, REACH) for a in range(1, b)]
#: Digits and signs that stand for letters.
_STANDS = dict(zip("013457@$", "oieastas", strict=True))


@cache
def _letters() -> np.ndarray:
    """Of each character of the first plane: 1 to 26 by its base letter, or 0."""
    out = np.zeros(0x10000, np.uint8)
    for point in [*range(0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(point).lower())[:1]
        base = {"ß": "s", "ø": "o", "æ": "a", "œ": "o", "ł": "l"}.get(base, base)
        base = _STANDS.get(base, base)
        if "a" <= base <= "z":
            out[point] = ord(base) - 96
    return out


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' letters in a row, each between marks and with zeros behind it; and each word's place."""
    points = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le", "replace"), np.uint32)
    code = _letters()[np.where(points < 0x10000, points, 0)]
    word = np.cumsum(points == 10) - (points == 10)
    word, code = word[code > 0], code[code > 0]
    drawn = np.zeros(len(code), bool)  # of a letter drawn out, two stay
    drawn[2:] = (code[2:] == code[1:-1]) & (code[2:] == code[:-2]) & (word[2:] == word[:-2])
    word, code = word[~drawn], code[~drawn]
    sizes = np.bincount(word, minlength=len(words))
    starts = np.cumsum(sizes + 2 + REACH) - (sizes + 2 + REACH)
    out = np.zeros(int(sizes.sum()) + len(words) * (2 + REACH) + REACH, np.int64)
    out[starts] = START
    out[starts + 1 + sizes] = END
    within = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[starts[word] + 1 + within] = code
    return out, starts


def triples(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Places where triples of each gap pattern start, their axes, and the pattern's weight."""
    n = len(code) - REACH
    for a, b in _PAIRS:
        at = np.flatnonzero((code[:n] > 0) & (code[a : n + a] > 0) & (code[b : n + b] > 0))
        yield at, (code[at] * 32 + code[at + a]) * 32 + code[at + b], DECAY ** (b - 2)


def against(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Each word's product with columns of axis weights, over the word's own length in triples."""
    wide = weights.reshape(AXES, -1)
    out = np.zeros((len(words), wide.shape[1]))
    for first in range(0, len(words), AT_ONCE):
        some = words[first : first + AT_ONCE]
        code, word = _placed(some)
        mass = np.zeros(len(some))
        for at, axis, weight in triples(code):
            where = word[at]
            mass += np.bincount(where, minlength=len(some)) * weight**2
            for j in range(wide.shape[1]):
                out[first : first + len(some), j] += np.bincount(where, wide[axis, j], len(some)) * weight
        out[first : first + len(some)] /= np.sqrt(np.maximum(mass, 1e-9))[:, None]
    return out


def _placed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code, starts = coded(words)
    word = np.zeros(len(code), np.int64)
    word[starts[1:]] = 1
    return code, np.cumsum(word)


def explicit(words: list[str]) -> np.ndarray:
    """The axes of each word, as rows; only for a bounded number of words."""
    out = np.zeros((len(words), AXES), np.float32)
    for i, word in enumerate(words):
        mass = 0.0
        for _, axis, weight in triples(coded([word])[0]):
            np.add.at(out[i], axis, weight)
            mass += len(axis) * weight**2
        out[i] /= max(mass, 1e-9) ** 0.5
    return out


def machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by Newton steps on the vectors inside the margin."""
    z = np.hstack([z, np.ones((len(z), 1))])
    u = np.zeros(z.shape[1])
    for _ in range(steps):
        inside = y * (z @ u) < 1
        own = z[inside] * weight[inside, None]
        made = np.linalg.solve(own.T @ z[inside] + ridge * np.eye(len(u)), own.T @ y[inside])
        if np.abs(made - u).max() < 1e-6:
            return made
        u = made
    return u


class Model:
    """weights: one per axis; bias; and a document's weights for its worst word, the number of bad words, their sum."""

    def __init__(self, weights: np.ndarray, bias: float, final: np.ndarray | None = None):
        self.weights, self.bias, self.final = weights.astype(np.float32), bias, final

    def words(self, words: list[str]) -> np.ndarray:
        return against(words, self.weights)[:, 0] + self.bias if words else np.zeros(0)

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.hstack([features, np.ones((len(features), 1))])
        return 1 / (1 + np.exp(-np.clip(x @ self.final, -30, 30)))


def summary(scores: np.ndarray, doc: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Of each document: its worst word's margin, and its distinct words beyond 0, counted and summed."""
    out = np.zeros((n, 3))
    out[:, 0] = -2.0
    np.maximum.at(out[:, 0], doc, np.clip(scores, -2, 2))
    bad = scores > 0
    both = np.unique(np.stack([doc[bad], code[bad]]), axis=1, return_index=True)[1] if bad.any() else np.zeros(0, np.int64)
    out[:, 1] = np.log1p(np.bincount(doc[bad][both], minlength=n))
    out[:, 2] = np.log1p(np.bincount(doc[bad][both], np.minimum(scores[bad][both], 2), n))
    return out


def _odds(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    return np.log((with_toxic + 0.5) / (toxic + 1)) - np.log((with_clean + 0.5) / (clean + 1))


def _axis_value(names: list[str], inside: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Each word's most telling triple: one that many toxic documents have, and few clean ones."""
    parts, sizes = [], []
    for at in range(0, len(names), AT_ONCE):
        some = names[at : at + AT_ONCE]
        code, word = _placed(some)
        pairs = np.sort(np.concatenate([word[at] * AXES + axis for at, axis, _ in triples(code)]))
        parts.append((pairs % AXES).astype(np.uint16))
        sizes.append(np.bincount(pairs // AXES, minlength=len(some)))
    axis, size = np.concatenate(parts), np.concatenate(sizes)
    first = np.concatenate([[0], np.cumsum(size)])
    counts, has = np.zeros((2, AXES)), np.zeros(AXES, bool)
    for x, t in zip(inside, toxic, strict=True):
        sizes = first[x + 1] - first[x]
        own = axis[np.repeat(first[x] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
        has[own] = True
        counts[t] += has
        has[own] = False
    value = np.maximum(_odds(counts[1], counts[0], int((toxic == 1).sum()), int((toxic == 0).sum())), 0) * np.log1p(counts[1])
    out = np.zeros(len(names))
    for at in range(0, len(names), AT_ONCE):
        stop = min(at + AT_ONCE, len(names))
        np.maximum.at(out, np.repeat(np.arange(at, stop), size[at:stop]), value[axis[first[at] : first[stop]]])
    return out


def learn(docs: list[list[str]], toxic: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Axis weights and bias from documents, given as distinct words. A toxic document says only that some of its
    words are bad: at first those that, or whose triples, toxic documents have and clean ones lack, then those that
    the machine finds. Clean words that it takes for bad weigh more in the next turn."""
    draw = np.random.default_rng(seed)
    names = sorted({w for d in docs for w in d})
    place = {w: i for i, w in enumerate(names)}
    inside = [np.array([place[w] for w in d], np.int64) for d in docs]
    none = np.zeros(0, np.int64)
    counts = np.array([np.bincount(np.concatenate([none, *[x for x, t in zip(inside, toxic, strict=True) if t == c]]), minlength=len(names)) for c in (0, 1)])
    odds = _odds(counts[1], counts[0], int((toxic == 1).sum()), int((toxic == 0).sum()))
    clean = np.flatnonzero(counts[0] > 0)
    first = _axis_value(names, inside, toxic) if names else np.zeros(0)
    value = np.maximum(odds, 0) * np.log1p(counts[1]) + first
    margin, weights, bias = np.zeros(len(names)), np.zeros(AXES), -1.0
    for turn in range(3):
        weight = np.zeros(len(names))
        for x, t in zip(inside, toxic, strict=True):
            if t and len(x):
                best = x[np.argsort(-value[x], kind="stable")[:3]]
                weight[best[(value[best] > 0) & (counts[0][best] <= 0.02 * counts[1][best])]] += 1
        bad = np.flatnonzero(weight)
        bad = bad[np.argsort(-weight[bad], kind="stable")][:WORDS]
        if not len(bad) or not len(clean):
            return weights, bias
        hard = clean[np.argsort(-margin[clean], kind="stable")][: WORDS // 2] if turn else none
        often = clean[np.argsort(-counts[0][clean], kind="stable")][: WORDS // 2]
        against_ = np.unique(np.concatenate([hard, often, draw.permutation(clean)[: WORDS // 2]]))
        marks = np.unique(np.concatenate([bad[: LANDMARKS // 2], hard[: LANDMARKS // 4], often[: LANDMARKS // 4], draw.permutation(against_)[: LANDMARKS // 4]]))
        axes = explicit([names[i] for i in marks]).astype(np.float64)
        values, vectors = np.linalg.eigh(axes @ axes.T)
        good = values > 1e-6 * max(values.max(), 1e-12)
        whiten = vectors[:, good] / np.sqrt(values[good])
        rows = np.concatenate([bad, against_])
        z = against([names[i] for i in rows], axes.T.copy()) @ whiten
        y = np.concatenate([np.ones(len(bad)), -np.ones(len(against_))])
        heavy = np.log1p(counts[0][against_]) * (1 + 4 * (margin[against_] > -0.5) * (turn > 0))
        share = np.concatenate([weight[bad] / weight[bad].sum(), 2 * heavy / heavy.sum()])
        u = machine(z, y, share)
        weights, bias = axes.T @ (whiten @ u[:-1]), float(u[-1])
        margin = against(names, weights)[:, 0] + bias
        value = np.where(counts[1] > 0, np.clip(margin, -1, 1) + 1, 0) * (0.2 * first + np.maximum(odds, 0) * np.log1p(counts[1]))
    return weights, bias


def fit(docs: list[list[str]], toxic: np.ndarray, weight: np.ndarray | None = None) -> Model | None:
    """The machine on all rows; the document's weights on margins that came from the other half of the rows.
    weight: how many rows of its class each row stands for."""
    if not (toxic == 1).any() or not (toxic == 0).any():
        return None
    weight = np.ones(len(docs)) if weight is None else weight
    features = np.zeros((len(docs), 3))
    half = np.arange(len(docs)) % 2
    for h in (0, 1):
        train, test = np.flatnonzero(half != h), np.flatnonzero(half == h)
        part = Model(*learn([docs[i] for i in train], toxic[train]))
        for i in test:
            margin = part.words(docs[i])
            features[i] = summary(margin, np.zeros(len(margin), np.int64), np.arange(len(margin)), 1)[0]
    x, y = np.hstack([features, np.ones((len(docs), 1))]), toxic.astype(np.float64)
    final = np.zeros(4)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ final, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(4)
        final += np.clip(np.linalg.solve(curve, x.T @ (weight * (y - p)) - 0.05 * final), -2, 2)
    final[:3] = np.maximum(final[:3], 0)
    weights, bias = learn(docs, toxic)
    return Model(weights, bias, final)


def tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens of a slice, and each token's document and code. Three or more single characters in a row
    make one more token, so that a spelled-out word is seen."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    flat = lists.flatten()
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    single = pc.equal(pc.utf8_length(flat), 1).to_numpy(zero_copy_only=False)
    coded_words = flat.dictionary_encode()
    names, code = coded_words.dictionary.to_numpy(zero_copy_only=False).tolist(), coded_words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    extra_doc, extra = [], []
    for start, stop in edge.reshape(-1, 2).tolist():
        for d in np.unique(doc[start:stop]).tolist() if stop - start >= 3 else ():
            own = np.flatnonzero(doc[start:stop] == d) + start
            if len(own) >= 3:
                extra_doc.append(d)
                extra.append("".join(names[c] for c in code[own].tolist()))
    return names + extra, np.concatenate([doc, np.array(extra_doc, np.int64)]), np.concatenate([code, len(names) + np.arange(len(extra))])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of each labelled document."""
    for batch in batches:
        for piece in text_slices(batch):
            names, doc, code = tokens(piece.column("text"))
            both = np.sort(doc * (len(names) + 1) + code)
            both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
            pairs = both // (len(names) + 1), both % (len(names) + 1)
            ends = np.searchsorted(pairs[0], np.arange(piece.num_rows + 1))
            lists = [[names[c] for c in pairs[1][a:b].tolist()] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("toxic"), pa.array(lists, pa.list_(pa.string()))], names=["doc_id", "toxic", "words"])


def remainder(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model | None:
    """A model from labelled documents that aren't held out: up to ``rows`` of either class, in the order of a hash of
    their ids. None if a class has no row."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.filter(remainder(F.col("doc_id")) != 1)
    chosen = None
    for c in (0, 1):
        part = known.filter(F.col("toxic") == c).select("doc_id", "toxic", F.xxhash64("doc_id").alias("hash")).orderBy("hash", "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents_only(docs).filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")  # at most 2 x rows ids
    own = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: dict[str, str] = {}  # of each word, one string for all documents
        rows = [(d, t, [one.setdefault(w, w) for w in ws]) for batch in batches for d, t, ws in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "toxic", "words")), strict=True)]
        rows.sort(key=lambda r: r[0])
        toxic = np.array([t for _, t, _ in rows], np.int64)
        weight = np.array([max(1.0, total[t] / max(1, int((toxic == t).sum()))) for t in toxic.tolist()])
        model = fit([ws for _, _, ws in rows], toxic, weight)
        if model is not None:
            made = [pa.array([model.weights], pa.list_(pa.float32())), pa.array([float(model.bias)]), pa.array([model.final], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(made, names=["weights", "bias", "final"])

    # one task has the training rows, which are bounded; the driver gets the machine alone
    words = own.mapInArrow(released(_words), "doc_id long, toxic int, words array<string>").repartition(1)
    made = words.mapInArrow(released(fitted), "weights array<float>, bias double, final array<double>").first()
    return made and Model(np.array(made["weights"], np.float32), made["bias"], np.array(made["final"]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """A row per document: the score, and up to three of its worst words.

    Nothing but the text counts. A null or empty text scores as a text without bad words; without a model all
    scores are 0. Repeated rows each get a row, a null doc_id stays null, an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for piece in text_slices(batch):
                n = piece.num_rows
                if model is None:
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.zeros(n)), pa.array([[]] * n, pa.list_(pa.string()))], names=["doc_id", "score", "worst"])
                    continue
                names, doc, code = tokens(piece.column("text"))
                margin = model.words(names)
                each = margin[code]
                worst: list[list[str]] = [[] for _ in range(n)]
                bad = np.flatnonzero(each > 0)
                for i in bad[np.argsort(-each[bad], kind="stable")].tolist():
                    own = worst[doc[i]]
                    if len(own) < 3 and names[code[i]] not in own:
                        own.append(names[code[i]])
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(model.score(summary(each, doc, code, n))), pa.array(worst, pa.list_(pa.string()))], names=["doc_id", "score", "worst"])

    return documents_only(docs).mapInArrow(released(run), SCHEMA)


def not_toxic(docs: DataFrame, model: Model | None, cut: float = CUT) -> DataFrame:
    """The rows, with all their columns, that score under the cut; all of them without a model."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def decide(piece: pa.RecordBatch) -> np.ndarray:
        if held.value is None:
            return np.ones(piece.num_rows, bool)
        names, doc, code = tokens(piece.column("text"))
        return held.value.score(summary(held.value.words(names)[code], doc, code, piece.num_rows)) < cut

    return rows_where(docs, decide)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
