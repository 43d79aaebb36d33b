"""Personal data by weak supervision.

Regular expressions give candidate spans; regex, gazetteer and context labelers vote on each. Counts of vote
patterns over the whole corpus go through expectation-maximisation, which estimates how reliable each labeler is
without labels, and the posteriors train a logistic span classifier. It decides on the spans that are added; base
spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, documents_only, released, table, text_slices
from pagewright.llm.spans import PII_KINDS, digest, joined, listed, pii_spans, touching

#: Gazetteers: fixed lists, all lower case.
GIVEN_NAMES = frozenset("james mary john patricia robert jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah charles karen anna maria peter paul pierre marie jean sophie hans klaus jürgen ursula carlos josé carmen luis juan ana laura emma lucas julia".split())
MAIL_PROVIDERS = frozenset("gmail yahoo hotmail outlook icloud aol protonmail gmx web orange".split())
STREETS = frozenset("street st avenue ave road rd lane boulevard drive straße strasse rue calle".split())
#: Context words, by what they speak for.
FOR = frozenset("phone tel telephone call mobile fax cell mail email e-mail contact write ssn social iban account bank card visa mastercard credit name named mr mrs ms dr madame monsieur señor señora herr frau ip host address born teléfono téléphone telefon handy correo".split())
AGAINST = frozenset("version isbn issn order invoice figure fig page pages chapter section table build release step item ref doi part model serial error line".split())

#: Kinds beyond the base ones, with the patterns that give their candidates.
EXTRA = {
    "email": re.compile(r"\b[A-Za-z0-9._%+-]{2,64} ?[(\[] ?at ?[)\]] ?[A-Za-z0-9-]{2,63}(?: ?[(\[] ?dot ?[)\]] ?[A-Za-z0-9-]{2,24}){1,4}\b", re.IGNORECASE),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "phone": re.compile(r"(?<![0-9+(.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9-])"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Señor|Señora|Madame|Monsieur)\.? [A-ZÀ-Þ][a-zà-ÿ]{1,30}\b"),
}
LABELERS = ("regex", "format", "gazetteer", "before", "after")
ROUNDS, SURE = 60, 0.5
#: Counts of patterns go in as shares of so many, so that pseudo-counts and ridge weigh alike in every corpus.
MASS = 1e5
SCANNED = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<kind:string,start:long,end:long>>, more array<struct<kind:string,start:long,end:long,pattern:string>>, patterns array<string>"
FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, personal boolean"
_WORD = re.compile(r"[\w'-]+")
_DIGIT = re.compile(r"[0-9]")


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def votes(text: str, kind: str, start: int, end: int, base: bool) -> str:
    """Each labeler's vote: + for personal data, - against, 0 for none; then the span's shape."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    if kind == "iban":
        form = "+" if iban_valid(span) else "-"
    elif kind == "ssn":
        form = "-" if span[:3] in ("000", "666") or span[0] == "9" or span[4:6] == "00" or span[7:] == "0000" else "+"
    elif kind == "phone":
        form = "+" if 9 <= digits <= 15 else "-"
    elif kind in ("card", "ip"):
        form = "+" if base else "-"
    else:
        form = "0"
    left, right = _WORD.findall(text[max(0, start - 48) : start].lower())[-5:], _WORD.findall(text[end : end + 32].lower())[:3]
    inside = set(_WORD.findall(span.lower())) | set(re.split(r"[._%+@-]", span.lower()))
    known = "+" if inside & (GIVEN_NAMES | MAIL_PROVIDERS) or GIVEN_NAMES & set(left[-2:]) else "-" if STREETS & set(right[:1]) and kind == "phone" else "0"

    def context(words: list[str]) -> str:
        good, bad = bool(FOR & set(words)), bool(AGAINST & set(words))
        return "0" if good == bad else "+" if good else "-"

    shape = f"{min(len(span) // 8, 4)}{min(4 * digits // max(1, len(span)), 3)}"
    return f"{kind}|{'+' if base else '0'}{form}{known}{context(left)}{context(right)}|{shape}"


def candidates(text: str, base: list) -> list[tuple[str, int, int, str]]:
    """Spans of the other patterns that no base span touches."""
    out, taken = [], touching((a, b) for _, a, b in base)
    digit = bool(_DIGIT.search(text))
    for kind, pattern in EXTRA.items():
        if kind in ("ssn", "iban", "phone") and not digit:
            continue
        if kind == "email" and "(at" not in (low := text.lower()) and "[at" not in low and "( at" not in low and "[ at" not in low:
            continue
        for m in pattern.finditer(text):
            if not taken(*m.span()):
                out.append((kind, *m.span()))
    if digit:  # near misses of base kinds teach the model what isn't personal
        for m in re.finditer(r"(?<![0-9])[0-9]{14,19}(?![0-9])", text):
            if not taken(*m.span()):
                out.append(("card", *m.span()))
    return [(k, a, b, votes(text, k, a, b, False)) for k, a, b in sorted(out, key=lambda s: (s[1], s[2], s[0]))]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span_type = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    more_type = pa.struct([*span_type, ("pattern", pa.string())])
    for batch in batches:
        for piece in text_slices(batch):
            columns: list[list] = [[] for _ in range(8)]
            for text in piece.column("text").to_pylist():
                base = pii_spans(text) if "@" in text or _DIGIT.search(text) else []
                more = candidates(text, base)
                counts = [sum(s[0] == k for s in base) for k in PII_KINDS]
                rows = [*counts, digest(base), [dict(zip(("kind", "start", "end"), s, strict=True)) for s in base], [dict(zip(("kind", "start", "end", "pattern"), s, strict=True)) for s in more], [votes(text, *s, True) for s in base] + [s[3] for s in more]]
                for column, value in zip(columns, rows, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(span_type), pa.list_(more_type), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["doc_id", *[f"n_{k}" for k in PII_KINDS], "base_sha256", "base", "more", "patterns"])


def _features(patterns: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Votes as -1, 0, 1; and the classifier's features: votes, squared votes, kind and shape."""
    parts = [p.split("|") for p in patterns]
    vote = np.array([[{"+": 1, "0": 0, "-": -1}[c] for c in p[1]] for p in parts], np.float64).reshape(len(parts), len(LABELERS))
    kinds = sorted({*PII_KINDS, *EXTRA})
    kind = np.array([[p[0] == k for k in kinds] for p in parts], np.float64).reshape(len(parts), len(kinds))
    shape = np.array([[int(c) / 4 for c in p[2]] for p in parts], np.float64).reshape(len(parts), 2)
    return vote, np.hstack([np.ones((len(parts), 1)), vote, vote**2, kind, shape])


def reliabilities(vote: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: how often each labeler casts each vote on either class, and the
    posterior of each pattern. It starts from the votes' majority; two pseudo-counts keep every share above 0."""
    post = np.clip(0.5 + 0.2 * vote.sum(1), 0.05, 0.95)
    share = np.zeros((2, vote.shape[1], 3))
    for _ in range(rounds):
        prior = (post @ count + 1) / (count.sum() + 2)
        log = np.tile(np.log([[1 - prior], [prior]]), (1, len(vote)))
        for c, weight in enumerate(((1 - post) * count, post * count)):
            for j in range(vote.shape[1]):
                for v in (-1, 0, 1):
                    share[c, j, v + 1] = (weight[vote[:, j] == v].sum() + (2 if (v > 0) == bool(c) and v else 1)) / (weight.sum() + 4)
                log[c] += np.log(share[c, j, vote[:, j].astype(int) + 1])
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))
    return share, post


def classifier(x: np.ndarray, post: np.ndarray, count: np.ndarray, steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic model fitted to the posteriors by Newton steps."""
    weight = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (count * (post - p)) - ridge * weight
        curve = (x * (count * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        weight += np.linalg.solve(curve, slope)
    return weight


def accepted(patterns: list[str], counts: list[int]) -> dict[str, float]:
    """What the trained classifier says of every pattern that the corpus holds."""
    if not patterns:
        return {}
    vote, x = _features(patterns)
    count = np.array(counts, np.float64)
    count *= MASS / count.sum()
    _, post = reliabilities(vote, count)
    score = 1 / (1 + np.exp(-np.clip(x @ classifier(x, post, count), -30, 30)))
    return dict(zip(patterns, score.tolist(), strict=True))


def find(docs: DataFrame) -> DataFrame:
    """A row per document: counts and digest of base spans, all spans, base and added, and whether there are any.

    A null or empty text has no spans. A very long text is read whole, in time linear in it and its spans. Repeated rows each get a row and count each time, a null doc_id stays null,
    an empty table gives no rows; other columns aren't read. Only counts of vote patterns, whose number is bounded
    by kinds, votes and shapes, reach the driver.
    """
    kept = Kept(docs.sparkSession)
    scanned = kept.write(documents_only(docs).mapInArrow(released(_scan), SCANNED))
    counts = scanned.select(F.explode("patterns").alias("pattern")).groupBy("pattern").count().orderBy("pattern").collect()
    scores = accepted([r["pattern"] for r in counts], [r["count"] for r in counts])
    sure = {p for p, s in scores.items() if s >= SURE}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, added = [], []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist(), strict=True):
                own = {(s["kind"], s["start"], s["end"]) for s in more if s["pattern"] in sure}
                spans = [(s["kind"], s["start"], s["end"]) for s in base]
                added.append(len(own))
                texts.append(joined(listed(spans + sorted(own), PII_KINDS)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")], pa.array(texts, pa.string()), pa.array(added, pa.int64()), pa.array([t != "" for t in texts], pa.bool_())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "personal"])

    return scanned.mapInArrow(released(run), FOUND)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
