"""Operators that read each document once: packing, licences, token counts; and exact search."""

import json
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pagewright.llm import exact_topk, license_scan, packing, token_counts

from . import cases


def sample_texts(seed=5, n=60):
    draw = random.Random(seed)
    words = ["Alpha", "it's", "don't", "x,", "naïve", "été!", "3.14", "<|endoftext|>", "mit", "MIT", "license", "License.", "apache", "general", "public", "(c)", "it’s", " ", "ΑΣ", "İx,", "é"]
    return ["".join(draw.choice(words) + draw.choice([" ", "  ", "\n", "\t", "-", ""]) for _ in range(draw.randrange(0, 90))) for _ in range(n)]


def test_pieces_hold_every_id_once(spark):
    texts = [*sample_texts(), None, "", "word " * 5000]
    rows = packing.pack(cases.documents(spark, texts)).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_file())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def test_differencing_fills_windows_evenly():
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 257, 3000)
    at, count = packing.windows_of(lengths)
    sums = np.bincount(at, lengths, count)
    assert sums.max() <= 2048 and lengths.sum() / (count * 2048) > 0.985 and sums.max() - sums.min() < 60
    at, count = packing.windows_of(np.full(5, 1500))  # the number of windows rises until all fit
    assert count == 5 and sorted(at) == [0, 1, 2, 3, 4]
    assert packing.windows_of(np.zeros(0))[1] == 0
    with pytest.raises(ValueError):
        packing.windows_of(np.array([4096]))


def test_words_are_learned_without_encoding_each_as_a_text():
    """Encoding a word as a text of its own takes longer than the model takes for it; marks at its end are no other word."""

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.n = tokenizer, 0

        def encode_batch_fast(self, texts, **how):
            self.n += sum(len(x.split(" ")) for x in texts)
            return self.tokenizer.encode_batch_fast(texts, **how)

    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abcdeéßñ") for _ in range(draw.randrange(2, 12))) for _ in range(500)})
    texts = [f"{w} {w}&&& {w},*** {w}" for w in words] + ["a<|endoftext|> <|endoftext|>. <|endoftext|>&&& <|endoftext| b|> it's!! 's'. ª²³% é=\u0338 Ünder-- x_"]
    ids = packing.Ids(packing.vocabulary_file())
    plain = ids.tokenizer
    ids.tokenizer = Counted(plain)
    flat, sizes = ids.texts(pa.array(texts, pa.string()), 1)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [plain.encode(x, add_special_tokens=False).ids + [1] for x in texts]
    assert ids.tokenizer.n < 30


def test_packing_takes_awkward_tables(spark):
    rows = packing.pack(cases.awkward(spark)).collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert [(r.length, r.doc_tokens) for r in rows if r.doc_id in (1, 2, 3)] == [(1, 1)] * 3
    assert sum(r.doc_id == 4 for r in rows) == 2
    assert packing.pack(cases.empty(spark)).count() == 0


def plain_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_licence_phrases_equal_a_plain_search(spark):
    texts = [*sample_texts(9, 150), None, "", "MIT License", "mit-license mit\nLICENSE", "xmit license", "apache licensee", "the General. Public_License mit license"]
    for r in license_scan.scan(cases.documents(spark, texts)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licences(texts[r.doc_id]), texts[r.doc_id]
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_licence_expressions(spark):
    assert license_scan.expression("MIT OR GPL-3.0") == ({"mit", "gpl-3.0"}, True)
    assert license_scan.expression("MIT and GPL-3.0") == ({"mit", "gpl-3.0"}, False)
    assert license_scan.expression("(GPL-2.0 WITH Classpath-exception-2.0 or Apache-2.0) AND MIT") == ({"gpl-2.0", "apache-2.0", "mit"}, True)
    assert license_scan.expression("MIT or GPL-2.0 and LGPL-3.0")[1] is True  # and binds tighter
    assert license_scan.expression("MIT files follow")[0] == {"mit"}
    assert license_scan.expression("or MIT") is None and license_scan.expression("unknown") is None
    assert license_scan.expression("MIT AND Unheard-Of-1.0 and more") == ({"mit", "unheard-of-1.0"}, False)
    assert license_scan.expression("CDDL-1.0 OR (MIT") == ({"cddl-1.0"}, False)
    many = " AND ".join(f"LicenseRef-{i}" for i in range(500))  # longer than any line
    assert license_scan.expression("MIT AND " + many)[0] == {"mit", *(f"licenseref-{i}" for i in range(500))}
    rows = license_scan.scan(cases.documents(spark, ["# SPDX-License-Identifier: (MIT OR GPL-2.0)\ncode", "plain", "SPDX-License-Identifier: AGPL-3.0-only"])).collect()
    got = {r.doc_id: (r.labels, r.permissive) for r in rows}
    assert got == {0: ("gpl-2.0,mit", True), 1: ("", None), 2: ("agpl-3.0-only", False)}


def test_licence_and_counts_take_awkward_tables(spark):
    for run in (license_scan.scan, token_counts.count_tokens):
        rows = run(cases.awkward(spark)).collect()
        assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "4", "5", "6", "7", "None"]
        assert all(r.n_words == 0 for r in rows if r.doc_id in (1, 2, 3))
        assert run(cases.empty(spark)).count() == 0


def test_counts_equal_the_greedy_longest_match(spark):
    pieces = set(token_counts.byte_pieces(token_counts.vocabulary_file()))
    longest = max(map(len, pieces))
    texts = [*sample_texts(3, 80), "supercalifragilistic antidisestablishment 12345678901234567890 ÿÿÿ"]

    def greedy(word):
        at, count = 0, 0
        while at < len(word):
            at += next(n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in pieces)
            count += 1
        return count

    for r in token_counts.count_tokens(cases.documents(spark, texts)).collect():
        words = texts[r.doc_id].encode().lower().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(b" " + w) for w in words))


def test_automaton_on_a_small_vocabulary():
    made = token_counts.Automaton([b"ab", b"abcd", b"bc", b"cde"])
    assert made.counts([b"abcde", b"abc", b"abcd", b"", b"bcde", b"abcx"]).tolist() == [2, 2, 1, 0, 3, 3]


def test_byte_pieces_cover_the_file():
    path = token_counts.vocabulary_file()
    with open(path, encoding="utf-8") as file:
        assert len(token_counts.byte_pieces(path)) >= len(json.load(file)["model"]["vocab"]) - 1


def brute_top(vectors, k=5):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(good):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for m, (i, w) in enumerate(good) if m != n and len(w) == len(v))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 2048])
def test_search_equals_brute_force(spark, block):
    draw = np.random.default_rng(2)
    vectors = [(int(i), [float(x) for x in draw.normal(size=8).astype(np.float32)]) for i in range(400)]
    vectors += [(1000, vectors[3][1]), (1001, vectors[3][1]), (1050, None), (1100, [1.0, None] * 4), (1150, [float("nan")] * 8), (1200, [float("inf")] * 8), (1250, []), (1300, [0.5, 0.25]), (1301, [0.5, 0.5]), (None, [0.0] * 8)]
    vectors += [vectors[7], (50, vectors[50][1]), (100, vectors[3][1]), (1400, [0.25] * 300), (1401, [0.5] * 300)]
    df = spark.createDataFrame([(i, v, 1, 0.5) for i, v in vectors], "vec_id long, embedding array<float>, label int, score double")
    got = sorted(tuple(r) for r in exact_topk.top_k(df, block=block).collect())
    assert got == brute_top(vectors)
    assert exact_topk.top_k(df.limit(0)).count() == 0


def test_cells_bound_scores_closely():
    draw = np.random.default_rng(3)
    vectors = np.floor(256 * draw.normal(size=(4000, 16))).astype(np.int64)
    low, high = vectors.min(0), vectors.max(0)
    grid = low, np.maximum(1, -(-(high - low + 1) // exact_topk.CELLS)), high
    least, most = exact_topk.bounds(vectors[:20], exact_topk.quantised(vectors, grid), grid)
    scores = vectors[:20] @ vectors.T
    assert (least <= scores).all() and (scores <= most).all()
    kth = -np.sort(-least, axis=1)[:, 4:5]
    assert (most >= kth).sum(1).mean() < 60  # of 4,000, as many exact vectors may be read at most
