"""Every matching method counts, alone and beside others."""

import random

import pytest
from pyspark.sql import functions as F

from pagewright.operators import matching
from pagewright.plans import evaluate


def test_stemmed_and_fuzzy_count(spark):
    chunks = spark.createDataFrame([("a", "an injury"), ("b", "an assesment was made"), ("c", "the of"), ("d", "injuries")], "chunk_id string, chunk_text string")
    terms = spark.createDataFrame([(1, "injuries", "assessment, zzz"), (2, "assessment", "")], "query_id long, search_term string, acceptable_terms string")
    pairs = terms.crossJoin(chunks)
    met = lambda *methods: {(r.query_id, r.chunk_id) for r in matching.any_rows(pairs, list(methods)).collect()}
    assert met("exact") == {(1, "d")} and met("semantic_only") == set()
    assert met("stemmed") == {(1, "a"), (1, "d")}
    assert (2, "b") in met("fuzzy")
    assert met(*matching.METHODS) == met("exact") | met("wildcard") | met("stemmed") | met("fuzzy")
    got = {r.query_id: tuple(r)[1:] for r in evaluate.presence(pairs, chunks, terms, ["exact", "stemmed"]).collect()}
    assert got == {1: (2, 0, 2), 2: (0, 0, 0)}
    assert {r.query_id: r.chunks_with_acceptable for r in evaluate.presence(pairs, chunks, terms, ["fuzzy"]).collect()}[1] >= 1
    with pytest.raises(ValueError):
        matching.any_method(F.lit("a"), F.lit("b"), ["stemmed"])


def test_fuzzy_over_many_pairs_equals_pair_by_pair():
    draw = random.Random(3)
    words = ["assessment", "assesment", "injury", "injuries", "of", "the", "straße", "naïve\U0001f600", "committee", "comittee", "a", "x"]
    words += ["".join(draw.choice("abcde") for _ in range(draw.randrange(1, 9))) for _ in range(20)]
    match, found = matching.Fuzzy(), 0
    match.PART = 7
    for n in range(1500):
        body = " ".join(draw.choices(words, k=draw.randrange(0, 14))).upper()
        term = " ".join(draw.choices(words, k=draw.randrange(0, 4))) if n % 3 else body[3:20].replace("E", "q", 1)
        want = matching.fuzzy_match(term, body)
        assert match(term, body) == want, (term, body)
        found += want
    assert 100 < found < 1400


def test_fuzzy_compares_only_stretches_with_enough_letters(monkeypatch):
    calls = []
    plain = matching.ratio
    monkeypatch.setattr(matching, "ratio", lambda a, b: calls.append(1) or plain(a, b))
    match = matching.Fuzzy()
    assert not any(match("liability statement", f"nothing here says who has to pay for {i} broken wheels " * 20) for i in range(50))
    assert len(calls) < 500


def test_fuzzy_blocks_equal_pair_by_pair(monkeypatch):
    """All terms of a case and many texts at once: ends, short texts, long terms, other scripts, many parts."""
    draw = random.Random(4)
    words = ["assessment", "assesment", "injury", "injuries", "of", "the", "straße", "naïve\U0001f600", "committee", "comittee", "a", "x", "\0", "İstanbul"]
    words += ["".join(draw.choice("abcde") for _ in range(draw.randrange(1, 9))) for _ in range(20)]
    found = 0
    for n in range(40):
        bodies = [" ".join(draw.choices(words, k=draw.randrange(0, 14))).upper() for _ in range(25)]
        terms = [" ".join(draw.choices(words, k=draw.randrange(0, 4))) if i % 3 else bodies[i][3:20].replace("E", "q", 1) for i in range(11)]
        terms += [bodies[3][: 80 + n].replace("A", "z", 2), "of the", ""]
        monkeypatch.setattr(matching.FuzzyBlock, "CHARS", (1 << 20, 60, 300)[n % 3])
        got = matching.FuzzyBlock(terms)(bodies)
        for i, body in enumerate(bodies):
            for j, term in enumerate(terms):
                assert got[i, j] == matching.fuzzy_match(term, body), (term, body)
        found += got.sum()
    assert 1000 < found < 10000


def test_methods_in_cases_equal_those_of_pairs_without_moving_texts(spark, monkeypatch):
    draw = random.Random(6)
    words = "injury injuries assessment assesment committee comittee the of claim claims claiming payer".split()
    bodies = spark.createDataFrame([(f"c{n}", f"k{n % 3}", " ".join(draw.choices(words, k=draw.randrange(0, 5))) or None) for n in range(60)], "chunk_id string, case_ref string, chunk_text string")
    terms = spark.createDataFrame([(n, f"k{n % 4}", " ".join(draw.choices(words, k=2)) if n else None) for n in range(20)], "query_id long, case_ref string, search_term string")
    pairs = terms.join(bodies, "case_ref")
    monkeypatch.setattr(matching, "TERMS", 2)
    flags = lambda df: sorted((r.query_id, r.chunk_id, r.matched) for r in df.collect())
    assert flags(matching.fuzzy_in_cases(terms, bodies)) == flags(matching.fuzzy(pairs))
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = matching.any_in_cases(terms, bodies, list(matching.METHODS))
    assert rows(whole) == rows(matching.any_rows(pairs, list(matching.METHODS)))
    # the texts of pairs, once for each term, are not in any exchange that makes rows distinct
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [" in line and "chunk_text" in line.split("]")[0]]
