"""Near-duplicate documents, fuzzy lines, and the pipeline, against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from pagewright.llm import line_dedup, links, near_dedup
from pagewright.llm.base import Kept
from pagewright.llm.links import components

from . import cases


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def grouped(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    near = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, grouped(sets, near)


def family(seed, n, words=120):
    """Copies that each change some words, so that near ones chain."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(draw.randrange(0, 5)):
            own[draw.randrange(words)] = f"v{draw.randrange(5000)}"
        out.append(" ".join(own))
        if draw.random() < 0.5:
            base = own
    return out


def test_groups_equal_brute_force(spark):
    texts = [t for s in range(12) for t in family(s, 12)]
    texts += [texts[0].upper().replace(" ", " \n"), None, "", " \t", "one two", "One  two", "one", "a b c d e", "a b c d f"]
    df = cases.documents(spark, texts, 100)
    sizes, roots = brute({100 + i: t for i, t in enumerate(texts)})
    rows = near_dedup.group(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], roots[r.doc_id], roots[r.doc_id] == r.doc_id), r
    assert sum(r.stays for r in rows) == len(set(roots.values()))


def test_groups_take_awkward_tables(spark):
    rows = near_dedup.group(cases.awkward(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "3", "4", "4", "5", "6", "7", "None"]
    assert [r.kept for r in rows if r.doc_id == 4] == [True, True] and sum(r.stays for r in rows if r.doc_id == 4) == 1
    assert near_dedup.group(cases.empty(spark)).count() == 0
    blank = near_dedup.group(cases.documents(spark, [None, "", " \t\n"]).coalesce(1)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept, r.stays) for r in blank) == [(i, 0, i, True, True) for i in range(3)]


def test_crowded_bands_equal_brute_force(spark, monkeypatch):
    """One text with so many edits that most pairs of copies share bands, and few are near: blocks of a few, so that there are many."""
    monkeypatch.setattr(links, "CROWD", 4)
    monkeypatch.setattr(links, "BLOCK", 16)
    monkeypatch.setattr(links, "CHECKED", 1)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(260):
        own = list(base)
        for at in draw.sample(range(100), draw.randrange(1, 6)):
            own[at] = f"v{draw.randrange(10**6)}"
        texts.append(" ".join(own))
    _, roots = brute(dict(enumerate(texts)))
    got = {r.doc_id: r.component_id for r in near_dedup.group(cases.documents(spark, texts)).collect()}
    assert got == roots and 1 < len(set(roots.values())) < 200


def test_signatures_estimate_the_similarity():
    draw = np.random.default_rng(0)
    for n, share in ((40, 0.5), (400, 0.8), (3, 0.0), (2000, 0.9)):
        both = draw.integers(0, 2**63, int(n * share), dtype=np.uint64)
        one, two = (np.sort(np.concatenate([both, draw.integers(0, 2**63, n - len(both), dtype=np.uint64)])) for _ in range(2))
        made = near_dedup.signatures(np.concatenate([one, two]), np.array([0, n, 2 * n]))
        want = len(both) / (2 * n - len(both))
        assert abs((made[0] == made[1]).mean() - want) < 0.12
        assert (made < np.iinfo(np.uint64).max).all()


def test_signature_is_the_minimum_over_whole_permutations():
    draw = np.random.default_rng(1)
    own = np.sort(draw.integers(0, 2**63, 30, dtype=np.uint64))
    want = np.full((1, near_dedup.PLACES), np.iinfo(np.uint64).max, np.uint64)
    order = np.tile(np.arange(near_dedup.PLACES), (len(own), 1))
    for step in range(near_dedup.PLACES):
        rank, swap = near_dedup._draw(own, step)
        for i in range(len(own)):
            place = order[i, swap[i]]
            order[i, swap[i]], order[i, step] = order[i, step], place
            want[0, place] = min(want[0, place], rank[i])
    assert (near_dedup.signatures(own, np.array([0, 30])) == want).all()


def test_shingles_of_slices_equal_those_of_single_texts():
    texts = ["a b c d e f g", "", "A  B\tc d e", "x", "a b c d e f g", "x y z w"]
    hashes, ends = near_dedup.shingles(pa.array(texts))
    for i, t in enumerate(texts):
        one, _ = near_dedup.shingles(pa.array([t]))
        assert (hashes[ends[i] : ends[i + 1]] == one).all() and len(one) == len(shingle_set(t))


def test_components_of_chains_stars_and_rings(spark):
    own = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(2).shuffle(own)
    df = spark.createDataFrame(own, "a long, b long")
    got = {r.node: r.root for r in components(Kept(spark), df).collect()}
    want = grouped({x for p in own for x in p if x != 300}, [p for p in own if p[0] != p[1]])
    assert got == want
    assert components(Kept(spark), df.limit(0)).count() == 0


# Lines ---------------------------------------------------------------------------------------------------------


def norm(line):
    low = line.lower()
    return " ".join(regex.findall(r"[\p{L}\p{M}\p{N}]+", low)) or low.strip()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j - 1] + (x != y), row[j] + 1, after[-1] + 1))
        row = after
    return row[-1]


def lines_left(texts):
    """By brute force: all pairs of lines, edit distances by the recurrence, without any fingerprint."""
    places = [(d, n, norm(line)) for d, t in texts.items() for n, line in enumerate((t or "").split("\n")) if norm(line)]
    kinds = sorted({x for _, _, x in places})
    bag = {x: Counter(x) for x in kinds}
    linked = [(a, b) for a in kinds for b in kinds if a < b and abs(len(a) - len(b)) <= (most := max(len(a), len(b)) // 10) and max((bag[a] - bag[b]).total(), (bag[b] - bag[a]).total()) <= most and distance(a, b) <= most]
    root = grouped(kinds, linked)
    first = {}
    for d, n, x in sorted(places):
        first.setdefault(root[x], (d, n))
    gone = {(d, n) for d, n, x in places if first[root[x]] != (d, n)}
    return {d: None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in texts.items()}, gone, linked


def test_lines_equal_brute_force(spark):
    draw = random.Random(7)
    pool = [" ".join(f"w{draw.randrange(900)}" for _ in range(draw.randrange(3, 60))) for _ in range(40)]
    texts = {}
    for d in range(60):
        lines = [" ".join(f"long{i}" for i in range(600)) + ("" if d % 2 else " end")] if d % 10 == 0 else []
        for _ in range(draw.randrange(1, 7)):
            words = draw.choice(pool).split()
            if draw.random() < 0.4:
                words[draw.randrange(len(words))] += "x"
            lines.append(draw.choice([" ", "  ", ", "]).join(words) + draw.choice(["", ".", "!"]))
        texts[d] = "\n".join(lines)
    texts |= {60: None, 61: "", 62: "\n\n", 63: "short line\nshort line"}
    want, gone, linked = lines_left(texts)
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in texts.items()], "doc_id long, text string, lang string, dropped string, line_no int")
    got = {r.doc_id: r.text for r in line_dedup.dedup(df).collect()}
    assert got == want and gone and linked


def test_lines_take_awkward_tables(spark):
    rows = line_dedup.dedup(cases.awkward(spark)).collect()
    assert len(rows) == 9 and {r.text for r in rows if r.doc_id == 4} == {"a row that is there twice"}
    assert line_dedup.dedup(cases.empty(spark)).count() == 0
    alone = line_dedup.dedup(cases.documents(spark, [None, "", " \n\t", "---\n***\n---"])).orderBy("doc_id").collect()
    assert [r.text for r in alone] == [None, "", " \n\t", "---\n***"]


def test_votes_are_majorities(spark):
    draw = random.Random(8)
    rows = [(n, [draw.getrandbits(64) - 2**63 for _ in range(n)]) for n in (1, 2, 3, 15, 16, 17, 40, 255)]
    each = spark.createDataFrame(rows, "n int, h array<long>").select("n", "h", F.explode("h").alias("x"))
    sums = [F.sum(F.shiftrightunsigned("x", i).bitwiseAND(F.lit(line_dedup._COUNTERS))) for i in range(line_dedup.SUMS)]
    for r in each.groupBy("n", "h").agg(line_dedup.majority(sums, F.col("n")).alias("s")).collect():
        assert r.s == sum(1 << b for b in range(56) if 2 * sum(h >> b & 1 for h in r.h) > r.n)


def test_crowded_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", 4)
    monkeypatch.setattr(links, "BLOCK", 8)
    monkeypatch.setattr(links, "CHECKED", 1)
    draw = random.Random(6)
    base = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(30)]
    texts = {}
    for d in range(120):
        own = list(base)
        for at in draw.sample(range(30), draw.randrange(0, 5)):
            own[at] = "".join(draw.choice("klmnopqrst") for _ in range(6))
        texts[d] = " ".join(own)
    want, gone, linked = lines_left(texts)
    got = {r.doc_id: r.text for r in line_dedup.dedup(cases.documents(spark, list(texts.values()))).collect()}
    assert linked and 2 * sum(got[d] == want[d] for d in texts) > len(texts)
    assert {d for d in texts if not got[d]} <= {d for d in texts if not want[d]}
    assert sum(not got[d] for d in texts) >= 0.9 * len(gone)


# Pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from pagewright.llm import toxicity

    from .test_scans import labelled, passage

    base, labels = labelled(spark, 160)
    rows = [(r.doc_id, f"{r.text} {passage(r.doc_id, 30)}") for r in base.collect()]
    rows += [(500 + i, rows[2 * i + 1][1] + " more") for i in range(10)]  # near copies
    rows += [(600 + i, f"{passage(700 + i)}\n{passage(9000)}") for i in range(5)]  # a shared line
    rows += [(700 + i, f"{passage(800 + i)} {passage(9100 + i)} {passage(900 + i)}") for i in range(5)]  # leaks
    rows += [(800, None), (801, "")]
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, passage(9100 + i)) for i in range(5)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = toxicity.train(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    left = {i: t for i, t in rows if scores[i] < toxicity.CUT}
    cut, _, _ = lines_left(left)
    left = {i: t for i, t in cut.items() if t == left[i] or (t or "").strip()}
    _, roots = brute(left)
    left = {i: t for i, t in left.items() if roots[i] == i}
    plain = lambda t: re.sub("[^0-9a-z]", "", (t or "").lower())
    left = {i: t for i, t in left.items() if not any(plain(passage(9100 + k)) in plain(t) for k in range(5))}

    stages, now = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        stages[name] = now
    assert {r.doc_id: r.text for r in now.collect()} == left
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == set(left)
    assert not any(i in left for i in range(700, 705)) and any(i in left for i in range(600, 605))


def test_components_that_are_stars_need_no_round(spark):
    kept = Kept(spark)
    got = components(kept, spark.createDataFrame([(1, n) for n in range(2, 9)] + [(20, 21)], "a long, b long"))
    assert kept.n == 1
    assert {r.node: r.root for r in got.collect()} == {n: 1 for n in range(1, 9)} | {20: 20, 21: 20}


def test_more_of_a_large_group_is_checked_before_all_pairs(spark):
    """Lines of a crowded key that are linked to a few of its largest group find one of them before all its lines meet."""
    kept, given = Kept(spark), []
    nodes = [(1, n) for n in range(1000)]
    keyed = spark.createDataFrame(nodes, "key long, node long").withColumn("trait", F.struct(F.lit(1).alias("one")))
    near = lambda a, b: (F.col(b) < 900) & ((F.col(a) == 0) | (F.col(a) == F.col(b) - 1)) | (F.col(b) >= 900) & (F.col(a) % 20 == F.col(b) % 20) & (F.col(a) > 0) & (F.col(a) < 900)

    def in_crowds(crowds):
        given.append(crowds.filter("root <> most").count())
        return crowds.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))

    roots = links.resolve(kept, keyed, lambda one, two: F.lit(True), lambda pairs: pairs.filter(near("a", "b")), lambda df: df.withColumn("load", F.lit("")), crowd=32, in_crowds=in_crowds)
    assert sum(given) <= 5
    assert roots.filter("root = 0").count() >= 995


def test_keys_of_several_groups_carry_their_largest(spark):
    """What is largest is found once for each round, from keys and groups alone."""
    members = spark.createDataFrame([(k, n, (n,)) for k, n in [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 5), (3, 6)]], "key long, node long, trait struct<x: long>")
    roots = spark.createDataFrame([(0, 0), (1, 0)], "node long, root long")
    got = sorted((r.key, r.node, r.root, r.most, r.nodes) for r in links._mixed(line_dedup.Kept(spark), members, roots).collect())
    assert got == [(1, 0, 0, 0, 3), (1, 1, 0, 0, 3), (1, 2, 2, 0, 3), (3, 5, 5, 6, 2), (3, 6, 6, 6, 2)]
