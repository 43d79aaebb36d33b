"""Alike lines must meet by edits alone: pairs with edited words and letters, at every length."""

import os
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.llm import line_dedup

from . import cases
from .test_groups import grouped, norm


def edited(draw, words, times):
    words = list(words)
    for at in draw.sample(range(len(words)), times):
        word = words[at]
        words[at] = word[:1] + draw.choice("0123456789") + word[2:]
    return words


def test_edited_copies_of_lines_go(spark):
    draw = random.Random(11)
    texts, n = [], 0
    for size in (6, 8, 10, 20, 50, 120):
        for _ in range(12):
            words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(3, 9))) for _ in range(size)]
            texts += [" ".join(words), " ".join(edited(draw, words, max(1, size // 12)))]
            n += 1
    left = line_dedup.dedup(cases.documents(spark, texts)).filter("text <> ''").count()
    assert left <= len(texts) - n + 1


def test_short_lines_go_too(spark):
    texts = ["page two\none\n\nan own line", "page two\none\n\n", "Page  two\n" + "x" * 500 + "\nreferences.", "x" * 499 + "y\nreferences"]
    got = [r.text for r in line_dedup.dedup(cases.documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == ["page two\none\n\nan own line", "\n", "x" * 500 + "\nreferences.", ""]


def test_runs_of_letters_part_short_lines_but_no_edited_ones(spark):
    """Lines of few syllables have near SimHashes; their texts needn't be compared for that."""
    draw = random.Random(5)
    syllables = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic".split()
    lines = ["".join(draw.choice(syllables) + draw.choice(["", "", " "]) for _ in range(21)).strip() for _ in range(300)]
    changed = []
    for line in lines:
        x = list(line)
        for at in draw.sample(range(len(x)), len(x) // 10):
            x[at] = draw.choice(["", "q", x[at] + "z", " "])
        changed.append("".join(x))
    rows = [(n, len(x), x) for n, x in enumerate(lines + changed) if len(x) < 54]
    traits = line_dedup.fingerprints(spark.createDataFrame(rows, "node long, size int, norm string")).select("node", F.struct("size", "sim", "low", "high").alias("trait"))
    one, two = (traits.select(F.col("node").alias(n), F.col("trait").alias(f"trait_{n}")) for n in "ab")
    pairs = one.crossJoin(two).withColumn("may", line_dedup._may(F.col("trait_a"), F.col("trait_b")))
    far = pairs.filter(f"a < b AND b < {len(lines)}").agg(F.count("*"), F.count_if("may")).first()
    assert far[1] < 0.03 * far[0]
    text, half = {n: x for n, _, x in rows}, (1 << 64) - 1
    for r in pairs.filter(f"b = a + {len(lines)}").collect():
        most = max(len(text[r.a]), len(text[r.b])) // 10
        x, y = (r[t].low & half | (r[t].high & half) << 64 for t in ("trait_a", "trait_b"))
        assert x and y and max((x & ~y).bit_count(), (y & ~x).bit_count()) <= 2 * most


def linked_lines(kinds):
    """All pairs within a tenth of edits: letters and pairs of letters leave few candidates, edit distances decide."""
    kinds = sorted(kinds, key=len)
    sizes = np.array([len(x) for x in kinds])
    bags = np.zeros((len(kinds), 512), np.int16)
    for i, x in enumerate(kinds):
        for c in x:
            bags[i, ord(c) % 64] += 1
        for two in zip(x, x[1:], strict=False):
            bags[i, 64 + zlib.crc32("".join(two).encode()) % 448] += 1
    pairs = []
    for i in range(len(kinds)):
        others = np.arange(i + 1, np.searchsorted(sizes, sizes[i] * 10 // 9 + 2, "right"))
        most = sizes[others] // 10
        off = np.abs(bags[others].astype(np.int32) - bags[i])
        near = (sizes[others] - sizes[i] <= most) & (off[:, :64].sum(1) <= 2 * most) & (off[:, 64:].sum(1) <= 4 * most)
        pairs += [(kinds[i], kinds[j]) for j in others[near]]
    code = {c: chr(33 + n) for n, c in enumerate(sorted({c for x in kinds for c in x}))}  # a byte a letter, as DuckDB counts bytes
    assert len(code) < 94
    plain = lambda x: "".join(code[c] for c in x)
    found = pa.table({"n": list(range(len(pairs))), "a": [plain(a) for a, _ in pairs], "b": [plain(b) for _, b in pairs]})  # noqa: F841
    good = duckdb.sql("SELECT n FROM found WHERE levenshtein(a, b) <= greatest(length(a), length(b)) // 10").fetchall()
    return [pairs[n] for (n,) in good]


def test_recall_on_the_driver_s_documents(spark):
    at = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(at):
        pytest.skip("no test data")
    docs = spark.read.parquet(at)
    places = [(r.doc_id, n, norm(line)) for r in docs.select("doc_id", "text").collect() for n, line in enumerate((r.text or "").split("\n")) if norm(line)]
    root = grouped(sorted({x for _, _, x in places}), linked_lines({x for _, _, x in places}))
    first = {}
    for d, n, x in sorted(places):
        first.setdefault(root[x], (d, n))
    want = {(d, n) for d, n, x in places if first[root[x]] != (d, n)}
    got = {(r.doc_id, n) for r in line_dedup.decide(docs).collect() for n in r.dropped}
    assert len(want - got) <= 0.02 * len(want) and len(got - want) <= 0.02 * len(want)


def test_pairs_of_blocks_meet_as_rows_and_keep_their_links(spark):
    """A lambda over arrays is interpreted for each pair; rows meet inside one compiled stage."""
    draw = random.Random(5)
    whole = ["".join(draw.choice("abcdefgh ") for _ in range(40)).strip() for _ in range(12)]
    texts = [t for w in whole for t in (w, w[:20] + "X" + w[20:], w[:10] + w[13:], w[::-1])]
    lines = spark.createDataFrame([(i, i % 40, len(t), t) for i, t in enumerate(texts)], "node long, root long, size int, norm string")
    traits = line_dedup.fingerprints(lines.drop("root")).groupBy("node").agg(F.first(F.struct("size", "sim", "low", "high")).alias("trait"))
    every = lines.join(traits, "node").select(F.struct("node", "root", "trait", F.col("norm").alias("load")).alias("x"))
    found = line_dedup._alike_in_blocks(every.agg(F.collect_list("x").alias("outsiders"), F.collect_list("x").alias("members")))
    assert found._jdf.queryExecution().executedPlan().toString().count("Generate explode(members") == 1
    one, two = (every.select(*[F.col(f"x.{c}").alias(f"{c}_{s}") for c in ("node", "root", "trait", "load")]) for s in "ab")
    near = line_dedup._may({k: F.col(f"trait_a.{k}") for k in ("size", "sim", "low", "high")}, {k: F.col(f"trait_b.{k}") for k in ("size", "sim", "low", "high")})
    pairs = [(r.node_a, r.root_b, r.node_b, r.load_a, r.load_b) for r in one.crossJoin(two).filter("root_a <> root_b").filter(near).collect()]
    want: dict = {}
    for a, root, b, x, y in pairs:
        if duckdb.execute("SELECT levenshtein(?, ?)", [x, y]).fetchone()[0] <= int(max(len(x), len(y)) * line_dedup.EDITS):
            want[a, root] = min(b, want.get((a, root), b))
    assert want and {(r.a, r.b) for r in found.collect()} == {(a, b) for (a, _), b in want.items()}


def test_crowded_lines_meet_by_segments(spark):
    """Of a key's lines those meet that share a segment: no link is left out, and few others are compared."""
    draw = random.Random(9)
    syllables = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic é".split()
    texts = []
    for size in [*range(9, 75), 89, 90, 91, 150, 199, 300]:
        for _ in range(4):
            whole = list("".join(draw.choice(syllables) + draw.choice(["", "", " "]) for _ in range(size))[:size])
            other = list(whole)
            for _ in range(size // 9):
                at, kind = draw.randrange(len(other)), draw.randrange(3)
                other[at : at + 1] = [[], ["q"], [other[at], "z"]][kind]
            longer = list(whole)
            for _ in range(size // 9):
                longer.insert(draw.randrange(len(longer)), "x")
            texts += ["".join(whole), "".join(other), "".join(longer)]
    # the first lines are the key's largest group; the others are groups of their own
    rows = [(7, n, 0 if n < 30 else n, 0, x) for n, x in enumerate(texts)]
    crowds = spark.createDataFrame(rows, "key long, node long, root long, most long, load string")
    found = {(r.a, r.b) for r in line_dedup._sharing_segments(crowds).collect()}
    assert not any(b < 30 for _, b in found)
    code = {c: chr(33 + n) for n, c in enumerate(sorted({c for x in texts for c in x}))}  # a byte a letter, as DuckDB counts bytes
    lines = pa.table({"n": list(range(len(texts))), "x": ["".join(code[c] for c in x) for x in texts]})  # noqa: F841
    alike = duckdb.connect().sql("SELECT a.n, b.n FROM lines a JOIN lines b ON a.n < b.n AND b.n >= 30 AND abs(length(a.x) - length(b.x)) <= greatest(length(a.x), length(b.x)) // 10 WHERE levenshtein(a.x, b.x) <= greatest(length(a.x), length(b.x)) // 10").fetchall()
    assert len(alike) > 200 and set(alike) <= found
    assert len(found) < 0.02 * len(texts) * (len(texts) - 1) / 2


def test_a_crowded_key_is_not_compared_pair_by_pair(spark):
    """Several hundred short lines of one key, none alike but for two: their pairs aren't made."""
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(40)) for _ in range(300)]
    texts.append(texts[200][:20] + "X" + texts[200][21:])
    kept, asked = line_dedup.Kept(spark), []
    lines = spark.createDataFrame([(1, n, len(x), x) for n, x in enumerate(texts)], "key long, node long, size int, load string")

    def links(pairs):
        asked.append(pairs.count())
        two = pairs.join(lines.select(F.col("node").alias("a"), F.col("load").alias("x")), "a").join(lines.select(F.col("node").alias("b"), F.col("load").alias("y")), "b")
        return two.filter(line_dedup._alike(F.col("x"), F.col("y"))).select("a", "b")

    keyed = lines.select("key", "node", F.struct("size").alias("trait"))
    roots = line_dedup.resolve(kept, keyed, lambda one, two: F.lit(True), links, lambda nodes: lines.select("node", "load").join(nodes, "node"), crowd=32, in_crowds=line_dedup._sharing_segments)
    assert [tuple(r) for r in roots.orderBy("node").collect()] == [(200, 200), (300, 200)]
    assert sum(asked) < 30 * len(texts)


def test_long_lines_of_crowded_keys_are_paired_once(spark):
    """Long lines of a key share most segments: a pair would be a row for each of them, and for each key."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randrange(4, 8)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(draw.randrange(8, 20))) + " " + passage for _ in range(50)]
    texts += [x[:30] + "7" + x[31:] for x in texts[40:]]
    # the first lines are each key's largest group; bits of far SimHashes leave out no pair
    rows = [(key, n, 0 if n < 8 else n, 0, (len(x), draw.getrandbits(55), 0, 0), x) for n, x in enumerate(texts) for key in (7, 8, 9) if (n + key) % 4]
    crowds = spark.createDataFrame(rows, "key long, node long, root long, most long, trait struct<size: int, sim: long, low: long, high: long>, load string")
    found = [(r.a, r.b) for r in line_dedup._in_crowds(line_dedup.Kept(spark), crowds).collect()]
    near = lambda a, b: abs(len(texts[a]) - len(texts[b])) <= max(len(texts[a]), len(texts[b])) // 10
    met = lambda a, b: any((a + k) % 4 and (b + k) % 4 for k in (7, 8, 9))
    assert sorted(found) == [(a, b) for a in range(len(texts)) for b in range(max(a + 1, 8), len(texts)) if near(a, b) and met(a, b)]
    assert {(n, n + 10) for n in range(40, 50)} <= set(found)


def test_segments_are_shuffled_part_by_part(spark, monkeypatch):
    """Each crowded key's segments are in one part, and a part is written before the next one begins."""
    rows = [(key, 10 * key + n, 10 * key + n, 10 * key, (40, n, 1, 0), f"{key:03d} {'ab cd ef gh ' * 3}") for key in range(40) for n in range(3)]
    crowds = spark.createDataFrame(rows, "key long, node long, root long, most long, trait struct<size: int, sim: long, low: long, high: long>, load string")
    kept, parts, before, share = line_dedup.Kept(spark), [], [], line_dedup._sharing_segments

    def watched(part):
        parts.append({r.key for r in part.collect()})
        return share(part)

    write = kept.write
    monkeypatch.setattr(line_dedup, "_sharing_segments", watched)
    monkeypatch.setattr(kept, "write", lambda df, *a: before.append(df.count()) or write(df, *a))
    found = {(r.a, r.b) for r in line_dedup._in_crowds(kept, crowds).collect()}
    assert found == {(10 * k + a, 10 * k + b) for k in range(40) for a in range(3) for b in range(a + 1, 3)}
    assert sum(map(len, parts)) == len(set().union(*parts)) == 40 and max(map(len, parts)) < 20
    assert sorted(before) == sorted([*[3 * len(p) for p in parts], 0])


def test_letters_part_lines_of_any_length_but_no_edited_ones(spark):
    """Counts of letters leave out pairs before texts are compared, and never one within the edits that are allowed."""
    draw = random.Random(8)
    rows, n = [], 0
    for size in (12, 45, 150, 700, 3000):
        for _ in range(12):
            own = "".join(draw.choice(draw.choice(["aaaaab", "etaoin ", "xyzé漢"])) for _ in range(size))
            x = list(own)
            for at in draw.sample(range(size), size // 10):
                x[at] = draw.choice(["", "q", x[at] + "z", " ", "漢"])
            rows += [(n, own, "".join(x), True), (n + 1, own, "".join(draw.choice("etaoin") if c in "ab" else c for c in own), False)]
            n += 2
    df = spark.createDataFrame(rows, "n long, x string, y string, near boolean")
    one, two = ({"size": F.length(c), **dict(zip(("letters", "others"), line_dedup._letters(F.col(c), F.length(c)), strict=True))} for c in "xy")
    got = df.select("near", line_dedup._letters_allow(one, two).alias("may"), line_dedup._alike(F.col("x"), F.col("y")).alias("alike")).collect()
    assert all(r.may for r in got if r.alike) and sum(r.alike for r in got) >= 60
    far = [r.may for r in got if not r.near and not r.alike]
    assert sum(far) < len(far) / 2  # of 3,000 characters, counts run full


def test_long_lines_of_other_letters_are_not_paired(spark):
    """In a crowded key, lines as long as each other but of other letters are no candidates."""
    texts = [c * 300 for c in "etaoin"] + ["e" * 290 + "x" * 10]
    rows = [(7, n, n, 0, x) for n, x in enumerate(texts)]
    lines = spark.createDataFrame(rows, "key long, node long, root long, most long, load string")
    traits = line_dedup.fingerprints(lines.select("node", F.length("load").alias("size"), F.col("load").alias("norm"))).groupBy("node").agg(F.first("letters").alias("letters"), F.first("others").alias("others"))
    zero = F.lit(0).cast("long")
    crowds = lines.join(traits, "node").withColumn("trait", F.struct(F.length("load").alias("size"), zero.alias("sim"), zero.alias("low"), zero.alias("high"), "letters", "others"))
    assert [(r.a, r.b) for r in line_dedup._in_crowds(line_dedup.Kept(spark), crowds).collect()] == [(0, 6)]


def test_features_are_made_once_and_letters_only_where_asked_for(spark):
    """Filters that the optimizer adds must not make a line's features again; counts of letters are for lines that share a key."""
    lines = spark.createDataFrame([(0, 40, "ab cd ef gh " * 3 + "last"), (1, 0, "")], "node long, size int, norm string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    every = line_dedup.fingerprints(lines)
    assert plan(every).count("array_distinct(") == 1 and "octet_length(" in plan(every)
    assert "octet_length(" not in plan(every.drop("letters", "others"))
    assert [(r.node, r.letters & 255, bool(r.keys)) for r in every.collect()] == [(0, 12, True)]


def test_only_lines_that_share_a_key_are_asked_for_more_traits(spark):
    """Two of many lines share a key: traits that tell pairs apart are made of these alone, and all pairs are tested by them."""
    kept, asked = line_dedup.Kept(spark), []
    keyed = spark.createDataFrame([(n // 2 if n < 4 else n, n, (n % 2,)) for n in range(40)], "key long, node long, trait struct<odd: int>")

    def shared(members):
        asked.append({r.node for r in members.collect()})
        return members.select("key", "node", "head", F.struct("trait.*", (F.col("node") < 2).alias("low")).alias("trait"))

    roots = line_dedup.resolve(kept, keyed, lambda one, two: one["low"] & two["low"], lambda pairs: pairs, lambda nodes: nodes.withColumn("load", F.lit("")), shared=shared, crowd=32, in_crowds=lambda crowds: crowds.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    assert sorted(tuple(r) for r in roots.collect()) == [(0, 0), (1, 0)]
    assert asked == [{0, 1, 2, 3}]


def test_bits_tell_which_lines_are_wanted(spark):
    """Line numbers far apart, at the edges of words and pages, and repeated ones."""
    draw = random.Random(2)
    numbers = [0, 1, 62, 63, 64, 4095, 4096, 8191, *[(p << 33) + n for p in (1, 7, 900) for n in (0, 63, 4095, 4096, 70_000)], *[draw.randrange(9_000) for _ in range(300)]]
    every = sorted({*numbers, *[n + 1 for n in numbers], *range(9_000)})
    nodes = spark.createDataFrame([(n,) for n in numbers + numbers[:20]], "node long")
    pages = line_dedup._pages(nodes)
    got = line_dedup._on_pages(spark.createDataFrame([(n, str(n)) for n in every], "node long, load string"), pages)
    assert sorted(r.node for r in got.collect()) == sorted(set(numbers)) and got.columns == ["node", "load"]
    assert pages.count() == len({n >> 12 for n in numbers})


def test_texts_and_traits_of_lines_are_not_moved_to_find_partners(spark, monkeypatch):
    """However many lines share a key, their texts stay where they lie; keys meet without traits, which only lines with a partner get."""
    draw = random.Random(6)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(60)) for _ in range(8)]
    docs = cases.documents(spark, [t for x in texts for t in (x, x[:30] + "7" + x[31:])]).coalesce(2)
    plans, write = [], line_dedup.Kept.write
    monkeypatch.setattr(line_dedup, "FEW", 5)
    monkeypatch.setattr(line_dedup.Kept, "write", lambda kept, df, *a: plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())) or write(kept, df, *a))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sum(len(r.dropped) for r in line_dedup.decide(docs).collect()) == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    letters = [p for _, p in plans if "octet_length(" in p]
    assert letters and all("BroadcastHashJoin" in p for p in letters)
    assert ["key", "node", "head"] in [c for c, _ in plans]


def test_small_keys_are_compared_in_one_round_and_keys_of_two_in_none(spark):
    """After the heads, small keys cost one exchange for all pairs across their groups; two nodes of a key are checked as its head and the other."""
    draw = random.Random(12)
    kept, asked = line_dedup.Kept(spark), []
    group = {n: draw.choice([n, n % 7, n % 7]) for n in range(400)}  # those of a group are links
    rows = [(key, n, (n % 3,)) for key, size in enumerate([2] * 30 + [3, 4, 5, 9, 20, 60] * 6) for n in draw.sample(range(400), size)]
    keyed = spark.createDataFrame(rows, "key long, node long, trait struct<kind: int>")
    same = spark.createDataFrame(list(group.items()), "node long, g long")

    def links(pairs):
        asked.append({(r.a, r.b) for r in pairs.collect()})
        return pairs.join(same.select(F.col("node").alias("a"), F.col("g").alias("x")), "a").join(same.select(F.col("node").alias("b"), F.col("g").alias("y")), "b").filter("x = y").select("a", "b")

    def found(rows, **more):
        asked.clear()
        loads = lambda nodes: nodes.withColumn("load", F.lit(""))
        roots = line_dedup.resolve(kept, keyed.filter(F.col("key").isin(sorted({k for k, _, _ in rows}))), lambda one, two: one["kind"] == two["kind"], links, loads, in_crowds=lambda crowds: crowds.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0), **more)
        return {r.node: r.root for r in roots.collect()}

    def want(rows, crowd):
        """Groups by all pairs of each key that may be links; of large keys, of any kind."""
        keys, root = {}, {n: n for n in group}
        for k, n, _ in rows:
            keys.setdefault(k, []).append(n)
        pairs = [(a, b) for nodes in keys.values() for a in nodes for b in nodes if a < b and group[a] == group[b] and (a % 3 == b % 3 or len(nodes) > crowd)]
        for _ in range(50):
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return {n: root[n] for pair in pairs for n in pair}

    assert found(rows, crowd=32, direct=128, wide=lambda one, two: F.lit(True)) == want(rows, 32)
    assert len(asked) == 2 and not asked[0] & asked[1]
    two = rows[:60]
    assert found(two) == want(two, 32) and len(asked) == 1
