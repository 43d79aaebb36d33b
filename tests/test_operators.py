"""Operators on small inputs."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from pagewright import config
from pagewright.functions import dates, ids, text
from pagewright.operators import matching, segment, sinks
from pagewright.plans import evaluate, retrieval
from pagewright.sources import derived, ocr_json


def rows_of(spec, height=32, pitch=40):
    """Words by row: a list of lists of texts; None skips a row."""
    out = []
    for row, words in enumerate(spec):
        for w in words or []:
            out.append({"top": 50 + pitch * row, "bottom": 50 + pitch * row + height, "ends": w[-1] in ".?!", "text": w})
    return out


def parts(words, starts):
    return [" ".join(w["text"] for w in words[a:b]) for a, b in zip(starts, [*starts[1:], len(words)], strict=True)]


def settings(low, high, ahead=3, back=6, gap=0.05):
    return config.WordStream(low, high, gap, ahead, back)


WORDS = "n int, words array<struct<top:int,bottom:int,ends:boolean,text:string>>"


def word_starts(spark, pages, made):
    df = spark.createDataFrame([(n, [(w["top"], w["bottom"], w["ends"], w["text"]) for w in p]) for n, p in enumerate(pages)], WORDS)
    got = {r.n: list(r.s) for r in df.select("n", segment.word_stream_starts(F.col("words"), made).alias("s")).collect()}
    return [got[n] for n in range(len(pages))]


def test_word_stream_cases(spark):
    one = lambda spec, made: parts(spec, word_starts(spark, [spec], made)[0])
    assert one(rows_of(["One two three. Four five six seven.".split()]), settings(3, 6)) == ["One two three.", "Four five six seven."]
    assert one(rows_of(["a b c d. e f".split()]), settings(3, 6)) == ["a b c d.", "e f"]  # up to the next sentence end
    assert one(rows_of(["a b. c d e f g h".split()]), settings(3, 4, 1)) == ["a b.", "c d e f", "g h"]  # cut back, then full
    assert one(rows_of(["a b".split(), None, None, "c d. e".split()]), settings(3, 6)) == ["a b", "c d. e"]  # a gap
    assert one(rows_of(["a b c".split(), None, None, "d. e".split()]), settings(3, 6)) == ["a b c", "d. e"]  # a gap before the end
    assert word_starts(spark, [[]], settings(3, 6)) == [[]]


def plain_starts(words, made):
    """Chunk by chunk: the nearest of the gap, the sentence end and the full size decides."""
    out, start, asked, n = [], 0, 0, len(words)
    far = lambda i: words[i]["top"] - words[i - 1]["bottom"] > round(made.max_vertical_gap * 1000)
    while start < n:
        out.append(start)
        gap = next((i for i in range(max(asked, start + 1), n) if far(i)), n)
        end = next((i for i in range(max(asked, start + made.min_words - 1), n) if words[i]["ends"]), n)
        full = start + made.max_words - 1
        if gap <= min(end, full):
            start = asked = gap
        elif end <= full:
            start = asked = end + 1
        else:
            back = [i for i in range(max(start, full - made.backward_words + 1), min(full, n)) if words[i]["ends"]] if full < n else []
            start, asked = (back[-1] + 1 if back else full + 1), full + 1
    return out


def test_word_stream_equals_plain_search(spark):
    draw = random.Random(11)
    pages = []
    for _ in range(60):
        spec = [[draw.choice(["a", "b", "c."]) if draw.random() < 0.3 else "w" for _ in range(12)] if draw.random() > 0.15 else None for _ in range(30)]
        pages.append(rows_of(spec))
    for made in (config.WordStream(), config.WordStream(8, 12, 0.05, 8, 10), settings(3, 6), settings(4, 5, 2, 4), settings(2, 30, 0, 29)):
        assert word_starts(spark, pages, made) == [plain_starts(p, made) for p in pages]
    assert not config.WordStream(8, 12, 0.05, 8, 10).closed_form and config.WordStream().closed_form


def test_general_settings_keep_every_word(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}{'.' if i % 7 == 0 else ''}" for i in range(300)), "en", "src1", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    out = segment.word_stream(docs, config.WordStream(8, 12, 0.05, 8, 10)).orderBy("page_num", "chunk_index").collect()
    assert " ".join(r.chunk_text for r in out) == docs.first().text and max(r.n_words for r in out) <= 12


def line(words, row, ends=False):
    return {"n_words": words, "top": 50 + 40 * row, "bottom": 82 + 40 * row, "ends": ends}


def test_line_sentences(spark):
    kind = "n int, rows array<struct<n_words:int,top:int,bottom:int,ends:boolean>>"

    def walk(rows, low=5, high=10):
        df = spark.createDataFrame([(0, [(r["n_words"], r["top"], r["bottom"], r["ends"]) for r in rows])], kind)
        at = list(df.select(segment.line_sentence_starts(F.col("rows"), config.LineSentence(low, high)).alias("s")).first().s)
        return [list(range(a, b)) for a, b in zip(at, [*at[1:], len(rows)], strict=False)]

    assert walk([line(3, 0), line(3, 1, True), line(3, 2)]) == [[0, 1], [2]]
    assert walk([line(5, 0), line(3, 1, True), line(3, 2)]) == [[0, 1], [2]]  # up to the next sentence end
    assert walk([line(3, 0, True), line(4, 1), line(9, 2, True)]) == [[0], [1, 2]]  # cut back, then full
    assert walk([line(3, 0), line(3, 9), line(3, 10)]) == [[0], [1, 2]]  # a gap
    assert walk([line(3, 0), line(12, 9, True), line(3, 10)]) == [[0], [1, 2]]  # a line after a gap doesn't close
    assert walk([line(5, 0), line(2, 20), line(1, 40, True), line(1, 41)]) == [[0, 1, 2], [3]]  # no gap within what is taken
    assert walk([line(4, 0, True), line(1, 1), line(4, 2), line(9, 3)]) == [[0], [1, 2, 3]]
    assert walk([]) == []


def test_strategies(spark):
    docs = spark.createDataFrame([(1, "A line of text.\n- item one\n", "en", "src1", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for name in (" Layout ", "textractor-word-stream", "linear-sentence-splitter"):
        assert segment.chunk(docs, name).count() >= 1
    with pytest.raises(ValueError):
        segment.chunk(docs, "unknown")


def test_merger_limits(spark):
    def chunk(i, words, top, page=1):
        return (1, page, i, " ".join(["w"] * words), 50, top, 100, top + 32, f"T{i}", 99.0 - i)

    rows = [chunk(0, 50, 50), chunk(1, 30, 90), chunk(2, 1, 130), chunk(3, 5, 800), chunk(4, 90, 840), chunk(0, 3, 50, 2)]
    df = spark.createDataFrame(rows, "doc_id long, page_num int, chunk_index int, chunk_text string, left int, top int, right int, bottom int, chunk_type string, confidence double")
    got = [(r.page_num, r.chunk_index, len(r.chunk_text.split()), r.chunk_type) for r in segment.merge(df).orderBy("page_num", "chunk_index").collect()]
    assert got == [(1, 0, 80, "T0"), (1, 1, 1, "T2"), (1, 2, 5, "T3"), (1, 3, 90, "T4"), (2, 0, 3, "T0")]


def cells(spark, rows):
    return spark.createDataFrame([(1, 1, 4, *r) for r in rows], "doc_id long, page_num int, p int, row_no int, cell int, text string, left int, top int, right int, bottom int")


def test_tables(spark):
    grid = cells(spark, [(0, 0, "A", 100, 100, 200, 120), (0, 1, "B", 400, 104, 500, 124), (1, 0, "C", 100, 200, 200, 220), (1, 1, "D", 400, 200, 500, 220)])
    assert [r.chunk_text for r in segment.visual_rows(grid).orderBy("part_no").collect()] == ["A B", "C D"]
    assert [r.chunk_text for r in segment.line_table(grid).collect()] == ["A B\nC D"]
    long = config.Layout(line_chunk_chars=5)
    assert [r.chunk_text for r in segment.line_table(grid, long).orderBy("part_no").collect()] == ["A B", "C D"]
    flat = cells(spark, [(0, 0, "A", 100, 100, 200, 100), (0, 1, "B", 400, 100, 500, 100)])
    assert segment.visual_rows(flat).count() == 2  # no heights: a row for each
    same = cells(spark, [(0, 0, "x", 1, 1, 2, 2), (0, 1, "x", 3, 1, 4, 2), (0, 2, " ", 5, 1, 9, 2), (1, 0, "", 1, 3, 2, 4)])
    got = segment.cell_rows(same).collect()
    assert [(r.chunk_text, r.right) for r in got] == [("x", 9)]


def test_ids_equal_uuid5(spark):
    df = spark.createDataFrame([(" File.PDF ", "TC19", "25-111111", 5, None), ("é", "", "x", None, None), ("a", "b", "c", 1, 0)], "f string, t string, c string, p int, i int")
    got = df.select(ids.uuid5(ids.key_of(F.col("f"), F.col("t"), F.col("c"), F.col("p"), F.col("i"))).alias("u")).collect()
    keys = ["file.pdf-tc19-25-111111-5", "é--x", "a-b-c-1-0"]
    assert [r.u for r in got] == [str(uuid.uuid5(uuid.UUID(config.NAMESPACE), k)) for k in keys]


def test_text_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(text.occurrences(F.lit("Aa aAa"), F.lit("aa"))) == 2 and get(text.occurrences(F.lit("x"), F.lit(""))) == 0
    assert [get(text.safe_int(F.lit(v))) for v in ("7", " 12 ", "-", "", "x")] == [7, 12, 0, 0, 0]
    assert get(text.tokens(F.lit("Café élan_2 x!"))) == ["café", "élan_2", "x"]
    assert get(text.listed(F.lit(" a, ,b ,"))) == ["a", "b"]
    assert get(text.ends_sentence(F.lit("end.  "))) and not get(text.ends_sentence(F.lit("a,")))


def test_dates(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(dates.extracted(F.lit("on 25 May 2021, May 2021 and 03/04/2020"))) == ["03/04/2020", "25 May 2021"]
    assert get(dates.extracted(F.lit("no date, version 1.2"))) == []
    assert get(dates.is_date(F.lit("1st Sept 2018"))) and not get(dates.is_date(F.lit("Sept 2018")))
    ways = get(dates.variants(F.lit("1st Sept 2018")))
    assert {"1/9/2018", "01-09-2018", "2018-09-01", "1st September 2018", "1-Sept-2018", "1 Sep 2018", "1st Sept 2018"} <= set(ways) and len(ways) == 14
    assert get(dates.variants(F.lit("May 2021"))) == ["May 2021"]
    assert "2020-04-03" in get(dates.for_search(F.lit("paid 3/4/2020"))) and get(dates.variants(F.lit("31/02/2020"))) == ["31/02/2020"]


def test_stemmer():
    want = {"running": "run", "caresses": "caress", "ponies": "poni", "ties": "tie", "cries": "cri", "agreed": "agre", "hopping": "hop", "hoping": "hope", "generously": "generous", "national": "nation", "relational": "relat", "conditional": "condit", "happy": "happi", "skis": "ski", "dying": "die", "news": "news", "proceed": "proceed", "knightly": "knight", "consolation": "consol", "communication": "communic", "injuries": "injuri", "injury": "injuri", "assessments": "assess", "assessment": "assess", "by": "by", "say": "say"}
    assert {w: matching.stem(w) for w in want} == want


def test_fuzzy():
    assert matching.ratio("abc", "abc") == 100 and matching.ratio("", "") == 100 and matching.ratio("abc", "xyz") == 0
    assert round(matching.ratio("kitten", "sitting"), 2) == 61.54
    assert matching.partial_ratio("psycho", "the psycholog") == 100
    assert matching.fuzzy_match("neuro-psychologist", "saw a neuro psychologist today")
    assert matching.fuzzy_match("assessment", "an assesment was made") and not matching.fuzzy_match("the of", "the of")
    assert not matching.fuzzy_match("one", "two three")


def test_exact_and_any(spark):
    one = spark.createDataFrame([("the heart attack", "A Heart-beat"), ("the of", "the of"), ("", "x"), ("art", "heart")], "t string, b string")
    got = one.select(matching.exact(F.col("t"), F.col("b")).alias("e"), matching.wildcard(F.col("t"), F.col("b")).alias("w"), matching.any_method(F.col("t"), F.col("b"), ["semantic_only"]).alias("s")).collect()
    assert [(r.e, r.w, r.s) for r in got] == [(True, False, False), (False, True, False), (False, True, False), (False, True, False)]


def test_stems_meet(spark):
    t = spark.createDataFrame([(1, "c", "the injuries")], "query_id long, case_ref string, search_term string")
    b = spark.createDataFrame([("x", "c", "An injury."), ("y", "c", "the"), ("z", "d", "injury")], "chunk_id string, case_ref string, chunk_text string")
    assert [r.chunk_id for r in matching.stemmed(t, b).collect()] == ["x"]


def test_precision_and_recall(spark):
    cases = [("a, b", "a, c", 50.0, 50.0, "b"), ("a", "", 0.0, 0.0, "a"), ("", "a", 0.0, None, ""), ("", "", 100.0, 100.0, ""), (None, None, 100.0, 100.0, ""), (" a ,, b", "b,a", 100.0, 100.0, ""), ("a,b,c", "a", 100.0, 33.33, "b, c")]
    df = spark.createDataFrame([c[:2] for c in cases], "expected_chunk_id string, all_chunk_ids string")
    got = [(r.precision, r.recall, r.missing_chunk_ids) for r in evaluate.chunk_match(df).collect()]
    assert got == [c[2:] for c in cases]


def test_adaptive_filter(spark):
    hits = spark.createDataFrame([(1, f"c{i}", s, i + 1) for i, s in enumerate([10.0, 5.0, 2.0, 0.5])] + [(2, "x", 0.1, 1)], "query_id long, chunk_id string, score double, rank int")
    run = lambda **k: [(r.chunk_id, r.result_type) for r in retrieval.adaptive(hits, config.Search(**k)).orderBy("query_id", "rank").collect()]
    assert run(score_filter=6, semantic_filter=1, min_before_fallback=2, max_semantic=1) == [("c0", "hybrid"), ("c1", "Semantic Fallback")]
    assert run(score_filter=4, semantic_filter=1, min_before_fallback=2) == [("c0", "hybrid"), ("c1", "hybrid")]
    assert run(score_filter=20, semantic_filter=20) == []


def test_hybrid_needs_a_clause(spark):
    some = spark.createDataFrame([(1, "a", 1.0)], "query_id long, chunk_id string, score double")
    with pytest.raises(ValueError):
        retrieval.hybrid(some, some, None, config.Search(lexical_boost=0, neural_boost=0))
    with pytest.raises(ValueError):
        retrieval.hybrid(some, some, None, search_type="other")
    both = retrieval.hybrid(some, some, some.select("query_id", "chunk_id")).collect()
    assert [(r.score, r["rank"]) for r in both] == [(28.0, 1)]


def test_two_phases_never_get_worse(spark):
    clauses = spark.createDataFrame([(q, f"c{i}", float((i * 7 + q) % 5), float((i * 3) % 4) / 4) for q in range(3) for i in range(30)], "query_id long, chunk_id string, lexical double, neural double")
    wanted = spark.createDataFrame([(q, f"c{i}") for q in range(3) for i in range(0, 30, 4)], "query_id long, chunk_id string")
    best = {r.phase: r.score for r in evaluate.two_phase(spark, clauses, wanted).groupBy("phase").agg(F.max("score").alias("score")).collect()}
    assert best[2] >= best[1] > 0


def test_loading_replaces_documents(spark, tmp_path):
    path = f"file://{tmp_path}/chunks"
    make = lambda rows: spark.createDataFrame(rows, "source_doc_id string, chunk_id string, x int")
    sinks.write_documents(make([("d1", "a", 1), ("d1", "b", 1), ("d2", "c", 1)]), path)
    for _ in range(2):
        sinks.write_documents(make([("d1", "a", 2)]), path)
    assert sorted((r.source_doc_id, r.chunk_id, r.x) for r in spark.read.parquet(path).collect()) == [("d1", "a", 2), ("d2", "c", 1)]
    sinks.write_documents(make([]), path)
    assert spark.read.parquet(path).count() == 2


def test_quarantine_and_causes(spark):
    df = spark.createDataFrame([(1, "x"), (2, ""), (3, None)], "i int, t string")
    assert [r.error for r in sinks.quarantine(df, {"empty": F.col("t") == ""}).orderBy("i").collect()] == [None, "empty", "empty"]
    errors = spark.createDataFrame([("429", "busy")] * 3 + [(None, "x")] * 2 + [("400", "a"), ("400", "b")], "status string, type string")
    assert sinks.top_causes(errors, ["status", "type"]).first().summary == "3x(status=429, type=busy); 2x(status=unknown, type=x); 1x(status=400, type=a)"


def test_ocr_responses(spark, tmp_path):
    block = {"Id": "l1", "BlockType": "LINE", "Text": "Hello", "TextType": "PRINTED", "Confidence": 99.0, "Page": 1, "Geometry": {"BoundingBox": {"Width": 0.1, "Height": 0.02, "Left": 0.05, "Top": 0.1}}}
    page = {"Id": "p1", "BlockType": "PAGE", "Relationships": [{"Type": "CHILD", "Ids": ["l1", "l2"]}, {"Type": "OTHER", "Ids": ["z"]}]}
    for name, status, pages in (("a", "SUCCEEDED", 1), ("b", "FAILED", 1), ("c", "SUCCEEDED", 0)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"JobStatus": status, "DocumentMetadata": {"Pages": pages}, "Blocks": [page, block]}, indent=1))
    good, bad = ocr_json.accepted(ocr_json.read(spark, f"file://{tmp_path}"))
    assert sorted(r.error for r in bad.collect()) == ["job status FAILED", "no pages"]
    assert [(r.block_type, r.text, r.left) for r in ocr_json.blocks(good).orderBy("block_pos").collect()] == [("PAGE", None, None), ("LINE", "Hello", 0.05)]
    assert [(r.parent_id, r.ordinal, r.child_id) for r in ocr_json.links(good).orderBy("ordinal").collect()] == [("p1", 0, "l1"), ("p1", 1, "l2")]


def test_settings_are_checked():
    for bad in (lambda: config.WordStream(100, 50), lambda: config.WordStream(0), lambda: config.Layout(y_tolerance=2), lambda: config.OcrJob(5, 5), lambda: config.Search(size=0), lambda: config.LineSentence(80, 120, -1), lambda: config.page_numbers([0])):
        with pytest.raises(ValueError):
            bad()


def test_derived_geometry(spark):
    docs = spark.createDataFrame([(997, " ".join(["word"] * 13) + "\n\nlast.", "en", "src3", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.row_no, r.col_no, r.left, r.top, r.text_type) for r in derived.words(docs).orderBy("word_pos").collect()]
    assert got[0] == (0, 0, 50, 50, "HANDWRITING") and got[1][:4] == (0, 1, 90, 50) and got[12][:3] == (1, 0, 50) and got[13][:2] == (2, 0)
    assert derived.meta(docs).first().case_ref == "26-700003"
