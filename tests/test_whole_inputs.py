"""Queries over whole inputs: nothing is cut off, left out or fixed in number."""

import random
import time

from pyspark.sql import functions as F

from pagewright.plans import catalog, nearest, retrieval

DATA = "/root/testdata/sf0.001"


def test_key_values_keep_whole_texts(spark):
    own = catalog.key_value_chunks_whole(spark, DATA).join(catalog.read(spark, DATA, "conversations").select("conv_id", "turn", "text"), ["conv_id", "turn"])
    assert own.filter("length(trim(text)) > 60").count() > 0
    assert own.filter("NOT endswith(chunk_text, trim(text))").count() == 0


def test_every_order_has_its_dates(spark):
    assert catalog.dates_for_search_all(spark, DATA).filter("variants <> ''").count() == catalog.read(spark, DATA, "orders").count()


def test_every_vector_is_a_query(spark):
    assert catalog.knn_topk_all(spark, DATA).select("query_id").distinct().count() == catalog.read(spark, DATA, "embeddings").filter("embedding IS NOT NULL").select("vec_id").distinct().count()


def test_every_order_asks_for_its_date(spark):
    found = catalog.date_clause_all(spark, DATA)
    assert found.filter("query_id = doc_id").count() == catalog.read(spark, DATA, "orders").count()


def test_no_dates_are_sent_to_every_task(spark):
    """Before dates are written out the planner sees few bytes, so that it would broadcast many rows."""
    plan = catalog.date_clause_all(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_texts_that_repeat_in_a_case_are_read_once_and_all_found(spark):
    terms = spark.createDataFrame([(1, 0, "seen 2 March 2020"), (2, 0, "seen 2 March 2020"), (3, 1, "on 02/03/2020 and 5 May 2021"), (4, 1, "no date")], "query_id long, case_ref long, search_term string")
    chunks = spark.createDataFrame([(10, 0, "Paid 2 Mar 2020."), (11, 0, "Paid 2 Mar 2020."), (12, 1, "Paid 2 Mar 2020."), (13, 1, "both 5-May-2021, 2020-03-02"), (14, 1, None), (15, 0, "2 Mar 2021")], "chunk_id long, case_ref long, chunk_text string")
    found = [tuple(r) for r in retrieval.date_clause(chunks, terms).collect()]
    assert sorted(found) == [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12), (3, 13)]


def test_blocks_of_vectors_give_what_pairs_give(spark, monkeypatch):
    """Ties, copies, null and short vectors, null scopes and ids, more rows than a block, with no pair as a row."""
    draw = random.Random(4)
    rows = [(i, i % 3, [draw.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, 0, [1.0, 0.5, 0.5, 1.0, 1.0, 2.0]) for i in range(80)]
    rows += [(400, 1, None), (401, 1, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (402, 1, [1.0, 2.0]), (403, None, [1.0] * 6), (404, 4, [1.0] * 6), (405, 4, None), (406, 2, [float("nan")] * 6), (None, 2, [1.0] * 6)]
    rows += [(500 + i, 5, [draw.gauss(0, 1) for _ in range(6)]) for i in range(700)]
    e = retrieval.unit(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"))
    queries = e.select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("vector"))
    monkeypatch.setattr(nearest, "QUERIES", 64)
    own = nearest.knn_every(queries, e, "label", "vec_id")
    assert "Join" not in own._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    found, want = (sorted(map(str, df.collect())) for df in (own, retrieval.knn(queries, e, "label", "vec_id")))
    assert found == want


def test_every_vector_is_compared_in_blocks(spark):
    assert "MapInArrow" in catalog.knn_topk_all(spark, DATA)._jdf.queryExecution().executedPlan().toString()


def test_a_vector_has_its_length_made_once(spark):
    own = spark.createDataFrame([(1, [3.0, 4.0]), (2, None), (3, [1.0, None])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.embedding for r in retrieval.unit(own).collect()} == {1: [0.6, 0.8], 2: None, 3: [None, None]}
    inside = spark.createDataFrame([(1, [1.0] * 20_000)], "vec_id long, embedding array<float>")
    start = time.time()
    assert retrieval.unit(inside).select(F.size("embedding")).first()[0] == 20_000
    assert retrieval.unit(inside).select(F.element_at("embedding", 20_000)).first()[0] < 0.01
    assert time.time() - start < 20
