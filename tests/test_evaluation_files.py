"""Files around an evaluation, written and read again; and the score that sweeps are judged by."""

import json

from pyspark.sql import functions as F

from pagewright.operators import segment
from pagewright.plans import evaluate, retrieval
from pagewright.sources import evaluation_files as files


def test_terms_are_cleaned(spark, tmp_path):
    (tmp_path / "terms.csv").write_text('search_term,acceptable associated terms,manual identifications,chunking_strategy,chunks_generated_with_stemming\n"  a, b ",x ,3,layout,True\nc,,,,\n')
    rows, said = files.read_terms(spark, f"file://{tmp_path}/terms.csv")
    assert rows.columns[:3] == ["search_term", "acceptable_terms", "manual_identifications"]
    assert said == {"chunks_generated_with_stemming": True, "chunking_strategy": "layout"}
    assert [r.manual_identifications for r in rows.collect()] == ["3", ""]


def test_expected_chunks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", "y, z"), (1, 'a "q"', "")], "n int, search_term string, expected_chunk_id string")
    files.write_expected_chunks(rows, f"file://{tmp_path}/out", "n", use_stemming=True, strategy="layout")
    back, said = files.read_terms(spark, f"file://{tmp_path}/out")
    assert said == {"chunks_generated_with_date_variants": False, "chunks_generated_with_stemming": True, "chunking_strategy": "layout"}
    assert [(r.n, r.search_term, r.expected_chunk_id, r.chunking_strategy) for r in back.collect()] == [("1", 'a "q"', "", "layout"), ("2", "b", "y, z", "")]


def test_runs_and_their_log(spark, tmp_path):
    config = spark.createDataFrame([("hybrid", 2, 20.0, "now")], "search_type string, fuzziness int, boost double, timestamp string")
    summary = spark.createDataFrame([(3, 1.5, 2)], "total_queries int, score double, queries_with_expected_chunk int")
    files.write_run(spark.range(4), config, summary, f"file://{tmp_path}/run")
    assert spark.read.csv(f"file://{tmp_path}/run/results", header=True).count() == 4
    for _ in range(2):
        files.append_log(config, summary, f"file://{tmp_path}/log")
    log = spark.read.csv(f"file://{tmp_path}/log", header=True)
    assert log.columns == ["timestamp", "search_type", "boost", "total_queries", "score"] and log.count() == 2


def test_sweeps(spark, tmp_path):
    trials = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 1.25, 2.5, 3.14159), (2, 2.5, 0.0, 3.14159)], "trial long, a double, b double, score double")
    files.write_sweep(trials, ["a", "b"], f"file://{tmp_path}/sweep", "s", "t1")
    summary = spark.read.json(f"file://{tmp_path}/sweep/t1/summary").first()
    assert (summary.n_trials, summary.best_trial_number, summary.best_score, summary.best_params.b) == (3, 1, 3.1416, 2.5)
    history = [json.loads(line) for part in sorted((tmp_path / "sweep/t1/trial_history").glob("part-*")) for line in part.read_text().splitlines()]
    assert [h["value"] for h in sorted(history, key=lambda h: h["number"])] == [None, 3.1416, 3.1416]
    assert spark.read.json(f"file://{tmp_path}/sweep/latest").first().timestamp == "t1"


def test_objective(spark):
    clauses = spark.createDataFrame([(1, "x", True, 1.0, 0.0), (1, "y", False, 0.5, 0.0), (2, "x", False, 0.0, 2.0)], "query_id long, chunk_id string, has boolean, a double, b double")
    grid = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0)], "trial long, a double, b double")
    got = {r.trial: r.score for r in evaluate.objective(clauses, grid, ["a", "b"], F.lit(4)).collect()}
    assert got == {0: evaluate.PENALTY, 1: 2 / 4 * 0.25, 2: 0.0, 3: 0.0312}


def test_objective_sorts_a_trial_at_a_time(spark):
    """No row is multiplied by the grid before the best of a trial are known."""
    kind = "query_id long, chunk_id string, has boolean, a double, b double"
    clauses = spark.createDataFrame([(q, f"{n:03}", n % 3 == 0, n / 100, (n * 7 % 50) / 50) for q in range(3) for n in range(60)] + [(9, "null", True, None, 1.0)], kind)
    grid = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0)], "trial long, a double, b double")
    found = evaluate.objective(clauses, grid, ["a", "b"], F.lit(4), k=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = {0: evaluate.PENALTY}
    for trial, a, b in [(1, 1.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0)]:
        best = sorted(((-round(n / 100 * a + (n * 7 % 50) / 50 * b, 5), f"{n:03}", n % 3 == 0) for n in range(60)))[:5]
        share = sum(h for _, _, h in best) / 5
        want[trial] = round((15 if share else 0) / 4 * share**2, 4)
    assert {r.trial: r.score for r in found.collect()} == want
    assert evaluate.objective(clauses, grid.limit(0), ["a", "b"], F.lit(4)).count() == 0


def test_terms_are_embedded_once(spark):
    terms = spark.createDataFrame([(1, "c", "some words"), (2, "c", "some words"), (3, "c", "other")], "query_id long, case_ref string, search_term string")
    got = {r.query_id: list(r.vector) for r in retrieval.embedded_terms(terms).collect()}
    assert got[1] == got[2] != got[3] and len(got[1]) == 64


def test_recovered_lines_join_the_table(spark):
    kind = "doc_id long, page_num int, p int, text string, left int, top int, right int, bottom int"
    blocks = spark.createDataFrame([(1, 1, 4, "a", 50, 50, 60, 82), (1, 1, 4, "c", 50, 130, 60, 162)], kind)
    lost = spark.createDataFrame([(1, 1, 4, "b", 50, 90, 60, 122)], kind)
    assert [r.chunk_text for r in segment.line_table(blocks, recovered=lost).collect()] == ["a\nb\nc"]
    assert [r.chunk_text for r in segment.line_table(blocks).collect()] == ["a\nc"]
