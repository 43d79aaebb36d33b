"""Every registered query, over small tables with nulls, empties, repeats, long texts and other columns."""

import random

import numpy as np
import pytest

from pagewright.llm import registry

from . import cases
from .test_scans import passage


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('tables')}"
    draw = random.Random(4)
    texts = [f"{passage(i)} {'idiot moron' if i % 4 == 0 else 'lovely'} {passage(100 + i)}\nshared line {i % 3} of words here" for i in range(60)]
    texts += [texts[1], texts[2] + " more", f"{passage(900)} {passage(7000)}", "mit license\nmail a@b.co token = abcdef123456"]
    docs = cases.documents(spark, texts, 100).unionByName(cases.awkward(spark))
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, int(i % 4 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, passage(7000)), (2, None), (None, passage(7001))], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    vectors = [(i, [draw.gauss(0, 1) for _ in range(8)], 0) for i in range(120)] + [(200, None, 1), (None, [0.0] * 8, 1), (50, [float("nan")] * 8, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at, docs.count()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_over_awkward_tables(spark, tables, name):
    at, n = tables
    rows = registry.QUERIES[name](spark, at).collect()
    if name.startswith("op10"):
        assert len(rows) == 3 * 5 and {r.query_id for r in rows} == {0, 50, 100}
    elif name.startswith("op2"):
        assert {r.doc_id for r in rows} == {None, *range(1, 8), *range(100, 164)}
    else:
        assert len(rows) == n
        assert sorted({r.doc_id for r in rows if r.doc_id is not None}) == [*range(1, 8), *range(100, 164)]
    if name.startswith("op5"):
        assert [r.doc_id for r in rows if r.contaminated] == [162]
    if name.startswith("op3"):
        assert {r.doc_id: r.component_id for r in rows}[160] == 101
    if name.startswith("op8"):
        assert sum(r.n_dropped for r in rows) >= 57


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_over_empty_tables(spark, tables, tmp_path, name):
    at, _ = tables
    for table in ("documents", "labels", "benchmark", "embeddings"):
        spark.read.parquet(f"{at}/{table}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{table}.parquet")
    assert registry.QUERIES[name](spark, f"file://{tmp_path}").count() == 0


def test_pipeline_over_awkward_and_empty_tables(spark, tables, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    at, _ = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    kept = docs
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, at)
        assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 162 not in ids and 160 not in ids and {1, 2, 3, 101, 103} <= set(ids)
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{at}/{table}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{table}.parquet")
    assert pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_vectors_of_whole_numbers_are_floors():
    assert np.floor(256 * np.float32(-0.001)) == -1
