"""Every query against its SQL on the smallest data; those without SQL give rows and keep their invariants."""

import duckdb
import pytest

from pagewright.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    made = duckdb.connect()
    made.execute("SET TimeZone='UTC'")
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return made


def plain(value):
    if isinstance(value, float):
        return round(value, 5)
    return value


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, sql, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = sql.execute(catalog.SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_gives_rows(spark, name):
    df = catalog.QUERIES[name](spark, DATA)
    assert df.limit(1).count() == 1 or name in ("match_stemmed",)


def test_entry():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_stream_equals_batch(spark):
    from pyspark.sql import functions as F

    stream = {tuple(r) for r in catalog.stream_ingest(spark, DATA).select("case_ref", "n_chunks").collect()}
    batch = {tuple(r) for r in catalog.chunks(spark, DATA).groupBy("case_ref").agg(F.count("*").alias("n_chunks")).collect()}
    assert stream == batch


def test_line_chunks_lose_no_word(spark):
    from pyspark.sql import functions as F

    own = catalog.line_sentence_chunks(spark, DATA)
    assert own.agg(F.sum("n_words")).first()[0] == catalog.lines_without_footers(spark, DATA).select(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert own.groupBy("doc_id", "page_num").agg((F.max("chunk_index") + 1 == F.count("*")).alias("ok")).filter("NOT ok").count() == 0
