"""Expected chunks of date terms, and by stems."""

from pagewright.plans import evaluate


def test_dates_and_stems(spark):
    terms = spark.createDataFrame([(1, "c", " 12 May 2021 "), (2, "c", "runs fast"), (3, "c", "  ")], "query_id long, case_ref string, search_term string")
    bodies = {"a": "12 people in May", "b": "On 12 May 2021 it", "d": "on 12/05/2021.", "e": "He was running", "f": "Breakfast, truns", "g": "run2 \u00e9run"}
    chunks = spark.createDataFrame([(k, "c", v) for k, v in bodies.items()] + [("z", "other", "12 May 2021 runs")], "chunk_id string, case_ref string, chunk_text string")

    def met(**options):
        return sorted(tuple(r) for r in evaluate.expected_chunks(terms, chunks, **options).collect())

    assert met() == [(1, "b"), (2, "f")]
    assert met(use_date_variants=True) == [(1, "b"), (1, "d"), (2, "f")]
    assert met(use_stemming=True) == [(1, "b"), (2, "e")]
    assert met(use_date_variants=True, use_stemming=True) == [(1, "b"), (1, "d"), (2, "e")]
