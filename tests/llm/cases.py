"""Small tables that every operator must take: nulls, empties, repeats, long texts, other columns."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, start long, score double"


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", f"src{i % 3}", len(t or ""), 7, 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark):
    """A null id, null and empty texts, blanks only, a repeated row, a very long word and a very long text."""
    long_text = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [(None, "some text without an id", None, None, None, None, None), (1, None, "en", "a", 0, 1, 0.1), (2, "", "en", None, 0, 1, 0.1), (3, " \n\t \n", None, "a", 4, 1, 0.1)]
    rows += [(4, "a row that is there twice", "en", "b", 25, 1, 0.1)] * 2
    rows += [(5, "x" * 60_000, "en", "b", 60_000, 1, 0.1), (6, long_text, "en", "b", len(long_text), 1, 0.1), (7, "naïve \U0001f600 \x0b ÿ", "fr", "c", 12, 1, 0.1)]
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
