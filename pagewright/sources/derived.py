"""Pages, words, lines and blocks with geometry, derived from plain texts.

A line of text is a paragraph; twelve words are a visual row; every fourth paragraph is followed by two empty rows;
22 rows are a page. Geometry is in thousandths of the page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.functions import ids, text

ROW_WORDS, PAGE_ROWS = 12, 22
MARGIN, ROW_PITCH, GLYPH, HEIGHT = 50, 40, 8, 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def meta(docs: DataFrame) -> DataFrame:
    """Of each document: its file, case, kind, date, and id."""
    case = F.concat(F.lit("26-7"), F.lpad(F.substr("source", F.lit(4)), 5, "0"))
    out = docs.select(
        "doc_id",
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("source_file_name"),
        case.alias("case_ref"),
        F.upper("lang").alias("correspondence_type"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("doc_id") % 365).cast("int"))).alias("received_date"),
    )
    out = out.withColumn("source_file_s3_uri", F.concat(F.lit("s3://cases/"), F.col("case_ref"), F.lit("/"), F.col("source_file_name")))
    return out.withColumn("source_doc_id", ids.uuid5(ids.key_of(F.col("source_file_name"), F.col("correspondence_type"), F.col("case_ref"))))


def rows(docs: DataFrame) -> DataFrame:
    """doc_id, p (paragraph), row (of the document), page_num, row_no (of the page), words (at most 12).

    One exchange by document numbers the rows; whatever is grouped by document or page after it needs no other.
    """
    paragraphs = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).select("doc_id", "p", text.words(F.col("line")).alias("words"))
    paragraphs = paragraphs.withColumn("used", F.ceil(F.size("words") / ROW_WORDS).cast("int") + F.when(F.col("p") % 4 == 3, 2).otherwise(0))
    before = Window.partitionBy("doc_id").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    placed = paragraphs.withColumn("first", F.coalesce(F.sum("used").over(before), F.lit(0)).cast("int")).filter(F.size("words") > 0)
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("words") - 1) / ROW_WORDS).cast("int")), lambda r: F.slice("words", r * ROW_WORDS + 1, F.lit(ROW_WORDS)))
    out = placed.select("doc_id", "p", "first", F.posexplode(cut).alias("r", "words"))
    row = F.col("first") + F.col("r")
    return out.select("doc_id", "p", row.alias("row"), (F.floor(row / PAGE_ROWS) + 1).cast("int").alias("page_num"), (row % PAGE_ROWS).alias("row_no"), "words")


def pages(docs: DataFrame) -> DataFrame:
    """doc_id, page_num, words: the page's words in reading order, each with its place, box and kind."""
    by_page = rows(docs).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("row_no", "row", "p", "words"))).alias("rows"))

    def word(r, x, c):
        left = F.lit(MARGIN) + GLYPH * (F.aggregate(F.slice(r["words"], F.lit(1), c), F.lit(0), lambda a, w: a + F.length(w)) + c)
        top = MARGIN + ROW_PITCH * r["row_no"]
        hand = (F.col("doc_id") * 31 + r["row"] * 7 + c) % 997 == 0
        return F.struct(
            r["row_no"].alias("row_no"), c.alias("col_no"), r["p"].alias("p"), r["row"].alias("row"), x.alias("text"), left.alias("left"), top.alias("top"),
            (left + GLYPH * F.length(x)).alias("right"), (top + HEIGHT).alias("bottom"), F.when(hand, "HANDWRITING").otherwise("PRINTED").alias("text_type"), text.ends_sentence(x).alias("ends"),
        )

    return by_page.select("doc_id", "page_num", F.flatten(F.transform("rows", lambda r: F.transform(r["words"], lambda x, c: word(r, x, c)))).alias("words"))


def words(docs: DataFrame) -> DataFrame:
    return pages(docs).select("doc_id", "page_num", F.posexplode("words").alias("word_pos", "w")).select("doc_id", "page_num", "word_pos", "w.*")


def lines(docs: DataFrame) -> DataFrame:
    """Visual rows as lines, and on every page a footer with its number; line_pos is the reading order."""
    own = rows(docs)
    body = own.select(
        "doc_id", "page_num", "p", "row_no", F.array_join("words", " ").alias("text"), F.lit(MARGIN).alias("left"), (MARGIN + ROW_PITCH * F.col("row_no")).alias("top"),
        (MARGIN + GLYPH * (F.aggregate("words", F.lit(0), lambda a, w: a + F.length(w)) + F.size("words") - 1)).alias("right"), F.size("words").alias("n_words"), (F.lit(90) + F.col("p") % 10).cast("double").alias("confidence"),
    )
    footer = own.select("doc_id", "page_num").distinct().select(
        "doc_id", "page_num", F.lit(-1).alias("p"), F.lit(PAGE_ROWS + 1).alias("row_no"), F.concat(F.lit("Page "), F.col("page_num").cast("string")).alias("text"), F.lit(MARGIN).alias("left"), F.lit(960).alias("top"),
        (MARGIN + GLYPH * (5 + F.length(F.col("page_num").cast("string")))).alias("right"), F.lit(2).alias("n_words"), F.lit(99.0).alias("confidence"),
    )
    out = body.unionByName(footer).withColumn("bottom", F.col("top") + HEIGHT)
    return out.withColumn("line_pos", F.row_number().over(Window.partitionBy("doc_id", "page_num").orderBy("top", "row_no")) - 1)


def layout_blocks(docs: DataFrame) -> DataFrame:
    """Paragraphs, or their part on a page, as blocks; every fifth paragraph is of the same type."""
    kind = F.element_at(F.array(*[F.lit(f"LAYOUT_{k}") for k in ("SECTION_HEADER", "TEXT", "TEXT", "LIST", "TABLE")]), (F.col("p") % 5 + 1).cast("int"))
    return lines(docs).filter("p >= 0").groupBy("doc_id", "page_num", "p").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.min("left").alias("left"), F.min("top").alias("top"), F.max("right").alias("right"), F.max("bottom").alias("bottom"),
        F.max("confidence").alias("confidence"), F.count("*").alias("n_lines"),
    ).withColumn("layout_type", kind)


def terms(benchmark: DataFrame) -> DataFrame:
    """Search terms: of each item's words of over three letters the first two, and the next three as acceptable ones.

    query_id, search_term, acceptable_terms (comma list), case_ref.
    """
    own = benchmark.select(F.col("item_id").alias("query_id"), F.filter(text.tokens(F.col("text")), lambda x: F.length(x) > 3).alias("w"))
    case = F.concat(F.lit("26-7"), F.lpad((F.col("query_id") % 20).cast("string"), 5, "0"))
    return own.select("query_id", F.array_join(F.slice("w", 1, 2), " ").alias("search_term"), F.array_join(F.slice("w", 3, 3), ", ").alias("acceptable_terms"), case.alias("case_ref"))
