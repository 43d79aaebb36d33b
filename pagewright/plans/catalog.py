"""Every query by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.config import Search
from pagewright.functions import dates, geometry, ids, text
from pagewright.operators import matching, segment, sinks
from pagewright.plans import evaluate, nearest, retrieval
from pagewright.plans.base_sql import DOC_KEY, STOP, sql, uuid5
from pagewright.sources import derived
from pagewright.sources.derived import read
from pagewright.sources.staging import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None, *needs: str):
    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            SQL[name] = sql(oracle, *needs)
        return f

    return add


def docs(spark, d) -> DataFrame:
    return read(spark, d, "documents")


def about(spark, d) -> DataFrame:
    return derived.meta(docs(spark, d))


def chunks(spark, d) -> DataFrame:
    return segment.with_ids(segment.word_stream(docs(spark, d)), docs(spark, d))


def terms(spark, d) -> DataFrame:
    return derived.terms(read(spark, d, "benchmark"))


def searched(spark, d) -> tuple[DataFrame, DataFrame]:
    """Chunks and terms for searches, whose clauses all read them: written once."""
    return staged(chunks(spark, d).select("chunk_id", "doc_id", "page_num", "chunk_index", "case_ref", "chunk_text")), staged(terms(spark, d))


BOX_SQL = '("right" - "left")/1000.0 AS width, (bottom - top)/1000.0 AS height, "left"/1000.0 AS "left", top/1000.0 AS top, "right"/1000.0 AS "right", bottom/1000.0 AS bottom'


def boxed(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *geometry.box(*(F.col(c) for c in ("left", "top", "right", "bottom"))))


# Sources -------------------------------------------------------------------------------------------------------


@query("uri_remap", "SELECT doc_id, regexp_replace(source_file_s3_uri, '^s3://[^/]+', 's3://other-bucket') AS uri FROM meta", "meta")
def uri_remap(spark, d):
    return about(spark, d).select("doc_id", F.regexp_replace("source_file_s3_uri", "^s3://[^/]+", "s3://other-bucket").alias("uri"))


@query("uri_parts", "SELECT page_id, regexp_extract(url, '^([a-z0-9]+)://', 1) AS scheme, regexp_extract(url, '^[a-z0-9]+://([^/]+)', 1) AS bucket, regexp_extract(url, '^[a-z0-9]+://[^/]+/(.*)$', 1) AS key FROM pages")
def uri_parts(spark, d):
    part = lambda p: F.regexp_extract("url", p, 1)
    return read(spark, d, "pages").select("page_id", part("^([a-z0-9]+)://").alias("scheme"), part("^[a-z0-9]+://([^/]+)").alias("bucket"), part("^[a-z0-9]+://[^/]+/(.*)$").alias("key"))


@query("search_terms_clean", "SELECT query_id, trim(search_term) AS search_term, trim(coalesce(acceptable_terms, '')) AS acceptable_terms, query_id % 2 = 0 AS use_dates FROM st", "st")
def search_terms_clean(spark, d):
    """All columns as strings, trimmed, nulls as '', and a flag that is written as text."""
    raw = terms(spark, d).select("query_id", F.concat(F.lit(" "), "search_term", F.lit("  ")).alias("search_term"), "acceptable_terms", F.when(F.col("query_id") % 2 == 0, "true").otherwise("FALSE").alias("use_dates"))
    clean = raw.select("query_id", *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("search_term", "acceptable_terms", "use_dates")])
    return clean.withColumn("use_dates", F.lower("use_dates") == "true")


@query("chunks_by_case", "SELECT chunk_id, coalesce(chunk_text, '') AS chunk_text, page_num AS page_number FROM c WHERE case_ref = '26-700003'", "c")
def chunks_by_case(spark, d):
    return chunks(spark, d).filter("case_ref = '26-700003'").select("chunk_id", F.coalesce("chunk_text", F.lit("")).alias("chunk_text"), F.col("page_num").alias("page_number"))


@query("chunk_count_by_case", "SELECT case_ref, count(*) AS n_chunks FROM c GROUP BY case_ref", "c")
def chunk_count_by_case(spark, d):
    return chunks(spark, d).groupBy("case_ref").agg(F.count("*").alias("n_chunks"))


@query("page_words", f"SELECT doc_id, page_num, word_pos, text, text_type, {BOX_SQL} FROM w", "w")
def page_words(spark, d):
    return boxed(derived.words(docs(spark, d)), "doc_id", "page_num", "word_pos", "text", "text_type")


@query("page_lines", f"SELECT doc_id, page_num, line_pos, text, confidence, {BOX_SQL} FROM ln", "ln")
def page_lines(spark, d):
    return boxed(derived.lines(docs(spark, d)), "doc_id", "page_num", "line_pos", "text", "confidence")


@query("ocr_flatten_blocks")
def ocr_flatten_blocks(spark, d):
    from pagewright.sources import ocr_json

    return ocr_json.blocks(ocr_json.sample(derived.lines(docs(spark, d))))


@query("stream_ingest")
def stream_ingest(spark, d):
    from pagewright.streaming.ingest import ingest_available

    return ingest_available(spark, f"{d}/documents.parquet")


# Sinks ---------------------------------------------------------------------------------------------------------


@query("upsert_by_document", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT c_custkey, c_name||'-new', c_nationkey, c_acctbal + 1, c_mktsegment FROM customer WHERE c_custkey % 7 = 0")
def upsert_by_document(spark, d):
    target = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    batch = target.filter("c_custkey % 7 = 0").withColumn("c_name", F.concat("c_name", F.lit("-new"))).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    once = sinks.upsert_documents(target, batch, "c_custkey")
    return sinks.upsert_documents(once, batch, "c_custkey")  # again: the same


@query("dedupe_by_chunk_id", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def dedupe_by_chunk_id(spark, d):
    return sinks.last_by_id(read(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", F.col("event_id"))


@query("delete_by_document", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def delete_by_document(spark, d):
    gone = read(spark, d, "orders").filter("o_orderpriority LIKE '1%'").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.delete_documents(read(spark, d, "customer").select("c_custkey", "c_name"), gone, "c_custkey")


_CAUSES = "SELECT coalesce(event_type, 'unknown') AS type, CAST(user_id % 3 AS VARCHAR) AS status, count(*) AS n FROM events GROUP BY ALL ORDER BY n DESC, status, type LIMIT 3"


@query("error_top_causes", f"SELECT string_agg(n||'x(status='||status||', type='||type||')', '; ' ORDER BY n DESC, status, type) AS summary FROM ({_CAUSES})")
def error_top_causes(spark, d):
    return sinks.top_causes(read(spark, d, "events").select((F.col("user_id") % 3).cast("string").alias("status"), F.col("event_type").alias("type")), ["status", "type"])


@query("quarantine_split", "SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'no text' WHEN n_chars < 100 THEN 'too short' END AS error FROM documents")
def quarantine_split(spark, d):
    return sinks.quarantine(docs(spark, d), {"no text": F.coalesce("text", F.lit("")) == "", "too short": F.col("n_chars") < 100}).select("doc_id", "error")


@query("page_image_uris", "SELECT m.doc_id, page_num, case_ref||'/'||source_doc_id||'/pages/'||page_num||'.png' AS key, 's3://images/'||case_ref||'/'||source_doc_id||'/pages/'||page_num||'.png' AS uri FROM hand JOIN meta m USING (doc_id)", "hand", "meta")
def page_image_uris(spark, d):
    own = derived.rows(docs(spark, d)).select("doc_id", "page_num").distinct().join(about(spark, d), "doc_id")
    key = F.concat_ws("/", "case_ref", "source_doc_id", F.lit("pages"), F.concat(F.col("page_num").cast("string"), F.lit(".png")))
    return own.select("doc_id", "page_num", key.alias("key"), F.concat(F.lit("s3://images/"), key).alias("uri"))


# Checks --------------------------------------------------------------------------------------------------------

_VALID = r"^s3://cases/\d{2}-[78]\d{5}/"


@query("valid_source_uris", rf"SELECT doc_id, regexp_matches(uri, '{_VALID}') AS valid FROM (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN replace(source_file_s3_uri, '26-7', '26-9') ELSE source_file_s3_uri END AS uri FROM meta)", "meta")
def valid_source_uris(spark, d):
    uri = F.when(F.col("doc_id") % 11 == 0, F.replace("source_file_s3_uri", F.lit("26-7"), F.lit("26-9"))).otherwise(F.col("source_file_s3_uri"))
    return about(spark, d).select("doc_id", uri.rlike(_VALID).alias("valid"))


@query("case_ref_from_uri", "SELECT page_id, coalesce(string_split(replace(url, 'https://', ''), '/')[2], '') AS segment FROM pages")
def case_ref_from_uri(spark, d):
    return read(spark, d, "pages").select("page_id", F.coalesce(F.get(F.split(F.replace("url", F.lit("https://"), F.lit("")), "/"), F.lit(1)), F.lit("")).alias("segment"))


@query("metadata_violations", "SELECT doc_id, lang IS NULL OR lang = '' AS no_kind, coalesce(n_chars, 0) <= 0 AS no_length, source IS NULL OR length(source) < 5 AS short_source FROM documents")
def metadata_violations(spark, d):
    return docs(spark, d).select("doc_id", (F.col("lang").isNull() | (F.col("lang") == "")).alias("no_kind"), (F.coalesce("n_chars", F.lit(0)) <= 0).alias("no_length"), (F.col("source").isNull() | (F.length("source") < 5)).alias("short_source"))


@query("docs_without_pages", "SELECT c_custkey AS doc_id FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM vrow)", "vrow")
def docs_without_pages(spark, d):
    return read(spark, d, "customer").select(F.col("c_custkey").alias("doc_id")).join(derived.rows(docs(spark, d)).select("doc_id").distinct(), "doc_id", "left_anti")


@query("lines_without_footers", "SELECT doc_id, page_num, line_pos, text FROM lnf", "lnf")
def lines_without_footers(spark, d):
    return segment.usable_lines(docs(spark, d)).select("doc_id", "page_num", "line_pos", "text")


@query("layout_blocks_kept", f"SELECT doc_id, page_num, p, layout_type, text, confidence, {BOX_SQL} FROM lb WHERE layout_type IN ('LAYOUT_TEXT', 'LAYOUT_LIST', 'LAYOUT_TABLE') AND trim(text) <> ''", "lb")
def layout_blocks_kept(spark, d):
    own = derived.layout_blocks(docs(spark, d)).filter(F.col("layout_type").isin("LAYOUT_TEXT", "LAYOUT_LIST", "LAYOUT_TABLE") & (F.trim("text") != ""))
    return boxed(own, "doc_id", "page_num", "p", "layout_type", "text", "confidence")


@query("page_handwriting", "SELECT doc_id, page_num, page_contains_handwriting FROM hand", "hand")
def page_handwriting(spark, d):
    return derived.pages(docs(spark, d)).select("doc_id", "page_num", F.exists("words", lambda w: w["text_type"] == "HANDWRITING").alias("page_contains_handwriting"))


@query("chunk_text_consistency", "SELECT (SELECT count(*) FROM hand) AS n_pages, count(*) AS n_violations FROM (SELECT doc_id, page_num, string_agg(text, ' ' ORDER BY word_pos) AS page_text FROM w GROUP BY ALL) JOIN (SELECT doc_id, page_num, string_agg(chunk_text, ' ' ORDER BY chunk_index) AS joined FROM c0 GROUP BY ALL) USING (doc_id, page_num) WHERE page_text <> joined", "w", "c0", "hand")
def chunk_text_consistency(spark, d):
    own = derived.pages(docs(spark, d)).select("doc_id", "page_num", F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("page_text"))
    joined = segment.word_stream(docs(spark, d)).groupBy("doc_id", "page_num").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_text"))), lambda x: x["chunk_text"]), " ").alias("joined"))
    both = own.join(joined, ["doc_id", "page_num"], "left")
    return both.agg(F.count("*").alias("n_pages"), F.count_if(text.normalized(F.col("page_text")) != F.coalesce("joined", F.lit(""))).alias("n_violations"))


@query("page_count_mismatch", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.n AS ocr_pages, b.n AS images FROM (SELECT doc_id, count(*) AS n FROM hand GROUP BY doc_id) a FULL JOIN (SELECT doc_id, CAST(1 + n_chars // 1700 AS BIGINT) AS n FROM documents) b ON a.doc_id = b.doc_id WHERE coalesce(a.n, 0) <> coalesce(b.n, 0) OR coalesce(a.n, 0) = 0", "hand")
def page_count_mismatch(spark, d):
    ocr = derived.rows(docs(spark, d)).select("doc_id", "page_num").distinct().groupBy("doc_id").agg(F.count("*").alias("ocr_pages"))
    images = docs(spark, d).select("doc_id", (1 + F.floor(F.col("n_chars") / 1700)).cast("long").alias("images"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return ocr.join(images, "doc_id", "full").filter((zero("ocr_pages") != zero("images")) | (zero("ocr_pages") == 0))


# Scalars -------------------------------------------------------------------------------------------------------


@query("document_uuids", "SELECT doc_id, source_doc_id FROM meta", "meta")
def document_uuids(spark, d):
    return about(spark, d).select("doc_id", "source_doc_id")


@query("page_uuids", f"SELECT doc_id, page_num, {uuid5(DOC_KEY + repr('-').join(['||', '||page_num']))} AS page_id FROM hand JOIN meta USING (doc_id)", "hand", "meta")
def page_uuids(spark, d):
    own = derived.rows(docs(spark, d)).select("doc_id", "page_num").distinct().join(about(spark, d), "doc_id")
    return own.select("doc_id", "page_num", ids.uuid5(ids.key_of(F.col("source_file_name"), F.col("correspondence_type"), F.col("case_ref"), F.col("page_num"))).alias("page_id"))


@query("chunk_uuids", "SELECT doc_id, page_num, chunk_index, chunk_id FROM c", "c")
def chunk_uuids(spark, d):
    return chunks(spark, d).select("doc_id", "page_num", "chunk_index", "chunk_id")


@query("chunk_counts", r"SELECT doc_id, page_num, chunk_index, length(chunk_text) AS character_count, len(list_filter(regexp_split_to_array(chunk_text, '[ \t\r\n]+'), lambda x: x <> '')) AS word_count FROM c0", "c0")
def chunk_counts(spark, d):
    return segment.word_stream(docs(spark, d)).select("doc_id", "page_num", "chunk_index", F.length("chunk_text").alias("character_count"), text.word_count(F.col("chunk_text")).alias("word_count"))


@query("bbox_edges", 'SELECT doc_id, page_num, line_pos, ("left" + ("right" - "left"))/1000.0 AS right_edge, (top + 32)/1000.0 AS bottom_edge, (top + 16)/1000.0 AS center_y FROM ln', "ln")
def bbox_edges(spark, d):
    right, bottom, center = geometry.edges(F.col("left"), F.col("top"), F.col("right") - F.col("left"), F.col("bottom") - F.col("top"))
    return derived.lines(docs(spark, d)).select("doc_id", "page_num", "line_pos", (right / 1000.0).alias("right_edge"), (bottom / 1000.0).alias("bottom_edge"), (center / 1000.0).alias("center_y"))


@query("normalized_words", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS normalized FROM documents")
def normalized_words(spark, d):
    return docs(spark, d).select("doc_id", text.normalized(F.col("text")).alias("normalized"))


@query("sentence_ends", "SELECT doc_id, page_num, word_pos FROM w WHERE ends", "w")
def sentence_ends(spark, d):
    return derived.words(docs(spark, d)).filter(text.ends_sentence(F.col("text"))).select("doc_id", "page_num", "word_pos")


@query("vertical_gaps", "SELECT doc_id, page_num, word_pos, top - lag(bottom) OVER (PARTITION BY doc_id, page_num ORDER BY word_pos) AS gap, coalesce(top - lag(bottom) OVER (PARTITION BY doc_id, page_num ORDER BY word_pos) > 50, false) AS breaks FROM w", "w")
def vertical_gaps(spark, d):
    order = Window.partitionBy("doc_id", "page_num").orderBy("word_pos")
    own = derived.words(docs(spark, d)).withColumn("gap", F.col("top") - F.lag("bottom").over(order))
    return own.select("doc_id", "page_num", "word_pos", "gap", F.coalesce(F.col("gap") > 50, F.lit(False)).alias("breaks"))


@query("key_value_chunks", "SELECT conv_id, turn, CASE WHEN kind = 'KEY_VALUE' THEN key||': '||value ELSE value END AS chunk_text FROM (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'KEY_VALUE' WHEN 1 THEN 'LINE' ELSE 'OTHER' END AS kind, trim(regexp_replace(trim(coalesce(role, '')), ':+$', '')) AS key, trim(coalesce(substr(text, 1, 60), '')) AS value FROM conversations) WHERE kind IN ('KEY_VALUE', 'LINE') AND value <> '' AND (kind = 'LINE' OR key <> '')")
def key_value_chunks(spark, d):
    own = read(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, "KEY_VALUE").when(F.col("turn") % 3 == 1, "LINE").otherwise("OTHER").alias("kind"), F.array(F.concat("role", F.lit(":"))).alias("key_words"), F.substring("text", 1, 60).alias("value"))
    return segment.key_values(own)


@query("key_value_chunks_whole", "SELECT conv_id, turn, CASE WHEN kind = 'KEY_VALUE' THEN key||': '||value ELSE value END AS chunk_text FROM (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'KEY_VALUE' WHEN 1 THEN 'LINE' ELSE 'OTHER' END AS kind, trim(regexp_replace(trim(coalesce(role, '')), ':+$', '')) AS key, trim(coalesce(text, '')) AS value FROM conversations) WHERE kind IN ('KEY_VALUE', 'LINE') AND value <> '' AND (kind = 'LINE' OR key <> '')")
def key_value_chunks_whole(spark, d):
    """As key_value_chunks, over whole texts."""
    own = read(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, "KEY_VALUE").when(F.col("turn") % 3 == 1, "LINE").otherwise("OTHER").alias("kind"), F.array(F.concat("role", F.lit(":"))).alias("key_words"), F.col("text").alias("value"))
    return segment.key_values(own)


@query("page_metadata", "SELECT m.source_doc_id, h.page_num, count(*) OVER (PARTITION BY doc_id) AS page_count, m.case_ref, m.received_date, m.correspondence_type, pt.page_text FROM hand h JOIN meta m USING (doc_id) JOIN (SELECT doc_id, page_num, string_agg(text, ' ' ORDER BY word_pos) AS page_text FROM w GROUP BY ALL) pt USING (doc_id, page_num)", "hand", "meta", "w")
def page_metadata(spark, d):
    own = derived.pages(docs(spark, d)).select("doc_id", "page_num", F.array_join(F.transform("words", lambda w: w["text"]), " ").alias("page_text"))
    own = own.withColumn("page_count", F.count("*").over(Window.partitionBy("doc_id")))
    return own.join(about(spark, d), "doc_id").select("source_doc_id", "page_num", "page_count", "case_ref", "received_date", "correspondence_type", "page_text")


@query("safe_int_cast", "SELECT event_id, raw, coalesce(CASE WHEN regexp_matches(trim(raw), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(raw) AS INTEGER) END, 0) AS number FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN CAST(event_id AS VARCHAR) WHEN 3 THEN '3.7' ELSE event_type END AS raw FROM events)")
def safe_int_cast(spark, d):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, "-").when(k == 1, "").when(k == 2, F.col("event_id").cast("string")).when(k == 3, "3.7").otherwise(F.col("event_type"))
    whole = F.when(F.trim("raw").rlike("^[+-]?[0-9]+$"), F.col("raw"))
    return read(spark, d, "events").select("event_id", raw.alias("raw")).select("event_id", "raw", text.safe_int(whole).alias("number"))


@query("term_frequency", "SELECT query_id, chunk_id, n FROM tf", "tf")
def term_frequency(spark, d):
    c, t = searched(spark, d)
    own = _hits(spark, d, c, t).join(c.select("chunk_id", "chunk_text"), "chunk_id").join(t.select("query_id", "search_term"), "query_id")
    return own.select("query_id", "chunk_id", text.occurrences(F.col("chunk_text"), F.col("search_term")).alias("n"))


@query("resolve_search_type", "SELECT event_id, coalesce(CASE WHEN lower(trim(raw)) IN ('hybrid', 'hybrid-dates', 'keyword', 'keyword-dates', 'semantic') THEN lower(trim(raw)) END, CASE WHEN flag IN ('hybrid', 'hybrid-dates', 'keyword', 'keyword-dates', 'semantic') THEN flag END, 'hybrid-dates') AS search_type FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' Hybrid ' WHEN 1 THEN 'SEMANTIC' WHEN 2 THEN '' ELSE event_type END AS raw, CASE WHEN event_id % 3 = 0 THEN 'keyword' ELSE 'none' END AS flag FROM events)")
def resolve_search_type(spark, d):
    k = F.col("event_id") % 4
    own = read(spark, d, "events").select("event_id", F.when(k == 0, " Hybrid ").when(k == 1, "SEMANTIC").when(k == 2, "").otherwise(F.col("event_type")).alias("raw"), F.when(F.col("event_id") % 3 == 0, "keyword").otherwise("none").alias("flag"))
    asked = F.lower(F.trim("raw"))
    return own.select("event_id", F.coalesce(F.when(asked.isin(*retrieval.TYPES), asked), F.when(F.col("flag").isin(*retrieval.TYPES), F.col("flag")), F.lit("hybrid-dates")).alias("search_type"))


@query("active_methods", "SELECT s_suppkey, array_to_string(m, ',') AS methods, CASE WHEN len(m) = 1 THEN m[1] ELSE 'hybrid' END AS label FROM (SELECT s_suppkey, CASE WHEN len(m0) = 0 THEN ['exact'] ELSE m0 END AS m FROM (SELECT s_suppkey, list_filter([CASE WHEN s_suppkey % 2 = 0 THEN 'exact' END, CASE WHEN s_suppkey % 3 = 0 THEN 'wildcard' END, CASE WHEN s_suppkey % 5 = 0 THEN 'stemmed' END, CASE WHEN s_suppkey % 7 = 0 THEN 'fuzzy' END, CASE WHEN s_suppkey % 11 = 0 THEN 'semantic_only' END], lambda x: x IS NOT NULL) AS m0 FROM supplier))")
def active_methods(spark, d):
    weights = dict(zip(("exact", "wildcard", "stemmed", "fuzzy", "semantic_only"), (2, 3, 5, 7, 11), strict=True))
    found = F.array_compact(F.array(*[F.when(F.col("s_suppkey") % n == 0, F.lit(m)) for m, n in weights.items()]))
    own = read(spark, d, "supplier").select("s_suppkey", F.when(F.size(found) == 0, F.array(F.lit("exact"))).otherwise(found).alias("m"))
    return own.select("s_suppkey", F.array_join("m", ",").alias("methods"), F.when(F.size("m") == 1, F.get("m", F.lit(0))).otherwise("hybrid").alias("label"))


# Segmentation --------------------------------------------------------------------------------------------------


@query("word_stream_chunks", f"SELECT chunk_id, doc_id, page_num, chunk_index, chunk_text, n_words, page_contains_handwriting, {BOX_SQL} FROM c", "c")
def word_stream_chunks(spark, d):
    return boxed(chunks(spark, d), "chunk_id", "doc_id", "page_num", "chunk_index", "chunk_text", "n_words", "page_contains_handwriting")


@query("line_sentence_chunks")
def line_sentence_chunks(spark, d):
    return boxed(segment.line_sentences(docs(spark, d)), "doc_id", "page_num", "chunk_index", "chunk_text", "n_words")


@query("layout_text_chunks", f"SELECT doc_id, page_num, p, part_no, chunk_text, confidence, {BOX_SQL} FROM ltc", "ltc")
def layout_text_chunks(spark, d):
    return boxed(segment.layout_text(docs(spark, d)), "doc_id", "page_num", "p", "part_no", "chunk_text", "confidence")


@query("list_chunks", f"SELECT doc_id, page_num, p, part_no, chunk_text, confidence, {BOX_SQL} FROM lic", "lic")
def list_chunks(spark, d):
    return boxed(segment.list_items(docs(spark, d)), "doc_id", "page_num", "p", "part_no", "chunk_text", "confidence")


@query("table_dispatch", "SELECT doc_id, page_num, p, CASE WHEN n_lines > 3 THEN 'line_table' ELSE 'cell_table' END AS chunker FROM lb WHERE layout_type = 'LAYOUT_TABLE'", "lb")
def table_dispatch(spark, d):
    """By the kind of the first child: here blocks of over three lines are tables of lines, others of cells."""
    own = derived.layout_blocks(docs(spark, d)).filter("layout_type = 'LAYOUT_TABLE'").withColumn("children", F.array(F.when(F.col("n_lines") > 3, "LINE").otherwise("TABLE")))
    first = F.get("children", F.lit(0))
    return own.select("doc_id", "page_num", "p", F.when(first == "LINE", "line_table").when(first == "TABLE", "cell_table").otherwise(F.raise_error(F.lit("a table without known children"))).alias("chunker"))


@query("visual_rows", f"SELECT doc_id, page_num, p, part_no, chunk_text, {BOX_SQL} FROM vrc", "vrc")
def visual_rows(spark, d):
    return boxed(segment.visual_rows(segment.table_lines(docs(spark, d))), "doc_id", "page_num", "p", "part_no", "chunk_text")


@query("line_table_chunks", f"SELECT doc_id, page_num, p, part_no, chunk_text, {BOX_SQL} FROM ltb", "ltb")
def line_table_chunks(spark, d):
    return boxed(segment.line_table(segment.table_lines(docs(spark, d))), "doc_id", "page_num", "p", "part_no", "chunk_text")


@query("cell_table_rows", f"""SELECT doc_id, page_num, p, row_no, chunk_text, {BOX_SQL} FROM (SELECT doc_id, page_num, p, row_no, string_agg(text, ' ' ORDER BY cell) FILTER (WHERE k = 1 AND trim(text) <> '') AS chunk_text, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_num, p, row_no, text ORDER BY cell) AS k FROM cell) GROUP BY ALL) WHERE chunk_text IS NOT NULL""", "cell")
def cell_table_rows(spark, d):
    return boxed(segment.cell_rows(segment.table_lines(docs(spark, d))), "doc_id", "page_num", "p", "row_no", "chunk_text")


@query("missed_lines", "SELECT doc_id, page_num, p, row_no, text FROM ln WHERE p % 5 = 4 AND (doc_id + page_num + row_no) % 4 = 0 AND trim(text) <> ''", "ln")
def missed_lines(spark, d):
    own = derived.lines(docs(spark, d)).filter("p >= 0 AND p % 5 = 4").withColumn("parent_id", F.concat_ws("-", "page_num", "p")).withColumn("child_id", F.concat_ws("-", "page_num", "row_no"))
    edges = own.select("doc_id", "parent_id", "child_id")
    actual = own.filter("(doc_id + page_num + row_no) % 4 <> 0").select("doc_id", "parent_id", "child_id")
    blocks = own.select("doc_id", "child_id", "page_num", "p", "row_no", "text", (F.col("right") - F.col("left")).alias("width"), (F.col("bottom") - F.col("top")).alias("height"))
    return segment.missed_lines(edges, actual, blocks).select("doc_id", "page_num", "p", "row_no", "text")


@query("layout_atomic_chunks", f"SELECT doc_id, page_num, chunk_index, chunk_type, chunk_text, confidence, {BOX_SQL} FROM atc", "atc")
def layout_atomic_chunks(spark, d):
    return boxed(segment.atomic(docs(spark, d)), "doc_id", "page_num", "chunk_index", "chunk_type", "chunk_text", "confidence")


@query("merged_chunks", f"""SELECT doc_id, page_num, part_no AS chunk_index, chunk_type, chunk_text, confidence, {BOX_SQL} FROM (SELECT doc_id, page_num, mg.part_no, first(chunk_type ORDER BY chunk_index) AS chunk_type, first(confidence ORDER BY chunk_index) AS confidence, string_agg(chunk_text, ' ' ORDER BY chunk_index) AS chunk_text, min("left") AS "left", min(a.top) AS top, max("right") AS "right", max(a.bottom) AS bottom FROM mg JOIN atc a USING (doc_id, page_num, chunk_index) GROUP BY doc_id, page_num, mg.part_no)""", "mg", "atc")
def merged_chunks(spark, d):
    return boxed(segment.merge(segment.atomic(docs(spark, d))), "doc_id", "page_num", "chunk_index", "chunk_type", "chunk_text", "confidence")


# Aggregates and windows ----------------------------------------------------------------------------------------


@query("enclosing_bbox", 'SELECT doc_id, page_num, min("left")/1000.0 AS "left", min(top)/1000.0 AS top, max("right")/1000.0 AS "right", max(bottom)/1000.0 AS bottom FROM w GROUP BY doc_id, page_num', "w")
def enclosing_bbox(spark, d):
    own = derived.words(docs(spark, d)).groupBy("doc_id", "page_num").agg(*geometry.enclosing())
    return own.select("doc_id", "page_num", *[(F.col(c) / 1000.0).alias(c) for c in ("left", "top", "right", "bottom")])


@query("ordered_concat", "SELECT conv_id, string_agg(role||': '||coalesce(text, ''), chr(10) ORDER BY turn, role) AS joined FROM conversations GROUP BY conv_id")
def ordered_concat(spark, d):
    own = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.concat("role", F.lit(": "), F.coalesce("text", F.lit(""))).alias("said")))).alias("x"))
    return own.select("conv_id", F.array_join(F.transform("x", lambda x: x["said"]), "\n").alias("joined"))


@query("chunks_per_page", "SELECT doc_id, page_num, count(*) AS n_chunks FROM c0 GROUP BY doc_id, page_num", "c0")
def chunks_per_page(spark, d):
    return segment.word_stream(docs(spark, d)).groupBy("doc_id", "page_num").agg(F.count("*").alias("n_chunks"))


@query("chunk_index", "SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS chunk_index FROM conversations")
def chunk_index(spark, d):
    return read(spark, d, "conversations").select("conv_id", "turn", "role", (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1).alias("chunk_index"))


@query("next_sentence_end", "SELECT doc_id, page_num, word_pos, next_end FROM wn", "wn")
def next_sentence_end(spark, d):
    ahead = Window.partitionBy("doc_id", "page_num").orderBy("word_pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return derived.words(docs(spark, d)).select("doc_id", "page_num", "word_pos", F.min(F.when(F.col("ends"), F.col("word_pos"))).over(ahead).alias("next_end"))


@query("id_set_algebra", "SELECT o_custkey, array_to_string(list_sort(list_intersect(a, b)), ',') AS both_sets, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS only_first, len(list_distinct(list_concat(a, b))) AS n_either FROM (SELECT o_custkey, list(DISTINCT o_orderkey % 7) FILTER (WHERE o_orderkey % 2 = 0) AS a0, list(DISTINCT o_orderkey % 7) FILTER (WHERE o_orderkey % 3 = 0) AS b0, coalesce(a0, []) AS a, coalesce(b0, []) AS b FROM orders GROUP BY o_custkey)")
def id_set_algebra(spark, d):
    value = F.col("o_orderkey") % 7
    own = read(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.when(F.col("o_orderkey") % 2 == 0, value)).alias("a"), F.collect_set(F.when(F.col("o_orderkey") % 3 == 0, value)).alias("b"))
    return own.select("o_custkey", F.array_join(F.array_sort(F.array_intersect("a", "b")).cast("array<string>"), ",").alias("both_sets"), F.array_join(F.array_sort(F.array_except("a", "b")).cast("array<string>"), ",").alias("only_first"), F.size(F.array_union("a", "b")).alias("n_either"))


# Terms and dates -----------------------------------------------------------------------------------------------


@query("stopword_filter", rf"SELECT item_id, array_to_string(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda x: x NOT IN {STOP}), ' ') AS kept FROM benchmark")
def stopword_filter(spark, d):
    return read(spark, d, "benchmark").select("item_id", F.array_join(text.without(text.tokens(F.col("text")), text.STOP_WORDS), " ").alias("kept"))


_EXACT = rf"list_has_any(list_filter(regexp_extract_all(lower(search_term), '[\p{{L}}\p{{N}}_]+'), lambda x: x NOT IN {STOP}), regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}_]+'))"


def _pairs(spark, d) -> DataFrame:
    return terms(spark, d).select("query_id", "case_ref", "search_term").join(chunks(spark, d).select("chunk_id", "case_ref", "chunk_text"), "case_ref")


@query("match_exact", f"SELECT query_id, chunk_id FROM st JOIN c USING (case_ref) WHERE {_EXACT}", "st", "c")
def match_exact(spark, d):
    """Words meet by equality, so that no text is compared with every term."""
    asked = terms(spark, d).select("query_id", "case_ref", F.explode(text.without(text.tokens(F.col("search_term")), text.STOP_WORDS)).alias("word"))
    held = chunks(spark, d).select("chunk_id", "case_ref", F.explode(F.array_distinct(text.tokens(F.col("chunk_text")))).alias("word"))
    return asked.join(held, ["case_ref", "word"]).select("query_id", "chunk_id").distinct()


@query("match_wildcard", "SELECT query_id, chunk_id FROM st JOIN c USING (case_ref) WHERE contains(lower(chunk_text), lower(search_term))", "st", "c")
def match_wildcard(spark, d):
    return _pairs(spark, d).filter(matching.wildcard(F.col("search_term"), F.col("chunk_text"))).select("query_id", "chunk_id")


@query("match_any_method", f"SELECT query_id, chunk_id FROM st JOIN c USING (case_ref) WHERE {_EXACT} OR contains(lower(chunk_text), lower(search_term))", "st", "c")
def match_any_method(spark, d):
    return _pairs(spark, d).filter(matching.any_method(F.col("search_term"), F.col("chunk_text"), ["exact", "wildcard", "semantic_only"])).select("query_id", "chunk_id")


@query("match_all_methods")
def match_all_methods(spark, d):
    """All five methods; the stemmer and the fuzzy ratio have no SQL."""
    texts, asked = searched(spark, d)
    return matching.any_in_cases(asked.select("query_id", "case_ref", "search_term"), texts.select("chunk_id", "case_ref", "chunk_text"), list(matching.METHODS), staged)


@query("match_stemmed")
def match_stemmed(spark, d):
    return matching.stemmed(terms(spark, d), chunks(spark, d))


@query("match_fuzzy")
def match_fuzzy(spark, d):
    return matching.fuzzy_in_cases(terms(spark, d), chunks(spark, d))


def _dated(spark, d) -> DataFrame:
    day = F.to_date("o_orderdate")
    shown = F.concat(F.lit("Ordered on "), F.date_format(day, "d MMMM yyyy"), F.lit(" and paid "), F.date_format(day, "dd/MM/yyyy"), F.lit(", due "), F.date_format(day, "yyyy-MM-dd"), F.lit(" or in "), F.date_format(day, "MMM yyyy"), F.lit("."))
    return read(spark, d, "orders").select("o_orderkey", day.alias("day"), shown.alias("text"))


_DATES = "SELECT o_orderkey, list_sort([dd||' '||full_name||' '||yy, lpad(CAST(dd AS VARCHAR),2,'0')||'/'||lpad(CAST(mm AS VARCHAR),2,'0')||'/'||yy, yy||'-'||lpad(CAST(mm AS VARCHAR),2,'0')||'-'||lpad(CAST(dd AS VARCHAR),2,'0')]) AS found, short_name||' '||yy AS short, full_name||' '||yy AS long FROM odv"


@query("dates_extracted", f"SELECT o_orderkey, array_to_string(list_sort(CASE WHEN contains(lower(long), lower(short)) THEN found ELSE list_append(found, short) END), '|') AS dates FROM ({_DATES})", "odv")
def dates_extracted(spark, d):
    return _dated(spark, d).select("o_orderkey", F.array_join(dates.extracted(F.col("text")), "|").alias("dates"))


def _ways(first: str) -> str:
    return f"list_sort(list_distinct(list_concat([{first}, dd||'/'||mm||'/'||yy, lpad(CAST(dd AS VARCHAR),2,'0')||'/'||lpad(CAST(mm AS VARCHAR),2,'0')||'/'||yy, dd||'-'||mm||'-'||yy, lpad(CAST(dd AS VARCHAR),2,'0')||'-'||lpad(CAST(mm AS VARCHAR),2,'0')||'-'||yy, yy||'-'||lpad(CAST(mm AS VARCHAR),2,'0')||'-'||lpad(CAST(dd AS VARCHAR),2,'0'), dd||' '||full_name||' '||yy, dd||th||' '||full_name||' '||yy, dd||' '||short_name||' '||yy, dd||th||' '||short_name||' '||yy, dd||'-'||full_name||'-'||yy, dd||'-'||short_name||'-'||yy], CASE WHEN mm = 9 THEN [dd||' Sept '||yy, dd||th||' Sept '||yy, dd||'-Sept-'||yy] ELSE [] END)))"


@query("date_variants", f"SELECT o_orderkey, array_to_string({_ways('dd||th||chr(32)||full_name||chr(32)||yy')}, '|') AS variants FROM odv", "odv")
def date_variants(spark, d):
    own = read(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    day = F.dayofmonth("day")
    shown = F.concat(day.cast("string"), dates.ordinal(day), F.lit(" "), F.date_format("day", "MMMM yyyy"))
    return own.select("o_orderkey", shown.alias("shown")).select("o_orderkey", F.array_join(dates.variants(F.col("shown")), "|").alias("variants"))


@query("dates_for_search", f"SELECT o_orderkey, array_to_string({_ways('dd||chr(32)||full_name||chr(32)||yy')}, '|') AS variants FROM odv WHERE o_orderkey % 4 = 0", "odv")
def dates_for_search(spark, d):
    own = read(spark, d, "orders").filter("o_orderkey % 4 = 0")
    shown = F.concat(F.lit("seen on "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit(" at noon"))
    return own.select("o_orderkey", shown.alias("text")).select("o_orderkey", F.array_join(dates.for_search(F.col("text")), "|").alias("variants"))


@query("dates_for_search_all", f"SELECT o_orderkey, array_to_string({_ways('dd||chr(32)||full_name||chr(32)||yy')}, '|') AS variants FROM odv", "odv")
def dates_for_search_all(spark, d):
    """As dates_for_search, over every order."""
    shown = F.concat(F.lit("seen on "), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit(" at noon"))
    return read(spark, d, "orders").select("o_orderkey", shown.alias("text")).select("o_orderkey", F.array_join(dates.for_search(F.col("text")), "|").alias("variants"))


@query("acceptable_terms", "SELECT query_id, array_to_string(list_filter(list_transform(string_split(acceptable_terms, ','), lambda x: lower(trim(x))), lambda x: x <> '' AND x <> lower(trim(search_term))), '|') AS terms FROM st", "st")
def acceptable_terms(spark, d):
    own = F.filter(F.transform(text.listed(F.col("acceptable_terms")), lambda x: F.lower(x)), lambda x: x != F.lower(F.trim("search_term")))
    return terms(spark, d).select("query_id", F.array_join(own, "|").alias("terms"))


@query("expected_chunks", "SELECT query_id, chunk_id FROM ex", "ex")
def expected_chunks(spark, d):
    return evaluate.expected_chunks(terms(spark, d), chunks(spark, d))


@query("expected_chunks_csv", "SELECT st.query_id, search_term, coalesce(expected_chunk_id, '') AS expected_chunk_id, CASE WHEN row_number() OVER (ORDER BY st.query_id) = 1 THEN 'word-stream' ELSE '' END AS chunking_strategy FROM st LEFT JOIN exs USING (query_id)", "st", "exs")
def expected_chunks_csv(spark, d):
    """The terms with their expected chunks; run metadata stands in the first row alone."""
    t = terms(spark, d)
    wanted = evaluate.expected_chunks(t, chunks(spark, d)).groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ", ").alias("expected_chunk_id"))
    first = t.agg(F.min("query_id").alias("first"))
    return t.join(wanted, "query_id", "left").crossJoin(F.broadcast(first)).select("query_id", "search_term", F.coalesce("expected_chunk_id", F.lit("")).alias("expected_chunk_id"), F.when(F.col("query_id") == F.col("first"), "word-stream").otherwise("").alias("chunking_strategy"))


# Retrieval -----------------------------------------------------------------------------------------------------


def _vectors(spark, d, c) -> DataFrame:
    """The chunks' vectors: each is given one of the table's, by its numbers."""
    e = retrieval.unit(read(spark, d, "embeddings").select("vec_id", "embedding"))
    total = e.agg(F.count("*").alias("n"))
    place = c.crossJoin(F.broadcast(total)).select("chunk_id", "case_ref", ((F.col("doc_id") * 7 + F.col("page_num") * 3 + F.col("chunk_index")) % F.col("n")).alias("vec_id"))
    return place.join(e, "vec_id").select("chunk_id", "case_ref", "embedding")


def _asked(spark, d, t) -> DataFrame:
    e = retrieval.unit(read(spark, d, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), "vector")
    return t.select("query_id", "case_ref").join(e, "query_id")


def _clauses(spark, d, c, t, k: int = 40) -> tuple[DataFrame, DataFrame]:
    return retrieval.bm25(c, t), retrieval.knn(_asked(spark, d, t), _vectors(spark, d, c), "case_ref", "chunk_id", k)


def _hits(spark, d, c, t, search_type: str = "hybrid") -> DataFrame:
    lexical, vector = _clauses(spark, d, c, t)
    return staged(retrieval.hybrid(lexical, vector, None, Search(), search_type))


@query("embed_chunks")
def embed_chunks(spark, d):
    return retrieval.hashed_vectors(chunks(spark, d)).select("chunk_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 3).alias("length"), F.size("embedding").alias("size"))


@query("bm25_scores", "SELECT query_id, chunk_id, score FROM bm", "bm")
def bm25_scores(spark, d):
    return retrieval.bm25(*searched(spark, d))


@query("knn_topk", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, e.vec_id, round((1 + list_cosine_similarity(q.v, e.v))/2, 6) AS score FROM ev q JOIN ev e USING (label) WHERE q.vec_id < 40)) WHERE rank <= 40", "ev")
def knn_topk(spark, d):
    e = retrieval.unit(read(spark, d, "embeddings"))
    return retrieval.knn(e.filter("vec_id < 40").select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("vector")), e, "label", "vec_id")


@query("knn_topk_all", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, e.vec_id, round((1 + list_cosine_similarity(q.v, e.v))/2, 6) AS score FROM ev q JOIN ev e USING (label))) WHERE rank <= 40", "ev")
def knn_topk_all(spark, d):
    """As knn_topk, with every vector as a query; products grow with the square of a label's vectors, but no pair is a row."""
    e = retrieval.unit(read(spark, d, "embeddings"))
    return nearest.knn_every(e.select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("vector")), e, "label", "vec_id")


@query("date_clause", f"SELECT DISTINCT a.query_id, b.doc_id FROM (SELECT o_orderkey AS query_id, unnest({_ways('dd||chr(32)||full_name||chr(32)||yy')}) AS way, o_orderkey % 20 AS scope FROM odv WHERE o_orderkey < 200) a JOIN (SELECT o_orderkey AS doc_id, o_orderkey % 20 AS scope, ' '||lower('Paid '||dd||' '||short_name||' '||yy||' in full')||' ' AS body FROM odv) b USING (scope) WHERE contains(body, ' '||lower(way)||' ')", "odv")
def date_clause(spark, d):
    own = read(spark, d, "orders")
    asked = own.filter("o_orderkey < 200").select(F.col("o_orderkey").alias("query_id"), (F.col("o_orderkey") % 20).alias("case_ref"), F.concat(F.lit("seen "), F.date_format("o_orderdate", "d MMMM yyyy")).alias("search_term"))
    body = own.select(F.col("o_orderkey").alias("chunk_id"), (F.col("o_orderkey") % 20).alias("case_ref"), F.concat(F.lit("Paid "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" in full.")).alias("chunk_text"))
    return retrieval.date_clause(body, asked).withColumnRenamed("chunk_id", "doc_id")


@query("date_clause_all", f"SELECT DISTINCT a.query_id, b.doc_id FROM (SELECT o_orderkey AS query_id, unnest({_ways('dd||chr(32)||full_name||chr(32)||yy')}) AS way, o_orderkey % 20 AS scope FROM odv) a JOIN (SELECT o_orderkey AS doc_id, o_orderkey % 20 AS scope, ' '||lower('Paid '||dd||' '||short_name||' '||yy||' in full')||' ' AS body FROM odv) b USING (scope) WHERE contains(body, ' '||lower(way)||' ')", "odv")
def date_clause_all(spark, d):
    """As date_clause, with every order as a query."""
    own = read(spark, d, "orders")
    asked = own.select(F.col("o_orderkey").alias("query_id"), (F.col("o_orderkey") % 20).alias("case_ref"), F.concat(F.lit("seen "), F.date_format("o_orderdate", "d MMMM yyyy")).alias("search_term"))
    body = own.select(F.col("o_orderkey").alias("chunk_id"), (F.col("o_orderkey") % 20).alias("case_ref"), F.concat(F.lit("Paid "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" in full.")).alias("chunk_text"))
    return retrieval.date_clause(body, asked).withColumnRenamed("chunk_id", "doc_id")


@query("hybrid_topk", "SELECT query_id, chunk_id, score, rank FROM hits", "hits")
def hybrid_topk(spark, d):
    return _hits(spark, d, *searched(spark, d))


@query("search_by_type", "SELECT 'keyword' AS search_type, query_id, chunk_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT query_id, chunk_id, round(score*20.0, 5) AS score FROM bm)) WHERE rank <= 40 UNION ALL SELECT 'semantic', query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score*4.0, 5) DESC, chunk_id) FROM vs", "bm", "vs")
def search_by_type(spark, d):
    lexical, vector = _clauses(spark, d, *searched(spark, d))
    parts = [retrieval.hybrid(lexical, vector, None, Search(), k).select(F.lit(k).alias("search_type"), "query_id", "chunk_id", "rank") for k in ("keyword", "semantic")]
    return parts[0].unionByName(parts[1])


_DATED = f"SELECT DISTINCT query_id, chunk_id FROM (SELECT query_id, case_ref, unnest({_ways('dd||chr(32)||full_name||chr(32)||yy')}) AS way FROM dst) JOIN dc USING (case_ref) WHERE contains(' '||replace(lower(chunk_text), '.', ' ')||' ', ' '||lower(way)||' ')"
_TYPED = " UNION ALL ".join(
    f"SELECT '{kind}' AS search_type, query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT query_id, chunk_id, round(sum(score), 5) AS score FROM ({' UNION ALL '.join(parts)}) GROUP BY ALL)"
    for kind, parts in {
        k: [b for b, there in (("SELECT query_id, chunk_id, score*20.0 AS score FROM dbm", k != "semantic"), ("SELECT query_id, chunk_id, score*4.0 AS score FROM dvs", k[:6] != "keywor"), (f"SELECT query_id, chunk_id, 4.0 AS score FROM ({_DATED})", k.endswith("dates"))) if there]
        for k in retrieval.TYPES
    }.items()
)


def _dated_clauses(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as texts of their customer's case, and every fiftieth as a term with a date: the three clauses."""
    own = staged(read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("case_ref"), "o_orderpriority", F.to_date("o_orderdate").alias("day")))
    text_of = F.concat(F.lit("Order "), F.col("o_orderpriority"), F.lit(" paid "), F.date_format("day", "d MMM yyyy"), F.lit(" in full."))
    c = own.select(F.col("o_orderkey").alias("chunk_id"), "case_ref", text_of.alias("chunk_text"))
    t = own.filter("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("query_id"), "case_ref", F.concat("o_orderpriority", F.lit(" of "), F.date_format("day", "d MMMM yyyy")).alias("search_term"))
    e = retrieval.unit(read(spark, d, "embeddings").select("vec_id", "embedding"))
    total = e.agg(F.count("*").alias("n"))  # one row
    place = lambda rows, key: rows.crossJoin(F.broadcast(total)).select(key, "case_ref", (F.col(key) % F.col("n")).alias("vec_id")).join(e, "vec_id")
    vector = retrieval.knn(place(t, "query_id").select("query_id", "case_ref", F.col("embedding").alias("vector")), place(c, "chunk_id").select("chunk_id", "case_ref", "embedding"), "case_ref", "chunk_id")
    return staged(retrieval.bm25(c, t)), staged(vector.select("query_id", "chunk_id", "score")), staged(retrieval.date_clause(c, t))


@query("hybrid_dates_topk", f"SELECT query_id, chunk_id, score, rank FROM ({_TYPED}) WHERE search_type = 'hybrid-dates' AND rank <= 40", "dbm", "dvs", "dst", "dc")
def hybrid_dates_topk(spark, d):
    """The default search: words, vectors and dates."""
    return retrieval.hybrid(*_dated_clauses(spark, d), Search())


@query("search_all_types", f"SELECT * FROM ({_TYPED}) WHERE rank <= 40", "dbm", "dvs", "dst", "dc")
def search_all_types(spark, d):
    """Every search type over the same clauses."""
    clauses = _dated_clauses(spark, d)
    parts = [retrieval.hybrid(*clauses, Search(), kind).select(F.lit(kind).alias("search_type"), "query_id", "chunk_id", "score", "rank") for kind in retrieval.TYPES]
    return reduce(DataFrame.unionByName, parts)


_BAND = "SELECT query_id, chunk_id, score, rank, score >= 3.9 AS over_, count(*) FILTER (WHERE score >= 3.9) OVER (PARTITION BY query_id) AS n_over FROM hits"


@query("adaptive_score_filter", f"SELECT query_id, chunk_id, score, rank, CASE WHEN over_ THEN 'hybrid' ELSE 'Semantic Fallback' END AS result_type FROM (SELECT *, row_number() OVER (PARTITION BY query_id, over_, NOT over_ AND score >= 2.0 ORDER BY rank) AS place FROM ({_BAND})) WHERE over_ OR (score >= 2.0 AND n_over < 5 AND place <= 10)", "hits")
def adaptive_score_filter(spark, d):
    return retrieval.adaptive(hybrid_topk(spark, d), Search(score_filter=3.9, semantic_filter=2.0))


@query("adaptive_hits_labelled", f"SELECT result_type, count(*) AS n_hits FROM (SELECT CASE WHEN over_ THEN 'hybrid' ELSE 'Semantic Fallback' END AS result_type FROM (SELECT *, row_number() OVER (PARTITION BY query_id, over_, NOT over_ AND score >= 2.0 ORDER BY rank) AS place FROM ({_BAND})) WHERE over_ OR (score >= 2.0 AND n_over < 5 AND place <= 10)) GROUP BY result_type", "hits")
def adaptive_hits_labelled(spark, d):
    return adaptive_score_filter(spark, d).groupBy("result_type").agg(F.count("*").alias("n_hits"))


# Evaluation ----------------------------------------------------------------------------------------------------


def _results(spark, d):
    c, t = searched(spark, d)
    hits, expected = _hits(spark, d, c, t), evaluate.expected_chunks(t, c)
    return c, t, hits, expected, evaluate.search_results(t, hits, c, expected)


def _relevance(spark, d) -> DataFrame:
    c, t, hits, _, results = _results(spark, d)
    return evaluate.relevance(results, evaluate.presence(hits, c, t, ["exact"]), (F.col("query_id") % 5).cast("int"))


@query("search_results", "SELECT * FROM sr", "sr")
def search_results(spark, d):
    return _results(spark, d)[-1]


@query("search_loop_results", """SELECT row_number() OVER (ORDER BY query_id) AS index, query_id, search_term, acceptable_terms, CAST(query_id % 3 + 1 AS VARCHAR) AS expected_page_number, coalesce(expected_chunk_id, '') AS expected_chunk_id, CAST(query_id % 5 AS VARCHAR) AS manual_identifications, coalesce(all_chunk_ids, '') AS all_chunk_ids, coalesce(all_page_numbers, '') AS all_page_numbers, coalesce(all_term_frequencies, '') AS all_term_frequencies, coalesce(total_term_frequency, 0) AS total_term_frequency, coalesce(total_results, 0) AS total_results
FROM st LEFT JOIN exs USING (query_id) LEFT JOIN (SELECT query_id, string_agg(chunk_id, ', ' ORDER BY rank) AS all_chunk_ids, string_agg(CAST(page_num AS VARCHAR), ', ' ORDER BY rank) AS all_page_numbers, string_agg(CAST(n AS VARCHAR), ', ' ORDER BY rank) AS all_term_frequencies, CAST(sum(n) AS BIGINT) AS total_term_frequency, count(*) AS total_results FROM tf JOIN (SELECT query_id, chunk_id, score FROM hits) USING (query_id, chunk_id) WHERE score >= 2.5 GROUP BY query_id) USING (query_id) WHERE trim(search_term) <> ''""", "st", "tf", "hits", "exs")
def search_loop_results(spark, d):
    """The result table, with hits under the score cut left out."""
    c, t = searched(spark, d)
    wanted = evaluate.expected_chunks(t, c).groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ", ").alias("expected_chunk_id"))
    asked = t.join(wanted, "query_id", "left").withColumn("expected_chunk_id", F.coalesce("expected_chunk_id", F.lit(""))).withColumn("expected_page_number", (F.col("query_id") % 3 + 1).cast("string")).withColumn("manual_identifications", (F.col("query_id") % 5).cast("string"))
    return evaluate.search_table(asked, _hits(spark, d, c, t), c, 2.5)


@query("query_term_freq", "SELECT query_id, total_term_frequency FROM sr", "sr")
def query_term_freq(spark, d):
    return search_results(spark, d).select("query_id", "total_term_frequency")


@query("precision_recall", "SELECT query_id, precision, recall, missing_chunk_ids FROM pr", "pr")
def precision_recall(spark, d):
    return evaluate.chunk_match(search_results(spark, d)).select("query_id", "precision", "recall", "missing_chunk_ids")


@query("term_presence", "SELECT * FROM tp", "tp")
def term_presence(spark, d):
    c, t = searched(spark, d)
    return evaluate.presence(_hits(spark, d, c, t), c, t, ["exact"])


_OVERLAP = "named AS (SELECT DISTINCT lower(trim(search_term)) AS term, chunk_id FROM ex JOIN st USING (query_id)), asked AS (SELECT query_id, lower(trim(search_term)) AS term, true AS own FROM st UNION ALL SELECT query_id, unnest(list_filter(list_transform(string_split(acceptable_terms, ','), lambda x: lower(trim(x))), lambda x: x <> '' AND x <> lower(trim(search_term)))), false FROM st), met AS (SELECT query_id, chunk_id, bool_or(own) AS own, bool_or(NOT own) AS other FROM asked JOIN named USING (term) GROUP BY ALL)"


@query("term_overlap_expected", f"SELECT * FROM (WITH {_OVERLAP} SELECT query_id, count(*) FILTER (WHERE own) AS chunks_with_search_term, count(*) FILTER (WHERE other) AS chunks_with_acceptable, count(*) FILTER (WHERE own OR other) AS chunks_with_any_term FROM (SELECT DISTINCT query_id, chunk_id FROM hits) LEFT JOIN met USING (query_id, chunk_id) GROUP BY query_id)", "ex", "st", "hits")
def term_overlap_expected(spark, d):
    c, t = searched(spark, d)
    return evaluate.overlap(_hits(spark, d, c, t), evaluate.expected_chunks(t, c), t)


@query("relevance_results", "SELECT * FROM rel", "rel")
def relevance_results(spark, d):
    return _relevance(spark, d)


@query("evaluation_summary", "SELECT * FROM summ", "summ")
def evaluation_summary(spark, d):
    return evaluate.summary(_relevance(spark, d))


@query("evaluation_log_row", "SELECT 'hybrid' AS search_type, 20.0::DOUBLE AS lexical_boost, 4.0::DOUBLE AS neural_boost, total_queries, avg_precision, avg_recall, optimization_score FROM summ", "summ")
def evaluation_log_row(spark, d):
    config = Search()
    return evaluation_summary(spark, d).select(F.lit("hybrid").alias("search_type"), F.lit(config.lexical_boost).alias("lexical_boost"), F.lit(config.neural_boost).alias("neural_boost"), "total_queries", "avg_precision", "avg_recall", "optimization_score")


def _sweep_inputs(spark, d):
    c, t = searched(spark, d)
    lexical, vector = _clauses(spark, d, c, t, 1 << 30)
    both = vector.select("query_id", "chunk_id", F.col("score").alias("neural")).join(lexical.withColumnRenamed("score", "lexical"), ["query_id", "chunk_id"], "left")
    return both.select("query_id", "chunk_id", F.coalesce("lexical", F.lit(0.0)).alias("lexical"), "neural"), evaluate.expected_chunks(t, c)


_GRID = "grid AS (SELECT a*5 + b AS trial, a*1.25::DOUBLE AS lexical_boost, b*1.25::DOUBLE AS neural_boost FROM range(5) x(a), range(5) y(b))"
_SWEEP = f"WITH {_GRID}, ranked AS (SELECT trial, query_id, chunk_id, row_number() OVER (PARTITION BY trial, query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT trial, query_id, chunk_id, round(lexical*lexical_boost + neural*neural_boost, 5) AS score FROM cl, grid) WHERE score > 0), met AS (SELECT trial, query_id, count(ex.chunk_id) / count(*) AS precision FROM ranked r LEFT JOIN ex USING (query_id, chunk_id) WHERE rank <= 10 GROUP BY ALL), scored AS (SELECT trial, round_even(avg(precision)*100, 2) AS score FROM met GROUP BY trial) SELECT grid.trial, lexical_boost, neural_boost, CASE WHEN lexical_boost <= 0 AND neural_boost <= 0 THEN -1000.0 ELSE coalesce(score, 0.0) END AS score FROM grid LEFT JOIN scored USING (trial)"


def _grid(spark) -> DataFrame:
    return spark.createDataFrame([(a * 5 + b, a * 1.25, b * 1.25) for a in range(5) for b in range(5)], "trial long, lexical_boost double, neural_boost double")


@query("boost_sweep", f"SELECT * FROM ({_SWEEP})", "cl", "ex")
def boost_sweep(spark, d):
    return evaluate.sweep(*_sweep_inputs(spark, d), _grid(spark))


BOOSTS = ["keyword", "analyser", "semantic", "wildcard", "fuzzy"]
_FIVE = "grid AS (SELECT a*16 + b*8 + c_*4 + d*2 + e AS trial, a*2.5::DOUBLE AS keyword, b*2.5::DOUBLE AS analyser, c_*2.5::DOUBLE AS semantic, d*2.5::DOUBLE AS wildcard, e*2.5::DOUBLE AS fuzzy FROM range(2) q(a), range(2) w(b), range(2) r(c_), range(2) t(d), range(2) y(e))"
_HAS = rf"list_has_any(list_filter(regexp_extract_all(TERM, '[\p{{L}}\p{{N}}_]+'), lambda x: x NOT IN {STOP}), regexp_extract_all(lower(chunk_text), '[\p{{L}}\p{{N}}_]+'))"
_OBJECTIVE = f"""WITH {_FIVE}, flags AS (SELECT query_id, chunk_id, {_HAS.replace('TERM', 'lower(search_term)')} AS own, contains(lower(chunk_text), lower(search_term)) AS inside, len(list_filter(list_filter(list_transform(string_split(acceptable_terms, ','), lambda x: lower(trim(x))), lambda x: x <> '' AND x <> lower(trim(search_term))), lambda t: {_HAS.replace('TERM', 't')})) > 0 AS other FROM st JOIN c USING (case_ref)),
all_clauses AS (SELECT query_id, chunk_id, own OR other AS has, CASE WHEN own THEN 1.0 ELSE 0.0 END AS k, lexical AS a, neural AS s, CASE WHEN inside THEN 1.0 ELSE 0.0 END AS w FROM flags JOIN cl USING (query_id, chunk_id)),
ranked AS (SELECT trial, query_id, chunk_id, has, row_number() OVER (PARTITION BY trial, query_id ORDER BY score DESC, chunk_id) AS rank FROM (SELECT trial, query_id, chunk_id, has, round(k*keyword + a*analyser + s*semantic + w*wildcard, 5) AS score FROM all_clauses, grid) WHERE score > 0),
per AS (SELECT trial, query_id, count(*) AS n, round_even(count(*) FILTER (WHERE has) / count(*) * 100, 2) AS share FROM ranked WHERE rank <= 40 GROUP BY ALL),
trials AS (SELECT trial, sum(n) FILTER (WHERE share > 0) AS returned, avg(share) AS share FROM per GROUP BY trial)
SELECT grid.trial, keyword, analyser, semantic, wildcard, fuzzy, CASE WHEN keyword + analyser + semantic + wildcard + fuzzy <= 0 THEN -1000.0 ELSE round_even(coalesce(returned, 0) / (SELECT count(*) FROM st) * pow(coalesce(trials.share, 0.0) / 100, 2), 4) END AS score FROM grid LEFT JOIN trials USING (trial)"""


@query("boost_sweep_objective", f"SELECT * FROM ({_OBJECTIVE})", "st", "c", "cl")
def boost_sweep_objective(spark, d):
    """Five boosts by the optimisation score; the fuzzy clause, which SQL lacks, matches nothing here."""
    c, t = searched(spark, d)
    term = F.lower(F.trim("search_term"))
    others = F.filter(F.transform(text.listed(F.col("acceptable_terms")), lambda x: F.lower(x)), lambda x: x != term)
    own, other = matching.exact(F.col("search_term"), F.col("chunk_text")), F.exists(others, lambda x: matching.exact(x, F.col("chunk_text")))
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    # each pair is made once, with its flags and its vectors' score, and moves once, without its texts
    texts, asked = c.join(_vectors(spark, d, c).select("chunk_id", "embedding"), "chunk_id"), t.join(_asked(spark, d, t).select("query_id", "vector"), "query_id")
    pairs = asked.join(texts, "case_ref").select("query_id", "chunk_id", (own | other).alias("has"), one(own).alias("keyword"), one(matching.wildcard(F.col("search_term"), F.col("chunk_text"))).alias("wildcard"), F.lit(0.0).alias("fuzzy"), retrieval.cosine_score(F.col("vector"), F.col("embedding")).alias("semantic"))
    scored = pairs.join(retrieval.bm25(c, t).withColumnRenamed("score", "analyser"), ["query_id", "chunk_id"], "left").fillna(0.0, ["analyser"])
    grid = spark.createDataFrame([(i, *[2.5 * (i >> b & 1) for b in (4, 3, 2, 1, 0)]) for i in range(32)], "trial long, " + ", ".join(f"{b} double" for b in BOOSTS))
    return evaluate.objective(staged(scored), grid, BOOSTS, F.lit(t.count()))


@query("embedded_search")
def embedded_search(spark, d):
    """Semantic search by vectors made of the texts themselves: each distinct term is embedded once."""
    c, t = searched(spark, d)
    vectors = retrieval.hashed_vectors(c).join(c.select("chunk_id", "case_ref"), "chunk_id")
    return retrieval.knn(retrieval.embedded_terms(t), vectors, "case_ref", "chunk_id")


@query("sweep_top_trials", f"SELECT trial, nullif(score, 0.0) AS value, lexical_boost, neural_boost FROM ({_SWEEP}) ORDER BY score DESC, trial LIMIT 5", "cl", "ex")
def sweep_top_trials(spark, d):
    """The five best trials as they are saved, where a score of 0 becomes null."""
    top = boost_sweep(spark, d).orderBy(F.desc("score"), "trial").limit(5)
    return top.select("trial", F.nullif("score", F.lit(0.0)).alias("value"), "lexical_boost", "neural_boost")


@query("two_phase_search")
def two_phase_search(spark, d):
    return evaluate.two_phase(spark, *_sweep_inputs(spark, d))
