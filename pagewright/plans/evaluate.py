"""Retrieval quality: matches against expected chunks, term presence, summary, and sweeps over weights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.config import Search
from pagewright.functions import dates, text
from pagewright.operators import matching


def percent(part: Column, whole: Column) -> Column:
    return F.bround(part / whole * 100, 2)


def chunk_match(rows: DataFrame) -> DataFrame:
    """precision, recall, missing_chunk_ids from the comma lists expected_chunk_id and all_chunk_ids.

    Without expected chunks precision is 0 and recall null if anything was found, else both are 100.
    """
    wanted, found = text.listed(F.col("expected_chunk_id")), text.listed(F.col("all_chunk_ids"))
    met = F.size(F.filter(wanted, lambda x: F.array_contains(found, x)))
    precision = F.when(F.size(wanted) > 0, F.when(F.size(found) > 0, percent(met, F.size(found))).otherwise(0.0)).when(F.size(found) > 0, 0.0).otherwise(100.0)
    recall = F.when(F.size(wanted) > 0, percent(met, F.size(wanted))).when(F.size(found) > 0, None).otherwise(100.0)
    return rows.withColumn("precision", precision).withColumn("recall", recall).withColumn("missing_chunk_ids", F.array_join(F.filter(wanted, lambda x: ~F.array_contains(found, x)), ", "))


def expected_chunks(terms: DataFrame, chunks: DataFrame, use_date_variants: bool = False, use_stemming: bool = False) -> DataFrame:
    """query_id, chunk_id of chunks in the case that hold what the term asks for.

    A term with a date: the whole term as it stands, or with ``use_date_variants`` any way of writing its dates. Any other
    term: any of its words, also inside a word, or with ``use_stemming`` a word of the letters a to z with the stem of any.
    """
    term = F.trim("search_term")
    asked = terms.select("query_id", "case_ref", term.alias("term"), text.words(F.lower(term)).alias("ws"), F.coalesce(dates.is_date(term), F.lit(False)).alias("dated")).filter(F.size("ws") > 0)
    body = chunks.select("chunk_id", "case_ref", F.lower("chunk_text").alias("body"))
    whole = F.transform(dates.for_search(F.col("term")), lambda x: F.lower(x)) if use_date_variants else F.array(F.lower("term"))
    sought = asked.withColumn("ws", F.when(F.col("dated"), whole).otherwise(F.col("ws")))
    if use_stemming:
        sought = sought.filter("dated")
    found = sought.select("query_id", "case_ref", "ws").join(body, "case_ref").filter(F.exists("ws", lambda w: F.contains("body", w))).select("query_id", "chunk_id")
    if not use_stemming:
        return found
    words = asked.filter("NOT dated").select("query_id", "case_ref", F.explode("ws").alias("word"))
    held = body.select("chunk_id", "case_ref", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(r"(?<![\p{L}\p{N}_])([a-z]+)(?![\p{L}\p{N}_])"), F.lit(1)))).alias("word"))
    known = matching.stems(words.select("word").unionByName(held.select("word")))
    left = words.join(known, "word").select("query_id", "case_ref", "stem").distinct()
    right = held.join(known.join(left.select("stem").distinct(), "stem", "left_semi"), "word").select("chunk_id", "case_ref", "stem")
    return found.unionByName(left.join(right, ["case_ref", "stem"]).select("query_id", "chunk_id").distinct())


def presence(hits: DataFrame, chunks: DataFrame, terms: DataFrame, methods: list[str]) -> DataFrame:
    """Per query, how many hits hold the term, an acceptable one, or either; hits without text are passed over."""
    own = hits.select("query_id", "chunk_id").join(chunks.select("chunk_id", "chunk_text"), "chunk_id").filter("chunk_text <> ''").join(terms.select("query_id", "search_term", "acceptable_terms"), "query_id")
    term = F.lower(F.trim("search_term"))
    others = F.filter(F.transform(text.listed(F.col("acceptable_terms")), lambda x: F.lower(x)), lambda x: x != term)
    if {"stemmed", "fuzzy"} & set(methods):
        has = matching.any_rows(own.select("query_id", "chunk_id", term.alias("search_term"), "chunk_text"), methods).withColumn("has", F.lit(True))
        other = matching.any_rows(own.select("query_id", "chunk_id", F.explode(others).alias("search_term"), "chunk_text"), methods).withColumn("other", F.lit(True))
        joined = own.select("query_id", "chunk_id").join(has, ["query_id", "chunk_id"], "left").join(other, ["query_id", "chunk_id"], "left")
        flagged = joined.select("query_id", F.coalesce("has", F.lit(False)).alias("has"), F.coalesce("other", F.lit(False)).alias("other"))
    else:
        has = matching.any_method(term, F.col("chunk_text"), methods)
        other = F.exists(others, lambda x: matching.any_method(x, F.col("chunk_text"), methods))
        flagged = own.select("query_id", has.alias("has"), other.alias("other"))
    return flagged.groupBy("query_id").agg(F.count_if("has").alias("chunks_with_search_term"), F.count_if("other").alias("chunks_with_acceptable"), F.count_if(F.col("has") | F.col("other")).alias("chunks_with_any_term"))


def search_results(terms: DataFrame, hits: DataFrame, chunks: DataFrame, expected: DataFrame) -> DataFrame:
    """A row per term that isn't blank: its hits, their pages and the term's frequency, and the expected chunks."""
    found = hits.join(chunks.select("chunk_id", "page_num", "chunk_text"), "chunk_id").join(terms.select("query_id", "search_term"), "query_id")
    found = found.withColumn("n", text.occurrences(F.col("chunk_text"), F.col("search_term")))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(c).cast("string").alias("v")))), lambda x: x["v"]), ", ")
    per = found.groupBy("query_id").agg(joined("chunk_id").alias("all_chunk_ids"), joined("page_num").alias("all_page_numbers"), F.count("*").alias("total_results"), F.sum("n").alias("total_term_frequency"))
    wanted = expected.groupBy("query_id").agg(F.array_join(F.array_sort(F.collect_list("chunk_id")), ", ").alias("expected_chunk_id"))
    rows = terms.filter(F.trim("search_term") != "").join(per, "query_id", "left").join(wanted, "query_id", "left")
    return rows.select("query_id", "search_term", "acceptable_terms", *[F.coalesce(c, F.lit("")).alias(c) for c in ("all_chunk_ids", "all_page_numbers", "expected_chunk_id")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_results", "total_term_frequency")])


def search_table(terms: DataFrame, hits: DataFrame, chunks: DataFrame, least: float = Search().score_filter) -> DataFrame:
    """The result table of a search: a numbered row per term that isn't blank, with what the hits of at least ``least`` hold.

    terms: query_id, search_term, and the columns that are passed on: acceptable_terms, expected_page_number,
    expected_chunk_id, manual_identifications.
    """
    asked = terms.filter(F.trim("search_term") != "")
    found = hits.filter(F.col("score") >= least).join(chunks.select("chunk_id", "page_num", "chunk_text"), "chunk_id").join(asked.select("query_id", "search_term"), "query_id")
    found = found.withColumn("n", text.occurrences(F.col("chunk_text"), F.col("search_term")))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(c).cast("string").alias("v")))), lambda x: x["v"]), ", ")
    per = found.groupBy("query_id").agg(joined("chunk_id").alias("all_chunk_ids"), joined("page_num").alias("all_page_numbers"), joined("n").alias("all_term_frequencies"), F.sum("n").alias("total_term_frequency"), F.count("*").alias("total_results"))
    passed = ["query_id", "search_term", "acceptable_terms", "expected_page_number", "expected_chunk_id", "manual_identifications"]
    rows = asked.select(*passed).join(per, "query_id", "left").withColumn("index", F.row_number().over(Window.orderBy("query_id")))  # one row per term
    return rows.select("index", *passed, *[F.coalesce(c, F.lit("")).alias(c) for c in ("all_chunk_ids", "all_page_numbers", "all_term_frequencies")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_term_frequency", "total_results")])


def relevance(results: DataFrame, present: DataFrame, manual: Column) -> DataFrame:
    rows = chunk_match(results).join(present, "query_id", "left").withColumn("manual_identifications", manual)
    total = F.col("total_results")
    share = lambda c: F.when(total > 0, percent(F.coalesce(c, F.lit(0)), total))
    return rows.select(
        "query_id", "search_term", "expected_chunk_id", "total_results", "precision", "recall", "missing_chunk_ids", share("chunks_with_search_term").alias("term_based_precision"),
        share("chunks_with_any_term").alias("acceptable_term_based_precision"), "manual_identifications", "total_term_frequency", (F.col("total_term_frequency") - F.col("manual_identifications")).alias("term_freq_difference"),
    )


def summary(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Ten figures over all queries, or over each group of them."""
    n, average = F.count("*"), lambda c: F.coalesce(F.avg(c), F.lit(0.0))
    returned = F.coalesce(F.sum(F.when(F.col("acceptable_term_based_precision") > 0, F.col("total_results"))), F.lit(0))
    out = rows.groupBy(*by).agg(
        n.alias("total_queries"), F.count_if(F.col("total_results") > 0).alias("queries_with_results"), returned.alias("returned"), F.count_if(F.trim("expected_chunk_id") != "").alias("queries_with_expected_chunk"),
        average("precision").alias("p"), average("recall").alias("r"), average("acceptable_term_based_precision").alias("a"),
    )
    p, r, a, total = (F.col(c) for c in ("p", "r", "a", "total_queries"))
    return out.filter(total > 0).select(
        *by, "total_queries", "queries_with_results", F.bround(F.col("queries_with_results") / total, 2).alias("result_rate"), F.bround(F.col("returned") / total, 2).alias("avg_chunks_returned"), "queries_with_expected_chunk",
        F.bround(p, 2).alias("avg_precision"), F.bround(r, 2).alias("avg_recall"), F.bround(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 2).alias("avg_f1_score"),
        F.bround(a, 2).alias("avg_acceptable_term_based_precision"), F.bround(F.col("returned") / total * F.pow(a / 100, F.lit(2)), 4).alias("optimization_score"),
    )


def overlap(hits: DataFrame, expected: DataFrame, terms: DataFrame) -> DataFrame:
    """Per query, its hits among the expected chunks of its term, of its acceptable terms, and of either."""
    named = expected.join(terms.select("query_id", F.lower(F.trim("search_term")).alias("term")), "query_id").select("term", "chunk_id").distinct()
    term = F.lower(F.trim("search_term"))
    others = F.filter(F.transform(text.listed(F.col("acceptable_terms")), lambda x: F.lower(x)), lambda x: x != term)
    asked = terms.select("query_id", term.alias("term"), F.lit(True).alias("own")).unionByName(terms.select("query_id", F.explode(others).alias("term"), F.lit(False).alias("own")))
    met = asked.join(named, "term").groupBy("query_id", "chunk_id").agg(F.bool_or("own").alias("own"), F.bool_or(~F.col("own")).alias("other"))
    found = hits.select("query_id", "chunk_id").distinct().join(met, ["query_id", "chunk_id"], "left")
    return found.groupBy("query_id").agg(F.count_if("own").alias("chunks_with_search_term"), F.count_if("other").alias("chunks_with_acceptable"), F.count_if(F.coalesce("own", F.lit(False)) | F.coalesce("other", F.lit(False))).alias("chunks_with_any_term"))


def sweep(clauses: DataFrame, expected: DataFrame, grid: DataFrame, k: int = 10) -> DataFrame:
    """The mean precision at k of every weighting of two clauses, all in one plan.

    clauses: query_id, chunk_id, lexical, neural (each clause's own score, 0 without it); grid: trial, lexical_boost,
    neural_boost. The grid is a handful of rows beside the clauses. A weighting without any weight scores -1000.
    """
    weighted = clauses.crossJoin(F.broadcast(grid)).withColumn("score", F.round(F.col("lexical") * F.col("lexical_boost") + F.col("neural") * F.col("neural_boost"), 5))
    best = Window.partitionBy("trial", "query_id").orderBy(F.desc("score"), "chunk_id")
    top = weighted.filter("score > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    met = top.join(expected.withColumn("met", F.lit(1)), ["query_id", "chunk_id"], "left").groupBy("trial", "query_id").agg((F.count("met") / F.count("*")).alias("precision"))
    scored = met.groupBy("trial").agg(F.bround(F.avg("precision") * 100, 2).alias("score"))
    none = (F.col("lexical_boost") <= 0) & (F.col("neural_boost") <= 0)
    return grid.join(scored, "trial", "left").select("trial", "lexical_boost", "neural_boost", F.when(none, -1000.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"))


#: What a weighting without any weight, or without any query, scores.
PENALTY = -1000.0


def objective(clauses: DataFrame, grid: DataFrame, boosts: list[str], n_queries: Column, k: int = 40, least: float = 0.0) -> DataFrame:
    """The optimisation score of every weighting of the clauses, all in one plan.

    clauses: query_id, chunk_id, has (whether the chunk holds the term or an acceptable one), and a column with each
    clause's own score; grid: trial, and a weight under each clause's name. Of each trial and query the best ``k`` of at least
    ``least`` count. The score is the mean number of hits of queries of which any has a term, over all queries, times the
    square of the mean share of hits that have one.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")

    def hits(trial: Row) -> DataFrame:
        score = F.round(sum((F.col(b) * F.lit(trial[b]).cast(grid.schema[b].dataType) for b in boosts), F.lit(0.0)), 5)
        scored = clauses.select("query_id", "chunk_id", "has", score.alias("score")).filter((F.col("score") > 0) & (F.col("score") >= least))
        return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(F.lit(trial["trial"]).cast(grid.schema["trial"].dataType).alias("trial"), "query_id", "has")

    # a trial is a branch, as the sorts of all trials at once would lie on disk; a grid is a handful of rows
    rows = grid.collect()
    if not rows:
        return grid.select("trial", *boosts, F.lit(PENALTY).alias("score"))
    top = reduce(DataFrame.unionByName, [hits(trial) for trial in rows])
    per = top.groupBy("trial", "query_id").agg(F.count("*").alias("n"), percent(F.count_if("has"), F.count("*")).alias("share"))
    trials = per.groupBy("trial").agg(F.sum(F.when(F.col("share") > 0, F.col("n"))).alias("returned"), F.avg("share").alias("share"))
    weights = sum((F.col(b) for b in boosts), F.lit(0.0))
    score = F.bround(F.coalesce(F.col("returned"), F.lit(0)) / n_queries * F.pow(F.coalesce("share", F.lit(0.0)) / 100, F.lit(2)), 4)
    return grid.join(trials, "trial", "left").select("trial", *boosts, F.when((weights <= 0) | (n_queries <= 0), PENALTY).otherwise(score).alias("score"))


def two_phase(spark: SparkSession, clauses: DataFrame, expected: DataFrame, high: float = 5.0, coarse: float = 1.25, fine: float = 0.25) -> DataFrame:
    """A coarse grid of weights, then a fine one around its best trial; every trial of both, with its score."""
    kind = "trial long, lexical_boost double, neural_boost double"
    steps = [i * coarse for i in range(int(high / coarse) + 1)]
    first = sweep(clauses, expected, spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in steps for b in steps)], kind))
    best = first.orderBy(F.desc("score"), "trial").first()
    around = [(a, b) for i in range(-2, 3) for j in range(-2, 3) if 0 <= (a := round(best["lexical_boost"] + i * fine, 4)) <= high and 0 <= (b := round(best["neural_boost"] + j * fine, 4)) <= high]
    second = sweep(clauses, expected, spark.createDataFrame([(1000 + i, a, b) for i, (a, b) in enumerate(around)], kind))
    return first.withColumn("phase", F.lit(1)).unionByName(second.withColumn("phase", F.lit(2)))


__all__ = ["Search", "chunk_match", "objective", "overlap", "presence", "relevance", "search_table", "summary", "sweep", "two_phase"]
