"""Chunkers: word stream, line sentences, layout blocks, tables, and the merger of atomic chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.config import Layout, LineSentence, WordStream
from pagewright.functions import geometry, ids
from pagewright.operators.greedy import segments, starts, typed
from pagewright.sources.derived import layout_blocks, lines, meta, pages

ENDS = (".", "?", "!")


def _state(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _int(value) -> Column:
    return F.lit(value).cast("int")


def word_stream_starts(words: Column, config: WordStream) -> Column:
    """Places at which chunks start. A chunk ends with the first sentence end from its smallest size on, at its largest
    size, or before a gap, whichever comes first; one that is full without a sentence end is cut after the last
    sentence end among its last ``backward_words``, and what follows that stays open.

    How far is looked ahead for a sentence end doesn't matter: the nearest one that fits is met anyway, and a gap before it
    comes first either way. Sentence ends count only from ``asked`` on, as what is left after a cut isn't asked again.
    """
    gap = round(config.max_vertical_gap * geometry.UNITS)
    indexed = F.transform(words, lambda w, i: _state(i=i, top=w["top"], bottom=w["bottom"], ends=w["ends"]))
    first = _state(starts=F.array().cast("array<int>"), start=_int(0), asked=_int(0), ended=_int(-1), bottom=_int(None), closed=F.lit(True))

    def step(a: Column, w: Column) -> Column:
        new = a["closed"] | F.coalesce(w["top"] - a["bottom"] > gap, F.lit(False))
        start = F.when(new, w["i"]).otherwise(a["start"])
        size, asked = w["i"] - start + 1, F.when(new, w["i"]).otherwise(a["asked"])
        done = w["ends"] & (w["i"] >= asked) & (size >= config.min_words)
        full = ~done & (size >= config.max_words)
        cut = full & (a["ended"] >= F.greatest(start, w["i"] - config.backward_words + 1))
        starts = F.when(new, F.array_append(a["starts"], w["i"])).otherwise(a["starts"])
        return _state(
            starts=F.when(cut, F.array_append(starts, a["ended"] + 1)).otherwise(starts),
            start=F.when(cut, a["ended"] + 1).otherwise(start),
            asked=F.when(cut, w["i"] + 1).otherwise(asked),
            ended=F.when(w["ends"], w["i"]).otherwise(a["ended"]),
            bottom=w["bottom"].cast("int"),
            closed=done | (full & ~cut),
        )

    return F.aggregate(indexed, first, step, lambda a: a["starts"])


def word_stream(docs: DataFrame, config: WordStream = WordStream()) -> DataFrame:
    """Chunks of each page's words with their boxes; chunk_index starts anew on every page."""
    paged = pages(docs)
    cut = paged.withColumn("starts", word_stream_starts(F.col("words"), config))
    hand = F.exists("words", lambda w: w["text_type"] == "HANDWRITING")
    spaced = lambda c: F.trim(F.when(c.contains("  ") | c.contains("\t") | c.contains("\n"), F.regexp_replace(c, r"\s+", " ")).otherwise(c)) if config.normalize_spacing else F.trim(c)
    each = cut.select("doc_id", "page_num", hand.alias("page_contains_handwriting"), F.posexplode(segments(F.col("words"), F.col("starts"))).alias("chunk_index", "part"))
    part = F.col("part")
    return each.select(
        "doc_id", "page_num", "chunk_index", spaced(F.array_join(F.transform(part, lambda w: w["text"]), " ")).alias("chunk_text"), F.size(part).alias("n_words"),
        F.array_min(F.transform(part, lambda w: w["left"])).alias("left"), F.array_min(F.transform(part, lambda w: w["top"])).alias("top"),
        F.array_max(F.transform(part, lambda w: w["right"])).alias("right"), F.array_max(F.transform(part, lambda w: w["bottom"])).alias("bottom"), "page_contains_handwriting",
    )


def with_ids(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    """The document's metadata and the chunk's id."""
    about = meta(docs)
    key = ids.key_of(F.col("source_file_name"), F.col("correspondence_type"), F.col("case_ref"), F.col("page_num"), F.col("chunk_index"))
    return chunks.join(about, "doc_id").withColumn("chunk_id", ids.uuid5(key))


def line_sentence_starts(rows: Column, config: LineSentence) -> Column:
    """Places at which chunks of lines start: one fold, for which each line knows the nearest sentence end of it and the
    next three, and the words up to there.

    From its smallest size on, a chunk takes all lines up to that end if they fit its largest size, ends at its
    largest size, or is cut after the last sentence end of its last three lines. A line after a gap opens a chunk, and
    isn't asked for closing; lines that are taken up to a sentence end aren't asked for gaps.
    """
    gap = round(config.max_vertical_gap * geometry.UNITS)

    def known(x: Column, i: Column) -> Column:
        ahead = reduce(lambda found, j: found.when(F.get(rows, i + j)["ends"], _int(j)), range(1, 4), F.when(x["ends"], _int(0)))
        more = reduce(lambda total, j: total + F.when(ahead >= j, F.get(rows, i + j)["n_words"]).otherwise(0), range(1, 4), _int(0))
        return _state(i=i, top=x["top"], bottom=x["bottom"], n=x["n_words"], ends=x["ends"], ahead=ahead, more=more)

    # start and count: of the open chunk; ended: the last sentence end; after: words since then; taken: the last line that joins unasked
    first = _state(starts=F.array().cast("array<int>"), start=_int(0), count=_int(0), ended=_int(-1), after=_int(0), taken=_int(-1), bottom=_int(None), closed=F.lit(True))

    def step(a: Column, x: Column) -> Column:
        unasked = x["i"] <= a["taken"]
        far = ~unasked & F.coalesce(x["top"] - a["bottom"] > gap, F.lit(False))
        new = a["closed"] | far
        start = F.when(new, x["i"]).otherwise(a["start"])
        count = F.when(new, x["n"]).otherwise(a["count"] + x["n"])
        ended = F.when(x["ends"], x["i"]).otherwise(a["ended"])
        after = F.when(x["ends"], 0).when(new, x["n"]).otherwise(a["after"] + x["n"])
        asked = ~unasked & ~far & (count >= config.min_words)
        fits = asked & F.coalesce(count + x["more"] <= config.max_words, F.lit(False)) & x["ahead"].isNotNull()
        full = asked & ~fits & (count >= config.max_words)
        cut = asked & ~fits & ~full & (ended >= F.greatest(start, x["i"] - 2))
        taken = F.when(fits, x["i"] + x["ahead"]).otherwise(a["taken"])
        closed = full | ((unasked | fits) & (x["i"] == taken))
        starts = F.when(new, F.array_append(a["starts"], x["i"])).otherwise(a["starts"])
        return _state(
            starts=F.when(cut, F.array_append(starts, ended + 1)).otherwise(starts),
            start=F.when(cut, ended + 1).otherwise(start),
            count=F.when(cut, after).otherwise(count).cast("int"),
            ended=ended,
            after=after.cast("int"),
            taken=taken,
            bottom=F.when(~closed, x["bottom"]).cast("int"),
            closed=closed,
        )

    return F.aggregate(F.transform(rows, known), first, step, lambda a: a["starts"])


def usable_lines(docs: DataFrame) -> DataFrame:
    """Lines that are neither footers nor page numbers, nor blank."""
    return lines(docs).filter("top < 950").filter(~F.coalesce(F.trim("text").rlike(r"(?i)^Page\s*\d+"), F.lit(False))).filter(F.trim("text") != "")


def line_sentences(docs: DataFrame, config: LineSentence = LineSentence()) -> DataFrame:
    """Chunks of whole lines that end with sentences; a page's lines fit one array."""
    ends = F.right(F.rtrim("text"), F.lit(1)).isin(*ENDS)
    paged = usable_lines(docs).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("top", "line_pos", "bottom", "left", "right", "n_words", ends.alias("ends"), "text"))).alias("rows"))
    each = paged.select("doc_id", "page_num", F.posexplode(segments(F.col("rows"), line_sentence_starts(F.col("rows"), config))).alias("chunk_index", "part"))
    part = F.col("part")
    return each.select(
        "doc_id", "page_num", "chunk_index", F.array_join(F.transform(part, lambda x: x["text"]), " ").alias("chunk_text"), F.aggregate(part, _int(0), lambda n, x: (n + x["n_words"]).cast("int")).alias("n_words"),
        F.array_min(F.transform(part, lambda x: x["left"])).alias("left"), F.array_min(F.transform(part, lambda x: x["top"])).alias("top"),
        F.array_max(F.transform(part, lambda x: x["right"])).alias("right"), F.array_max(F.transform(part, lambda x: x["bottom"])).alias("bottom"),
    )


#: Numbers of the derived layout types.
_TYPES = {"SECTION_HEADER": (0,), "TEXT": (1, 2), "LIST": (3,), "TABLE": (4,)}


def _lines_of_blocks(docs: DataFrame, *kinds: str) -> DataFrame:
    """doc_id, page_num, p, items: the lines of blocks of the given layout types, in order."""
    own = lines(docs).filter("p >= 0").filter((F.col("p") % 5).isin(*[n for kind in kinds for n in _TYPES[kind]]))
    return own.groupBy("doc_id", "page_num", "p").agg(F.array_sort(F.collect_list(F.struct("row_no", "text", "left", "top", "right", "bottom"))).alias("items"), F.max("confidence").alias("confidence"))


def _exploded(cut: DataFrame, separator: str = " ", *more: str) -> DataFrame:
    part = F.col("part")
    return cut.select(
        "doc_id", "page_num", "p", "part_no", F.array_join(F.transform(part, lambda x: x["text"]), separator).alias("chunk_text"), F.array_min(F.transform(part, lambda x: x["left"])).alias("left"),
        F.array_min(F.transform(part, lambda x: x["top"])).alias("top"), F.array_max(F.transform(part, lambda x: x["right"])).alias("right"), F.array_max(F.transform(part, lambda x: x["bottom"])).alias("bottom"), "confidence", *more,
    )


def _packed(items: Column, config: Layout) -> Column:
    """Lines, packed while their text stays within the limit; a longer first line stays alone."""

    def then(a, x, new):
        size = F.length(F.trim(x["text"]))
        return {"size": F.when(new, size).otherwise(a["size"] + 1 + size)}

    at = starts(items, {"size": typed(0, "int")}, lambda a, x: a["size"] + 1 + F.length(F.trim(x["text"])) > config.max_chars, then)
    return segments(items, at)


def _single(items: Column) -> Column:
    """Each line that isn't blank, alone."""
    return F.transform(F.filter(items, lambda x: F.trim(x["text"]) != ""), lambda x: F.array(x))


def layout_text(docs: DataFrame, config: Layout = Layout(), kinds: tuple[str, ...] = ("SECTION_HEADER", "TEXT")) -> DataFrame:
    """A block's lines, packed while the text stays within the limit; a longer first line stays alone."""
    return _exploded(_lines_of_blocks(docs, *kinds).select("*", F.posexplode(_packed(F.col("items"), config)).alias("part_no", "part")))


def list_items(docs: DataFrame) -> DataFrame:
    """A chunk for each text of a list; blank ones and other children are left out."""
    return _exploded(_lines_of_blocks(docs, "LIST").select("*", F.posexplode("items").alias("part_no", "x")).filter("trim(x.text) <> ''").withColumn("part", F.array("x")))


def table_lines(docs: DataFrame, words_a_cell: int = 3) -> DataFrame:
    """Cells of tables: runs of three words of a visual row, with boxes and a small wobble of their tops."""
    from pagewright.sources.derived import words as all_words

    own = all_words(docs).filter("p % 5 = 4").withColumn("cell", F.floor(F.col("col_no") / words_a_cell).cast("int"))
    cells = own.groupBy("doc_id", "page_num", "p", "row_no", "cell").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col_no", "text"))), lambda x: x["text"]), " ").alias("text"), *geometry.enclosing())
    return cells.withColumn("top", F.col("top") + (F.col("cell") * 3 % 7)).withColumn("bottom", F.col("bottom") + (F.col("cell") * 3 % 7))


def visual_rows(blocks: DataFrame, config: Layout = Layout()) -> DataFrame:
    """Blocks of one table in visual rows: a row ends where a block's middle is too far from its first block's.

    Heights count as they are if over 0; without any such height every block is a row. Middles and the tolerance are
    compared in whole units: twice the middle, against the sum of heights, so that no fraction is rounded.
    """
    grouped = blocks.groupBy("doc_id", "page_num", "p").agg(F.array_sort(F.collect_list(F.struct("top", "left", "text", "right", "bottom"))).alias("items"))
    tall = F.filter(F.transform("items", lambda x: x["bottom"] - x["top"]), lambda h: h > 0)
    n, total = F.size(tall), F.aggregate(tall, F.lit(0), lambda a, h: a + h)
    grouped = grouped.withColumn("n_tall", n).withColumn("tall", total)

    def begins(a, x):
        off = F.abs(x["top"] + x["bottom"] - a["middle"])  # twice the distance
        return (F.col("n_tall") == 0) | (off * F.col("n_tall") >= 2 * F.col("tall") * config.y_tolerance)

    at = starts(F.col("items"), {"middle": typed(0, "int")}, begins, lambda a, x, new: {"middle": F.when(new, x["top"] + x["bottom"]).otherwise(a["middle"])})
    cut = grouped.withColumn("at", at).select("doc_id", "page_num", "p", F.posexplode(segments(F.col("items"), F.col("at"))).alias("row_no", "part"))
    part = F.array_sort(F.transform("part", lambda x: F.struct(x["left"].alias("left"), x["top"].alias("top"), x["text"].alias("text"), x["right"].alias("right"), x["bottom"].alias("bottom"))))
    return _exploded(cut.withColumn("part", part).withColumn("part_no", F.col("row_no")).withColumn("confidence", F.lit(None).cast("double")))


def line_table(blocks: DataFrame, config: Layout = Layout(), recovered: DataFrame | None = None) -> DataFrame:
    """One chunk for a table whose text is short, its rows joined by line breaks; else one for each row.

    ``recovered`` are lines that the table names but its children lack, as from ``missed_lines``: they join the rows.
    """
    names = ("doc_id", "page_num", "p", "text", "left", "top", "right", "bottom")
    if recovered is not None:
        blocks = blocks.select(*names).unionByName(recovered.select(*names))
    rows = visual_rows(blocks, config)
    whole = rows.groupBy("doc_id", "page_num", "p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part_no", "chunk_text"))), lambda x: x["chunk_text"]), "\n").alias("whole"), *geometry.enclosing("all_"))
    both = rows.join(whole, ["doc_id", "page_num", "p"])
    short = F.length("whole") < config.line_chunk_chars
    names = ("left", "top", "right", "bottom")
    one = whole.filter(short).select("doc_id", "page_num", "p", F.lit(0).alias("part_no"), F.col("whole").alias("chunk_text"), *[F.col(f"all_{n}").alias(n) for n in names])
    return one.unionByName(both.filter(~short).select("doc_id", "page_num", "p", "part_no", "chunk_text", *names))


def cell_rows(cells: DataFrame) -> DataFrame:
    """A table's rows from cells (row_no, cell): empty and repeated texts are left out, boxes of all cells count."""
    first = F.row_number().over(Window.partitionBy("doc_id", "page_num", "p", "row_no", "text").orderBy("cell")) == 1
    own = cells.withColumn("keep", first & (F.trim("text") != ""))
    out = own.groupBy("doc_id", "page_num", "p", "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct("cell", "text")))), lambda x: x["text"]), " ").alias("chunk_text"), *geometry.enclosing())
    return out.filter("chunk_text <> ''")


def key_values(blocks: DataFrame) -> DataFrame:
    """'key: value' of each pair; kinds other than pairs and lines, and halves without the other, give nothing."""
    key = F.trim(F.regexp_replace(F.trim(F.array_join(F.coalesce("key_words", F.array().cast("array<string>")), " ")), ":+$", ""))
    value = F.trim(F.coalesce("value", F.lit("")))
    made = F.when((F.col("kind") == "KEY_VALUE") & (key != "") & (value != ""), F.concat(key, F.lit(": "), value)).when((F.col("kind") == "LINE") & (value != ""), value)
    return blocks.withColumn("chunk_text", made).filter("chunk_text IS NOT NULL").drop("key_words", "value", "kind")


def atomic(docs: DataFrame, config: Layout = Layout()) -> DataFrame:
    """Every block routed to its type's chunker, and numbered within its page. Lines are derived once for all but tables."""
    items, kind = F.col("items"), F.col("p") % 5
    cut = F.when(kind.isin(*_TYPES["LIST"]), _single(items)).otherwise(_packed(items, config))
    blocks = _lines_of_blocks(docs, "SECTION_HEADER", "TEXT", "LIST")
    text = _exploded(blocks.select("*", F.posexplode(cut).alias("part_no", "part"))).withColumn("chunk_type", F.when(kind == 0, "LAYOUT_SECTION_HEADER").otherwise("LAYOUT_TEXT"))
    confidence = (F.lit(90) + F.col("p") % 10).cast("double")
    tables = line_table(table_lines(docs), config).withColumn("confidence", confidence).withColumn("chunk_type", F.lit("LAYOUT_TABLE"))
    return text.unionByName(tables).withColumn("chunk_index", F.row_number().over(Window.partitionBy("doc_id", "page_num").orderBy("p", "part_no")) - 1)


def merge(chunks: DataFrame, config: Layout = Layout()) -> DataFrame:
    """Atomic chunks of a page, merged while words and distance stay within limits; the first one's type stays."""
    gap = round(config.merge_gap * geometry.UNITS)
    count = F.size(F.filter(F.split("chunk_text", "[ \t\r\n]+"), lambda x: x != ""))
    grouped = chunks.withColumn("n", count).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("chunk_index", F.col("chunk_text").alias("text"), "n", "left", "top", "right", "bottom", "chunk_type", "confidence"))).alias("items"))
    at = starts(
        F.col("items"), {"n": typed(0, "int"), "bottom": typed(0, "int")},
        lambda a, x: (a["n"] + x["n"] > config.merge_words) | (F.abs(x["top"] - a["bottom"]) > gap),
        lambda a, x, new: {"n": F.when(new, x["n"]).otherwise(a["n"] + x["n"]), "bottom": x["bottom"]},
    )
    each = grouped.withColumn("at", at).select("doc_id", "page_num", F.posexplode(segments(F.col("items"), F.col("at"))).alias("part_no", "part"))
    first = F.get("part", F.lit(0))
    out = each.withColumn("p", F.lit(0)).withColumn("confidence", first["confidence"]).withColumn("chunk_type", first["chunk_type"])
    return _exploded(out, " ", "chunk_type").drop("p").withColumnRenamed("part_no", "chunk_index").withColumn("page_contains_handwriting", F.lit(False))


def missed_lines(edges: DataFrame, actual: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines that a table's CHILD links name, but its children lack: with text and a box."""
    lost = edges.join(actual, ["doc_id", "parent_id", "child_id"], "left_anti")
    return lost.join(blocks, ["doc_id", "child_id"]).filter("trim(text) <> '' AND width > 0 AND height > 0")


#: The strategies that callers choose by name.
STRATEGIES = {
    "textractor-word-stream": lambda docs: word_stream(docs),
    "linear-sentence-splitter": lambda docs: line_sentences(docs),
    "layout": lambda docs: merge(atomic(docs)),
}


def chunk(docs: DataFrame, strategy: str) -> DataFrame:
    name = strategy.strip().lower()
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; known: {', '.join(sorted(STRATEGIES))}")
    return STRATEGIES[name](docs)


__all__ = ["STRATEGIES", "chunk", "layout_blocks", "word_stream"]
