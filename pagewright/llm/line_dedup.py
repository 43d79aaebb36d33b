"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, connected groups.

Everything is DataFrame expressions. Two lines are alike if at most a tenth of the longer one's characters must be
edited. A line's fingerprint is a SimHash in ``BLOCKS`` blocks: each feature of the line votes in one block alone, which
its hash chooses. So edits change the blocks of the edited features, and leave all others equal bit by bit: by the
pigeonhole principle, lines whose differing features lie in fewer blocks than there are share one. Blocks are keys of
candidates; the votes of all features give the line's whole SimHash, and candidates further than ``FAR`` bits apart
are left out before texts are compared.

Features are content words, or runs of letters where a line is short or has few words. Of a longer line, those vote
whose hash ends in zeros, a bit more for each doubling of the length, so that a block always holds a few. Levels of length
overlap by more than a tenth, so that lines that may be alike always have blocks of one level.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.base import Kept, table, uncoalesced
from pagewright.llm.links import resolve

#: The share of characters that may be edited; bits of two SimHashes that may differ (unrelated lines: 28 on average).
EDITS, FAR = 0.1, 19
#: Blocks of a fingerprint.
BLOCKS = 7
#: Kinds of features: lengths of lines from and below which they are taken, the length from which all of them vote (half
#: of them from twice that length, and so on), and features of a block, at least.
KINDS = {"few twos": (9, 34, None, 2), "twos": (31, 60, None, 3), "fours": (54, 200, 25, 3), "words": (180, 2**31 - 1, 160, 3)}
#: Under so many different features, a longer line is of a kind of its own: all of them vote, every block counts, and as one
#: more feature easily changes all blocks, they are dealt out anew so many times.
DULL, DEALS = 12, 4
#: Dull lines from this length on link by equality alone: each pair of them would take time with the square of the length.
DULL_SIZE = 1000
#: Letters of a content word, at least; a line has few words if there is under one in so many characters.
LETTERS, FEW_WORDS = 4, 16
#: Sums that hold votes: each has seven counters of eight bits, for every eighth bit of a hash.
SUMS = 8
_COUNTERS = sum(1 << 8 * i for i in range(7))
#: Bits for the runs of two letters that a line has. An edit takes at most two of them away, so that a line may lack at most
#: twice as many of the other's bits as characters may be edited. Longer lines hold most bits, and have none set.
BITS = 128
#: Letters that are counted for each line, a byte each; a last count is of all other characters. Half the sum of what two lines'
#: counts and lengths differ by is at most the number of edits between them.
LETTERS_COUNTED = " entihaorsdulcg"
#: All but letters, marks, digits and line breaks; a line without any letter stands as it is.
_NO_WORD = r"[^\p{L}\p{M}\p{N}\n]+"
#: Unsettled lines of a key that are paired by a join where their SimHashes are near, and however far these are; of more lines, the
#: short ones are paired that share a segment.
CROWD, DIRECT = 32, 128
#: Characters of a segment, and the length of the lines from which segments are so long. Disjoint ones fit in for one more than
#: there may be edits, so that one at least stands in any line that is alike.
SEGMENTS = {4: 0, 6: 12, 7: 28, 8: 72}
#: Texts are moved in so many parts after each other, so that shuffle files of a part at most lie on disk.
PARTS = 2
#: So are the segments of crowded keys, by key.
KEY_PARTS = 4
#: Lines are sought by pages of bits, one for each of 4,096 line numbers. Up to so many pages, some 600 bytes each, are sent to every
#: task; more lines are joined where their numbers lie.
FEW = 100_000


def own_key() -> list[Column]:
    """What names a document: its id and 128 bits of its text."""
    text = F.col("text").cast("string")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(1), text).alias("text_hash2")]


OWN = ["doc_id", "text_hash", "text_hash2"]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text_hash2, line_no, norm, size, h1, h2 (128 bits of norm) of lines that aren't blank.

    norm: lower-cased words with single blanks between them.
    """
    low = docs.select(*own_key(), F.lower(F.col("text").cast("string")).alias("low"))
    both = F.arrays_zip(F.split(F.regexp_replace("low", _NO_WORD, " "), "\n").alias("words"), F.split("low", "\n").alias("line"))
    split = low.select(*OWN, F.posexplode(both).alias("line_no", "both")).select(*OWN, "line_no", F.trim("both.words").alias("words"), F.col("both.line").alias("line"))
    # only lines without a word need their marks, which take long to trim
    marks = F.trim(F.translate("line", "\t\r\x0b\f", "    "))
    normed = split.select(*OWN, "line_no", F.when(F.col("words") != "", F.col("words")).otherwise(marks).alias("norm")).filter("norm <> ''")
    return normed.select("*", F.length("norm").alias("size"), F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(1), "norm").alias("h2"))


def majority(sums: list[Column], n: Column) -> Column:
    """The bits that more than half of ``n`` hashes have, from sums of the counters. Counters of more than 255 votes run
    over, always alike."""
    lift = (F.lit(127) - F.shiftright(F.least(n, F.lit(255)), 1)).cast("long") * _COUNTERS  # so that a counter's top bit tells
    bits = [F.shiftright(F.coalesce(F.try_add(s, lift), F.lit(0).cast("long")), 7).bitwiseAND(F.lit(_COUNTERS)) * (1 << i) for i, s in enumerate(sums)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def _kinds(size: Column) -> Column:
    """tag, level: the kinds of features and the levels that a line of this length has."""
    found = []
    for tag, (low, high, whole, _) in enumerate(KINDS.values()):
        levels = [F.lit(0)]
        if whole:
            level = lambda length: F.greatest(F.floor(F.log2(size / F.lit(length))).cast("int"), F.lit(0))
            upper, lower = level(whole * 0.9), level(whole)
            levels = [lower, F.when(upper != lower, upper)]
        found += [F.when((size >= low) & (size < high) & k.isNotNull(), F.struct(F.lit(tag).alias("tag"), k.alias("level"))) for k in levels]
    return F.array_compact(F.array(*found))


def _letters(norm: Column, size: Column) -> list[Column]:
    """Two sums of eight bytes with how often the line has each letter of ``LETTERS_COUNTED`` and any other; 255 stands for more."""
    held = [F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(x), F.lit(""))) for x in LETTERS_COUNTED]
    held.append(size - sum(held[1:], held[0]))
    counts = [F.shiftleft(F.least(n, F.lit(255)).cast("long"), 8 * (i % 8)) for i, n in enumerate(held)]
    return [reduce(lambda x, y: x.bitwiseOR(y), counts[:8]).alias("letters"), reduce(lambda x, y: x.bitwiseOR(y), counts[8:]).alias("others")]


def fingerprints(lines: DataFrame) -> DataFrame:
    """node, sim, low, high, letters, others, keys of lines (node, size, norm): for each of a line's kinds and levels its SimHash, the
    bits of its runs of two letters if they are its features, the counts of its letters, and a key for each block with enough
    features, as others would tell nothing. Votes are sums, made where the lines lie if node deals them out. Counts of letters aren't
    made if they are dropped."""
    counted = lines.select("node", "size", "norm", *_letters(F.col("norm"), F.col("size")))
    own = counted.select("node", "size", "letters", "others", "norm", F.explode(_kinds(F.col("size"))).alias("kind")).select("node", "size", "letters", "others", "norm", "kind.*")
    runs = {n: F.regexp_extract_all("norm", F.lit(f"(?s)(?=({'.' * n}))"), 1) for n in (2, 4)}
    n_words = F.col("size") - F.length(F.replace("norm", F.lit(" "))) + 1
    features = F.when(F.col("tag") < 2, runs[2]).when((F.col("tag") == 2) | (n_words * FEW_WORDS < F.col("size")), runs[4]).otherwise(F.split("norm", " "))
    own = own.select("node", "size", "letters", "others", "tag", "level", F.array_distinct(features).alias("features"))
    dull = (F.col("tag") > 1) & (F.size("features") < DULL) & (F.col("size") < DULL_SIZE)
    levels = F.when(dull, F.sequence(F.lit(0), F.lit(DEALS - 1))).otherwise(F.array("level"))
    own = own.select("node", "size", "letters", "others", F.when(dull, len(KINDS)).otherwise(F.col("tag")).alias("tag"), F.explode(levels).alias("level"), "features")
    line, counts = ["node", "size", "tag", "level"], ["letters", "others"]
    # an inner explode gets a filter on its array, which would make all features again for each of its conditions
    each = own.select(*line, *counts, F.explode_outer("features").alias("feature")).filter(F.col("feature").isNotNull() & ((F.col("tag") != 3) | (F.length("feature") >= LETTERS))).select(*line, *counts, F.when(F.col("tag") == len(KINDS), F.xxhash64("feature", "level")).otherwise(F.xxhash64("feature")).alias("h"))
    voting = each.filter((F.col("tag") == len(KINDS)) | (F.col("h").bitwiseAND(F.expr("shiftleft(1L, level) - 1")) == 0))
    zero = F.lit(0).cast("long")
    votes = [F.coalesce(F.try_sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_COUNTERS))), zero).alias(f"s{i}") for i in range(SUMS)]
    place = F.shiftright("h", 56).bitwiseAND(F.lit(BITS - 1)).cast("int")
    bit = lambda first: F.bit_or(F.when((F.col("tag") < 2) & (place >= first) & (place < first + 64), F.expr("1L << cast(shiftright(h, 56) & 63 AS int)")).otherwise(zero))
    blocks = voting.groupBy(*line, F.pmod("h", F.lit(BLOCKS)).cast("int").alias("block")).agg(*votes, bit(0).alias("low"), bit(64).alias("high"), F.count("*").cast("int").alias("n"), *[F.max(c).alias(c) for c in counts])
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS.values()], F.lit(1)), F.col("tag") + 1)
    sums = [F.col(f"s{i}") for i in range(SUMS)]
    keyed = blocks.withColumn("key", F.when(F.col("n") >= least, F.xxhash64("tag", "level", "block", majority(sums, F.col("n")))))
    whole = [F.coalesce(F.try_sum(x), zero).alias(f"s{i}") for i, x in enumerate(sums)]
    voted = keyed.groupBy(*line).agg(*whole, F.bit_or("low").alias("low"), F.bit_or("high").alias("high"), F.sum("n").cast("int").alias("n"), *[F.max(c).alias(c) for c in counts], *[F.max(F.when(F.col("block") == b, F.col("key"))).alias(f"key_{b}") for b in range(BLOCKS)])
    sim = F.when(F.col("tag") == len(KINDS), zero).otherwise(majority(sums, F.col("n")))  # that of a few features tells nothing
    return voted.select("node", "size", sim.alias("sim"), "low", "high", "letters", "others", F.array_compact(F.array(*[F.col(f"key_{b}") for b in range(BLOCKS)])).alias("keys"))


def _may(one: Column, two: Column) -> Column:
    """Lengths and runs of two letters allow a link, and SimHashes are near."""
    return (F.bit_count(one["sim"].bitwiseXOR(two["sim"])) <= FAR) & _runs_allow(one, two)


def _runs_allow(one: Column, two: Column) -> Column:
    """Lengths and runs of two letters allow a link."""
    a, b = one["size"], two["size"]
    most = F.floor(F.greatest(a, b) * EDITS)
    lacks = lambda x, y: sum(F.bit_count(x[w].bitwiseAND(F.bitwise_not(y[w]))) for w in ("low", "high")) <= 2 * most
    return (F.abs(a - b) <= most) & lacks(one, two) & lacks(two, one)


def _letters_allow(one: Column, two: Column) -> Column:
    """Lengths and counts of letters allow a link: an edit makes one letter less, another one more, or both. Unlike the bits of
    runs, counts tell lines of any length apart."""
    a, b = one["size"], two["size"]
    byte = lambda x, i: F.shiftrightunsigned(x, i).bitwiseAND(F.lit(255))
    apart = [F.abs(byte(one[w], i) - byte(two[w], i)) for w in ("letters", "others") for i in range(0, 64, 8)]
    return sum(apart[1:], apart[0]) + F.abs(a - b) <= 2 * F.floor(F.greatest(a, b) * EDITS)


def _near(one: Column, two: Column) -> Column:
    return _may(one, two) & _letters_allow(one, two)


def _wide(one: Column, two: Column) -> Column:
    """All that a link needs, however far the SimHashes are."""
    return _runs_allow(one, two) & _letters_allow(one, two)


def _shared(x: Column, y: Column) -> Column:
    """How many characters both start with, by halving steps."""
    same = lambda at, step: F.substring(x, at + 1, step) == F.substring(y, at + 1, step)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(22))])
    return F.aggregate(F.filter(steps, lambda s: s <= F.least(F.length(x), F.length(y))), F.lit(0), lambda at, step: at + F.when(same(at, step), step).otherwise(0))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is made once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _alike(x: Column, y: Column) -> Column:
    """At most a tenth of the longer line is edited.

    Edits word by word are never fewer than the least edits, so lines of as many words are alike for sure if those are few
    enough. Else the least edits are counted of what is left when the common ends are cut off, as time goes with its square.
    """
    most = F.floor(F.greatest(F.length(x), F.length(y)) * EDITS).cast("int")
    one, two = F.split(x, " "), F.split(y, " ")
    by_word = F.aggregate(F.zip_with(one, two, lambda a, b: F.when(a == b, 0).otherwise(F.levenshtein(a, b))), F.lit(0), lambda n, d: n + d)
    cut = lambda z, at: F.struct(F.reverse(F.substring(z["x"], at + 1, F.length(z["x"]))).alias("x"), F.reverse(F.substring(z["y"], at + 1, F.length(z["y"]))).alias("y"))
    ended = lambda z: _let(_shared(z["x"], z["y"]), lambda at: cut(z, at))
    least = _let(ended(F.struct(x.alias("x"), y.alias("y"))), lambda r: _let(ended(r), lambda z: F.call_function("levenshtein", z["x"], z["y"], most) >= 0))
    near = F.when((F.size(one) == F.size(two)) & (by_word <= most), True).otherwise(least)
    return F.when(F.abs(F.length(x) - F.length(y)) <= most, near).otherwise(False)


def _segment_size(size: Column) -> Column:
    return reduce(lambda x, q: F.when(size >= SEGMENTS[q], q).otherwise(x), list(SEGMENTS)[1:], F.lit(next(iter(SEGMENTS))))


def _sharing_segments(crowds: DataFrame) -> DataFrame:
    """(a, b) of lines of several groups of a key, all that may be alike among them: the longer line has one of the shorter
    line's segments, moved by no more characters than may be edited.

    A line of n characters is alike to none longer than n / 0.9, which allows n / 9 edits. Each spoils one of the disjoint
    segments at most, so that one is whole of n / 9 and one more.
    """
    size = F.length("load")
    sized = crowds.select("key", "node", "root", "most", "load", size.alias("size"), F.struct(*_letters(F.col("load"), size)).alias("held")).select("*", "held.*").withColumn("most_edits", F.floor(F.col("size") * EDITS).cast("int"))
    own, least = _segment_size(F.col("size")), _segment_size(F.col("size") - F.col("most_edits"))
    runs = lambda q: F.regexp_extract_all("load", F.concat(F.lit("(?s)(?=(.{"), q.cast("string"), F.lit("}))")), 1)
    # outsiders meet all lines of the key; those of its largest group, which share a root, don't meet each other
    outside = F.col("root") != F.col("most")
    named = F.xxhash64("key", "q", "turn", "segment").alias("h")
    place = F.transform(F.sequence(F.lit(0), F.floor(F.col("size") * (EDITS / (1 - EDITS)) + 1e-6).cast("int")), lambda i: F.struct((i * F.col("q")).alias("at"), F.substring("load", i * F.col("q") + 1, F.col("q")).alias("segment")))
    held = sized.withColumn("q", own).select("key", "node", "root", "size", "letters", "others", "q", F.when(outside, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("turns"), F.explode(place).alias("s")).select("key", "node", "root", "size", "letters", "others", "q", "s.*", F.explode("turns").alias("turn"))
    asked = sized.select("key", "node", "root", "size", "letters", "others", "most_edits", F.when(outside, 0).otherwise(1).alias("turn"), "load", F.explode(F.array_distinct(F.array(own, least))).alias("q"))
    asked = asked.select("key", "node", "root", "size", "letters", "others", "most_edits", "turn", "q", F.posexplode(runs(F.col("q"))).alias("at", "segment"))
    one = held.select(named, F.col("node").alias("x"), F.col("root").alias("root_x"), F.col("size").alias("size_x"), F.col("at").alias("at_x"), F.col("letters").alias("letters_x"), F.col("others").alias("others_x"))
    two = asked.select(named, "node", "root", "size", "most_edits", "at", "letters", "others")
    near = (F.col("root_x") != F.col("root")) & (F.col("size_x") <= F.col("size")) & (F.col("size") - F.col("size_x") <= F.col("most_edits")) & (F.abs(F.col("at") - F.col("at_x")) <= F.col("most_edits"))
    near = near & _letters_allow(*({c: F.col(f"{c}{end}") for c in ("size", "letters", "others")} for end in ("_x", "")))
    return one.join(two.hint("shuffle_hash"), "h").filter(near).select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _long_in_keys(crowds: DataFrame) -> DataFrame:
    """(a, b) of lines of several groups of a key whose lengths, and counts of letters if traits have them, allow a link, each pair in one key alone.

    For keys of more than runs of two letters: lines that share one are much the same text and hold most of each other's
    segments, so that segments would leave out hardly a pair, and give it once for each of them.
    """
    keys = crowds.groupBy("node").agg(F.collect_set("key").alias("keys"))
    counts = [F.col(f"trait.{c}") for c in ("letters", "others") if c in crowds.schema["trait"].dataType.names]
    lines = crowds.select("key", "node", "root", F.col("trait.size").alias("size"), (F.col("root") != F.col("most")).alias("outside"), *counts).join(keys, "node")
    one, two = (df.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "size", "outside", "keys", *(["letters", "others"] if counts else []))]) for s, df in (("a", lines.filter("outside")), ("b", lines)))
    once = ~F.col("outside_b") | (F.col("node_a") < F.col("node_b"))
    near = F.abs(F.col("size_a") - F.col("size_b")) <= F.floor(F.greatest("size_a", "size_b") * EDITS)
    if counts:
        near = near & _letters_allow(*({c: F.col(f"{c}_{end}") for c in ("size", "letters", "others")} for end in "ab"))
    first = F.col("key") == F.array_min(F.array_intersect("keys_a", "keys_b"))
    return one.join(two, "key").filter((F.col("root_a") != F.col("root_b")) & once & near & first).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def _in_crowds(kept: Kept, crowds: DataFrame) -> DataFrame:
    """Pairs of crowded keys: by segments where the features are runs of two letters, whose bits are then set, as many
    unlike lines share such a key; by lengths and letters where they are not. A pair is met in a key where one of both is outside
    its largest group, as lines of one group aren't paired in any."""
    short = (F.col("trait.low") != 0) | (F.col("trait.high") != 0)
    # a part after the other, so that the segments of a part at most lie on disk
    parts = [_sharing_segments(crowds.filter(short & (F.pmod(F.xxhash64("key"), F.lit(KEY_PARTS)) == i))) for i in range(KEY_PARTS)]
    return reduce(DataFrame.unionByName, [kept.write(found) for found in [*parts, _long_in_keys(crowds.filter(~short))]])


def _alike_in_blocks(blocks: DataFrame) -> DataFrame:
    """(a, b) of each outsider and, of every other group in its block, one line that is alike: all pairs, which the tests
    hold ``_sharing_segments`` against."""

    # blocks are few bytes and much work, so they are dealt out by their number
    dealt = blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # pairs are rows inside one compiled stage, as lambdas over arrays are interpreted for each pair
    pairs = dealt.select("members", F.explode("outsiders").alias("one")).select("one", F.explode("members").alias("two"))
    near = pairs.filter((F.col("two.root") != F.col("one.root")) & _may(F.col("one.trait"), F.col("two.trait")))
    # a number of each row's own keeps this filter from joining the one before, which it would take out of the compiled stage
    numbered = near.select(F.col("one.node").alias("a"), F.col("two.root").alias("root"), F.col("two.node").alias("b"), F.col("one.load").alias("x"), F.col("two.load").alias("y"), F.monotonically_increasing_id().alias("n"))
    found = numbered.filter(_alike(F.col("x"), F.col("y")) & (F.col("n") >= 0))
    return found.groupBy("a", "root").agg(F.min("b").alias("b")).select("a", "b")


def _pages(nodes: DataFrame) -> DataFrame:
    """page, bits: for each 4,096 numbers among which are some of ``nodes``, 64 longs with a bit for each that is. Numbers may repeat."""
    words = nodes.groupBy(F.shiftright("node", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(node & 63L AS int))")).alias("bits"))
    held = words.groupBy(F.shiftright("word", 6).alias("page")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(F.lit(63)).cast("int").alias("at"), "bits"))).alias("held"))
    return held.select("page", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long"))).alias("bits"))


def _on_pages(df: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows of ``df`` whose node has a bit; they stay where they lie."""
    bit = F.expr("getbit(get(bits, cast(shiftright(node, 6) & 63L AS int)), cast(node & 63L AS int)) = 1")
    return df.join(F.broadcast(pages), (F.shiftright("node", 12) == F.col("page")) & bit).select(*df.columns)


def decide(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text_hash2, dropped (line numbers from 0, ascending): documents that lose lines."""
    kept = Kept(docs.sparkSession)
    # every line once with its text; what follows moves no text but that of one line of each kind
    lines = kept.write(lines_of(docs).withColumn("node", F.monotonically_increasing_id()), "zstd")
    place = F.struct(F.col("doc_id").isNull().alias("null"), *OWN, "line_no")
    kinds = kept.write(lines.groupBy("h1", "h2").agg(F.min("node").alias("node"), (F.count("*") > 1).alias("many")))
    parts = []
    for i in range(PARTS):
        texts, own = (df.filter(F.pmod(F.xxhash64("node"), F.lit(PARTS)) == i) for df in (lines.select("node", "size", "norm"), kinds.select("node")))
        parts.append(kept.write(fingerprints(texts.repartition("node").join(own.hint("shuffle_hash"), "node", "left_semi")).drop("letters", "others")))
    traits = reduce(DataFrame.unionByName, parts)
    # traits are moved for the few lines that share a key, and their exchange is one for the heads and for their members
    keyed = traits.select(F.explode("keys").alias("key"), "node")

    def among(nodes: DataFrame) -> Callable[[DataFrame], DataFrame]:
        pages = kept.write(_pages(nodes))
        few = pages.count() <= FEW
        return lambda df: _on_pages(df, pages) if few else df.join(nodes, "node", "left_semi")

    def texts_of(nodes: DataFrame) -> DataFrame:
        return among(nodes)(lines.select("node", F.col("norm").alias("load")))

    def with_traits(members: DataFrame) -> DataFrame:
        wanted = among(members.select("node"))
        counts = wanted(lines.select("node", "norm")).select("node", *_letters(F.col("norm"), F.length("norm")))
        own = wanted(traits).join(counts.hint("shuffle_hash"), "node").select("node", "keys", F.struct("size", "sim", "low", "high", "letters", "others").alias("trait"))
        # a line has traits of each of its kinds and levels, and a key is of one of them
        return members.join(own.hint("shuffle_hash"), "node").filter(F.array_contains("keys", F.col("key"))).select("key", "node", "head", "trait")

    def links(pairs: DataFrame) -> DataFrame:
        texts = kept.write(texts_of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))))
        two = pairs.join(texts.select(F.col("node").alias("a"), F.col("load").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("load").alias("y")), "b")
        with uncoalesced(docs.sparkSession):
            return kept.write(two.filter(_alike(F.col("x"), F.col("y"))).select("a", "b"))

    roots = resolve(kept, keyed, _near, links, texts_of, crowd=CROWD, in_crowds=lambda crowds: _in_crowds(kept, crowds), shared=with_traits, direct=DIRECT, wide=_wide)
    # every node of roots has a link
    many = kept.write(kinds.join(roots, "node", "left").filter(F.col("many") | F.col("root").isNotNull()).select("h1", "h2", F.coalesce("root", "node").alias("root")))
    placed = kept.write(lines.select(*OWN, "line_no", "h1", "h2").join(many.hint("shuffle_hash"), ["h1", "h2"]).select(*OWN, "line_no", "root"))
    stays = kept.write(placed.groupBy("root").agg(F.min(place).alias("stay")))
    lost = placed.join(stays, "root").filter(place != F.col("stay"))
    dropped = kept.write(lost.groupBy(*OWN).agg(F.array_sort(F.collect_set("line_no")).alias("dropped")))
    kept.keep_only(dropped)
    return dropped


def dedup(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text without the lines that are dropped, and ``dropped``, their numbers from 0.

    Of each connected group of alike lines the one stays that comes first by doc_id (null last), then text hash and
    line number; blank lines all stay. Lines of any length take part, and a very long text or line is read whole; a
    text without line breaks is one line; only lines of ``DULL_SIZE`` characters with hardly any different features link by equality alone. A null or empty text stays as it is. Rows that repeat both doc_id and text
    are one document, and each of them keeps what it keeps. An empty table gives no rows. Other columns pass through,
    whatever their names; only one named ``dropped`` is replaced.
    """
    return _with_dropped(docs, decide(docs)).withColumn("text", F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("dropped"), i)), "\n")))


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}0").eqNullSafe(F.col(f"{right}0")) & (F.col(f"{left}1") == F.col(f"{right}1")) & (F.col(f"{left}2") == F.col(f"{right}2"))


def _with_dropped(docs: DataFrame, lost: DataFrame) -> DataFrame:
    names = [c for c in docs.columns if c != "dropped"]
    left = docs.select(*names, *[c.alias(f"__own{i}") for i, c in enumerate(own_key())])
    right = lost.select(*[F.col(c).alias(f"__lost{i}") for i, c in enumerate(OWN)], "dropped")
    return left.join(right, _same("__own", "__lost"), "left").select(*names, "dropped")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document: its lines, how many are dropped, and their numbers. The texts aren't moved for that."""
    docs = table(spark, sf_dir, "documents")
    lost = decide(docs).select(*[F.col(c).alias(f"__lost{i}") for i, c in enumerate(OWN)], "dropped")
    own = docs.select(*[c.alias(f"__own{i}") for i, c in enumerate(own_key())], F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    joined = own.join(lost, _same("__own", "__lost"), "left")
    return joined.select(F.col("__own0").alias("doc_id"), "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join(F.transform("dropped", lambda x: x.cast("string")), ","), F.lit("")).alias("dropped"))
