"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that term matching leaves out.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the to was were will with she they this had have been would could should may might can but not no so if than then these those what which who whom whose when where why how all each every both few more most other some such only own same into over through during before after above below between under again further once here there any about"
).split()
#: Words that the index's analyser leaves out.
INDEX_STOP_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()
BLANKS = "[ \t\r\n]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda x: x != "")


def normalized(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))


def ends_sentence(text: Column) -> Column:
    return F.right(F.rtrim(text), F.lit(1)).isin(".", "?", "!")


def tokens(text: Column) -> Column:
    """Runs of letters, digits and underscores of any script, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def letters(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))


def without(found: Column, stop: list[str]) -> Column:
    held = F.array(*[F.lit(w) for w in stop])
    return F.filter(found, lambda x: ~F.array_contains(held, F.lower(x)))


def occurrences(text: Column, term: Column) -> Column:
    """How often the term stands in the text, without overlaps and in any case; 0 if either is empty."""
    t, s = F.lower(text), F.lower(term)
    return F.when((F.length(s) == 0) | (F.length(t) == 0) | s.isNull() | t.isNull(), F.lit(0)).otherwise(((F.length(t) - F.length(F.replace(t, s, F.lit("")))) / F.greatest(F.length(s), F.lit(1))).cast("int"))


def listed(text: Column) -> Column:
    """A comma list's parts, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def safe_int(text: Column) -> Column:
    return F.coalesce(F.trim(text).try_cast("int"), F.lit(0))
