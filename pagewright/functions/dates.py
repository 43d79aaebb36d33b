"""Dates in texts: detection, extraction, and the ways of writing a date that searches try."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names, and the shapes in which dates are recognised.
FULL = "January|February|March|April|May|June|July|August|September|October|November|December"
SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
PATTERNS = [
    r"\b\d{1,2}/\d{1,2}/\d{2,4}\b",
    r"\b\d{1,2}-\d{1,2}-\d{2,4}\b",
    r"\b\d{1,2}\.\d{1,2}\.\d{2,4}\b",
    r"\b\d{4}-\d{1,2}-\d{1,2}\b",
    *[rf"\b\d{{1,2}}(?:st|nd|rd|th)\s+(?:{m})\s+\d{{2,4}}\b" for m in (FULL, SHORT, "Sept")],
    *[rf"\b\d{{1,2}}\s+(?:{m})\s+\d{{2,4}}\b" for m in (FULL, SHORT, "Sept")],
    *[rf"\b\d{{1,2}}-(?:{m})-\d{{2,4}}\b" for m in (FULL, SHORT, "Sept")],
    *[rf"\b(?:{m})\s+\d{{2,4}}\b" for m in (FULL, SHORT)],
    rf"\b(?:{SHORT})\s+\d{{1,2}},?\s+\d{{2,4}}\b",
]


def _let(value: Column, use) -> Column:
    """``use`` of a value that is made once, however often it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_date(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(f"(?i){p}") for p in PATTERNS])


def extracted(text: Column) -> Column:
    """All distinct dates, without those that stand inside a longer one; of twins in case the least. Sorted."""
    found = F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(f"(?i)({p})"), F.lit(1)) for p in PATTERNS]))
    unique = F.array_sort(F.array_distinct(found))
    least = lambda every: F.filter(every, lambda x: ~F.exists(every, lambda y: (F.lower(y) == F.lower(x)) & (y < x)))
    whole = lambda every: F.filter(every, lambda x: ~F.exists(every, lambda y: (F.length(y) > F.length(x)) & F.contains(F.lower(y), F.lower(x))))
    return _let(unique, lambda u: _let(least(u), whole))


#: The shapes of dates that name a day, month and year, as patterns and as formats.
SHAPES = [
    (r"^\d{4} \d{1,2} \d{1,2}$", "yyyy M d"),
    (r"^\d{1,2} \d{1,2} \d{4}$", "d M yyyy"),
    (r"^\d{1,2} \d{1,2} \d{2}$", "d M yy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{2}$", "d MMM yy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{2}$", "d MMMM yy"),
    (r"^[A-Za-z]{4,} \d{1,2} \d{4}$", "MMMM d yyyy"),
]


def parsed(date: Column) -> Column:
    """The day that a date with day, month and year names, day first; null for anything else."""
    plain = F.regexp_replace(F.regexp_replace(date, r"(?i)(\d)(st|nd|rd|th)\b", "$1"), r"(?i)\bSept\b", "Sep")
    plain = F.initcap(F.regexp_replace(F.regexp_replace(plain, r"[./-]", " "), r"[\s,]+", " "))
    return _let(plain, lambda p: F.coalesce(*[F.to_date(F.when(p.rlike(r), F.try_to_timestamp(p, F.lit(f)))) for r, f in SHAPES]))


def ordinal(day: Column) -> Column:
    return F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")


def variants(date: Column, day_of: Column | None = None) -> Column:
    """The ways of writing a date, itself among them, distinct and sorted; itself alone if it can't be parsed."""
    day = F.struct(date.alias("date"), (parsed(date) if day_of is None else day_of).alias("at"))
    return _let(day, lambda x: F.when(x["at"].isNull(), F.array(x["date"])).otherwise(_let(_named(x["date"], x["at"]), _ways)))


def _named(date: Column, at: Column) -> Column:
    """The parts that ways of writing a day are made of."""
    d, m = F.dayofmonth(at).cast("string"), F.month(at).cast("string")
    parts = {"date": date, "d": d, "m": m, "y": F.year(at).cast("string"), "dd": F.lpad(d, 2, "0"), "mm": F.lpad(m, 2, "0"), "full": F.date_format(at, "MMMM"), "short": F.date_format(at, "MMM"), "th": F.concat(d, ordinal(F.dayofmonth(at)))}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def _ways(x: Column) -> Column:
    d, m, y, dd, mm, full, short, th = (x[n] for n in ("d", "m", "y", "dd", "mm", "full", "short", "th"))
    ways = [x["date"], F.concat_ws("/", d, m, y), F.concat_ws("/", dd, mm, y), F.concat_ws("-", d, m, y), F.concat_ws("-", dd, mm, y), F.concat_ws("-", y, mm, dd)]
    ways += [F.concat_ws(" ", a, b, y) for b in (full, short) for a in (d, th)] + [F.concat_ws("-", d, b, y) for b in (full, short)]
    sept = F.when(m == "9", F.array(F.concat_ws(" ", d, F.lit("Sept"), y), F.concat_ws(" ", th, F.lit("Sept"), y), F.concat_ws("-", d, F.lit("Sept"), y))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(F.array(*ways), sept)))


def for_search(text: Column) -> Column:
    """Variants of all extracted dates, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(extracted(text), lambda x: variants(x)))))
