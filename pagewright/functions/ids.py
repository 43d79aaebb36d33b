"""Version-5 UUIDs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.config import NAMESPACE


def key_of(file_name, correspondence_type, case_ref, page_num=None, chunk_index=None) -> Column:
    """The natural key: names trimmed and in lower case, then the numbers that aren't null, joined by hyphens."""
    names = [F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (file_name, correspondence_type, case_ref)]
    numbers = [c.cast("string") for c in (page_num, chunk_index) if c is not None]
    return F.concat_ws("-", *names, *numbers)


def uuid5(key: Column, namespace: str = NAMESPACE) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(key, "UTF-8")))
    at = F.instr(F.lit("0123456789abcdef"), F.substring(h, 17, 1))
    variant = F.substr(F.lit("89ab89ab89ab89ab"), at, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
