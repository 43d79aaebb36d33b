"""Greedy segmentation of an ordered array: one fold, whose state is what the current segment needs to know."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column, Column], Column]


def starts(items: Column, state: dict[str, Column], begins: Step, then: Callable[[Column, Column, Column], dict[str, Column]]) -> Column:
    """Places from 0 at which segments start.

    state: the fields of the fold's state; begins(state, item): whether an item starts a segment, besides the first;
    then(state, item, new): the fields after the item. The state grows only by the starts, never by the items.
    """
    indexed = F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    first = F.struct(*[v.alias(k) for k, v in state.items()], F.array().cast("array<int>").alias("starts"))

    def merge(a: Column, e: Column) -> Column:
        new = (e["i"] == 0) | F.coalesce(begins(a, e["x"]), F.lit(False))
        fields = [v.cast(_type(state[k])).alias(k) if _type(state[k]) else v.alias(k) for k, v in then(a, e["x"], new).items()]
        return F.struct(*fields, F.when(new, F.array_append(a["starts"], e["i"])).otherwise(a["starts"]).alias("starts"))

    return F.aggregate(indexed, first, merge, lambda a: a["starts"])


def _type(column: Column) -> str | None:
    return getattr(column, "_kind", None)


def typed(value, kind: str) -> Column:
    """A start value whose type all later values are cast to."""
    column = F.lit(value).cast(kind)
    column._kind = kind
    return column


def segments(items: Column, at: Column) -> Column:
    """The segments as arrays."""
    return F.transform(at, lambda s, i: F.slice(items, s + 1, F.coalesce(F.get(at, i + 1), F.size(items)) - s))
