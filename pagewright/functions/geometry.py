"""Boxes: page geometry is kept in whole thousandths of the page, and turned into ratios on the way out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 1000.0


def box(left: Column, top: Column, right: Column, bottom: Column) -> list[Column]:
    """width, height, left, top, right, bottom as ratios, from thousandths."""
    return [((right - left) / UNITS).alias("width"), ((bottom - top) / UNITS).alias("height"), (left / UNITS).alias("left"), (top / UNITS).alias("top"), (right / UNITS).alias("right"), (bottom / UNITS).alias("bottom")]


def enclosing(prefix: str = "") -> list[Column]:
    """Aggregates for the box around all boxes."""
    return [F.min("left").alias(f"{prefix}left"), F.min("top").alias(f"{prefix}top"), F.max("right").alias(f"{prefix}right"), F.max("bottom").alias(f"{prefix}bottom")]


def edges(left: Column, top: Column, width: Column, height: Column) -> tuple[Column, Column, Column]:
    return left + width, top + height, top + height / 2
