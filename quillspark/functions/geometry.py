"""Rectangles as structs x0, y0, x1, y1 (doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))])


def area(r: Column) -> Column:
    return F.greatest(F.lit(0.0), r["x1"] - r["x0"]) * F.greatest(F.lit(0.0), r["y1"] - r["y0"])


def overlap_ratio(a: Column, b: Column) -> Column:
    """The share of a that b covers."""
    both = rect(F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"]))
    return F.when(area(a) > 0, area(both) / area(a)).otherwise(0.0)


def union(r: Column) -> Column:
    """Aggregate: the bounding box."""
    return rect(F.min(r["x0"]), F.min(r["y0"]), F.max(r["x1"]), F.max(r["y1"]))


def expand(r: Column, width: Column, height: Column, padding: float = 7.0) -> Column:
    return rect(F.greatest(F.lit(0.0), r["x0"] - padding), F.greatest(F.lit(0.0), r["y0"] - padding), F.least(width, r["x1"] + padding), F.least(height, r["y1"] + padding))


def text_like(r: Column, page_height: Column, pixel_width: Column, pixel_height: Column) -> Column:
    """Images of the size of a line of text, outside the margins."""
    inside = (r["y0"] >= 70.0) & (r["y1"] <= page_height - 65.0)
    return inside & (r["y1"] - r["y0"]).between(6.0, 24.0) & (r["x1"] - r["x0"] >= 6.0) & (pixel_width >= 8) & pixel_height.between(16, 80)
