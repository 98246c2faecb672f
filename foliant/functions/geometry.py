"""Rectangles on pages, sort indexes and vectors, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION = "pageIndex int, rects array<array<double>>"


def position(col: Column) -> Column:
    """The JSON position of an annotation as a struct."""
    return F.from_json(col, POSITION)


def flipped(rects: Column, page_height: Column) -> Column:
    """Rectangles with the y axis turned over: from the top to from the bottom of the page, or back."""
    return F.transform(rects, lambda r: F.array(r[0], page_height - r[3], r[2], page_height - r[1]))


def least_edge(rects: Column, k: int) -> Column:
    return F.array_min(F.transform(rects, lambda r: r[k]))


def sort_index(page: Column, y: Column, x: Column) -> Column:
    """Page, vertical and horizontal place as a text that sorts in reading order."""
    return F.format_string("%05d|%06d|%05d", page.cast("int"), y.cast("int"), x.cast("int"))


def area_is_valid(x: Column, y: Column, w: Column, h: Column) -> Column:
    """A normalised rectangle: inside the page, with extent, all numbers finite."""
    finite = ~(F.isnan(x) | F.isnan(y) | F.isnan(w) | F.isnan(h))
    inside = (x >= 0) & (y >= 0) & (w > 0) & (w <= 1) & (h > 0) & (h <= 1) & (x + w <= 1) & (y + h <= 1)
    return F.coalesce(finite & inside, F.lit(False))


def area_rect(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """A normalised area (from the top) as a rectangle in page units (from the bottom), to four digits."""
    return F.array(*[F.round(v, 4) for v in (x * width, (1 - y - h) * height, (x + w) * width, (1 - y) * height)])


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
