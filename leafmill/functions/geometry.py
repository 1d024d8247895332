"""Rectangles of flat polygons [x1, y1, x2, y2, ...] in inches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def xs(polygon: Column) -> Column:
    return F.filter(polygon, lambda v, i: i % 2 == 0)


def ys(polygon: Column) -> Column:
    return F.filter(polygon, lambda v, i: i % 2 == 1)


def bbox(polygon: Column) -> Column:
    """Least and greatest coordinates; null for fewer than four numbers."""
    box = F.struct(F.array_min(xs(polygon)).alias("x0"), F.array_min(ys(polygon)).alias("y0"), F.array_max(xs(polygon)).alias("x1"), F.array_max(ys(polygon)).alias("y1"))
    return F.when(F.size(polygon) >= 4, box)


def union_polygon(polygons: Column) -> Column:
    """The rectangle about all points, clockwise from the top left; empty without any."""
    x, y = F.flatten(F.transform(polygons, xs)), F.flatten(F.transform(polygons, ys))
    a, b, c, d = F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.array(a, b, c, b, c, d, a, d)).otherwise(F.array().cast("array<double>"))


def overlaps(a: Column, b: Column) -> Column:
    """Whether two boxes share area; touching edges don't, and a null box overlaps nothing."""
    hit = (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])
    return F.coalesce(hit, F.lit(False))


def overlap_ratio(box: Column, other: Column) -> Column:
    """The share of box that other covers."""
    w = F.greatest(F.lit(0.0), F.least(box["x1"], other["x1"]) - F.greatest(box["x0"], other["x0"]))
    h = F.greatest(F.lit(0.0), F.least(box["y1"], other["y1"]) - F.greatest(box["y0"], other["y0"]))
    return w * h / F.greatest((box["x1"] - box["x0"]) * (box["y1"] - box["y0"]), F.lit(1e-9))


def near(box: Column, other: Column, inches: float) -> Column:
    """Whether other meets box grown by inches on each side, edges included."""
    return (other["x1"] >= box["x0"] - inches) & (other["x0"] <= box["x1"] + inches) & (other["y1"] >= box["y0"] - inches) & (other["y0"] <= box["y1"] + inches)


def crop_rect(box: Column, page_width: Column, page_height: Column, padding: float) -> Column:
    """The padded box in points, clamped to the page; null if a point or less is left in either direction."""
    x0, y0 = F.greatest(F.lit(0.0), (box["x0"] - padding) * 72), F.greatest(F.lit(0.0), (box["y0"] - padding) * 72)
    x1, y1 = F.least(page_width * 72, (box["x1"] + padding) * 72), F.least(page_height * 72, (box["y1"] + padding) * 72)
    return F.when((x1 - x0 > 1) & (y1 - y0 > 1), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))
