"""Boxes are structs (x1, y1, x2, y2), half open on the right and below. All expressions are built-in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def from_array(c: Column) -> Column:
    return box(*[F.get(c, F.lit(i)) for i in range(4)])


def is_valid(b: Column) -> Column:
    return (b["x1"] >= 0) & (b["y1"] >= 0) & (b["x2"] > b["x1"]) & (b["y2"] > b["y1"])


def inside(inner: Column, outer: Column) -> Column:
    return (inner["x1"] >= outer["x1"]) & (inner["y1"] >= outer["y1"]) & (inner["x2"] <= outer["x2"]) & (inner["y2"] <= outer["y2"])


def in_page(b: Column, width: Column, height: Column) -> Column:
    return is_valid(b) & (b["x2"] <= width) & (b["y2"] <= height)


def shift(b: Column, dx: Column, dy: Column) -> Column:
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def overlaps(a: Column, b: Column) -> Column:
    """Strictly: touching boxes do not overlap."""
    return (F.greatest(a["x1"], b["x1"]) < F.least(a["x2"], b["x2"])) & (F.greatest(a["y1"], b["y1"]) < F.least(a["y2"], b["y2"]))


def overlap_1d(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1))


def overlap_ratio(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Shared length over the shorter side (1 at least)."""
    return overlap_1d(a1, a2, b1, b2) / F.greatest(F.lit(1), F.least(a2 - a1, b2 - b1))


def gap_x(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), a["x1"] - b["x2"], b["x1"] - a["x2"])


def gap_y(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), a["y1"] - b["y2"], b["y1"] - a["y2"])


def gap(a: Column, b: Column) -> Column:
    return F.hypot(gap_x(a, b).cast("double"), gap_y(a, b).cast("double"))


def width(b: Column) -> Column:
    return b["x2"] - b["x1"]


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def aspect(b: Column, places: int = 3) -> Column:
    """Long side over short side, rounded half to even."""
    return F.bround(F.greatest(width(b), height(b)) / F.greatest(F.lit(1), F.least(width(b), height(b))), places)


def area_fraction(b: Column, page_width: Column, page_height: Column, places: int = 6) -> Column:
    return F.bround(area(b) / F.greatest(F.lit(1), page_width * page_height), places)


def edge_margin(size: Column, share: float = 0.01) -> Column:
    return F.greatest(F.lit(2), F.bround(size * share).cast("int"))


def touches_edge(b: Column, page_width: Column, page_height: Column) -> Column:
    mx, my = edge_margin(page_width), edge_margin(page_height)
    return (b["x1"] <= mx) | (b["y1"] <= my) | (b["x2"] >= page_width - mx) | (b["y2"] >= page_height - my)


def to_points(b: Column, page_width: Column, page_height: Column, out_width: float, out_height: float, margin: float = 0.0) -> Column:
    """Pixels to a page with its origin below: the page scaled to fit within the margin, centred, y turned over."""
    scale = F.least((F.lit(out_width) - 2 * margin) / page_width, (F.lit(out_height) - 2 * margin) / page_height)
    left, low = (F.lit(out_width) - page_width * scale) / 2, (F.lit(out_height) - page_height * scale) / 2
    return box(left + b["x1"] * scale, low + (page_height - b["y2"]) * scale, left + b["x2"] * scale, low + (page_height - b["y1"]) * scale)


def crop(fractions: Column, page_width: Column, page_height: Column) -> Column:
    """A box in shares of the page as pixels, rounded half to even."""
    r = lambda x: F.bround(x).cast("int")
    return box(r(fractions["x1"] * page_width), r(fractions["y1"] * page_height), r(fractions["x2"] * page_width), r(fractions["y2"] * page_height))


def free_intervals(low: Column, high: Column, blockers: Column, pad: float = 4.0, least: float = 54.0) -> Column:
    """What is left of [low, high] without the blockers (array of struct a, b), widened by ``pad``; pieces below ``least`` go."""
    d = lambda x: x.cast("double")
    span = lambda a, b: F.struct(d(a).alias("a"), d(b).alias("b"))

    def cut(state: Column, blocker: Column) -> Column:
        a, b = blocker["a"] - pad, blocker["b"] + pad
        return F.struct(F.concat(state["done"], F.array(span(state["at"], F.least(a, d(high))))).alias("done"), F.greatest(state["at"], d(b)).alias("at"))

    start = F.struct(F.expr("cast(array() as array<struct<a:double,b:double>>)").alias("done"), d(low).alias("at"))
    pieces = F.aggregate(F.array_sort(blockers), start, cut, lambda s: F.concat(s["done"], F.array(span(s["at"], high))))
    return F.filter(pieces, lambda p: p["b"] - p["a"] >= least)


def widest(intervals: Column) -> Column:
    """The widest interval, the first of several."""
    return F.aggregate(intervals, F.expr("cast(null as struct<a:double,b:double>)"), lambda best, p: F.when(best.isNull() | (p["b"] - p["a"] > best["b"] - best["a"]), p).otherwise(best))
