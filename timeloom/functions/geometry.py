"""Quadrilaterals as arrays of struct(x, y)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BORDER_PX = 2  # fixed value: how near to the edge of a frame counts as touching it


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def centre(corners: Column) -> Column:
    n = F.size(corners)
    return F.struct((_sum(F.transform(corners, lambda p: p["x"].cast("double"))) / n).alias("x"), (_sum(F.transform(corners, lambda p: p["y"].cast("double"))) / n).alias("y"))


def distance(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def area(corners: Column) -> Column:
    """Area by the cross products of neighbouring corners."""
    following = F.concat(F.slice(corners, 2, 100), F.slice(corners, 1, 1))
    return F.abs(_sum(F.zip_with(corners, following, lambda p, q: (p["x"] * q["y"] - q["x"] * p["y"]).cast("double")))) / 2


def side(corners: Column, i: int, j: int) -> Column:
    return distance(F.get(corners, F.lit(i)), F.get(corners, F.lit(j)))


def aspect(corners: Column) -> Column:
    """Mean width over mean height of corners in order top-left, top-right, bottom-right, bottom-left; 0 without height."""
    width, height = (side(corners, 0, 1) + side(corners, 3, 2)) / 2, (side(corners, 0, 3) + side(corners, 1, 2)) / 2
    return F.when(height > 0, width / height).otherwise(0.0)


def touches_border(corners: Column, width: Column, height: Column) -> Column:
    return F.exists(
        corners,
        lambda p: (p["x"] <= BORDER_PX) | (p["y"] <= BORDER_PX) | (p["x"] >= width - 1 - BORDER_PX) | (p["y"] >= height - 1 - BORDER_PX),
    )


def order_corners(corners: Column) -> Column:
    """Clockwise by angle around the centroid, beginning with the corner of least x + y."""
    middle = centre(corners)
    keyed = F.transform(corners, lambda p: F.struct(F.atan2(p["y"] - middle["y"], p["x"] - middle["x"]).alias("a"), p["x"].alias("x"), p["y"].alias("y")))
    ring = F.transform(F.array_sort(keyed), lambda k: F.struct(k["x"].alias("x"), k["y"].alias("y")))
    sums = F.transform(ring, lambda p: p["x"] + p["y"])
    first = F.array_position(sums, F.array_min(sums)).cast("int")
    return F.concat(F.slice(ring, first, F.size(ring)), F.slice(ring, F.lit(1), first - 1))


def plausible_successor(previous: Column, current: Column, diagonal: Column, max_jump: float) -> Column:
    """Whether a centre can have moved that far in one step: at most a fraction of the diagonal; true without one."""
    return (diagonal <= 0) | (distance(previous, current) <= max_jump * diagonal)


def settled(centres: Column, diagonal: Column, max_jump: float) -> Column:
    """Whether a run of at least two centres stays together from each to the next."""
    pairs = F.zip_with(F.slice(centres, F.lit(2), F.greatest(F.size(centres) - 1, F.lit(0))), F.slice(centres, F.lit(1), F.greatest(F.size(centres) - 1, F.lit(0))), lambda b, a: distance(a, b))
    return (F.size(centres) >= 2) & ((diagonal <= 0) | F.forall(pairs, lambda d: d <= max_jump * diagonal))


def crop_bounds(rect: tuple[int, int, int, int], width: Column, height: Column) -> Column:
    """struct(x, y, w, h) of a rectangle cut to a frame; zero width or height where it lies outside."""
    x, y, w, h = rect
    left, top = F.least(F.lit(max(x, 0)), width), F.least(F.lit(max(y, 0)), height)
    right, bottom = F.greatest(left, F.least(F.lit(x + w), width)), F.greatest(top, F.least(F.lit(y + h), height))
    return F.struct(left.alias("x"), top.alias("y"), (right - left).alias("w"), (bottom - top).alias("h"))


def band_rects(top: Column, bottom: Column, width: Column, bands: dict[str, tuple[float, float, float, float]]) -> Column:
    """map(name -> struct(x, y, w, h)): bands given as fractions (y0, y1 of the extent, x0, x1 of the width); empty ones dropped."""
    entries = []
    for name, (y0, y1, x0, x1) in bands.items():
        cut = lambda size, f: F.bround(size * F.lit(f)).cast("int")
        high, low, left, right = top + cut(bottom - top, y0), top + cut(bottom - top, y1), cut(width, x0), cut(width, x1)
        entries += [F.lit(name), F.struct(left.alias("x"), high.alias("y"), (right - left).alias("w"), (low - high).alias("h"))]
    return F.map_filter(F.create_map(*entries), lambda _, r: (r["w"] >= 1) & (r["h"] >= 1))
