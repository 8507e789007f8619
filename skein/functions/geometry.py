"""Coordinates, boxes, colours and grids as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_pixels(x: Column, origin: Column, per_grid: Column, places: int = 2) -> Column:
    return F.round((x - origin) * per_grid, places)


def rgb_of_argb(color: Column) -> Column:
    return F.right(color, F.lit(6))


def chebyshev(a: list[Column], b: list[Column]) -> Column:
    return F.greatest(*[F.abs(x - y) for x, y in zip(a, b)])


def within(a: list[Column], b: list[Column], tolerance: int) -> Column:
    return chebyshev(a, b) <= tolerance


def anchored_box(fx: Column, fy: Column, width: Column, height: Column, base: Column, scale: Column, least: int = 64) -> Column:
    """Box of a sprite centred at fractions of a canvas, its side at least `least`."""
    side = F.greatest(F.lit(least), (base * scale).cast("int"))
    left = lambda f, total: (f * total).cast("int") - F.floor(side / 2).cast("int")
    return F.struct(left(fx, width).alias("x"), left(fy, height).alias("y"), side.alias("side"))


def square_crop(cx: Column, cy: Column, side: Column, width: Column, height: Column) -> Column:
    """A square around a centre, moved inside the canvas and no larger than it."""
    s = F.least(side, width, height)
    edge = lambda c, most: F.greatest(F.lit(0), F.least(c - F.floor(s / 2).cast("int"), most - s))
    return F.struct(edge(cx, width).alias("x"), edge(cy, height).alias("y"), s.alias("side"))


def hex_centre(col: Column, row: Column, edge: Column | float) -> Column:
    """Centre and axial coordinates of a flat-topped hexagon of an edge length in a grid whose odd columns are half a row lower; the
    hexagon (0, 0) is centred at the origin, columns and rows may be negative."""
    edge = F.lit(edge) if isinstance(edge, (int, float)) else edge
    odd = F.pmod(col, F.lit(2))
    down = F.lit(math.sqrt(3)) * edge
    y = row * down + F.when(odd == 1, down / 2).otherwise(F.lit(0.0))
    return F.struct((col * (F.lit(1.5) * edge)).alias("x"), y.alias("y"), col.alias("q"), (row - ((col - odd) / 2).cast("long")).alias("r"))


def arrow_head(x0: Column, y0: Column, x1: Column, y1: Column, size: float, spread: float = math.pi / 7) -> Column:
    """Corners of an arrow's head and the middle of its shaft."""
    angle = F.atan2(y1 - y0, x1 - x0)
    corner = lambda s: F.struct((x1 - size * F.cos(angle + F.lit(s))).alias("x"), (y1 - size * F.sin(angle + F.lit(s))).alias("y"))
    return F.struct(corner(spread).alias("left"), corner(-spread).alias("right"), F.struct(((x0 + x1) / 2).alias("x"), ((y0 + y1) / 2).alias("y")).alias("middle"))


def sector_angle(nth: Column, total: Column, base: Column, jitter: Column) -> Column:
    return base + F.lit(2 * math.pi) * nth / total + jitter


def latent_size(width: Column, height: Column, least: int) -> Column:
    """Width and height enlarged until the shorter is `least` (rounded half to even), then cut to multiples of 8."""
    short = F.least(width, height)
    scale = F.lit(float(least)) / short
    side = lambda x: F.floor(F.when(short < least, F.greatest(F.lit(least), F.bround(x * scale).cast("int"))).otherwise(x) / 8).cast("int") * 8
    return F.struct(side(width).alias("width"), side(height).alias("height"))


def spaced(count: Column, low: Column, high: Column) -> Column:
    """So many positions in the middles of equal parts of a stretch."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: low + (high - low) * (i + F.lit(0.5)) / count)).otherwise(F.array().cast("array<double>"))


def around(x: Column, y: Column, w: Column, h: Column, count: Column) -> Column:
    """So many points evenly along a rectangle's edge, clockwise from its upper left."""
    whole = 2 * (w + h)

    def point(i: Column) -> Column:
        d = whole * i / count
        px = F.when(d < w, x + d).when(d < w + h, x + w).when(d < 2 * w + h, x + w - (d - w - h)).otherwise(x)
        py = F.when(d < w, y).when(d < w + h, y + (d - w)).when(d < 2 * w + h, y + h).otherwise(y + h - (d - 2 * w - h))
        return F.struct(px.cast("double").alias("x"), py.cast("double").alias("y"))

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), point))


def png_size(content: Column) -> Column:
    """Width and height from a PNG's header; null for other bytes."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")
    return F.when(F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A", F.struct(number(17).alias("width"), number(21).alias("height")))
