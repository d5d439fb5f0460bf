"""Planar geometry and the UTM projection as column expressions.

A point is ``struct<x,y>``, a ring an array of points (closed), a polygon an array of rings
whose first is the outer one, and a shape an array of polygons, as a municipality may have
several parts. The projection is the published Krüger series for GRS80.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
SHAPE = f"array<array<array<{POINT}>>>"

# GRS80 ellipsoid and UTM zone 22 south.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
CENTRAL_MERIDIAN, SCALE = -51.0, 0.9996
FALSE_EASTING, FALSE_NORTHING = 500000.0, 10000000.0

_n = FLATTENING / (2 - FLATTENING)
_A = SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_E = 2 * math.sqrt(_n) / (1 + _n)
# Series coefficients to the third order in n.
ALPHA = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240)
BETA = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480)
DELTA = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


# The expressions below are SQL text: a formula reaches Spark as one expression, and each
# ``transform`` is a stage whose shared terms are computed once per point.


def _series(coef: tuple[float, ...], first: str, second: str, xi: str = "p.xi", eta: str = "p.eta") -> str:
    return " + ".join(f"{k!r}D * {first}({2 * j}D * {xi}) * {second}({2 * j}D * {eta})" for j, k in enumerate(coef, 1))


def ring_to_utm(ring: str) -> str:
    """SQL for longitude/latitude points to easting/northing, in metres."""
    conformal = f"""transform({ring}, p -> named_struct(
        't', sinh(atanh(sin(radians(p.y))) - {_E!r}D * atanh({_E!r}D * sin(radians(p.y)))),
        'd', radians(p.x - ({CENTRAL_MERIDIAN!r}D))))"""
    sphere = f"transform({conformal}, p -> named_struct('xi', atan2(p.t, cos(p.d)), 'eta', atanh(sin(p.d) / sqrt(1D + p.t * p.t))))"
    size = SCALE * _A
    return f"""transform({sphere}, p -> named_struct(
        'x', {FALSE_EASTING!r}D + {size!r}D * (p.eta + {_series(ALPHA, "cos", "sinh")}),
        'y', {FALSE_NORTHING!r}D + {size!r}D * (p.xi + {_series(ALPHA, "sin", "cosh")})))"""


def ring_to_lonlat(ring: str) -> str:
    """SQL for easting/northing points back to longitude/latitude in degrees."""
    size = SCALE * _A
    scaled = f"transform({ring}, p -> named_struct('xi', (p.y - {FALSE_NORTHING!r}D) / {size!r}D, 'eta', (p.x - {FALSE_EASTING!r}D) / {size!r}D))"
    sphere = f"""transform({scaled}, p -> named_struct(
        'xi', p.xi - ({_series(BETA, "sin", "cosh")}), 'eta', p.eta - ({_series(BETA, "cos", "sinh")})))"""
    conformal = f"transform({sphere}, p -> named_struct('chi', asin(sin(p.xi) / cosh(p.eta)), 'd', atan2(sinh(p.eta), cos(p.xi))))"
    latitude = " + ".join(f"{k!r}D * sin({2 * j}D * p.chi)" for j, k in enumerate(DELTA, 1))
    return f"transform({conformal}, p -> named_struct('x', {CENTRAL_MERIDIAN!r}D + degrees(p.d), 'y', degrees(p.chi + {latitude})))"


def _one_point(x: str, y: str) -> str:
    return f"array(named_struct('x', double({x}), 'y', double({y})))"


def utm(lon: str, lat: str) -> Column:
    """Projected point of two columns."""
    return F.expr(f"get({ring_to_utm(_one_point(lon, lat))}, 0)")


def lonlat(east: str, north: str) -> Column:
    """Geographic point of two projected columns."""
    return F.expr(f"get({ring_to_lonlat(_one_point(east, north))}, 0)")


def shape_to_utm(shape: str) -> Column:
    return F.expr(f"transform({shape}, g -> transform(g, r -> {ring_to_utm('r')}))")


def _segments(ring: str) -> str:
    """Consecutive point pairs of a closed ring."""
    n = f"greatest(size({ring}) - 1, 0)"
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (a, b) -> named_struct('a', a, 'b', b))"


def segments(shape: str) -> Column:
    """All edges of a shape, for ``strictly_inside``."""
    return F.expr(f"flatten(transform(flatten({shape}), r -> {_segments('r')}))")


def _ring_moments(ring: str) -> str:
    """Absolute area and area-weighted coordinates, taken relative to the first vertex."""
    local = f"""transform({_segments(ring)}, s -> named_struct(
        'ax', s.a.x - get({ring}, 0).x, 'ay', s.a.y - get({ring}, 0).y, 'bx', s.b.x - get({ring}, 0).x, 'by', s.b.y - get({ring}, 0).y))"""
    cross = "(s.ax * s.by - s.bx * s.ay)"
    return f"""aggregate({local}, named_struct('a', 0D, 'x', 0D, 'y', 0D),
        (m, s) -> named_struct('a', m.a + {cross} / 2D, 'x', m.x + (s.ax + s.bx) * {cross} / 6D, 'y', m.y + (s.ay + s.by) * {cross} / 6D),
        m -> named_struct('a', abs(m.a), 'x', m.x * signum(m.a) + get({ring}, 0).x * abs(m.a), 'y', m.y * signum(m.a) + get({ring}, 0).y * abs(m.a)))"""


def moments(shape: str) -> Column:
    """Struct ``a, x, y``: area and area-weighted coordinates, holes taken off, parts added up."""
    holes = "slice(g, 2, greatest(size(g) - 1, 0))"
    part = f"""aggregate(transform({holes}, r -> {_ring_moments('r')}), {_ring_moments('get(g, 0)')},
        (m, h) -> named_struct('a', m.a - h.a, 'x', m.x - h.x, 'y', m.y - h.y))"""
    return F.expr(
        f"""aggregate(transform({shape}, g -> {part}), named_struct('a', 0D, 'x', 0D, 'y', 0D),
        (m, h) -> named_struct('a', m.a + h.a, 'x', m.x + h.x, 'y', m.y + h.y))"""
    )


def area(shape: str) -> Column:
    return moments(shape)["a"]


def centroid_of(moments: str) -> Column:
    """Centroid point of a column of moments; null for an area of zero."""
    return F.expr(f"if({moments}.a > 0, named_struct('x', {moments}.x / {moments}.a, 'y', {moments}.y / {moments}.a), null)")


def bounding_box(shape: str) -> Column:
    xs, ys = (f"transform(flatten(transform({shape}, g -> get(g, 0))), p -> p.{c})" for c in "xy")
    return F.expr(f"named_struct('x0', array_min({xs}), 'y0', array_min({ys}), 'x1', array_max({xs}), 'y1', array_max({ys}))")


def strictly_inside(segs: str, x: str, y: str) -> Column:
    """Even-odd test over all edges; points on an edge are outside."""
    flips = f"""(s.a.y > {y}) <> (s.b.y > {y})
        AND {x} < (s.b.x - s.a.x) * ({y} - s.a.y) / nullif(s.b.y - s.a.y, 0D) + s.a.x"""
    touches = f"""(s.b.x - s.a.x) * ({y} - s.a.y) = (s.b.y - s.a.y) * ({x} - s.a.x)
        AND {x} BETWEEN least(s.a.x, s.b.x) AND greatest(s.a.x, s.b.x) AND {y} BETWEEN least(s.a.y, s.b.y) AND greatest(s.a.y, s.b.y)"""
    return F.expr(f"size(filter({segs}, s -> {flips})) % 2 = 1 AND NOT exists({segs}, s -> {touches})")
