"""Web-map tiles in column arithmetic: geometries in the unit square, cut to a tile.

The square world maps to 0..1 both ways, y downwards. A tile's borders are multiples of a
power of two there, so no rounding decides which tile a vertex falls into, at any zoom.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions.grid import MERCATOR_MAX_LAT

#: Units along the side of a tile in the geometries that go into it.
EXTENT = 4096.0


def unit_x(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x + F.lit(180.0)) / F.lit(360.0)))


def unit_y(y: Column) -> Column:
    r = F.radians(F.greatest(F.lit(-MERCATOR_MAX_LAT), F.least(F.lit(MERCATOR_MAX_LAT), y)))
    v = (F.lit(1.0) - F.log(F.tan(r) + F.lit(1.0) / F.cos(r)) / F.lit(math.pi)) / F.lit(2.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))


def _each_vertex(parts: Column, fn) -> Column:
    return F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, fn)))


def _at(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def unit_parts(geom: Column) -> Column:
    return _each_vertex(geom["parts"], lambda v: _at(unit_x(v["x"]), unit_y(v["y"])))


def local_parts(parts: Column, x: Column, y: Column, zoom: Column) -> Column:
    """Coordinates within a tile, 0 to ``EXTENT``."""
    n = F.pow(F.lit(2.0), zoom)
    return _each_vertex(parts, lambda v: _at((v["x"] * n - x) * EXTENT, (v["y"] * n - y) * EXTENT))


def _cut_ring(ring: Column, axis: str, bound: Column, below: bool) -> Column:
    """A closed ring cut to one side of a line, closed again; empty if nothing is left."""
    other = "y" if axis == "x" else "x"

    def step(e):
        a, b = e[f"{axis}1"], e[f"{axis}2"]
        a_in, b_in = (a <= bound, b <= bound) if below else (a >= bound, b >= bound)
        across = e[f"{other}1"] + (bound - a) / (b - a) * (e[f"{other}2"] - e[f"{other}1"])
        hit = _at(bound, across) if axis == "x" else _at(across, bound)
        end = _at(e["x2"], e["y2"])
        none = F.slice(F.array(end), 1, 0)
        return F.when(a_in & b_in, F.array(end)).when(a_in, F.array(hit)).when(b_in, F.array(hit, end)).otherwise(none)

    left = F.flatten(F.transform(G.ring_edges(ring), step))
    return G.once(left, lambda v: F.concat(v, F.slice(v, 1, 1)))


def _cutter(axis: str, bound: Column, below: bool):
    return lambda ring: _cut_ring(ring, axis, bound, below)


def _cut_rings(part: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    for axis, bound, below in (("x", x0, False), ("x", x1, True), ("y", y0, False), ("y", y1, True)):
        part = F.transform(part, _cutter(axis, bound, below))
    return F.filter(part, lambda ring: F.size(ring) > 0)


def _cut_line(ring: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """The pieces of a line inside the box, each a list of vertices."""

    def clip(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]

        def enters(d, a, lo, hi):
            t = F.when(d > 0, (lo - a) / d).when(d < 0, (hi - a) / d)
            return F.when(d == 0, F.when((a >= lo) & (a <= hi), 0.0).otherwise(2.0)).otherwise(t)

        def leaves(d, a, lo, hi):
            return F.when(d > 0, (hi - a) / d).when(d < 0, (lo - a) / d).otherwise(F.lit(1.0))

        def point(t):
            # Ends stay as they are; a point on the border is not pushed out by rounding.
            x = F.when(t >= 1, e["x2"]).when(t <= 0, e["x1"]).otherwise(e["x1"] + t * dx)
            y = F.when(t >= 1, e["y2"]).when(t <= 0, e["y1"]).otherwise(e["y1"] + t * dy)
            return _at(F.greatest(x0, F.least(x1, x)), F.greatest(y0, F.least(y1, y)))

        t0 = F.greatest(F.lit(0.0), enters(dx, e["x1"], x0, x1), enters(dy, e["y1"], y0, y1))
        t1 = F.least(F.lit(1.0), leaves(dx, e["x1"], x0, x1), leaves(dy, e["y1"], y0, y1))
        return G.once(F.array(t0, t1), lambda t: F.when(t[0] <= t[1], F.transform(t, point)))

    pieces = F.array_compact(F.transform(G.ring_edges(ring), clip))

    def joined(done, piece):
        last = F.get(done, F.size(done) - 1)
        follows = F.get(last, F.size(last) - 1) == piece[0]
        longer = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.concat(last, F.slice(piece, 2, 1))))
        return F.when(F.coalesce(follows, F.lit(False)), longer).otherwise(F.concat(done, F.array(piece)))

    empty = F.slice(F.array(F.slice(F.array(_at(F.lit(0.0), F.lit(0.0))), 1, 0)), 1, 0)
    return F.aggregate(pieces, empty, joined)


def cut_parts(kind: Column, parts: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Parts of a line or area inside a box, borders included; no part if there is none."""
    # Inside a hole, the shell and the hole are both cut to the whole box.
    hollow = lambda p: F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda ring: _is_box(ring, x0, x1, y0, y1))
    areas = F.filter(F.transform(parts, lambda p: _cut_rings(p, x0, x1, y0, y1)), lambda p: (F.size(p) > 0) & ~hollow(p))
    lines = F.flatten(F.transform(parts, lambda p: F.transform(_cut_line(p[0], x0, x1, y0, y1), lambda piece: F.array(piece))))
    return F.when(F.endswith(kind, F.lit("POLYGON")), areas).otherwise(lines)


def reaches(parts: Column, x1: Column, y1: Column) -> Column:
    """Whether what was cut to a tile belongs to it: a tile owns its left and upper border,
    and the world's right and lower one."""
    own_x = lambda v: (v["x"] < x1) | (x1 >= 1.0)
    own_y = lambda v: (v["y"] < y1) | (y1 >= 1.0)
    flat = F.flatten(F.flatten(parts))
    return F.exists(flat, own_x) & F.exists(flat, own_y)


def fills(kind: Column, parts: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Whether what was cut to a tile is the whole tile: one ring through its four corners."""
    one = F.endswith(kind, F.lit("POLYGON")) & (F.size(parts) == 1) & (F.size(parts[0]) == 1)
    return F.coalesce(F.when(one, _is_box(parts[0][0], x0, x1, y0, y1)), F.lit(False))


def _is_box(ring: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    corners = F.forall(ring, lambda v: ((v["x"] == x0) | (v["x"] == x1)) & ((v["y"] == y0) | (v["y"] == y1)))
    double = F.aggregate(G.ring_edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0))
    return corners & (F.abs(double) == 2 * (x1 - x0) * (y1 - y0))
