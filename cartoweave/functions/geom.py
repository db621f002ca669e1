"""Geometry as nested columns: ``struct<kind, parts<rings<vertices<x, y>>>>``.

A point is one part with one ring of one vertex, a line is one ring per part and
a polygon is a closed shell followed by its closed holes. Everything here is a
row-local expression over that struct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERTEX_TYPE = "struct<x:double,y:double>"
PARTS_TYPE = f"array<array<array<{VERTEX_TYPE}>>>"
GEOM_TYPE = f"struct<kind:string,parts:{PARTS_TYPE}>"
EDGE_TYPE = "struct<x1:double,y1:double,x2:double,y2:double>"

# Output class of every geometry kind.
KIND_LABELS = {
    "POINT": "points",
    "MULTIPOINT": "points",
    "LINESTRING": "lines",
    "MULTILINESTRING": "lines",
    "POLYGON": "polygons",
    "MULTIPOLYGON": "polygons",
}
GEOMETRY_LABELS = ("points", "lines", "polygons")

# Spelling of every kind in GeoJSON.
GEOJSON_KINDS = {
    "POINT": "Point",
    "MULTIPOINT": "MultiPoint",
    "LINESTRING": "LineString",
    "MULTILINESTRING": "MultiLineString",
    "POLYGON": "Polygon",
    "MULTIPOLYGON": "MultiPolygon",
}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def make(kind: str | Column, parts: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), parts.alias("parts"))


def point(x: Column | str, y: Column | str) -> Column:
    return make("POINT", F.array(F.array(F.array(vertex(as_col(x), as_col(y))))))


def line(vertices: Column) -> Column:
    return make("LINESTRING", F.array(F.array(vertices)))


def closed(ring: Column) -> Column:
    """The ring with its first vertex repeated at the end."""
    return F.when(
        F.element_at(ring, 1) == F.element_at(ring, -1), ring
    ).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def polygon(shell: Column, holes: Column | None = None) -> Column:
    rings = F.array(closed(shell))
    if holes is not None:
        rings = F.concat(rings, F.transform(holes, closed))
    return make("POLYGON", F.array(rings))


def kind(geom: Column | str) -> Column:
    return as_col(geom)["kind"]


def label_of_kind(kind_col: Column) -> Column:
    """points / lines / polygons, NULL for a kind without a class."""
    table = F.create_map(*[F.lit(s) for pair in KIND_LABELS.items() for s in pair])
    return table[kind_col]


def label(geom: Column | str) -> Column:
    return label_of_kind(kind(geom))


def vertices(geom: Column | str) -> Column:
    return F.flatten(F.flatten(as_col(geom)["parts"]))


def extent(geom: Column | str) -> Column:
    """``struct<xmin, ymin, xmax, ymax>``; NULL bounds when there is no vertex."""
    names = ("xmin", "ymin", "xmax", "ymax")
    none = F.struct(*[F.lit(None).cast("double").alias(n) for n in names])

    def grow(b, v):
        return F.struct(
            F.least(b["xmin"], v["x"]).alias("xmin"),
            F.least(b["ymin"], v["y"]).alias("ymin"),
            F.greatest(b["xmax"], v["x"]).alias("xmax"),
            F.greatest(b["ymax"], v["y"]).alias("ymax"),
        )

    return F.coalesce(F.aggregate(vertices(geom), none, grow), none)


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ring_edges(ring: Column) -> Column:
    count = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, 1, count),
        F.slice(ring, 2, count),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges(geom: Column | str) -> Column:
    """All segments of a line or polygon; a vertex without a segment (a point)
    counts as a segment of length zero."""
    per_ring = F.flatten(
        F.transform(
            as_col(geom)["parts"],
            lambda part: F.transform(
                part,
                lambda ring: F.when(F.size(ring) > 1, ring_edges(ring)).otherwise(
                    F.transform(
                        ring,
                        lambda v: F.struct(
                            v["x"].alias("x1"),
                            v["y"].alias("y1"),
                            v["x"].alias("x2"),
                            v["y"].alias("y2"),
                        ),
                    )
                ),
            ),
        )
    )
    return F.flatten(per_ring)


def part_starts(geom: Column | str) -> Column:
    """The first vertex of every part."""
    return F.transform(as_col(geom)["parts"], lambda part: part[0][0])


def dump(geom: Column | str) -> Column:
    """The parts of a multi geometry, each a single geometry of its own."""
    g = as_col(geom)
    single = F.regexp_replace(g["kind"], "^MULTI", "")
    return F.transform(
        g["parts"],
        lambda part: F.struct(single.alias("kind"), F.array(part).alias("parts")),
    )


def _mean_vertex(geom: Column) -> Column:
    return _moments(vertices(geom), lambda v: (F.lit(1.0), v["x"], v["y"]), _mean_of)


def _moments(items: Column, weigh, finish=None) -> Column:
    """Sum ``(w, w*x, w*y)`` over an array, ``weigh`` giving the triple per item.
    ``finish`` turns the sums into the result, so they are worked out only once."""

    def add(acc, item):
        w, wx, wy = weigh(item)
        return F.struct(
            (acc["w"] + w).alias("w"), (acc["wx"] + wx).alias("wx"), (acc["wy"] + wy).alias("wy")
        )

    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"))
    return F.aggregate(items, zero, add, finish)


def _mean_of(m: Column) -> Column:
    return F.when(
        m["w"] > 0, F.struct((m["wx"] / m["w"]).alias("x"), (m["wy"] / m["w"]).alias("y"))
    )


def _line_centroid(geom: Column) -> Column:
    def weigh(e):
        length = F.sqrt(
            (e["x2"] - e["x1"]) * (e["x2"] - e["x1"]) + (e["y2"] - e["y1"]) * (e["y2"] - e["y1"])
        )
        return length, length * (e["x1"] + e["x2"]) / 2, length * (e["y1"] + e["y2"]) / 2

    return _moments(edges(geom), weigh, _mean_of)


def _ring_moments(ring: Column) -> Column:
    """Shoelace sums of a ring about its first vertex, always of positive area."""
    ox, oy = ring[0]["x"], ring[0]["y"]

    def weigh(e):
        x1, y1 = e["x1"] - ox, e["y1"] - oy
        x2, y2 = e["x2"] - ox, e["y2"] - oy
        cross = x1 * y2 - x2 * y1
        return cross / 2, (x1 + x2) * cross / 6, (y1 + y2) * cross / 6

    def upright(m):
        sign = F.signum(m["w"])
        return F.struct(
            (m["w"] * sign).alias("w"),
            ((m["wx"] + m["w"] * ox) * sign).alias("wx"),
            ((m["wy"] + m["w"] * oy) * sign).alias("wy"),
        )

    return _moments(ring_edges(ring), weigh, upright)


def _area_centroid(geom: Column) -> Column:
    rings = F.flatten(
        F.transform(
            geom["parts"],
            lambda part: F.transform(
                part,
                lambda ring, i: F.struct(
                    F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("s"),
                    _ring_moments(ring).alias("m"),
                ),
            ),
        )
    )
    return _moments(
        rings,
        lambda r: (r["s"] * r["m"]["w"], r["s"] * r["m"]["wx"], r["s"] * r["m"]["wy"]),
        _mean_of,
    )


def centroid(geom: Column | str) -> Column:
    """``struct<x, y>``: mean of points, length-weighted for lines, area-weighted
    for polygons (holes subtract). Zero length or area falls back to the mean."""
    g = as_col(geom)
    weighted = F.when(F.endswith(kind(g), F.lit("LINESTRING")), _line_centroid(g)).when(
        F.endswith(kind(g), F.lit("POLYGON")), _area_centroid(g)
    )
    return F.when(kind(g) == "POINT", g["parts"][0][0][0]).otherwise(F.coalesce(weighted, _mean_vertex(g)))


def contains_xy(geom: Column | str, x: Column, y: Column) -> Column:
    """Ray-crossing parity inside one row: is (x, y) in the polygon? A point on an
    edge belongs to exactly one of the two sides."""
    crossings = F.filter(edges(geom), lambda e: ray_hits(e, x, y))
    return F.size(crossings) % 2 == 1


def ray_hits(e: Column, x: Column, y: Column) -> Column:
    """Does the ray from (x, y) towards +x cross the edge?"""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    return F.when(
        straddles,
        x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"],
    ).otherwise(F.lit(False))


def segments_meet(a: Column, b: Column) -> Column:
    """Do two closed segments share a point? (orientation test, touching counts)"""

    def turn(px, py, qx, qy, rx, ry):
        return (qx - px) * (ry - py) - (qy - py) * (rx - px)

    d1 = turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d2 = turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    d3 = turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d4 = turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    boxes = (
        (F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
        & (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
        & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
        & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
    )
    return boxes & (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0)


def segment_point_distance(e: Column, x: Column, y: Column) -> Column:
    """Distance from (x, y) to a segment, in the units of the plane."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    len2 = dx * dx + dy * dy
    t = F.when(
        len2 > 0,
        F.greatest(
            F.lit(0.0),
            F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / len2),
        ),
    ).otherwise(F.lit(0.0))
    px, py = e["x1"] + t * dx, e["y1"] + t * dy
    return F.sqrt(F.pow(x - px, 2) + F.pow(y - py, 2))


def segment_distance(a: Column, b: Column) -> Column:
    """Distance between two segments: none if they meet, else from one of the four ends."""
    ends = [segment_point_distance(s, o[f"x{i}"], o[f"y{i}"]) for s, o in ((a, b), (b, a)) for i in (1, 2)]
    return F.when(segments_meet(a, b), F.lit(0.0)).otherwise(F.least(*ends))


def thin(geom: Column | str, tolerance: float) -> Column:
    """Drop ring vertices closer than ``tolerance`` to the chord of their two
    neighbours. Ends stay, and a ring is left alone if under four would remain.
    Not topology preserving."""

    def thin_ring(ring):
        inner = F.greatest(F.size(ring) - 2, F.lit(0))
        chords = F.zip_with(
            F.slice(ring, 1, inner),
            F.slice(ring, 3, inner),
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )
        marked = F.zip_with(
            F.slice(ring, 2, inner),
            chords,
            lambda v, c: F.when(segment_point_distance(c, v["x"], v["y"]) >= tolerance, v),
        )
        kept = F.concat(F.slice(ring, 1, 1), F.array_compact(marked), F.slice(ring, -1, 1))
        return F.when(
            F.size(ring) > 2, once(kept, lambda k: F.when(F.size(k) >= 4, k).otherwise(ring))
        ).otherwise(ring)

    g = as_col(geom)
    return F.struct(
        g["kind"].alias("kind"),
        F.transform(g["parts"], lambda part: F.transform(part, thin_ring)).alias("parts"),
    )
