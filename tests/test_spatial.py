"""Boundary and distance filters against brute force, and under skew."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import grid
from cartoweave.operators import spatial as S
from tests.test_admin import brute_inside, random_world


def polygons(spark, polys, key="k"):
    return spark.createDataFrame(
        [(k, [[[{"x": x, "y": y} for x, y in ring] for ring in p]]) for k, p in enumerate(polys)],
        f"{key} int, parts {G.PARTS_TYPE}",
    ).select(key, G.make("POLYGON", F.col("parts")).alias("geom"))


def turn(p, q, r):
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def meet(a, b, c, d):
    def sign(v):
        return (v > 0) - (v < 0)

    boxes = (
        min(a[0], b[0]) <= max(c[0], d[0]) and max(a[0], b[0]) >= min(c[0], d[0])
        and min(a[1], b[1]) <= max(c[1], d[1]) and max(a[1], b[1]) >= min(c[1], d[1])
    )
    return boxes and sign(turn(c, d, a)) * sign(turn(c, d, b)) <= 0 and sign(turn(a, b, c)) * sign(turn(a, b, d)) <= 0


def test_intersects_equals_brute_force(spark):
    polys, _ = random_world(3)
    bounds = polys[:4]
    rnd = random.Random(5)
    features = []
    for i in range(300):
        x, y, s = rnd.uniform(-30, 30), rnd.uniform(-30, 30), rnd.choice([0.1, 1, 3, 25])
        if i % 3 == 0:
            features.append((i, "POINT", [[(x, y)]]))
        elif i % 3 == 1:
            features.append((i, "LINESTRING", [[(x, y), (x + rnd.uniform(-s, s), y + rnd.uniform(-s, s)), (x + s, y)]]))
        else:
            features.append((i, "POLYGON", [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]))
    rows = [(i, k, [[[{"x": a, "y": b} for a, b in ring] for ring in rings]]) for i, k, rings in features]
    df = spark.createDataFrame(rows, f"id int, kind string, parts {G.PARTS_TYPE}").select("id", G.make(F.col("kind"), F.col("parts")).alias("geom"))

    def touches(kind, rings):
        for p in bounds:
            if brute_inside(p, *rings[0][0]):
                return True
            if kind != "POINT":
                for ring in rings:
                    for a, b in zip(ring, ring[1:]):
                        if any(meet(a, b, c, d) for r in p for c, d in zip(r, r[1:])):
                            return True
            if kind == "POLYGON" and any(brute_inside(rings, *r[0]) for r in p):
                return True
        return False

    want = sorted(i for i, kind, rings in features if touches(kind, rings))
    got = sorted(r["id"] for r in S.intersects_boundary(df, polygons(spark, bounds), "id", 1.0).collect())
    assert got == want and 0 < len(want) < 300


def test_features_that_hold_a_whole_ring(spark):
    """Islands inside large features, also where the feature is given twice over."""
    islands = [[[(x, x), (x + 0.1, x), (x + 0.1, x + 0.1), (x, x + 0.1), (x, x)]] for x in (0.0, 3.0, 40.0)]
    big = [[{"x": a, "y": b} for a, b in ((-5.0, -5.0), (10.0, -5.0), (10.0, 10.0), (-5.0, 10.0), (-5.0, -5.0))]]
    hole = [*big, [{"x": a, "y": b} for a, b in ((-1.0, -1.0), (5.0, -1.0), (5.0, 5.0), (-1.0, 5.0), (-1.0, -1.0))]]
    rows = [(1, "POLYGON", [big]), (2, "POLYGON", [hole]), (3, "MULTIPOLYGON", [big, big])]
    df = spark.createDataFrame(rows, f"id int, kind string, parts {G.PARTS_TYPE}").select("id", G.make(F.col("kind"), F.col("parts")).alias("geom"))
    got = sorted(r["id"] for r in S.intersects_boundary(df, polygons(spark, islands), "id", 0.5).collect())
    assert got == [1, 3]


def test_repeated_boundary_parts_do_not_cancel(spark):
    square = [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]]
    bounds = polygons(spark, [square, square])
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0)], "id int, x double, y double")
    assert [r["id"] for r in S.points_within(pts, S.boundary_index(bounds, 0.5), "id").collect()] == [1]


def test_within_distance(spark):
    polys, points = random_world(9)
    points = points[:1500]
    bounds = polys[:3]
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    radius, metres = 6378137.0, 120_000.0

    def project(x, y):
        return radius * math.radians(x), radius * math.log(math.tan(math.pi / 4 + math.radians(y) / 2))

    def near(x, y):
        px, py = project(x, y)
        for p in bounds:
            for ring in p:
                for a, b in zip(ring, ring[1:]):
                    (ax, ay), (bx, by) = project(*a), project(*b)
                    dx, dy = bx - ax, by - ay
                    t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
                    if math.hypot(px - ax - t * dx, py - ay - t * dy) <= metres:
                        return True
        return False

    want = sorted(i for i, (x, y) in enumerate(points) if any(brute_inside(p, x, y) for p in bounds) or near(x, y))
    got = sorted(r["id"] for r in S.within_distance(pts, polygons(spark, bounds), metres, "id", 1.0).collect())
    assert got == want
    with pytest.raises(ValueError):
        S.within_distance(pts, polygons(spark, bounds), -1.0, "id")


def test_repeated_points_in_crowded_cells(spark):
    """Several parts of one feature may start at the same crowded place."""
    polys, points = random_world(4)
    inside = [(x, y) for x, y in points[:1500] if any(brute_inside(p, x, y) for p in polys)][:50]
    pts = spark.createDataFrame([(7, x, y) for x, y in inside] * 2, "id int, x double, y double")
    index = S.build_index(polygons(spark, polys), ["k"], 6.0, edges_per_row=2)
    got = sorted((r["id"], r["k"]) for r in S.pip_pairs(pts, index, ["id"]).distinct().collect())
    assert got == sorted({(7, k) for x, y in inside for k, p in enumerate(polys) if brute_inside(p, x, y)})


def test_cell_cover_area_and_single_owner(spark):
    square = [[(0.0, 0.0), (5.0, 0.0), (5.0, 5.0), (0.0, 5.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]]
    right = [[(5.0, 0.0), (9.0, 0.0), (9.0, 5.0), (5.0, 5.0), (5.0, 0.0)]]
    cover = S.cell_cover(polygons(spark, [square, right]), ["k"], 0.25)
    counts = {r["k"]: r["count"] for r in cover.groupBy("k").count().collect()}
    assert counts == {0: (25 - 1) * 16, 1: 20 * 16}
    assert cover.groupBy("cell").count().where("count > 1").isEmpty()


def test_points_are_joined_without_nested_loops(spark):
    polys, points = random_world(1)
    index = S.build_index(polygons(spark, polys), ["k"], 1.0)
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    pairs = S.pip_pairs(pts, index, ["id"])
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ring_wraps_columns_and_stops_at_the_poles(spark):
    g = grid.lonlat(10.0)
    row = spark.range(1).select(
        F.size(g.ring(g.cell(F.lit(0.0), F.lit(0.0)))).alias("a"),
        F.size(g.ring(g.cell(F.lit(0.0), F.lit(89.0)))).alias("b"),
        F.array_contains(g.ring(g.cell(F.lit(-179.0), F.lit(0.0))), g.cell(F.lit(179.0), F.lit(0.0))).alias("c"),
    ).first()
    assert tuple(row) == (9, 6, True)


def test_near_features_come_by_id_alone(spark, monkeypatch):
    """Whether a feature shares a point is asked for its id; whole features are not joined
    for it a second time."""
    monkeypatch.setattr(S, "intersects_boundary", None)
    bound = polygons(spark, [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]])
    xy = [(1, 1.0, 1.0, 3.0, 3.0), (2, 4.5, 1.0, 9.0, 1.0), (3, 6.0, 1.0, 9.0, 1.0), (4, -3.0, 2.0, 9.0, 2.0)]
    ends = F.array(G.vertex(F.col("a"), F.col("b")), G.vertex(F.col("c"), F.col("d")))
    lines = spark.createDataFrame(xy, "id int, a double, b double, c double, d double").select("id", G.line(ends).alias("geom"))
    assert sorted(r["id"] for r in S.near_boundary(lines, bound, 80_000.0, "id", 1.0).collect()) == [1, 2, 4]
