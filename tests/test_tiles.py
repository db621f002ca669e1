"""Tiles of areas and lines against plain geometry, and many areas in one run."""

import math
import random

from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import tiles as TL
from cartoweave.operators import layers as L
from cartoweave.operators import spatial as S
from cartoweave.plans.many import areas_from_geojson, export_many
from cartoweave.sources.base import ExtractSource
from cartoweave.sources.boundary import Boundary
from cartoweave.spec import CategorySpec, OsmBlock, RunSpec
from tests.test_spatial import polygons


def shapes(spark, rows):
    parts = [(i, kind, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in parts]) for i, kind, parts in rows]
    return spark.createDataFrame(parts, f"id int, kind string, parts {G.PARTS_TYPE}").select("id", G.make(F.col("kind"), F.col("parts")).alias("geom"))


def unit(x, y):
    r = math.radians(max(-85.0511287798066, min(85.0511287798066, y)))
    return (x + 180) / 360, (1 - math.log(math.tan(r) + 1 / math.cos(r)) / math.pi) / 2


def tiles_on(line, z, steps=4000):
    """Tiles that many points along a line fall into."""
    out = set()
    for (x1, y1), (x2, y2) in zip(line, line[1:]):
        (u1, v1), (u2, v2) = unit(x1, y1), unit(x2, y2)
        for k in range(steps + 1):
            t = k / steps
            out.add((min(int((u1 + t * (u2 - u1)) * 2**z), 2**z - 1), min(int((v1 + t * (v2 - v1)) * 2**z), 2**z - 1)))
    return out


def area_of(ring):
    return abs(sum(a["x"] * b["y"] - b["x"] * a["y"] for a, b in zip(ring, ring[1:]))) / 2


def test_a_line_is_in_the_tiles_it_passes(spark):
    line = [(-170.3, 60.1), (10.2, -33.7), (100.9, 70.3), (101.1, 12.9)]
    got = L.tile_pyramid(shapes(spark, [(1, "LINESTRING", [[line]])]), 2, 5).collect()
    for z in (2, 3, 4, 5):
        own = {(r.x, r.y) for r in got if r.z == z}
        want = tiles_on(line, z)
        assert want <= own and len(own - want) <= 2
    for r in got:
        for part in r.geom.parts:
            assert all(-1e-6 <= v[c] <= TL.EXTENT + 1e-6 for ring in part for v in ring for c in ("x", "y"))


def test_an_area_costs_its_outline(spark):
    """A notched area: what is cut to the tiles of a zoom adds up to the area at every zoom,
    full tiles stand for their descendants."""
    ring = [(-100, -50), (120, -50), (120, 60), (10, 5), (-100, 60), (-100, -50)]
    df = shapes(spark, [(1, "POLYGON", [[ring]])])
    whole = [dict(zip("xy", unit(*p))) for p in ring]
    packed = L.tile_pyramid(df, 0, 7, expand=False).collect()
    every = L.tile_pyramid(df, 0, 7).collect()
    for z in (0, 3, 7):
        pieces = [area_of(ring) * (1 if k == 0 else -1) for r in every if r.z == z for part in r.geom.parts for k, ring in enumerate(part)]
        assert abs(sum(pieces) / TL.EXTENT**2 / 4**z - area_of(whole)) < 1e-9
        assert len({(r.x, r.y) for r in every if r.z == z}) == sum(r.z == z for r in every)
    deepest = [r for r in packed if r.z == 7]
    assert not any(r.full and any((p.z, p.x, p.y) == (r.z - 1, r.x // 2, r.y // 2) and p.full for p in packed) for r in packed)
    # About eight units of outline to a side of 128 tiles, not 128 times 128.
    assert len(deepest) < 8 * 128 and sum(r.z == 7 for r in every) > 2500


def test_points_and_holes(spark):
    hole = [(-10, -10), (10, -10), (10, 10), (-10, 10), (-10, -10)]
    outer = [(-60, -60), (60, -60), (60, 60), (-60, 60), (-60, -60)]
    df = shapes(spark, [(1, "POLYGON", [[outer, hole]]), (2, "MULTIPOINT", [[[(0.5, 0.5)]], [[(0.6, 0.6)]], [[(-100, 0)]]]), (3, "POINT", [[[(180, -90)]]])])
    got = L.tile_pyramid(df, 6, 6).collect()
    holes = {(r.x, r.y) for r in got if r.id == 1}
    n = 2**6
    u, v = unit(0.1, 0.1)
    assert (int(u * n), int(v * n)) not in holes
    u, v = unit(30, 30)
    assert (int(u * n), int(v * n)) in holes
    points = {(r.x, r.y): r for r in got if r.id == 2}
    assert len(points) == 2 and {len(r.geom.parts) for r in points.values()} == {1, 2}
    assert [(r.x, r.y) for r in got if r.id == 3] == [(n - 1, n - 1)]


def segment_gap(a, b, c, d):
    def gap(p, s, e):
        dx, dy = e[0] - s[0], e[1] - s[1]
        t = max(0.0, min(1.0, ((p[0] - s[0]) * dx + (p[1] - s[1]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return math.dist(p, (s[0] + t * dx, s[1] + t * dy))

    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    if side(c, d, a) * side(c, d, b) < 0 and side(a, b, c) * side(a, b, d) < 0:
        return 0.0
    return min(gap(a, c, d), gap(b, c, d), gap(c, a, b), gap(d, a, b))


def metres(p):
    return 6378137 * math.radians(p[0]), 6378137 * math.log(math.tan(math.pi / 4 + math.radians(p[1]) / 2))


def test_near_boundary_takes_every_kind(spark):
    bound = [[[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]]]
    r = random.Random(3)
    rows = [
        (1, "LINESTRING", [[[(20, 5), (5, 5)]]]), (2, "LINESTRING", [[[(5, 5), (20, 5)]]]),
        (3, "MULTIPOINT", [[[(40, 40)]], [[(5, 5)]]]), (4, "POLYGON", [[[(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)]]]),
        (5, "POLYGON", [[[(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)], [(-20, -20), (30, -20), (30, 30), (-20, 30), (-20, -20)]]]),
    ]
    near = {1, 2, 3, 4}
    for i in range(10, 150):
        a = (r.uniform(-15, 25), r.uniform(-15, 25))
        b = (a[0] + r.uniform(-6, 6), a[1] + r.uniform(-6, 6))
        rows.append((i, "LINESTRING", [[[a, b]]]))
        ring = bound[0][0]
        inside = any(0 <= p[0] < 10 and 0 <= p[1] < 10 for p in (a, b))
        if inside or min(segment_gap(metres(a), metres(b), metres(c), metres(d)) for c, d in zip(ring, ring[1:])) <= 300_000:
            near.add(i)
    assert 30 < len(near) < 110
    area = Boundary("X", (-180, -90, 180, 90), polygons(spark, bound), "x", 300_000.0)
    for points in (True, False):
        assert {r.id for r in area.keep(shapes(spark, rows), "id", points=points, step=1.0).collect()} == near


def many_rows(spark, points):
    rows = [(f"node/{i}", {"shop": kind}, x, y) for i, (x, y, kind) in enumerate(points)]
    df = spark.createDataFrame(rows, "feature_id string, tags map<string,string>, x double, y double")
    return df.select("feature_id", "tags", G.point("x", "y").alias("geometry"))


def test_a_later_run_replaces_its_own_areas(spark, tmp_path):
    def box(x):
        return f'{{"type": "Polygon", "coordinates": [[[{x}, 0], [{x + 10}, 0], [{x + 10}, 10], [{x}, 10], [{x}, 0]]]}}'

    areas = areas_from_geojson(spark.createDataFrame([("aaa", box(0)), ("bbb", box(5)), ("ccc", box(50)), ("aaa", box(0))], "iso3 string, text string"))
    run = RunSpec(categories=(CategorySpec("Food", osm=OsmBlock(filter={"shop": "food"}, select=("feature_id AS id",))), CategorySpec("Off", osm=OsmBlock(enabled=False)), CategorySpec("Bad", osm=OsmBlock(filter={"shop": True}, select=("no_such AS id",)))))
    first = many_rows(spark, [(1.0, 1.0, "food"), (7.0, 1.0, "food"), (7.0, 2.0, "toys"), (55.0, 5.0, "food"), (100.0, 5.0, "food")])
    many = export_many(spark, run, ExtractSource(spark, first, "s"), areas, str(tmp_path), 1.0)
    rows = lambda m: {(r.iso3, r.id) for r in m.layers["food"].collect()}
    assert rows(many) == {("AAA", "node/0"), ("AAA", "node/1"), ("BBB", "node/1"), ("CCC", "node/3")}
    status = {(r.iso3, r.slug): (r.status, r.features) for r in many.statuses.collect()}
    assert status["AAA", "food"] == ("ok", 2) and status["CCC", "off"] == ("skipped", 0) and status["BBB", "bad"][0] == "failed" and len(status) == 9
    again = many_rows(spark, [(8.0, 8.0, "food"), (12.0, 8.0, "food")])
    many = export_many(spark, run, ExtractSource(spark, again, "s"), areas.where("iso3 <> 'AAA'"), str(tmp_path), 1.0)
    assert rows(many) == {("AAA", "node/0"), ("AAA", "node/1"), ("BBB", "node/0"), ("BBB", "node/1")}
    assert {(r.iso3, r.features) for r in many.statuses.where("slug = 'food'").collect()} == {("BBB", 2), ("CCC", 0)}
    assert {r.status for r in many.statuses.where("iso3 = 'CCC' AND slug = 'food'").collect()} == {"empty"}


def test_areas_crowded_with_edges(spark):
    """A cell with more edges than one index row lists gives the same pairs."""
    ring = [(math.cos(k / 700 * math.tau) * 3 + 5, math.sin(k / 700 * math.tau) * 3 + 5) for k in range(700)]
    areas = polygons(spark, [[[*ring, ring[0]]], [[(4.0, 4.0), (30.0, 4.0), (30.0, 30.0), (4.0, 30.0), (4.0, 4.0)]]])
    r = random.Random(1)
    points = [(i, r.uniform(0, 12), r.uniform(0, 12)) for i in range(200)]
    features = shapes(spark, [(i, "POINT", [[[(x, y)]]]) for i, x, y in points])
    want = {(i, 0) for i, x, y in points if math.dist((x, y), (5, 5)) < 2.999} | {(i, 1) for i, x, y in points if 4 <= x < 30 and 4 <= y < 30}
    close = {(i, 0) for i, x, y in points if 2.999 <= math.dist((x, y), (5, 5)) <= 3}
    got = [(x.id, x.k) for x in S.assign_areas(features, areas, ["k"], "id", 20.0).collect()]
    assert len(got) == len(set(got)) and set(got) - close == want


def test_children_out_of_reach_are_not_cut(spark):
    """Of a parent's four children only those its box reaches are tried, and what lies
    inside one child comes out as it is; cutting every child gives the same."""
    ring = [(0.26, 0.26), (0.3, 0.26), (0.3, 0.3), (0.26, 0.3), (0.26, 0.26)]
    wide = [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6), (0.4, 0.4)]
    rows = spark.createDataFrame([(k, "POLYGON", [[[{"x": x, "y": y} for x, y in r]]]) for k, r in enumerate((ring, wide))], f"id int, _kind string, _parts {G.PARTS_TYPE}")
    tiles = L._cut_to(L._first_tiles(rows, 0))
    corner = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)]))
    split = tiles.withColumn("_c", corner).withColumn("z", F.col("z") + 1).withColumn("x", F.col("_c.dx").cast("bigint")).withColumn("y", F.col("_c.dy").cast("bigint")).drop("_c", "full")
    found = {(r.id, r.x, r.y): r for r in L._cut_children(split).collect()}
    assert set(found) == {(r.id, r.x, r.y) for r in L._cut_to(split.drop("_box")).collect()} == {(0, 0, 0)} | {(1, x, y) for x in (0, 1) for y in (0, 1)}
    assert found[0, 0, 0]._parts == tiles.where("id = 0").first()._parts
