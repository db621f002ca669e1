"""The comb in many polygons of bounded size holds the same places as in one."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoweave.catalog import crowded
from cartoweave.functions import geom as G
from cartoweave.operators import spatial as S
from tests.test_spatial import brute_inside

SF = "/root/testdata/sf0.001"
NAMES = ("crowded_points_within", "crowded_intersects", "crowded_tag_admin")


@pytest.mark.parametrize("name", NAMES)
def test_many_polygons_hold_what_one_holds(spark, monkeypatch, name):
    found = []
    for span in (1 << 40, 700):
        monkeypatch.setattr(crowded, "SPAN", span)
        found.append(sorted(map(tuple, getattr(crowded, name)(spark, SF).collect()), key=repr))
    assert found[0] and found[0] == found[1]


def test_polygons_are_bounded(spark):
    corners = F.size(F.col("geom.parts")[0][0])
    sizes = [r[0] for r in crowded.comb(spark, SF, 700).select(corners).collect()]
    assert len(sizes) > 3 and max(sizes) <= 700 + 5


def test_bounded_polygons_are_crowded(spark):
    index = S.boundary_index(crowded.comb(spark, "/root/testdata/sf0.1"), crowded.V.STEP)
    assert index.crowded


def test_a_place_meets_few_edges(spark):
    """However many edges a cell holds, a place is asked about those of its fine cell."""
    sf = "/root/testdata/sf0.1"
    index = S.boundary_index(crowded.comb(spark, sf), crowded.V.STEP)
    listed = index.crowded.rows.agg(F.max(F.size("edges")).alias("most"), F.sum(F.size("edges")).alias("all")).first()
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert listed["most"] <= S.EDGES_PER_ROW and orders <= listed["all"] <= 2 * orders
    assert index.rows.where("fine AND edges IS NOT NULL").isEmpty()
    index.release()


def test_lines_and_places_by_fine_cells(spark):
    """Spokes of a gear and thousands of short edges in one spot, against brute force."""
    gear = [(3 + (2 + 0.4 * (i % 2)) * math.cos(math.pi * i / 700), 3 + (2 + 0.4 * (i % 2)) * math.sin(math.pi * i / 700)) for i in range(1400)]
    knot = [(6.5 + 0.01 * (1 + 0.5 * (i % 2)) * math.cos(math.pi * i / 600), 1 + 0.01 * (1 + 0.5 * (i % 2)) * math.sin(math.pi * i / 600)) for i in range(1200)]
    rings = [[*r, r[0]] for r in (gear, knot, [(0.2, 0.2), (2.5, 0.2), (2.5, 2.5)])]
    area = spark.createDataFrame([(k, [[[{"x": x, "y": y} for x, y in r]]]) for k, r in enumerate(rings)], f"k int, parts {G.PARTS_TYPE}").select("k", G.make("POLYGON", F.col("parts")).alias("geom"))
    rnd = random.Random(3)
    spots = [(rnd.uniform(0, 8), rnd.uniform(0, 8)) for _ in range(500)] + [(rnd.uniform(6.48, 6.52), rnd.uniform(0.98, 1.02)) for _ in range(200)] + gear[::70]
    held = [(i, k) for i, p in enumerate(spots) for k, r in enumerate(rings) if brute_inside([r], *p)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "id int, x double, y double")
    for per_row in (512, 60):
        index = S.build_index(area, ["k"], 8.0, edges_per_row=per_row)
        assert index.crowded and sorted(map(tuple, S.pip_pairs(points, index, ["id"]).collect())) == held
        index.release()
    lines = [(x, y, x + rnd.uniform(-0.3, 0.3), y + rnd.uniform(-0.3, 0.3)) for x, y in spots[:300]]

    def side(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def meet(a, b, c, d):
        return side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0

    touching = [i for i, (a, b, c, d) in enumerate(lines) if any(brute_inside([r], a, b) or any(meet((a, b), (c, d), *e) for e in zip(r, r[1:])) for r in rings)]
    features = spark.createDataFrame(enumerate(lines), "id int, l struct<a: double, b: double, c: double, d: double>")
    features = features.select("id", G.line(F.array(G.vertex(F.col("l.a"), F.col("l.b")), G.vertex(F.col("l.c"), F.col("l.d")))).alias("geom"))
    got = S.intersects_boundary(features, area.select("geom"), "id", 8.0)
    assert sorted(r["id"] for r in got.collect()) == touching
