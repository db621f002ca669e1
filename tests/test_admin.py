"""Admin tagging on small hand-made countries, and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import wkt
from cartoweave.operators import admin as A
from cartoweave.operators import spatial as S

COUNTRY = ("QQA", "Quadria")
# An L-shaped region around a square one, a sliver east of both; districts cut them up.
OUTLINES = {
    1: {
        "QA.W": [(20, -30), (32, -30), (32, -26), (26, -26), (26, -18), (20, -18)],
        "QA.M": [(26, -26), (32, -26), (32, -18), (26, -18)],
        "QA.E": [(32, -30), (35, -24), (32, -18)],
    },
    2: {
        "QA.W1": [(20, -30), (26, -30), (26, -18), (20, -18)],
        "QA.W2": [(26, -30), (32, -30), (32, -26), (26, -26)],
        "QA.M1": [(26, -26), (32, -26), (26, -18)],
        "QA.E1": [(32, -30), (35, -24), (32, -24)],
    },
}
PLACES = [(11, 22.3, -20.1), (12, 28.4, -28.7), (13, 27.1, -24.9), (14, 31.2, -19.3), (15, 33.1, -25.2), (16, 33.0, -21.4), (17, 40.5, -20.5), (18, 21.0, -33.3)]


def ring_text(ring):
    return "POLYGON((" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"


def level_rows(n):
    return [(COUNTRY[0], code, f"Area {code}", *COUNTRY, ring_text(ring)) for code, ring in OUTLINES[n].items()]


def code_at(n, x, y):
    return min((c for c, ring in OUTLINES[n].items() if brute_inside([[*ring, ring[0]]], x, y)), default=None)


def admin_table(spark, levels):
    rows = [(n, p, nm, a0, a0n, g) for n, lv in levels.items() for _, p, nm, a0, a0n, g in lv]
    df = spark.createDataFrame(
        rows, "level int, pcode string, name string, adm0_pcode string, adm0_name string, wkt string"
    )
    return df.withColumn("geom", wkt.from_wkt("wkt")).drop("wkt")


def feature_table(spark):
    rows = [(i, f"place {i}", f"POINT({x} {y})") for i, x, y in PLACES]
    # An area is tagged by its middle.
    rows.append((19, "field", ring_text([(21, -22), (24, -22), (24, -21), (21, -21)])))
    return spark.createDataFrame(rows, "id int, label string, wkt string").withColumn("geom", wkt.from_wkt("wkt")).drop("wkt")


@pytest.mark.parametrize("mode", ["geos", "strict"])
def test_codes_of_places(spark, mode):
    admin = admin_table(spark, {n: level_rows(n) for n in OUTLINES})
    out = A.tag_admin(feature_table(spark), admin, COUNTRY[0], [1, 2], mode, step=0.5)
    assert out.columns == ["id", "label", "geom", *A.code_columns([1, 2])]
    middle = [*PLACES, (19, 22.5, -21.5)]
    want = {i: (code_at(1, x, y), code_at(2, x, y)) for i, x, y in middle}
    rows = out.collect()
    assert {r["id"]: (r["adm1_pcode"], r["adm2_pcode"]) for r in rows} == want
    assert None in {v[1] for v in want.values() if v[0]} and (None, None) in want.values()
    assert {(r["adm0_pcode"], r["adm0_name"]) for r in rows} == {COUNTRY}
    assert all(r["adm1_name"] == (f"Area {r['adm1_pcode']}" if r["adm1_pcode"] else None) for r in rows)


def test_levels_without_data(spark):
    admin = admin_table(spark, {1: level_rows(1)}).unionByName(admin_table(spark, {2: level_rows(2)}).withColumn("pcode", F.lit(None).cast("string")))
    out = A.tag_admin(feature_table(spark), admin, COUNTRY[0], [1, 2, 3], "geos", step=0.5)
    states = {r["level"]: r["state"] for r in A.tag_report(out, [1, 2, 3]).collect()}
    assert states == {1: "tagged", 2: "empty", 3: "empty"}
    bare = A.tag_admin(feature_table(spark), admin.where("false"), "zzq", [1, 3])
    assert {tuple(r[c] for c in A.code_columns([1, 3])) for r in bare.collect()} == {("ZZQ", None, None, None, None, None)}


def test_quotes_are_data(spark):
    rows = [("Q'A", "Q'A-\"1\"", "The \"Old\" Town's", "Q'A", "L'Isle", ring_text(OUTLINES[1]["QA.W"]))]
    out = A.tag_admin(feature_table(spark), admin_table(spark, {1: rows}), "Q'A", [1], step=0.5)
    row = out.where("id = 11").first()
    assert (row["adm0_name"], row["adm1_pcode"], row["adm1_name"]) == ("L'Isle", "Q'A-\"1\"", "The \"Old\" Town's")


def test_resolution_words():
    assert A.resolve_mode("geos", "h3_neighbor") == "h3_neighbor"
    assert A.resolve_mode("geos", None) == "geos"
    with pytest.raises(ValueError):
        A.resolve_mode("geo", None)


def brute_inside(poly, x, y):
    inside = False
    for ring in poly:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def random_world(seed):
    """Star-shaped polygons with a hole, and points including polygon vertices."""
    import math

    rnd = random.Random(seed)
    polys = []
    for k in range(12):
        cx, cy = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
        n = rnd.randint(5, 60)
        radii = [rnd.uniform(2, 9) for _ in range(n)]
        shell = [
            (cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
            for i, r in enumerate(radii)
        ]
        hole = [(cx - 0.5, cy - 0.5), (cx + 0.5, cy - 0.5), (cx + 0.5, cy + 0.5), (cx - 0.5, cy + 0.5)]
        polys.append([shell + shell[:1], hole + hole[:1]])
    points = [(rnd.uniform(-30, 30), rnd.uniform(-30, 30)) for _ in range(1500)]
    points += [v for p in polys for ring in p for v in ring]
    # A third of all points in one spot.
    points += [(0.1 + rnd.random() / 50, 0.1 + rnd.random() / 50) for _ in range(700)]
    return polys, points


@pytest.mark.parametrize("step,per_row", [(1.0, 512), (0.3, 512), (4.0, 3)])
def test_pip_join_equals_brute_force(spark, step, per_row):
    polys, points = random_world(7)
    pdf = spark.createDataFrame(
        [(k, [[[{"x": x, "y": y} for x, y in ring] for ring in p]]) for k, p in enumerate(polys)],
        f"k int, parts {G.PARTS_TYPE}",
    ).select("k", G.make("POLYGON", F.col("parts")).alias("geom"))
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    index = S.build_index(pdf, ["k"], step, edges_per_row=per_row)
    got = sorted(tuple(r) for r in S.pip_pairs(pts, index, ["id"]).collect())
    want = sorted(
        (i, k) for i, (x, y) in enumerate(points) for k, p in enumerate(polys) if brute_inside(p, x, y)
    )
    assert got == want


def test_crowded_cells_give_the_same_codes(spark):
    polys, points = random_world(11)
    admin = spark.createDataFrame(
        [
            (1, f"P{k:02d}", f"n{k}", "XXX", "X", [[[{"x": x, "y": y} for x, y in ring] for ring in p]])
            for k, p in enumerate(polys)
        ],
        f"level int, pcode string, name string, adm0_pcode string, adm0_name string, parts {G.PARTS_TYPE}",
    ).withColumn("geom", G.make("POLYGON", F.col("parts")))
    feats = spark.createDataFrame(
        [(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double"
    ).select("id", G.point("x", "y").alias("geom"))
    tight = A.build_lookup(admin, [1], "strict", 2.0, max_cell_edges=4)
    assert tight.crowded
    loose = A.build_lookup(admin, [1], "strict", 2.0)
    assert not loose.crowded
    run = lambda lk: sorted(
        (r["id"], r["adm1_pcode"])
        for r in A.tag_admin(feats, admin, "XXX", [1], "strict", lookup=lk).collect()
    )
    want = []
    for i, (x, y) in enumerate(points):
        inside = [f"P{k:02d}" for k, p in enumerate(polys) if brute_inside(p, x, y)]
        want.append((i, min(inside) if inside else None))
    assert run(tight) == want
    assert run(loose) == want


@pytest.mark.parametrize("mode", ["geos", "h3_neighbor", "strict"])
def test_folded_lookups_give_the_same_codes(spark, mode):
    admin = admin_table(spark, {1: level_rows(1), 2: level_rows(2)[:2]})
    points = [(i, 19 + (i * 7 % 340) / 20, -31 + (i * 13 % 280) / 20) for i in range(2000)]
    feats = spark.createDataFrame(points, "id int, x double, y double").select("id", G.point("x", "y").alias("geom"))
    plain = A.build_lookup(admin, [1, 2], mode, 0.05)
    folded = A.build_lookup(admin, [1, 2], mode, 0.05, blocks_from=0)
    assert plain.blocks is None and folded.blocks.count() > 10
    assert folded.rows.count() < plain.rows.count() / 2
    run = lambda lk: sorted(
        tuple(r) for r in A.tag_admin(feats, admin, "QQA", [1, 2], mode, lookup=lk).drop("geom").collect()
    )
    assert run(folded) == run(plain)
    folded.release()
    plain.release()


def test_crowded_boundaries_keep_rows_as_they_are(spark):
    """Light and crowded parts in one cell, rows that repeat an id, and no edge limit."""
    import math

    gear = [(3 + (2 + 0.3 * (i % 2)) * math.cos(2 * math.pi * i / 2400), 3 + (2 + 0.3 * (i % 2)) * math.sin(2 * math.pi * i / 2400)) for i in range(2400)]
    boxes = [[(0.5, 0.5), (4, 0.5), (4, 4), (0.5, 4)], gear]
    area = spark.createDataFrame([(ring_text(r),) for r in boxes], "w string").select(wkt.from_wkt("w").alias("geom"))
    rnd = random.Random(5)
    points = [(i // 2, rnd.uniform(0, 7), rnd.uniform(0, 7)) for i in range(800)]
    df = spark.createDataFrame(points, "id int, x double, y double").withColumn("geom", G.point("x", "y"))
    held = lambda x, y: any(brute_inside([[*r, r[0]]], x, y) for r in boxes)
    want = sorted((i, x, y) for i, x, y in points if held(x, y))
    index = S.boundary_index(area, 8.0)
    assert not S.crowded_cells(index).isEmpty()
    got = S.points_within(df, index, "id").select("id", "x", "y").collect()
    assert sorted(tuple(r) for r in got) == want
    one_each = df.dropDuplicates(["id"])
    got = sorted(r["id"] for r in S.intersects_boundary(one_each, area, "id", step=8.0).collect())
    assert got == sorted(r["id"] for r in one_each.collect() if held(r["x"], r["y"]))
