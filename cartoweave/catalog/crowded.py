"""Boundaries with thousands of edges in a cell, beside light ones, and repeated rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.functions import geom as G
from cartoweave.operators import admin as A
from cartoweave.operators import spatial as S

# A comb with one tooth edge per order over four degrees, and a plain box that overlaps it.
COMB = f"""{V.with_('pts')}, v AS (SELECT o_orderkey AS i, -2 + CAST(o_orderkey AS DOUBLE) * 4 / (SELECT max(o_orderkey) + 1 FROM orders) AS x,
        1 + CAST(o_orderkey * 7919 % 1000 AS DOUBLE) / 1000 AS y FROM orders
    UNION ALL SELECT 0, -2e0, -1e0 UNION ALL SELECT 1000000000000, 2e0, -1e0 UNION ALL SELECT 1000000000001, -2e0, -1e0),
    teeth AS (SELECT 1 AS k, x AS x1, y AS y1, lead(x) OVER (ORDER BY i) AS x2, lead(y) OVER (ORDER BY i) AS y2 FROM v),
    sides AS (SELECT * FROM teeth WHERE x2 IS NOT NULL
        UNION ALL VALUES (2, -0.5e0, -2e0, 0.5e0, -2e0), (2, 0.5e0, -2e0, 0.5e0, 0.25e0), (2, 0.5e0, 0.25e0, -0.5e0, 0.25e0), (2, -0.5e0, 0.25e0, -0.5e0, -2e0)),
    spots AS (SELECT id, id // 2 AS pair, x / 60 AS x, y / 40 AS y FROM pts),
    held AS (SELECT id, k FROM spots, sides WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY id, k HAVING count(*) % 2 = 1)"""


#: Order keys of one polygon, so that no row grows with the table.
SPAN = 1 << 16


def comb(spark, d, span=None):
    """``(k, geom)``: the comb, cut upright at the first tooth of every ``span`` keys, and
    the box. The cuts are in two polygons each, so every place is in one of them."""
    orders = V.table(spark, d, "orders")
    last = orders.agg((F.max("o_orderkey") + 1).alias("n"))
    teeth = orders.join(last).selectExpr(
        "o_orderkey AS i", "-2 + cast(o_orderkey AS double) * 4 / n AS x", "1 + cast(o_orderkey * 7919 % 1000 AS double) / 1000 AS y"
    ).withColumn("part", F.floor(F.col("i") / (span or SPAN)))
    # One row per polygon: where it begins, and where the next one does.
    along = Window.orderBy("part")
    begins = teeth.groupBy("part").agg(F.min(F.struct("i", "x", "y")).alias("first")).select(
        "part", F.lag("first").over(along).isNull().alias("leftmost"), "first", F.lead("first").over(along).alias("next")
    )

    def corner(x, y):
        return F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))

    def point(tooth):
        return F.struct(tooth["x"].alias("x"), tooth["y"].alias("y"))

    left = F.when(F.col("leftmost"), F.array(corner(-2, -1))).otherwise(F.array(corner(F.col("first.x"), -1)))
    right = F.when(F.col("next").isNull(), F.array(corner(2, -1))).otherwise(F.array(point(F.col("next")), corner(F.col("next.x"), -1)))
    rings = teeth.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("t")).join(begins, "part")
    outline = F.concat(left, F.transform("t", point), right)
    box = F.array(corner(-0.5, -2), corner(0.5, -2), corner(0.5, 0.25), corner(-0.5, 0.25))
    return rings.select(F.lit(1).alias("k"), G.polygon(outline).alias("geom")).unionByName(spark.range(1).select(F.lit(2).alias("k"), G.polygon(box).alias("geom")))


def spots(spark, d):
    return V.pts(spark, d).selectExpr("id", "id div 2 AS pair", "x / 60 AS x", "y / 40 AS y")


@query("crowded_points_within", f"{COMB} SELECT pair, x, y FROM spots WHERE id IN (SELECT id FROM held)")
def crowded_points_within(spark, d):
    """Two rows share each id here: every row is judged by its own place."""
    index = S.boundary_index(comb(spark, d), V.STEP)
    return S.points_within(spots(spark, d), index, "pair").select("pair", "x", "y")


@query("crowded_intersects", f"{COMB} SELECT id FROM spots WHERE id IN (SELECT id FROM held)")
def crowded_intersects(spark, d):
    features = spots(spark, d).select("id", G.point("x", "y").alias("geom"))
    return S.intersects_boundary(features, comb(spark, d).select("geom"), "id", V.STEP).select("id")


@query("crowded_tag_admin", f"{COMB} SELECT s.id, min('P' || h.k) AS adm1_pcode FROM spots s LEFT JOIN held h ON s.id = h.id GROUP BY s.id")
def crowded_tag_admin(spark, d):
    code = F.concat(F.lit("P"), F.col("k").cast("string"))
    admin = comb(spark, d).select(
        F.lit(1).alias("level"), code.alias("pcode"), code.alias("name"), F.lit("QQA").alias("adm0_pcode"), F.lit("Q").alias("adm0_name"), "geom"
    )
    features = spots(spark, d).select("id", G.point("x", "y").alias("geom"))
    return A.tag_admin(features, admin, "QQA", [1], "strict", V.STEP).select("id", "adm1_pcode")
