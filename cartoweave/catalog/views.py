"""Feature, admin and element tables derived from the given tables.

Each view exists twice: as a DataFrame and, in ``SQL``, as the same arithmetic in
plain SQL for the cross-check. Coordinates are cast to double before any division.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.session import checkpoint_dir

STEP = 2.0

# A concave outline on a 72 x 36 cell; level 2 uses it at half size.
OUTLINE = ((0, 0), (72, 0), (72, 36), (36, 18), (0, 36), (0, 0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lon(key: str) -> str:
    return f"cast(({key} * 7919) % 36000 as double) / 100 - 180"


def lat(key: str) -> str:
    return f"cast(({key} * 104729) % 18000 as double) / 100 - 90"


def pts(spark, d) -> DataFrame:
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS id", f"{lon('c_custkey')} AS x", f"{lat('c_custkey')} AS y",
        "c_name AS name", "c_mktsegment AS segment", "c_acctbal AS balance",
    )


def point_features(spark, d) -> DataFrame:
    return pts(spark, d).select("id", "name", "segment", "balance", G.point("x", "y").alias("geom"))


ITEM_KEYS = ("(l_orderkey * 31 + l_partkey)", "(l_orderkey * 17 + l_suppkey)")


def item_points(spark, d) -> DataFrame:
    """One point per line item: the large point layer. The id stands for the place,
    so line items at one place share it."""
    a, b = ITEM_KEYS
    return table(spark, d, "lineitem").selectExpr(
        f"({a} * 7919) % 36000 * 100000 + ({b} * 104729) % 18000 AS id", f"{lon(a)} AS x", f"{lat(b)} AS y",
        "l_returnflag AS flag", "l_quantity AS quantity",
    )


def area(ring: Column) -> Column:
    """A polygon of one ring that is closed already."""
    return G.make("POLYGON", F.array(F.array(ring)))


def outline(x0: str, y0: str, scale: int = 1) -> Column:
    pairs = ", ".join(
        f"struct(cast({x0} + {a // scale} as double) AS x, cast({y0} + {b // scale} as double) AS y)" for a, b in OUTLINE
    )
    return F.expr(f"array({pairs})")


def admin1(spark, d) -> DataFrame:
    n = table(spark, d, "nation")
    shell = outline("(-180 + 72 * (n_nationkey % 5))", "(-90 + 36 * floor(n_nationkey / 5))")
    return n.select(F.col("n_nationkey").alias("k"), area(shell).alias("geom"), "n_name", "n_regionkey")


def admin2(spark, d) -> DataFrame:
    quarters = table(spark, d, "nation").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(3))))
    shell = outline(
        "(-180 + 72 * (n_nationkey % 5) + 36 * (q % 2))", "(-90 + 36 * floor(n_nationkey / 5) + 18 * floor(q / 2))", 2
    )
    return quarters.select(
        (F.col("n_nationkey") * 4 + F.col("q")).cast("int").alias("k"), area(shell).alias("geom"), "n_nationkey", "q"
    )


def regions(spark, d) -> DataFrame:
    """Five horizontal strips of 36 degrees."""
    y = "(-90 + 36 * r_regionkey)"
    corners = ((-180, 0), (180, 0), (180, 36), (-180, 36), (-180, 0))
    pairs = ", ".join(f"struct(cast({a} as double) AS x, cast({y} + {b} as double) AS y)" for a, b in corners)
    return table(spark, d, "region").select(
        F.col("r_regionkey").alias("k"), F.col("r_name").alias("iso3"), area(F.expr(f"array({pairs})")).alias("geom")
    )


def admin_levels(spark, d) -> DataFrame:
    """(level, pcode, name, adm0_pcode, adm0_name, geom) of one country, levels 1, 2."""
    one = admin1(spark, d).select(
        F.lit(1).alias("level"), F.expr("concat('N', lpad(cast(k as string), 2, '0'))").alias("pcode"),
        F.col("n_name").alias("name"), "geom",
    )
    two = admin2(spark, d).select(
        F.lit(2).alias("level"), F.expr("concat('N', lpad(cast(n_nationkey as string), 2, '0'), '0', cast(q as string))").alias("pcode"),
        F.expr("concat('NATION_', cast(n_nationkey as string), '/', cast(q as string))").alias("name"), "geom",
    )
    return one.unionByName(two).select(
        "level", "pcode", "name", F.lit("WLD").alias("adm0_pcode"), F.lit("World").alias("adm0_name"), "geom"
    )


def admin_table(spark, d, level: int) -> DataFrame:
    """Admin polygons as shipped: iso_3, adm<N>_src, adm<N>_name, adm0_src, adm0_name."""
    df = admin1(spark, d) if level == 1 else admin2(spark, d).join(
        table(spark, d, "nation").select("n_nationkey", "n_regionkey"), "n_nationkey"
    ).withColumn("n_name", F.expr("concat('NATION_', cast(n_nationkey as string), '/', cast(q as string))"))
    return df.select(
        F.expr("concat('R', cast(n_regionkey as string))").alias("iso_3"),
        F.expr("concat('N', lpad(cast(k as string), 3, '0'))").alias(f"adm{level}_src"),
        F.col("n_name").alias(f"adm{level}_name"),
        F.expr("concat('R', cast(n_regionkey as string))").alias("adm0_src"),
        F.expr("concat('Region ', cast(n_regionkey as string))").alias("adm0_name"),
        "geom",
    )


def line_features(spark, d) -> DataFrame:
    """A two-vertex line per order, from its customer's point."""
    x, y = lon("o_custkey"), lat("o_custkey")
    ends = (
        f"array(struct({x} AS x, {y} AS y), struct({x} + cast(o_orderkey % 7 - 3 as double) AS x, "
        f"{y} + cast(o_orderkey % 5 - 2 as double) AS y))"
    )
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), G.line(F.expr(ends)).alias("geom"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("update_time"),
    )


def poly_features(spark, d) -> DataFrame:
    """A square per supplier, its side 1 to 5 degrees."""
    x, y, s = lon("s_suppkey"), lat("s_suppkey"), "cast(1 + s_suppkey % 5 as double)"
    corners = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    shell = "array(" + ", ".join(f"struct({x} + {a} * {s} AS x, {y} + {b} * {s} AS y)" for a, b in corners) + ")"
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), area(F.expr(shell)).alias("geom")
    )


def mixed_features(spark, d) -> DataFrame:
    """Points, lines and polygons in one layer, with multi forms of each."""

    def multi(single: str, when: str) -> Column:
        kind = f"CASE WHEN {when} THEN 'MULTI{single}' ELSE '{single}' END"
        parts = f"CASE WHEN {when} THEN concat(geom.parts, geom.parts) ELSE geom.parts END"
        return F.expr(f"named_struct('kind', {kind}, 'parts', {parts})")

    p = point_features(spark, d).select(
        F.expr("concat('node/', cast(id as string))").alias("id"), multi("POINT", "id % 4 = 0").alias("geom")
    )
    line_ = line_features(spark, d).select(
        F.expr("concat('way/', cast(id as string))").alias("id"), multi("LINESTRING", "id % 5 = 0").alias("geom")
    )
    poly = poly_features(spark, d).select(
        F.expr("concat('area/', cast(id as string))").alias("id"), multi("POLYGON", "id % 3 = 0").alias("geom")
    )
    return p.unionByName(line_).unionByName(poly)


def stored(df: DataFrame) -> DataFrame:
    """The derived table as a run finds it: written out and read back."""
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch(spark, name: str) -> str:
    """A fresh folder in the shared checkpoint area for a table written by a query."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cartoweave/{name}-{uuid.uuid4().hex}"


def tagged_features(spark, d) -> DataFrame:
    """Parts as points with a tag map; a tenth lacks ``brand``."""
    tags = (
        "CASE WHEN p_partkey % 10 = 0 THEN map('type', p_type, 'name', p_name) "
        "ELSE map('brand', p_brand, 'type', p_type, 'name', p_name) END"
    )
    return table(spark, d, "part").select(
        F.expr("concat('node/', cast(p_partkey as string))").alias("feature_id"), F.expr(tags).alias("tags"),
        G.point(F.expr(lon("p_partkey")), F.expr(lat("p_partkey"))).alias("geometry"), "p_partkey", "p_size",
    )


def nested_features(spark, d) -> DataFrame:
    """Parts as release rows: nested names, a list of sources, a stored box."""
    x, y = lon("p_partkey"), lat("p_partkey")
    return table(spark, d, "part").selectExpr(
        "cast(p_partkey as string) AS id",
        "named_struct('primary', p_name, 'common', CASE WHEN p_partkey % 3 = 0 THEN map('en', p_name, 'fr', p_type) "
        "ELSE map('fr', p_type) END) AS names",
        "CASE WHEN p_partkey % 7 = 0 THEN cast(array() as array<struct<dataset:string>>) "
        "ELSE array(named_struct('dataset', p_brand), named_struct('dataset', 'other')) END AS sources",
        f"named_struct('xmin', {x}, 'xmax', {x} + 1, 'ymin', {y}, 'ymax', {y} + 1) AS bbox",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_type END AS class",
        "p_size AS num_floors", "p_partkey",
    ).withColumn("geometry", G.point(F.expr(x), F.expr(y)))


def nodes(spark, d) -> DataFrame:
    """Element nodes; every tenth carries a tag of its own."""
    return table(spark, d, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_custkey % 10 = 0 THEN map('amenity', lower(c_mktsegment)) ELSE cast(map() as map<string,string>) END AS tags",
        f"{lon('c_custkey')} AS x", f"{lat('c_custkey')} AS y",
    )


def ways(spark, d) -> DataFrame:
    """A way per order over four consecutive nodes; every third is closed, and every
    other closed one is a building."""
    refs = "transform(sequence(0, 3), i -> o_custkey + i)"
    return table(spark, d, "orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderkey % 6 = 0 THEN map('building', 'yes', 'status', o_orderstatus) "
        "ELSE map('highway', lower(substr(o_orderpriority, 3)), 'status', o_orderstatus) END AS tags",
        f"CASE WHEN o_orderkey % 3 = 0 THEN concat({refs}, array(o_custkey)) ELSE {refs} END AS refs",
    )


def relations(spark, d) -> DataFrame:
    """A relation per supplier: two ways as members."""
    return table(spark, d, "supplier").selectExpr(
        "s_suppkey AS id", "map('type', 'multipolygon', 'landuse', s_name) AS tags",
        "array(named_struct('ref', s_suppkey * 3, 'role', 'outer'), named_struct('ref', s_suppkey * 3 + 3, 'role', 'outer')) AS members",
    )


# --- the same views in SQL -------------------------------------------------

_OUTLINE_ROWS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(OUTLINE))

SQL = {
    "pts": f"""pts AS (SELECT c_custkey AS id, {lon('c_custkey')} AS x, {lat('c_custkey')} AS y,
        c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer)""",
    "item_points": f"""item_points AS (SELECT ({ITEM_KEYS[0]} * 7919) % 36000 * 100000 + ({ITEM_KEYS[1]} * 104729) % 18000 AS id,
        {lon(ITEM_KEYS[0])} AS x, {lat(ITEM_KEYS[1])} AS y, count(*) AS items FROM lineitem GROUP BY ALL)""",
    "edges1": f"""outl(i, a, b) AS (VALUES {_OUTLINE_ROWS}),
    v1 AS (SELECT n_nationkey AS k, i, CAST(-180 + 72 * (n_nationkey % 5) + a AS DOUBLE) AS x,
        CAST(-90 + 36 * (n_nationkey // 5) + b AS DOUBLE) AS y FROM nation, outl),
    edges1 AS (SELECT p.k, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM v1 p JOIN v1 q ON p.k = q.k AND q.i = p.i + 1)""",
    "edges2": """v2 AS (SELECT n_nationkey * 4 + q AS k, i, CAST(-180 + 72 * (n_nationkey % 5) + 36 * (q % 2) + a // 2 AS DOUBLE) AS x,
        CAST(-90 + 36 * (n_nationkey // 5) + 18 * (q // 2) + b // 2 AS DOUBLE) AS y
        FROM nation, outl, (VALUES (0), (1), (2), (3)) AS qs(q)),
    edges2 AS (SELECT p.k, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM v2 p JOIN v2 q ON p.k = q.k AND q.i = p.i + 1)""",
    "region_edges": """rv(i, a, b) AS (VALUES (0, -180, 0), (1, 180, 0), (2, 180, 36), (3, -180, 36), (4, -180, 0)),
    rvv AS (SELECT r_regionkey AS k, r_name AS iso3, i, CAST(a AS DOUBLE) AS x, CAST(-90 + 36 * r_regionkey + b AS DOUBLE) AS y FROM region, rv),
    region_edges AS (SELECT p.k, p.iso3, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM rvv p JOIN rvv q ON p.k = q.k AND q.i = p.i + 1)""",
    "lines": f"""lines AS (SELECT o_orderkey AS id, {lon('o_custkey')} AS x1, {lat('o_custkey')} AS y1,
        {lon('o_custkey')} + CAST(o_orderkey % 7 - 3 AS DOUBLE) AS x2, {lat('o_custkey')} + CAST(o_orderkey % 5 - 2 AS DOUBLE) AS y2,
        o_orderpriority AS priority, o_orderdate AS update_time FROM orders)""",
    "squares": f"""squares AS (SELECT s_suppkey AS id, s_name AS name, {lon('s_suppkey')} AS x, {lat('s_suppkey')} AS y,
        CAST(1 + s_suppkey % 5 AS DOUBLE) AS s FROM supplier)""",
    "square_edges": """square_edges AS (
        SELECT id, x AS x1, y AS y1, x + 1 * s AS x2, y + 0 * s AS y2 FROM squares
        UNION ALL SELECT id, x + 1 * s, y + 0 * s, x + 1 * s, y + 1 * s FROM squares
        UNION ALL SELECT id, x + 1 * s, y + 1 * s, x + 0 * s, y + 1 * s FROM squares
        UNION ALL SELECT id, x + 0 * s, y + 1 * s, x, y FROM squares)""",
    "tagged": f"""tagged AS (SELECT 'node/' || p_partkey AS feature_id, p_partkey, p_size,
        CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS brand, p_type AS type, p_name AS name,
        {lon('p_partkey')} AS x, {lat('p_partkey')} AS y FROM part)""",
    "nodes": f"""nodes AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN lower(c_mktsegment) END AS amenity,
        {lon('c_custkey')} AS x, {lat('c_custkey')} AS y FROM customer)""",
    "way_refs": """way_refs AS (SELECT o_orderkey AS id, i, o_custkey + CASE WHEN i = 4 THEN 0 ELSE i END AS ref
        FROM orders, (VALUES (0), (1), (2), (3), (4)) AS t(i) WHERE i < 4 OR o_orderkey % 3 = 0)""",
}

SQL_PARITY = "(y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1"


def with_(*names: str) -> str:
    """A WITH clause of the named views (and what they build on)."""
    needs = {"edges2": ["edges1"], "square_edges": ["squares"]}
    order: list[str] = []

    def add(name: str) -> None:
        for other in needs.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n    ".join(SQL[n] for n in order)
