"""Admin tagging and the other joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.functions import geom as G
from cartoweave.functions.grid import lonlat
from cartoweave.operators import admin as A
from cartoweave.operators import layers as L
from cartoweave.operators import report as R
from cartoweave.operators import resume as RS
from cartoweave.operators import spatial as S
from cartoweave.sources import scans, sinks

CELL = (
    "(greatest(0, least(CAST(floor((y + 90) / 2e0) AS BIGINT), 89)) * 180"
    " + greatest(0, least(CAST(floor((x + 180) / 2e0) AS BIGINT), 179)))"
)
CENTRES = (
    "cells AS (SELECT range AS cell, (CAST(range % 180 AS DOUBLE) + 0.5e0) * 2e0 - 180 AS x, "
    "(CAST(range // 180 AS DOUBLE) + 0.5e0) * 2e0 - 90 AS y FROM range(16200))"
)


def cover_sql(level: int) -> str:
    return (
        f"cover{level} AS (SELECT k, cell FROM cells, edges{level} WHERE {V.SQL_PARITY} "
        "GROUP BY k, cell HAVING count(*) % 2 = 1)"
    )


CODE = {
    1: ("'N' || lpad(CAST(k AS VARCHAR), 2, '0')", "'NATION_' || k"),
    2: (
        "'N' || lpad(CAST(k // 4 AS VARCHAR), 2, '0') || '0' || (k % 4)",
        "'NATION_' || (k // 4) || '/' || (k % 4)",
    ),
}


def owners_sql(level: int) -> str:
    code, name = CODE[level]
    return f"owners{level} AS (SELECT cell, min({code}) AS pcode, min_by({name}, {code}) AS name FROM cover{level} GROUP BY cell)"


def pip_sql(level: int, points: str = "pts") -> str:
    return (
        f"pip{level} AS (SELECT id, k FROM {points}, edges{level} WHERE {V.SQL_PARITY} "
        "GROUP BY id, k HAVING count(*) % 2 = 1)"
    )


def neighbours_sql(level: int, points: str = "pts") -> str:
    """Majority among the nine cells round each residual feature."""
    code, name = CODE[level]
    return f"""located AS (SELECT id, {CELL} AS cell FROM {points}),
    residual AS (SELECT l.id, l.cell FROM located l LEFT JOIN owners{level} o ON l.cell = o.cell WHERE o.cell IS NULL),
    near AS (SELECT r.id, k, count(*) AS hits FROM residual r JOIN cover{level} c
        ON abs(c.cell // 180 - r.cell // 180) <= 1
        AND (abs(c.cell % 180 - r.cell % 180) <= 1 OR abs(c.cell % 180 - r.cell % 180) = 179)
        GROUP BY r.id, k),
    nearest AS (SELECT id, {code} AS pcode, {name} AS name FROM near
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY hits DESC, {code}) = 1)"""


def level1(spark, d):
    return V.admin_levels(spark, d).where("level = 1")


def level1_cover(spark, d):
    return S.cell_cover(level1(spark, d), ["level", "pcode", "name"], V.STEP)


@query("cell_cover", f"{V.with_('edges1')}, {CENTRES}, {cover_sql(1)} SELECT k, cell FROM cover1")
def cell_cover(spark, d):
    return S.cell_cover(V.admin1(spark, d), ["k"], V.STEP)


@query("feature_cell", f"{V.with_('squares')} SELECT id, {CELL} AS cell FROM (SELECT id, x + s / 2 AS x, y + s / 2 AS y FROM squares)")
def feature_cell(spark, d):
    return A.with_cell(A.with_centroid(V.poly_features(spark, d)), V.STEP).select("id", "cell")


@query(
    "cell_join",
    f"{V.with_('pts', 'edges1')}, {CENTRES}, {cover_sql(1)}, {owners_sql(1)} "
    f"SELECT id, p.cell, o.pcode, o.name FROM (SELECT id, {CELL} AS cell FROM pts) p LEFT JOIN owners1 o ON p.cell = o.cell",
)
def cell_join(spark, d):
    points = A.with_cell(V.pts(spark, d).drop("name"), V.STEP, "x", "y")
    return A.cell_join(points, A.cell_owners(level1_cover(spark, d))).select("id", "cell", "pcode", "name")


@query("pip_join", f"{V.with_('pts', 'edges1')}, {pip_sql(1)} SELECT id, k FROM pip1")
def pip_join(spark, d):
    return S.pip_join(V.pts(spark, d), V.admin1(spark, d), ["id"], ["k"], V.STEP)


@query(
    "neighbor_join",
    f"{V.with_('pts', 'edges1')}, {CENTRES}, {cover_sql(1)}, {owners_sql(1)}, {neighbours_sql(1)} SELECT id, pcode, name FROM nearest",
)
def neighbor_join(spark, d):
    points = A.with_cell(V.pts(spark, d).drop("name"), V.STEP, "x", "y")
    cover = level1_cover(spark, d)
    left = A.residuals(A.cell_join(points, A.cell_owners(cover)))
    return A.neighbor_join(left, cover, lonlat(V.STEP), "id")


@query(
    "residual_semi",
    f"{V.with_('pts', 'edges1')}, {CENTRES}, {cover_sql(1)}, {owners_sql(1)} "
    f"SELECT id, p.cell FROM (SELECT id, {CELL} AS cell FROM pts) p WHERE NOT EXISTS (SELECT 1 FROM owners1 o WHERE o.cell = p.cell)",
)
def residual_semi(spark, d):
    points = A.with_cell(V.pts(spark, d).drop("name"), V.STEP, "x", "y")
    return A.residuals(A.cell_join(points, A.cell_owners(level1_cover(spark, d)))).select("id", "cell")


@query(
    "coalesce_fallback",
    f"{V.with_('pts', 'edges1')}, {CENTRES}, {cover_sql(1)}, {owners_sql(1)}, {neighbours_sql(1)} "
    "SELECT l.id, coalesce(o.pcode, n.pcode) AS pcode, coalesce(o.name, n.name) AS name FROM located l "
    "LEFT JOIN owners1 o ON l.cell = o.cell LEFT JOIN nearest n ON l.id = n.id",
)
def coalesce_fallback(spark, d):
    points = A.with_cell(V.pts(spark, d).select("id", "x", "y"), V.STEP, "x", "y")
    cover = level1_cover(spark, d)
    joined = A.cell_join(points, A.cell_owners(cover))
    fallback = A.neighbor_join(A.residuals(joined), cover, lonlat(V.STEP), "id")
    return A.with_fallback(joined, fallback, "id").select("id", "pcode", "name")


def tagged_sql(points: str, prefer_cells: bool = True) -> str:
    """Levels 1 and 2 by cell owner, else by the smallest code containing the point."""

    def best(level: int) -> str:
        code, name = CODE[level]
        return (
            f"best{level} AS (SELECT id, min({code}) AS pcode, min_by({name}, {code}) AS name FROM pip{level} GROUP BY id)"
        )

    def pick(level: int, column: str) -> str:
        if prefer_cells:
            return f"CASE WHEN o{level}.cell IS NOT NULL THEN o{level}.{column} ELSE b{level}.{column} END AS adm{level}_{'pcode' if column == 'pcode' else 'name'}"
        return f"b{level}.{column} AS adm{level}_{column}"

    return (
        f"{V.with_(points, 'edges1', 'edges2')}, {CENTRES}, {cover_sql(1)}, {cover_sql(2)}, {owners_sql(1)}, {owners_sql(2)}, "
        f"{pip_sql(1, points)}, {pip_sql(2, points)}, {best(1)}, {best(2)}, "
        f"tagged AS (SELECT p.id, {pick(1, 'pcode')}, {pick(1, 'name')}, {pick(2, 'pcode')}, {pick(2, 'name')} "
        f"FROM (SELECT *, {CELL} AS cell FROM {points}) p LEFT JOIN owners1 o1 ON p.cell = o1.cell LEFT JOIN owners2 o2 ON p.cell = o2.cell "
        "LEFT JOIN best1 b1 ON p.id = b1.id LEFT JOIN best2 b2 ON p.id = b2.id)"
    )


TAG_COLUMNS = "id, 'WLD' AS adm0_pcode, 'World' AS adm0_name, adm1_pcode, adm1_name, adm2_pcode, adm2_name"


def tag_points(spark, d, mode, levels=(1, 2)):
    points = V.pts(spark, d).select("id", G.point("x", "y").alias("geom"))
    return A.tag_admin(points, V.admin_levels(spark, d), "WLD", levels, mode, V.STEP, id_col="id").drop("geom")


@query("multi_level_tag", f"{tagged_sql('pts')} SELECT {TAG_COLUMNS} FROM tagged")
def multi_level_tag(spark, d):
    return tag_points(spark, d, "geos")


@query("tag_strict", f"{tagged_sql('pts', prefer_cells=False)} SELECT {TAG_COLUMNS} FROM tagged")
def tag_strict(spark, d):
    return tag_points(spark, d, "strict")


@query(
    "tag_neighbor",
    f"{V.with_('pts', 'edges1')}, {CENTRES}, {cover_sql(1)}, {owners_sql(1)}, {neighbours_sql(1)} "
    "SELECT l.id, 'WLD' AS adm0_pcode, 'World' AS adm0_name, coalesce(o.pcode, n.pcode) AS adm1_pcode, coalesce(o.name, n.name) AS adm1_name "
    "FROM located l LEFT JOIN owners1 o ON l.cell = o.cell LEFT JOIN nearest n ON l.id = n.id",
)
def tag_neighbor(spark, d):
    return tag_points(spark, d, "h3_neighbor", (1,))


@query(
    "tag_level_report",
    f"{tagged_sql('pts')}, placed AS (SELECT *, {CELL} AS cell FROM pts), "
    "held AS (SELECT CAST(1 AS INTEGER) AS level, count(*) AS by_cell FROM placed WHERE cell IN (SELECT cell FROM owners1) "
    "UNION ALL SELECT 2, count(*) FROM placed WHERE cell IN (SELECT cell FROM owners2) UNION ALL SELECT 3, 0), "
    "final AS (SELECT 1 AS level, count(*) AS total, count(adm1_pcode) AS matched FROM tagged UNION ALL "
    "SELECT 2, count(*), count(adm2_pcode) FROM tagged UNION ALL SELECT 3, count(*), 0 FROM tagged) "
    "SELECT level, total, by_cell, total - by_cell AS residual, matched, round(100e0 * (total - matched) / total, 2) AS null_percent, "
    "CASE WHEN matched > 0 THEN 'tagged' ELSE 'empty' END AS state FROM held JOIN final USING (level)",
)
def tag_level_report(spark, d):
    """Counted while the tagged layer is written."""
    points, levels = V.pts(spark, d).select("id", G.point("x", "y").alias("geom")), (1, 2, 3)
    tagged = A.tag_admin(points, V.admin_levels(spark, d), "WLD", levels, "geos", V.STEP, by_cell=True)
    layer, seen = A.observe_tags(tagged, levels)
    sinks.write_layer(layer, V.scratch(spark, "tagged"))
    return A.observed_report(spark, seen.get, levels)


@query(
    "tag_items_by_admin",
    f"{tagged_sql('item_points')} SELECT adm1_pcode, adm2_pcode, CAST(sum(items) AS BIGINT) AS features FROM tagged JOIN item_points USING (id) GROUP BY ALL",
)
def tag_items_by_admin(spark, d):
    points = V.item_points(spark, d).select("id", G.point("x", "y").alias("geom"))
    tagged = A.tag_admin(points, V.admin_levels(spark, d), "WLD", (1, 2), "geos", V.STEP, id_col="id")
    return tagged.groupBy("adm1_pcode", "adm2_pcode").agg(F.count("*").alias("features"))


@query(
    "adm0_seed",
    "SELECT 'R' || n_regionkey AS iso3, 'R' || n_regionkey AS adm0_pcode, 'Region ' || n_regionkey AS adm0_name "
    "FROM nation WHERE n_regionkey = 3 GROUP BY n_regionkey",
)
def adm0_seed(spark, d):
    levels = {n: scans.admin_level(V.admin_table(spark, d, n), n, "R3") for n in (1, 2)}
    return A.adm0_seed(A.stack_levels(levels), "R3").select(F.lit("R3").alias("iso3"), "adm0_pcode", "adm0_name")


@query(
    "null_level_schema",
    f"{V.with_('pts')} SELECT id, 'XYZ' AS adm0_pcode, CAST(NULL AS VARCHAR) AS adm0_name, CAST(NULL AS VARCHAR) AS adm1_pcode, "
    "CAST(NULL AS VARCHAR) AS adm1_name, CAST(NULL AS VARCHAR) AS adm2_pcode, CAST(NULL AS VARCHAR) AS adm2_name FROM pts",
)
def null_level_schema(spark, d):
    points = V.pts(spark, d).select("id", G.point("x", "y").alias("geom"))
    none = V.admin_levels(spark, d).where("adm0_pcode = 'XYZ'")
    return A.tag_admin(points, none, "xyz", (1, 2)).drop("geom")


@query(
    "boundary_resolution",
    "SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'h3_neighbor' ELSE 'geos' END AS mode FROM part",
)
def boundary_resolution(spark, d):
    chosen = F.when(F.col("p_size") % 3 == 0, F.lit("h3_neighbor"))
    return V.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), A.mode_column(F.lit("geos"), chosen).alias("mode")
    )


def manifest(spark, d):
    """A state entry per order: some uploaded, some only built, some lost."""
    return V.table(spark, d, "orders").selectExpr(
        "'NPL' AS iso3", "'osm' AS source", "lower(regexp_replace(o_orderpriority, '[^a-zA-Z]+', '')) || '_' || (o_custkey % 50) AS slug",
        "cast(year(o_orderdate) as string) AS snapshot", "o_orderdate AS built_utc",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS uploaded_utc", "o_orderkey % 4 <> 0 AS artifact_present",
    )


MANIFEST_SQL = """m AS (SELECT 'NPL' AS iso3, 'osm' AS source,
    lower(regexp_replace(o_orderpriority, '[^a-zA-Z]+', '', 'g')) || '_' || (o_custkey % 50) AS slug,
    CAST(year(o_orderdate) AS VARCHAR) AS snapshot, o_orderdate AS built_utc,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS uploaded_utc, o_orderkey % 4 <> 0 AS artifact_present FROM orders),
    latest AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY iso3, source, slug
        ORDER BY built_utc DESC, uploaded_utc DESC NULLS LAST, snapshot DESC, artifact_present DESC) = 1),
    specs AS (SELECT DISTINCT iso3, source, slug, snapshot FROM m)"""


@query(
    "resume_anti_join",
    f"WITH {MANIFEST_SQL} SELECT 'uploaded' AS done, s.iso3, s.source, s.slug, s.snapshot FROM specs s WHERE NOT EXISTS (SELECT 1 FROM latest l "
    "WHERE l.slug = s.slug AND l.snapshot = s.snapshot AND l.uploaded_utc IS NOT NULL) "
    "UNION ALL SELECT 'built', s.iso3, s.source, s.slug, s.snapshot FROM specs s WHERE NOT EXISTS (SELECT 1 FROM latest l "
    "WHERE l.slug = s.slug AND l.snapshot = s.snapshot AND l.artifact_present)",
)
def resume_anti_join(spark, d):
    entries = manifest(spark, d)
    specs = entries.select("iso3", "source", "slug", "snapshot").distinct()
    uploaded = RS.pending(specs, entries, "uploaded").withColumn("done", F.lit("uploaded"))
    return uploaded.unionByName(RS.pending(specs, entries, "built").withColumn("done", F.lit("built")))


@query(
    "stale_cache_join",
    "WITH remote AS (SELECT o_custkey % 5 AS level, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS upstream_date FROM orders GROUP BY 1), "
    "seen AS (SELECT DISTINCT s_suppkey % 5 AS level FROM supplier WHERE s_suppkey % 5 <> 4), "
    "local AS (SELECT s.level, CASE WHEN s.level IN (1, 3) THEN '1990-01-01' ELSE r.upstream_date END AS local_date FROM seen s JOIN remote r ON s.level = r.level) "
    "SELECT CAST(r.level AS INTEGER) AS level, upstream_date, local_date FROM remote r LEFT JOIN local l ON r.level = l.level "
    "WHERE l.local_date IS DISTINCT FROM r.upstream_date AND r.level > 0",
)
def stale_cache_join(spark, d):
    orders = V.table(spark, d, "orders")
    remote = orders.groupBy((F.col("o_custkey") % 5).alias("adm")).agg(
        F.max(F.to_date("o_orderdate")).cast("string").alias("date")
    ).withColumn("grp", F.lit("edge"))
    seen = V.table(spark, d, "supplier").select((F.col("s_suppkey") % 5).alias("adm")).where("adm <> 4").distinct()
    old = F.col("adm").isin(1, 3)
    local = seen.join(remote.select("adm", "date"), "adm").select(
        F.col("adm").alias("level"), F.when(old, F.lit("1990-01-01")).otherwise(F.col("date")).alias("date")
    )
    return RS.stale_levels(remote, local, "edge", [1, 2, 3, 4]).select("level", "upstream_date", "local_date")


@query(
    "extract_lookup",
    "WITH idx AS (SELECT 'x' || p_partkey AS id, p_name AS name, CASE p_size % 4 WHEN 0 THEN 'asia' WHEN 1 THEN NULL WHEN 2 THEN 'europe' ELSE 'deep' END AS parent, "
    "CASE WHEN p_partkey % 3 = 0 THEN ['C' || (p_partkey % 40)] ELSE ['C' || (p_partkey % 40), 'C' || (p_partkey % 37)] END AS codes, 'u/' || p_partkey AS url FROM part), "
    "c AS (SELECT 'K' || n_nationkey AS iso3, 'C' || n_nationkey AS iso2 FROM nation) "
    "SELECT iso3, iso2, id AS extract_id, name, url AS pbf_url, url || '.md5' AS md5_url FROM idx JOIN c ON list_contains(codes, iso2) "
    "WHERE parent IS NULL OR parent IN ('asia', 'europe') QUALIFY row_number() OVER (PARTITION BY iso3 ORDER BY codes <> [iso2], id) = 1",
)
def extract_lookup(spark, d):
    index = V.table(spark, d, "part").selectExpr(
        "concat('x', p_partkey) AS id", "p_name AS name",
        "CASE p_size % 4 WHEN 0 THEN 'asia' WHEN 1 THEN NULL WHEN 2 THEN 'europe' ELSE 'deep' END AS parent",
        "CASE WHEN p_partkey % 3 = 0 THEN array(concat('C', p_partkey % 40)) "
        "ELSE array(concat('C', p_partkey % 40), concat('C', p_partkey % 37)) END AS codes",
        "concat('u/', p_partkey) AS url",
    )
    countries = V.table(spark, d, "nation").selectExpr("concat('K', n_nationkey) AS iso3", "concat('C', n_nationkey) AS iso2")
    return scans.lookup_extract(index, countries, scans.CONTINENTS)


def staged(spark, d):
    return V.table(spark, d, "part").selectExpr(
        "CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source",
        "concat('layer_', p_size) AS slug", "concat('p/', p_partkey) AS path",
    )


def layer_specs(spark, d):
    """A category per nation: slug, order, and whether a source is tiled."""
    both = V.table(spark, d, "nation").withColumn("source", F.explode(F.array(F.lit("osm"), F.lit("overture"))))
    return both.selectExpr(
        "concat('layer_', n_nationkey) AS slug", "n_nationkey AS ord", "source",
        "NOT (n_nationkey % 4 = 0 AND source = 'overture') AS tiles",
    )


@query(
    "layer_semi_join",
    "SELECT source, slug, path FROM (SELECT CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source, "
    "'layer_' || p_size AS slug, p_size, 'p/' || p_partkey AS path FROM part) WHERE source <> 'osm' AND p_size IN (SELECT n_nationkey FROM nation) "
    "AND NOT (source = 'overture' AND p_size % 4 = 0)",
)
def layer_semi_join(spark, d):
    return L.mergeable_layers(staged(spark, d), layer_specs(spark, d), "osm").select("source", "slug", "path")


@query(
    "metadata_prefix_join",
    "WITH n AS (SELECT 'exp_npl_' || lower(replace(p_name, ' ', '_')) || '_' || lower(p_type) || '_osm_metadata.json' AS name, "
    "lower(replace(p_name, ' ', '_')) || '_' || lower(p_type) || '_osm_metadata.json' AS rest FROM part), "
    "s AS (SELECT slug, row_number() OVER (ORDER BY length(slug), slug) AS ord FROM (SELECT DISTINCT lower(replace(p_name, ' ', '_')) AS slug FROM part "
    "UNION SELECT DISTINCT split_part(lower(p_name), ' ', 1) FROM part WHERE p_size < 10)) "
    "SELECT name, slug FROM (SELECT DISTINCT n.name, s.slug, s.ord FROM n JOIN s ON starts_with(n.rest, s.slug || '_')) "
    "QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord) = 1",
)
def metadata_prefix_join(spark, d):
    part = V.table(spark, d, "part")
    names = part.selectExpr(
        "concat('exp_npl_', lower(replace(p_name, ' ', '_')), '_', lower(p_type), '_osm_metadata.json') AS name"
    ).distinct()
    slugs = part.selectExpr("lower(replace(p_name, ' ', '_')) AS slug").union(
        part.where("p_size < 10").selectExpr("split_part(lower(p_name), ' ', 1)")
    ).distinct()
    # Shorter slugs come first, equal ones by name: no numbering of all of them is needed.
    specs = slugs.withColumn("ord", F.length("slug"))
    return L.match_slug(names, specs, F.lit("exp_npl_"))


@query(
    "source_panels",
    "WITH l AS (SELECT DISTINCT 'layer_' || (p_size % 30) AS slug, p_size % 30 AS o, CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source FROM part) "
    "SELECT slug, CAST(o AS INTEGER) AS ord, 'Nation ' || o AS label, string_agg(source, ',' ORDER BY CASE source WHEN 'osm' THEN 0 WHEN 'overture' THEN 1 ELSE 99 END) AS sources "
    "FROM l JOIN nation ON o = n_nationkey GROUP BY slug, o",
)
def source_panels(spark, d):
    layers = V.table(spark, d, "part").selectExpr(
        "concat('layer_', p_size % 30) AS slug",
        "CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source",
    )
    specs = V.table(spark, d, "nation").selectExpr(
        "concat('layer_', n_nationkey) AS slug", "n_nationkey AS ord", "concat('Nation ', n_nationkey) AS label"
    )
    return R.source_panels(layers, specs).withColumn("sources", F.array_join("sources", ","))
