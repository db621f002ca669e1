"""Projections, boxes, boundaries and tag filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.functions import geom as G
from cartoweave.operators import admin as A
from cartoweave.operators import filters as FL
from cartoweave.operators import spatial as S
from cartoweave.plans.many import export_many
from cartoweave.sources import scans
from cartoweave.sources.base import ExtractSource
from cartoweave.sources.boundary import WORLD_BBOX, Boundary, boundary_bbox
from cartoweave.spec import CategorySpec, OsmBlock, RunSpec

BBOX = (-100.0, -40.0, 60.0, 50.0)
IN_BBOX = "x <= 60 AND x >= -100 AND y <= 50 AND y >= -40"

# Five layers over the tag map of ``tagged_features``.
CATEGORIES = (
    CategorySpec("Economy Goods", osm=OsmBlock(filter={"type": "ECONOMY"})),
    CategorySpec("Small or Medium", osm=OsmBlock(filter={"type": ["SMALL", "MEDIUM"], "brand": "Brand#2"})),
    CategorySpec("Branded", osm=OsmBlock(filter={"brand": True})),
    CategorySpec("Off", osm=OsmBlock(enabled=False, filter={"name": True})),
    CategorySpec("Two Brands", osm=OsmBlock(filter={"brand": ["Brand#7", "Brand#3"], "type": "PROMO"})),
)


@query(
    "project_select",
    f"{V.with_('tagged')} SELECT feature_id AS id, name, type AS kind, CAST(x AS VARCHAR) IS NOT NULL AS has_geom FROM tagged",
)
def project_select(spark, d):
    df = FL.project(V.tagged_features(spark, d), ["feature_id AS id", "tags['name'] AS name", "tags['type'] AS kind"])
    return df.select("id", "name", "kind", F.col("geom").isNotNull().alias("has_geom"))


@query("project_struct_path", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part")
def project_struct_path(spark, d):
    return V.nested_features(spark, d).selectExpr("id", "names.primary AS name")


@query(
    "project_list_first",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS source FROM part",
)
def project_list_first(spark, d):
    return V.nested_features(spark, d).select("id", FL.list_first("sources")["dataset"].alias("source"))


@query("project_map_key", f"{V.with_('tagged')} SELECT feature_id, brand, CAST(NULL AS VARCHAR) AS missing FROM tagged")
def project_map_key(spark, d):
    return V.tagged_features(spark, d).select(
        "feature_id", FL.map_value("tags", "brand").alias("brand"), FL.map_value("tags", "nothing").alias("missing")
    )


@query("project_json_text", "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS name_en FROM part")
def project_json_text(spark, d):
    return V.nested_features(spark, d).select("id", FL.map_value("names.common", "en").alias("name_en"))


@query(
    "project_json_value",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN '\"' || p_name || '\"' END AS name_en FROM part",
)
def project_json_value(spark, d):
    return V.nested_features(spark, d).select("id", FL.json_value("names.common", "en").alias("name_en"))


@query(
    "inject_local_names",
    f"{V.with_('tagged')} SELECT feature_id AS id, name, brand AS name_en, CAST(NULL AS VARCHAR) AS name_ar, type AS type FROM tagged",
)
def inject_local_names(spark, d):
    fields = ["feature_id AS id", "tags['name'] AS name", "tags['brand'] AS name_en", "tags['type'] AS type"]
    return FL.project(V.tagged_features(spark, d), FL.inject_local_names(fields, scans.languages_of("SDN"))).drop("geom")


@query(
    "local_languages",
    "WITH c AS (SELECT n_name AS iso3 FROM nation UNION SELECT r_name FROM region), "
    "t AS (SELECT p_size % 30 AS k, CASE WHEN p_type = 'ECONOMY' THEN 'en' ELSE lower(substr(p_type, 1, 2)) END AS lang, min(p_partkey) AS rank FROM part GROUP BY 1, 2), "
    "r AS (SELECT 'NATION_' || k AS iso3, lang, row_number() OVER (PARTITION BY k ORDER BY rank) AS n FROM t WHERE lang <> 'en') "
    "SELECT c.iso3, coalesce(string_agg(lang, ',' ORDER BY n), '') AS languages FROM c LEFT JOIN r ON upper(c.iso3) = r.iso3 AND n <= 3 GROUP BY c.iso3",
)
def local_languages(spark, d):
    dimension = V.table(spark, d, "part").selectExpr(
        "concat('NATION_', p_size % 30) AS iso3", "p_partkey AS rank",
        "CASE WHEN p_type = 'ECONOMY' THEN 'en' ELSE lower(substr(p_type, 1, 2)) END AS lang",
    )
    countries = V.table(spark, d, "nation").selectExpr("n_name AS iso3").union(
        V.table(spark, d, "region").selectExpr("r_name")
    ).distinct()
    return scans.local_languages(countries, dimension).withColumn("languages", F.array_join("languages", ","))


@query(
    "filter_bbox_struct",
    f"SELECT CAST(p_partkey AS VARCHAR) AS id FROM (SELECT p_partkey, {V.lon('p_partkey')} AS x, {V.lat('p_partkey')} AS y FROM part) "
    "WHERE x <= 60 AND x + 1 >= -100 AND y <= 50 AND y + 1 >= -40",
)
def filter_bbox_struct(spark, d):
    return V.nested_features(spark, d).where(FL.bbox_overlaps(F.col("bbox"), BBOX)).select("id")


@query(
    "filter_bbox_geom",
    f"{V.with_('lines')} SELECT id FROM lines WHERE least(x1, x2) <= 60 AND greatest(x1, x2) >= -100 AND least(y1, y2) <= 50 AND greatest(y1, y2) >= -40",
)
def filter_bbox_geom(spark, d):
    return V.line_features(spark, d).where(G.once(G.extent("geom"), lambda b: FL.bbox_overlaps(b, BBOX))).select("id")


@query(
    "filter_earth",
    f"{V.with_('lines')} SELECT id FROM lines WHERE least(x1, x2) >= -180 AND greatest(x1, x2) <= 180 AND least(y1, y2) >= -90 AND greatest(y1, y2) <= 90",
)
def filter_earth(spark, d):
    return V.line_features(spark, d).where(G.once(G.extent("geom"), FL.on_earth)).select("id")


def some_nations(spark, d):
    """A boundary of several concave polygons, holes between them."""
    return V.admin1(spark, d).where("k % 2 = 0").select("geom")


MEET = """least(f.x1, f.x2) <= greatest(b.x1, b.x2) AND greatest(f.x1, f.x2) >= least(b.x1, b.x2)
    AND least(f.y1, f.y2) <= greatest(b.y1, b.y2) AND greatest(f.y1, f.y2) >= least(b.y1, b.y2)
    AND sign((b.x2 - b.x1) * (f.y1 - b.y1) - (b.y2 - b.y1) * (f.x1 - b.x1)) * sign((b.x2 - b.x1) * (f.y2 - b.y1) - (b.y2 - b.y1) * (f.x2 - b.x1)) <= 0
    AND sign((f.x2 - f.x1) * (b.y1 - f.y1) - (f.y2 - f.y1) * (b.x1 - f.x1)) * sign((f.x2 - f.x1) * (b.y2 - f.y1) - (f.y2 - f.y1) * (b.x2 - f.x1)) <= 0"""


@query(
    "filter_boundary_intersects",
    f"""{V.with_('lines', 'square_edges', 'edges1', 'pts')},
    bound AS (SELECT * FROM edges1 WHERE k % 2 = 0),
    segs AS (SELECT 'way/' || id AS id, x1, y1, x2, y2 FROM lines UNION ALL SELECT 'area/' || id, x1, y1, x2, y2 FROM square_edges),
    starts AS (SELECT 'node/' || id AS id, x, y FROM pts UNION ALL SELECT 'way/' || id, x1, y1 FROM lines UNION ALL SELECT 'area/' || id, x, y FROM squares),
    inside AS (SELECT id FROM starts, bound WHERE {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1),
    crossing AS (SELECT f.id FROM segs f, bound b WHERE {MEET}),
    corners AS (SELECT DISTINCT x1 AS x, y1 AS y FROM bound),
    holding AS (SELECT 'area/' || e.id AS id FROM square_edges e, corners WHERE {V.SQL_PARITY} GROUP BY e.id, x, y HAVING count(*) % 2 = 1)
    SELECT id FROM inside UNION SELECT id FROM crossing UNION SELECT id FROM holding""",
)
def filter_boundary_intersects(spark, d):
    return S.intersects_boundary(V.stored(V.mixed_features(spark, d)), some_nations(spark, d), "id", V.STEP).select("id")


@query(
    "filter_boundary_points",
    f"{V.with_('pts', 'edges1')} SELECT DISTINCT id FROM (SELECT id FROM pts, edges1 WHERE k % 2 = 0 AND {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1)",
)
def filter_boundary_points(spark, d):
    index = S.boundary_index(some_nations(spark, d), V.STEP)
    return S.points_within(V.pts(spark, d), index, "id").select("id")


@query(
    "filter_predicates",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_type AS class FROM part WHERE p_size % 5 <> 0 AND p_type NOT IN ('PROMO', 'LARGE') AND p_name = p_name AND p_size IN (1, 2, 3, 4, 6, 7, 8)",
)
def filter_predicates(spark, d):
    conditions = ["class NOT IN ('PROMO', 'LARGE')", "", "names.primary = names.primary", "num_floors IN (1, 2, 3, 4, 6, 7, 8)"]
    return FL.where_all(V.nested_features(spark, d), conditions).select("id", "class")


@query(
    "build_where",
    f"""{V.with_('tagged', 'edges1')}, kept AS (SELECT * FROM tagged WHERE {IN_BBOX} AND type <> 'PROMO')
    SELECT DISTINCT feature_id FROM (SELECT feature_id FROM kept, edges1 WHERE k % 2 = 0 AND {V.SQL_PARITY} GROUP BY feature_id, k HAVING count(*) % 2 = 1)""",
)
def build_where(spark, d):
    cheap = FL.build_where(V.tagged_features(spark, d), BBOX, ["tags['type'] <> 'PROMO'"], box=None)
    area = Boundary("WLD", BBOX, some_nations(spark, d), "nations")
    return area.keep(cheap, "feature_id", "geometry", points=True, step=V.STEP).select("feature_id")


@query(
    "boundary_tag_count",
    f"""{V.with_('pts', 'edges1')}, kept AS (SELECT * FROM pts WHERE {IN_BBOX}),
    hit AS (SELECT id, k FROM kept, edges1 WHERE {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1)
    SELECT 'N' || lpad(CAST(k AS VARCHAR), 2, '0') AS adm1_pcode, count(*) AS features FROM hit WHERE k % 2 = 0 GROUP BY k""",
)
def boundary_tag_count(spark, d):
    points = FL.build_where(V.point_features(spark, d), BBOX, box=None, geom="geom")
    area = Boundary("WLD", BBOX, some_nations(spark, d), "nations")
    inside = area.keep(points, "id", "geom", points=True, step=V.STEP)
    tagged = A.tag_admin(
        inside, V.admin_levels(spark, d).where("level = 1"), "WLD", (1,), "strict", V.STEP, id_col="id"
    )
    return tagged.groupBy("adm1_pcode").agg(F.count("*").alias("features"))


@query("tag_any", f"{V.with_('tagged')} SELECT feature_id FROM tagged WHERE brand IS NOT NULL")
def tag_any(spark, d):
    return V.tagged_features(spark, d).where(FL.tag_predicate({"brand": True})).select("feature_id")


@query("tag_equals", f"{V.with_('tagged')} SELECT feature_id FROM tagged WHERE type = 'PROMO'")
def tag_equals(spark, d):
    return V.tagged_features(spark, d).where(FL.tag_predicate({"type": "PROMO"})).select("feature_id")


@query("tag_in", f"{V.with_('tagged')} SELECT feature_id FROM tagged WHERE brand IN ('Brand#3', 'Brand#12')")
def tag_in(spark, d):
    return V.tagged_features(spark, d).where(
        FL.tag_predicate({"brand": ["Brand#3", "Brand#12", "Brand#3"]})
    ).select("feature_id")


@query(
    "tag_or_filter",
    f"{V.with_('tagged')} SELECT feature_id, 'some' AS which FROM tagged WHERE brand = 'Brand#5' OR type IN ('SMALL', 'LARGE') "
    "UNION ALL SELECT feature_id, 'empty' FROM tagged",
)
def tag_or_filter(spark, d):
    df = V.tagged_features(spark, d)
    some = df.where(FL.tag_predicate({"brand": "Brand#5", "type": ["SMALL", "LARGE"], "name": False}))
    everything = df.where(FL.tag_predicate({}))
    nothing = df.where(FL.tag_predicate({"name": False}))
    parts = [(some, "some"), (everything, "empty"), (nothing, "false")]
    named = [p.select("feature_id", F.lit(w).alias("which")) for p, w in parts]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("tag_wildcard", f"{V.with_('tagged')} SELECT feature_id FROM tagged WHERE brand IS NOT NULL")
def tag_wildcard(spark, d):
    wanted = FL.normalise_filter({"brand": "*"})
    return V.tagged_features(spark, d).where(FL.tag_predicate(wanted)).select("feature_id")


def filter_rows(spark, d):
    """Filter rules as rows: (category, key, value), NULL meaning any value."""
    return V.table(spark, d, "part").selectExpr(
        "p_name AS category", "lower(p_type) AS key", "CASE WHEN p_type = 'PROMO' AND p_size = 7 THEN NULL ELSE p_brand END AS value"
    )


@query(
    "tag_union_filter",
    "WITH r AS (SELECT lower(p_type) AS key, CASE WHEN p_type = 'PROMO' AND p_size = 7 THEN NULL ELSE p_brand END AS value FROM part) "
    "SELECT key, bool_or(value IS NULL) AS any_value, CASE WHEN NOT bool_or(value IS NULL) THEN string_agg(DISTINCT value, ',' ORDER BY value) END AS listed FROM r GROUP BY key",
)
def tag_union_filter(spark, d):
    return FL.union_rows(filter_rows(spark, d)).withColumn("listed", F.array_join("listed", ","))


@query(
    "tag_union_scan",
    f"{V.with_('tagged')} SELECT feature_id FROM tagged WHERE type IN ('ECONOMY', 'SMALL', 'MEDIUM', 'PROMO') OR brand IS NOT NULL",
)
def tag_union_scan(spark, d):
    return V.tagged_features(spark, d).where(FL.tag_predicate(FL.union_filter(CATEGORIES))).select("feature_id")


CATEGORISED = (
    "categorised AS (SELECT feature_id, 'economy_goods' AS category FROM tagged WHERE type = 'ECONOMY' "
    "UNION ALL SELECT feature_id, 'small_or_medium' FROM tagged WHERE type IN ('SMALL', 'MEDIUM') OR brand = 'Brand#2' "
    "UNION ALL SELECT feature_id, 'branded' FROM tagged WHERE brand IS NOT NULL "
    "UNION ALL SELECT feature_id, 'two_brands' FROM tagged WHERE brand IN ('Brand#3', 'Brand#7') OR type = 'PROMO')"
)


@query("categorise_one_pass", f"{V.with_('tagged')}, {CATEGORISED} SELECT feature_id, category FROM categorised")
def categorise_one_pass(spark, d):
    return FL.categorise(V.tagged_features(spark, d), CATEGORIES).select("feature_id", "category")


@query("select_category", f"{V.with_('tagged')}, {CATEGORISED} SELECT feature_id, category FROM categorised WHERE category = 'two_brands'")
def select_category(spark, d):
    from cartoweave.spec import select_category as pick

    run = pick(RunSpec(iso3="NPL", categories=CATEGORIES), "two-brands")
    return FL.categorise(V.tagged_features(spark, d), run.categories).select("feature_id", "category")


MX, MY = "6378137e0 * radians({0})", "6378137e0 * ln(tan(pi() / 4 + radians(greatest(-89.9, least(89.9, {0}))) / 2))"


@query(
    "within_distance",
    f"""{V.with_('pts', 'edges1')}, bound AS (SELECT * FROM edges1 WHERE k % 2 = 0),
    inside AS (SELECT DISTINCT id FROM (SELECT id FROM pts, bound WHERE {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1)),
    m AS (SELECT id, {MX.format('x')} AS px, {MY.format('y')} AS py FROM pts),
    e AS (SELECT {MX.format('x1')} AS ax, {MY.format('y1')} AS ay, {MX.format('x2')} AS bx, {MY.format('y2')} AS b2 FROM bound),
    t AS (SELECT id, px, py, ax, ay, bx, b2, greatest(0e0, least(1e0, ((px - ax) * (bx - ax) + (py - ay) * (b2 - ay)) / ((bx - ax) * (bx - ax) + (b2 - ay) * (b2 - ay)))) AS t FROM m, e),
    near AS (SELECT DISTINCT id FROM t WHERE sqrt((px - ax - t * (bx - ax)) * (px - ax - t * (bx - ax)) + (py - ay - t * (b2 - ay)) * (py - ay - t * (b2 - ay))) <= 150000)
    SELECT id FROM inside UNION SELECT id FROM near""",
)
def within_distance(spark, d):
    return S.within_distance(V.pts(spark, d), some_nations(spark, d), 150_000.0, "id", V.STEP).select("id")


def _apart(px: str, py: str, s: str) -> str:
    """Squared distance of a point from the segment ``s`` in SQL."""
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    t = f"CASE WHEN {dx} * {dx} + {dy} * {dy} > 0 THEN greatest(0e0, least(1e0, (({px} - {s}.x1) * {dx} + ({py} - {s}.y1) * {dy}) / ({dx} * {dx} + {dy} * {dy}))) ELSE 0e0 END"
    return f"(({px} - {s}.x1 - {t} * {dx}) ** 2 + ({py} - {s}.y1 - {t} * {dy}) ** 2)"


def in_metres(table: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{m.format(c)} AS {c}' for m, c in ((MX, 'x1'), (MY, 'y1'), (MX, 'x2'), (MY, 'y2')))}) FROM {table}"


@query(
    "within_distance_mixed",
    f"""{V.with_('lines', 'square_edges', 'edges1', 'pts')},
    bound AS (SELECT * FROM edges1 WHERE k % 2 = 0),
    segs AS (SELECT 'way/' || id AS id, x1, y1, x2, y2 FROM lines UNION ALL SELECT 'area/' || id, x1, y1, x2, y2 FROM square_edges UNION ALL SELECT 'node/' || id, x, y, x, y FROM pts),
    starts AS (SELECT 'node/' || id AS id, x, y FROM pts UNION ALL SELECT 'way/' || id, x1, y1 FROM lines UNION ALL SELECT 'area/' || id, x, y FROM squares),
    inside AS (SELECT id FROM starts, bound WHERE {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1),
    crossing AS (SELECT f.id FROM segs f, bound b WHERE f.id NOT LIKE 'node/%' AND {MEET}),
    corners AS (SELECT DISTINCT x1 AS x, y1 AS y FROM bound),
    holding AS (SELECT 'area/' || e.id AS id FROM square_edges e, corners WHERE {V.SQL_PARITY} GROUP BY e.id, x, y HAVING count(*) % 2 = 1),
    near AS (SELECT f.id FROM ({in_metres('segs')}) f, ({in_metres('bound')}) b
        WHERE sqrt(least({_apart('f.x1', 'f.y1', 'b')}, {_apart('f.x2', 'f.y2', 'b')}, {_apart('b.x1', 'b.y1', 'f')}, {_apart('b.x2', 'b.y2', 'f')})) <= 80000 OR ({MEET}))
    SELECT id FROM inside UNION SELECT id FROM crossing UNION SELECT id FROM holding UNION SELECT id FROM near""",
)
def within_distance_mixed(spark, d):
    area = Boundary("NPL", WORLD_BBOX, some_nations(spark, d), "nations", 80_000.0)
    return area.keep(V.stored(V.mixed_features(spark, d)), "id", step=V.STEP).select("id")


@query("boundary_bbox", f"{V.with_('edges1')} SELECT k, min(x1) AS xmin, min(y1) AS ymin, max(x1) AS xmax, max(y1) AS ymax FROM edges1 GROUP BY k")
def bbox_of_boundary(spark, d):
    return boundary_bbox(V.admin1(spark, d), by=["k"])


@query("multi_country", f"{V.with_('pts', 'region_edges')} SELECT id, iso3 FROM pts, region_edges WHERE {V.SQL_PARITY} GROUP BY id, iso3 HAVING count(*) % 2 = 1")
def multi_country(spark, d):
    """All regions exported in one job: written by area, and read back."""
    points = V.pts(spark, d).select(F.col("id").alias("feature_id"), F.create_map(F.lit("segment"), "segment").alias("tags"), G.point("x", "y").alias("geometry"))
    run = RunSpec(categories=(CategorySpec("Customers", osm=OsmBlock(filter={"segment": True}, select=("feature_id AS id",))),))
    many = export_many(spark, run, ExtractSource(spark, points, "2026-04-15"), V.regions(spark, d).select("iso3", "geom"), V.scratch(spark, "many"), V.STEP)
    return many.layers["customers"].select("id", "iso3")


@query(
    "multi_country_status",
    f"""{V.with_('lines', 'squares', 'square_edges', 'edges1', 'pts')},
    bound AS (SELECT *, 'N' || (k % 5) AS iso3 FROM edges1 WHERE k % 2 = 0),
    segs AS (SELECT 'way/' || id AS id, x1, y1, x2, y2 FROM lines UNION ALL SELECT 'area/' || id, x1, y1, x2, y2 FROM square_edges),
    starts AS (SELECT 'node/' || id AS id, x, y FROM pts UNION ALL SELECT 'way/' || id, x1, y1 FROM lines UNION ALL SELECT 'area/' || id, x, y FROM squares),
    inside AS (SELECT id, iso3 FROM starts, bound WHERE {V.SQL_PARITY} GROUP BY id, iso3, k HAVING count(*) % 2 = 1),
    crossing AS (SELECT f.id, iso3 FROM segs f, bound b WHERE {MEET}),
    corners AS (SELECT DISTINCT iso3, x1 AS x, y1 AS y FROM bound),
    holding AS (SELECT 'area/' || e.id AS id, iso3 FROM square_edges e, corners WHERE {V.SQL_PARITY} GROUP BY e.id, iso3, x, y HAVING count(*) % 2 = 1),
    pairs AS (SELECT id, iso3 FROM inside UNION SELECT id, iso3 FROM crossing UNION SELECT id, iso3 FROM holding),
    every AS (SELECT DISTINCT iso3 FROM bound),
    beyond AS (SELECT id FROM segs WHERE least(x1, x2) < -180 OR greatest(x1, x2) > 180 OR least(y1, y2) < -90 OR greatest(y1, y2) > 90),
    counted AS (SELECT iso3, split_part(id, '/', 1) AS slug, count(*) AS features FROM pairs WHERE id NOT IN (SELECT id FROM beyond) GROUP BY ALL)
    SELECT e.iso3, s.slug, CASE WHEN s.slug = 'off' THEN 'skipped' WHEN coalesce(features, 0) = 0 THEN 'empty' ELSE 'ok' END AS status, coalesce(features, 0) AS features
    FROM every e CROSS JOIN (VALUES ('node'), ('way'), ('area'), ('off'), ('none')) AS s(slug) LEFT JOIN counted c ON c.iso3 = e.iso3 AND c.slug = s.slug""",
)
def multi_country_status(spark, d):
    """Points, lines and areas against five areas of several polygons each: a status of each."""
    mixed = V.stored(V.mixed_features(spark, d)).select(F.col("id").alias("feature_id"), F.create_map(F.lit("kind"), F.split("id", "/")[0]).alias("tags"), F.col("geom").alias("geometry"))
    slugs = [CategorySpec(k, osm=OsmBlock(filter={"kind": k}, select=("feature_id AS id",), enabled=k != "off")) for k in ("node", "way", "area", "off", "none")]
    areas = V.admin1(spark, d).where("k % 2 = 0").select(F.expr("concat('n', cast(k % 5 as string))").alias("iso3"), "geom")
    many = export_many(spark, RunSpec(categories=tuple(slugs)), ExtractSource(spark, mixed, "2026-04-15"), areas, V.scratch(spark, "many"), V.STEP)
    return many.statuses.select("iso3", "slug", "status", "features")


@query(
    "resolve_formats",
    "SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'gpkg,shp' WHEN 1 THEN 'geojson' WHEN 2 THEN '' ELSE 'gpkg,shp' END AS downloads, "
    "CASE WHEN p_size % 4 IN (1, 2) THEN true ELSE false END AS geoparquet, 'wanted' AS status FROM part",
)
def resolve_formats(spark, d):
    specs = V.table(spark, d, "part").selectExpr(
        "p_partkey AS id",
        "CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN array('geojson', 'geoparquet') WHEN 2 THEN array('geoparquet') "
        "ELSE cast(array() as array<string>) END AS formats",
    )
    return FL.resolve_formats(specs, ["gpkg", "shp"]).withColumn("downloads", F.array_join("downloads", ","))


@query(
    "dataset_identity",
    "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'folder_' || n_nationkey ELSE lower(n_name) END AS identity FROM nation",
)
def dataset_identity(spark, d):
    n = V.table(spark, d, "nation")
    iso3 = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).otherwise(F.lit(""))
    folder = F.concat(F.lit("folder_"), F.col("n_nationkey").cast("string"))
    return n.select(F.col("n_nationkey").alias("id"), FL.dataset_identity(iso3, folder).alias("identity"))


@query("world_boundary", f"{V.with_('pts')} SELECT id FROM pts")
def world_boundary(spark, d):
    world = Boundary("WLD", WORLD_BBOX, None, "whole planet (boundary.geom: world)")
    points = FL.build_where(V.point_features(spark, d), world.bbox, box=None, geom="geom")
    return world.keep(points, "id").select("id")
