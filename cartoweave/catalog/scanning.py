"""Scans, listings, element assembly and extracts, and every sink read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartoweave.catalog import filtering as FI
from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.catalog.scalars import sql_number
from cartoweave.functions import geom as G
from cartoweave.functions import wkt
from cartoweave.operators import elements as E
from cartoweave.operators import layers as L
from cartoweave.operators import resume as RS
from cartoweave.plans import export as X
from cartoweave.sources import scans, sinks
from cartoweave.sources.base import ExtractSource, ReleaseSource
from cartoweave.sources.boundary import WORLD_BBOX, Boundary, parse_geojson
from cartoweave.spec import CategorySpec, OsmBlock, OvertureBlock, RunSpec


def write_release(spark, d) -> str:
    root = V.scratch(spark, "release")
    df = V.nested_features(spark, d).selectExpr(
        "*", "CASE WHEN p_partkey % 2 = 0 THEN 'places' ELSE 'base' END AS theme", "lower(class) AS type"
    )
    df.write.partitionBy("theme", "type").parquet(f"{root}/2026-04-15.0")
    return root


@query(
    "scan_hive_release",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, true AS has_filename FROM part WHERE p_partkey % 2 = 0 AND p_size % 5 <> 0 AND p_type = 'PROMO'",
)
def scan_hive_release(spark, d):
    df = scans.scan_release(spark, write_release(spark, d), "2026-04-15.0", "places", "promo")
    return df.select("id", F.col("names.primary").alias("name"), F.col("filename").contains("theme=places/type=promo").alias("has_filename"))


@query(
    "scan_feature_extract",
    f"{V.with_('tagged')} SELECT feature_id, brand, true AS tagged FROM tagged UNION ALL SELECT feature_id, NULL, false FROM tagged",
)
def scan_feature_extract(spark, d):
    full, bare = V.scratch(spark, "extract"), V.scratch(spark, "extract")
    df = V.tagged_features(spark, d)
    df.write.parquet(full)
    df.drop("tags").write.parquet(bare)
    one = scans.scan_extract(spark, full).select("feature_id", FI.FL.map_value("tags", "brand").alias("brand"), F.lit(True).alias("tagged"))
    two = scans.scan_extract(spark, bare).select("feature_id", FI.FL.map_value("tags", "brand").alias("brand"), F.lit(False).alias("tagged"))
    return one.unionByName(two)


@query(
    "latest_release",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') || '.' || (o_orderkey % 12) AS release FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey % 12 DESC LIMIT 1",
)
def latest_release(spark, d):
    listing = V.table(spark, d, "orders").selectExpr(
        "concat('release/', date_format(o_orderdate, 'yyyy-MM-dd'), '.', o_orderkey % 12, '/') AS prefix"
    )
    return scans.latest_release(listing)


@query(
    "latest_snapshot",
    "SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS snapshot FROM orders UNION ALL SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM orders",
)
def latest_snapshot(spark, d):
    listing = V.table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("name"))
    first = listing.agg(F.min("name").alias("name")).first()["name"]
    return scans.latest_snapshot(listing).unionByName(scans.latest_snapshot(listing, first))


@query(
    "scan_admin_level",
    "SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS pcode, n_name AS name, 'R2' AS adm0_pcode, 'Region 2' AS adm0_name FROM nation WHERE n_regionkey = 2",
)
def scan_admin_level(spark, d):
    path = V.scratch(spark, "admin1")
    V.admin_table(spark, d, 1).write.parquet(path)
    return scans.scan_admin(spark, path, 1, "r2").drop("geom")


@query(
    "geojson_boundary",
    f"{V.with_('squares')} SELECT id, 'POLYGON' AS kind, round(x, 7) AS xmin, round(y, 7) AS ymin, round(x + s, 7) AS xmax, round(y + s, 7) AS ymax FROM squares "
    "UNION ALL SELECT id, 'POLYGON', round(x, 7), round(y, 7), round(x + s, 7), round(y + s, 7) FROM squares WHERE id % 3 = 2",
)
def geojson_boundary(spark, d):
    shape = wkt.to_geojson("geom")
    feature = F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), shape, F.lit("}"))
    pair = F.concat(F.lit('{"type":"FeatureCollection","features":['), feature, F.lit(","), feature, F.lit("]}"))
    text = F.when(F.col("id") % 3 == 0, shape).when(F.col("id") % 3 == 1, feature).otherwise(pair)
    docs = V.poly_features(spark, d).select("id", text.alias("text"))
    boxes = parse_geojson(docs).select("id", "geom.kind", G.extent("geom").alias("b"))
    return boxes.select("id", "kind", *[F.round(f"b.{c}", 7).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


WAYS = """shaped AS (SELECT r.id, count(*) AS n, r.id % 3 = 0 AND count(*) >= 4 AS is_ring, min(x) AS xmin, max(y) AS ymax
    FROM way_refs r JOIN nodes n ON r.ref = n.id GROUP BY r.id)"""


@query(
    "assemble_features",
    f"""{V.with_('nodes', 'way_refs')}, {WAYS}, members AS (SELECT s_suppkey AS rel, unnest([s_suppkey * 3, s_suppkey * 3 + 3]) AS way FROM supplier),
    rels AS (SELECT rel, count(*) AS parts, sum(n) AS n, min(xmin) AS xmin, max(ymax) AS ymax FROM members JOIN shaped ON way = id WHERE n >= 4 GROUP BY rel)
    SELECT 'node/' || id AS feature_id, 'POINT' AS kind, 1 AS n_tags, 1 AS vertices, x AS xmin, y AS ymax FROM nodes WHERE amenity IS NOT NULL
    UNION ALL SELECT 'way/' || id, CASE WHEN is_ring AND id % 6 = 0 THEN 'POLYGON' ELSE 'LINESTRING' END, 2, CAST(n AS INTEGER), xmin, ymax FROM shaped WHERE n >= 2
    UNION ALL SELECT 'relation/' || rel, 'MULTIPOLYGON', 2, CAST(n AS INTEGER), xmin, ymax FROM rels""",
)
def assemble_features(spark, d):
    features = E.assemble_features(V.nodes(spark, d), V.ways(spark, d), V.relations(spark, d), step=V.STEP)
    box = G.extent("geom")
    return features.select(
        "feature_id", F.col("geom.kind").alias("kind"), F.size("tags").alias("n_tags"), F.size(G.vertices("geom")).alias("vertices"),
        box["xmin"].alias("xmin"), box["ymax"].alias("ymax"),
    )


INSIDE = (
    f"inside AS (SELECT DISTINCT id FROM (SELECT id FROM nodes, edges1 WHERE k % 2 = 0 AND {V.SQL_PARITY} GROUP BY id, k HAVING count(*) % 2 = 1)), "
    "held AS (SELECT r.id, count(*) AS n FROM way_refs r JOIN inside i ON r.ref = i.id GROUP BY r.id)"
)
WHOLE = "whole AS (SELECT id, CASE WHEN id % 3 = 0 THEN 5 ELSE 4 END AS n FROM {0})"


def as_rows(parts):
    nodes = parts["nodes"].select(F.lit("node").alias("element"), "id", F.lit(0).alias("n_refs"))
    ways = parts["ways"].select(F.lit("way").alias("element"), "id", F.size("refs").alias("n_refs"))
    out = nodes.unionByName(ways)
    if "relations" in parts:
        out = out.unionByName(parts["relations"].select(F.lit("relation").alias("element"), "id", F.size("members").alias("n_refs")))
    return out


def extract(spark, d, strategy):
    return as_rows(
        E.extract_elements(V.nodes(spark, d), V.ways(spark, d), FI.some_nations(spark, d), strategy, V.relations(spark, d), V.STEP)
    )


@query(
    "extract_simple",
    f"{V.with_('nodes', 'way_refs', 'edges1')}, {INSIDE} SELECT 'node' AS element, id, 0 AS n_refs FROM inside UNION ALL SELECT 'way', id, CAST(n AS INTEGER) FROM held",
)
def extract_simple(spark, d):
    return extract(spark, d, "simple")


NODES_OF = "SELECT id FROM inside UNION SELECT n.id FROM way_refs r JOIN whole w ON r.id = w.id JOIN nodes n ON r.ref = n.id"


@query(
    "extract_complete_ways",
    f"{V.with_('nodes', 'way_refs', 'edges1')}, {INSIDE}, {WHOLE.format('held')} SELECT 'node' AS element, id, 0 AS n_refs FROM ({NODES_OF}) UNION ALL SELECT 'way', id, n FROM whole",
)
def extract_complete_ways(spark, d):
    return extract(spark, d, "complete_ways")


@query(
    "extract_smart",
    f"""{V.with_('nodes', 'way_refs', 'edges1')}, {INSIDE}, members AS (SELECT s_suppkey AS rel, unnest([s_suppkey * 3, s_suppkey * 3 + 3]) AS way FROM supplier),
    touched AS (SELECT DISTINCT rel FROM members WHERE way IN (SELECT id FROM held)),
    kept AS (SELECT id FROM held UNION SELECT m.way FROM members m JOIN touched USING (rel) JOIN orders o ON o.o_orderkey = m.way),
    {WHOLE.format('kept')} SELECT 'node' AS element, id, 0 AS n_refs FROM ({NODES_OF}) UNION ALL SELECT 'way', id, n FROM whole
    UNION ALL SELECT 'relation', rel, 2 FROM touched""",
)
def extract_smart(spark, d):
    return extract(spark, d, "smart")


@query("cluster_by_cell", f"{V.with_('lines')} SELECT id, priority, least(x1, x2) AS xmin FROM lines")
def cluster_by_cell(spark, d):
    path = V.scratch(spark, "clustered")
    sinks.write_clustered(V.line_features(spark, d), path)
    return spark.read.parquet(path).select("id", "priority", "bbox.xmin")


@query("write_layer_parquet", f"{V.with_('lines')} SELECT id, priority, x1, y1, x2, y2 FROM lines")
def write_layer_parquet(spark, d):
    path = V.scratch(spark, "layer")
    sinks.write_layer(V.line_features(spark, d), path)
    ring = F.col("geom.parts")[0][0]
    return spark.read.parquet(path).select(
        "id", "priority", ring[0]["x"].alias("x1"), ring[0]["y"].alias("y1"), ring[1]["x"].alias("x2"), ring[1]["y"].alias("y2")
    )


@query("write_geoparquet", f"{V.with_('lines')} SELECT id, priority, x1, y1, x2, y2 FROM lines")
def write_geoparquet(spark, d):
    path = V.scratch(spark, "geoparquet")
    sinks.write_geoparquet(V.line_features(spark, d).select("id", "priority", "geom"), path)
    back = sinks.decode_wkb(spark.read.parquet(path))
    ring = F.col("geom.parts")[0][0]
    return back.select(
        "id", "priority", ring[0]["x"].alias("x1"), ring[0]["y"].alias("y1"), ring[1]["x"].alias("x2"), ring[1]["y"].alias("y2")
    )


@query(
    "read_geoparquet_box",
    f"""{V.with_('lines')} SELECT id, x1, y1, x2, y2, least(x1, x2) AS xmin, greatest(y1, y2) AS ymax FROM lines
    WHERE least(x1, x2) <= 40 AND greatest(x1, x2) >= -60 AND least(y1, y2) <= 35 AND greatest(y1, y2) >= -20""",
)
def read_geoparquet_box(spark, d):
    """Lines whose box meets another, from a clustered layer."""
    path = V.scratch(spark, "geoparquet_box")
    sinks.write_geoparquet(V.line_features(spark, d).select("id", "geom"), path, cluster=True)
    ring = F.col("geom.parts")[0][0]
    return sinks.read_geoparquet(spark, path, (-60.0, -20.0, 40.0, 35.0)).select(
        "id", ring[0]["x"].alias("x1"), ring[0]["y"].alias("y1"), ring[1]["x"].alias("x2"), ring[1]["y"].alias("y2"), "bbox.xmin", "bbox.ymax"
    )


@query(
    "write_geojson",
    f"""{V.with_('pts')} SELECT '{{"type":"Feature","properties":{{"id":' || id || ',"name":"' || name || '","segment":' || CASE WHEN id % 4 = 0 THEN 'null' ELSE '"' || segment || '"' END
    || '}},"geometry":{{"type":"Point","coordinates":[' || {sql_number('x')} || ',' || {sql_number('y')} || ']}}}}' AS value FROM pts""",
)
def write_geojson(spark, d):
    path = V.scratch(spark, "geojson")
    points = V.point_features(spark, d).withColumn("segment", F.when(F.col("id") % 4 != 0, F.col("segment"))).drop("balance")
    sinks.write_geojson(points, path)
    return spark.read.text(path)


@query(
    "write_kml",
    f"""{V.with_('lines')} SELECT '<Placemark><ExtendedData><Data name="id"><value>' || id || '</value></Data><Data name="note"><value>&lt;' || priority || '&gt; &amp; more</value></Data></ExtendedData>'
    || '<LineString><coordinates>' || {sql_number('x1')} || ',' || {sql_number('y1')} || ' ' || {sql_number('x2')} || ',' || {sql_number('y2')} || '</coordinates></LineString></Placemark>' AS value FROM lines""",
)
def write_kml(spark, d):
    path = V.scratch(spark, "kml")
    lines = V.line_features(spark, d).select("id", F.concat(F.lit("<"), "priority", F.lit("> & more")).alias("note"), "geom")
    sinks.write_kml(lines, path)
    return spark.read.text(path).where(F.startswith("value", F.lit("<Placemark>")))


@query(
    "write_split_by_geometry",
    "SELECT 'points' AS geometry_label, count(*) AS n, count_if(c_custkey % 4 = 0)::BIGINT AS multi FROM customer UNION ALL SELECT 'lines', count(*), count_if(o_orderkey % 5 = 0)::BIGINT FROM orders "
    "UNION ALL SELECT 'polygons', count(*), count_if(s_suppkey % 3 = 0)::BIGINT FROM supplier",
)
def write_split_by_geometry(spark, d):
    path = V.scratch(spark, "split")
    sinks.write_split(V.mixed_features(spark, d), path)
    return spark.read.parquet(path).groupBy("geometry_label").agg(
        F.count("*").alias("n"), F.count_if(F.startswith("geom.kind", F.lit("MULTI"))).alias("multi")
    )


@query(
    "staged_layers",
    "SELECT CASE WHEN p_partkey % 3 = 1 THEN 'overture' ELSE 'other' END AS source, lower(p_type) AS slug, count(*) AS n FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 2 = 0 GROUP BY ALL",
)
def staged_layers(spark, d):
    root = V.scratch(spark, "staged")
    df = V.nested_features(spark, d).join(V.table(spark, d, "part").select("p_partkey", "p_type"), "p_partkey").selectExpr(
        "id", "geometry AS geom", "CASE WHEN p_partkey % 2 = 0 THEN 'NPL' ELSE 'COD' END AS iso3",
        "CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source", "lower(p_type) AS slug",
    )
    sinks.stage_layers(df, root)
    return sinks.staged_layers(spark, root, "npl", "osm").groupBy("source", "slug").agg(F.count("*").alias("n"))


TILE = """least(greatest(CAST(floor((1e0 - ln(tan(radians(greatest(-85.0511287798066e0, least(85.0511287798066e0, {0})))) + 1e0 / cos(radians(greatest(-85.0511287798066e0, least(85.0511287798066e0, {0})))))
    / pi()) / 2e0 * pow(2e0, z)) AS BIGINT), 0), CAST(pow(2, z) AS BIGINT) - 1)"""
TILE_X = "least(greatest(CAST(floor(({0} + 180) / 360e0 * pow(2e0, z)) AS BIGINT), 0), CAST(pow(2, z) AS BIGINT) - 1)"


@query(
    "tile_pyramid",
    f"{V.with_('pts')} SELECT z, tx AS x, ty AS y, 'places' AS layer, count(*) AS n FROM (SELECT CAST(range AS INTEGER) AS z, {TILE_X.format('x')} AS tx, {TILE.format('y')} AS ty FROM pts, range(13)) GROUP BY ALL",
)
def tile_pyramid(spark, d):
    return L.tile_counts(L.tile_pyramid(V.point_features(spark, d)), "places")


@query(
    "tile_pyramid_areas",
    f"{V.with_('squares')}, b AS (SELECT id, CAST(range AS INTEGER) AS z, {TILE_X.format('x')} AS x1, {TILE_X.format('(x + s)')} AS x2, {TILE.format('(y + s)')} AS y1, {TILE.format('y')} AS y2 FROM squares, range(9)), "
    "c AS (SELECT *, unnest(generate_series(x1, x2)) AS x FROM b), t AS (SELECT *, unnest(generate_series(y1, y2)) AS y FROM c) SELECT z, x, y, id FROM t",
)
def tile_pyramid_areas(spark, d):
    return L.tile_pyramid(V.poly_features(spark, d), 0, 8).select("z", "x", "y", "id")


@query(
    "layer_metadata_sink",
    f"{V.with_('lines')} SELECT 'roads' AS category, 'osm' AS source, count(*) AS feature_count, min(least(x1, x2)) AS xmin, 3::INTEGER AS n_columns, count(DISTINCT priority) AS priorities FROM lines",
)
def layer_metadata_sink(spark, d):
    path = V.scratch(spark, "metadata")
    meta = X.layer_metadata(V.line_features(spark, d), "roads", "osm", "2026-04-15")
    sinks.write_layer_metadata(meta, path)
    back = sinks.read_layer_metadata(spark, path, meta.schema)
    return back.select(
        "category", "source", "feature_count", "xmin", F.size("columns").alias("n_columns"),
        F.filter("columns", lambda c: c["name"] == "priority")[0]["distinct_count"].alias("priorities"),
    )


@query(
    "export_manifest",
    "SELECT upper(o_orderpriority) AS iso3, 'user-provided' AS boundary, '(' || printf('%.4f', min(o_totalprice)) || ', 0.0000, ' || printf('%.4f', max(o_totalprice)) || ', 90.0000)' AS bbox, "
    "o_orderstatus AS dataset, 'geojson' AS format, format('{:,}', count(*)) AS features, 'OpenStreetMap' AS source, '2026' AS snapshot, 'ODbL' AS license, "
    "CASE WHEN o_orderstatus = 'F' THEN '(not specified)' ELSE 'u' END AS license_url FROM orders GROUP BY o_orderpriority, o_orderstatus",
)
def export_manifest(spark, d):
    results = V.table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.min("o_totalprice").alias("xmin"), F.max("o_totalprice").alias("xmax"), F.count("*").alias("feature_count")
    ).select(
        F.lower("o_orderpriority").alias("iso3"), F.lit("user-provided").alias("boundary"), "xmin", F.lit(0.0).alias("ymin"), "xmax",
        F.lit(90.0).alias("ymax"), F.col("o_orderstatus").alias("category"), F.lit("geojson").alias("format"), "feature_count",
        F.lit("OpenStreetMap").alias("source"), F.lit("2026").alias("snapshot"), F.lit("ODbL").alias("license"),
        F.when(F.col("o_orderstatus") != "F", F.lit("u")).alias("license_url"),
    )
    path = V.scratch(spark, "manifest")
    manifest = RS.export_manifest(results)
    manifest.write.json(path)
    return spark.read.schema(manifest.schema).json(path)


@query(
    "write_theme_cache",
    f"{V.with_('tagged')}, {FI.CATEGORISED} SELECT '2026-04-15' AS snapshot, category AS theme, count(*) AS rows, true AS at_theme FROM categorised GROUP BY category",
)
def write_theme_cache(spark, d):
    root = V.scratch(spark, "themes")
    df = V.tagged_features(spark, d).select("feature_id", "tags", "geometry")
    sinks.write_theme_cache(df, FI.CATEGORIES, root, "2026-04-15", themes=["branded", "two_brands"])
    kept = sinks.cached_themes(spark, root, "2026-04-15")
    manifest = sinks.write_theme_cache(df, FI.CATEGORIES, root, "2026-04-15", existing=kept)
    return manifest.select("snapshot", "theme", "rows", F.endswith("path", F.concat(F.lit("theme="), "theme")).alias("at_theme"))


@query(
    "artifact_path",
    "SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'exp/v1/' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN 'f' || p_size ELSE 'NPL' END || '/' || lower(p_type) || "
    "CASE WHEN p_partkey % 2 = 0 THEN '/points' ELSE '' END || '/tm_npl_' || lower(p_type) || CASE WHEN p_partkey % 2 = 0 THEN '_points' ELSE '' END || '_osm_geojson.zip' AS path FROM part",
)
def artifact_path(spark, d):
    slug = F.lower("p_type")
    geometry = F.when(F.col("p_partkey") % 2 == 0, F.lit("points")).otherwise(F.lit(""))
    name = L.artifact_name(F.lit("tm_npl"), slug, geometry, F.lit("osm"), F.lit("geojson"))
    prefix = F.when(F.col("p_size") % 2 == 0, F.lit("/exp/v1/")).otherwise(F.lit(""))
    folder = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("f"), F.col("p_size").cast("string"))).otherwise(F.lit(""))
    return V.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), L.artifact_key(prefix, F.lit("npl"), slug, name, folder, geometry).alias("path")
    )


RUN_CATEGORIES = (
    CategorySpec("Economy", osm=OsmBlock(filter={"type": "ECONOMY"}, select=("feature_id AS id", "tags['name'] AS name"))),
    CategorySpec("Branded", osm=OsmBlock(filter={"brand": True}, select=("feature_id AS id", "tags['brand'] AS brand"), where=("tags['type'] <> 'PROMO'",))),
    CategorySpec("Nothing", osm=OsmBlock(filter={"type": "NONE"}, select=("feature_id AS id",))),
    CategorySpec("Disabled", osm=OsmBlock(enabled=False)),
    CategorySpec("Formatless", formats=(), osm=OsmBlock(filter={"type": "SMALL"}, select=("feature_id AS id",))),
)


@query(
    "source_plugin",
    f"""{V.with_('tagged', 'edges1')}, inside AS (SELECT DISTINCT feature_id, brand, type FROM (SELECT feature_id, brand, type FROM tagged, edges1
        WHERE k % 2 = 0 AND {FI.IN_BBOX} AND {V.SQL_PARITY} GROUP BY feature_id, brand, type, k HAVING count(*) % 2 = 1))
    SELECT 'NPL' AS iso3, 'osm' AS source, 'economy' AS slug, 'ok' AS status, count(*) AS features FROM inside WHERE type = 'ECONOMY'
    UNION ALL SELECT 'NPL', 'osm', 'branded', 'ok', count(*) FROM inside WHERE brand IS NOT NULL AND type <> 'PROMO'
    UNION ALL SELECT 'NPL', 'osm', 'nothing', 'empty', 0 UNION ALL SELECT 'NPL', 'osm', 'disabled', 'skipped', 0
    UNION ALL SELECT 'NPL', 'osm', 'formatless', 'ok', count(*) FROM inside WHERE type = 'SMALL'""",
)
def source_plugin(spark, d):
    extract = V.tagged_features(spark, d).select("feature_id", "tags", "geometry")
    run = RunSpec(iso3="NPL", key="tm", formats=("geojson",), categories=RUN_CATEGORIES)
    area = Boundary("NPL", FI.BBOX, FI.some_nations(spark, d), "nations")
    statuses, _ = X.run_export(
        spark, run, ExtractSource(spark, extract, "2026-04-15"), area, V.scratch(spark, "run"), points=True, step=V.STEP
    )
    return spark.createDataFrame(
        [(s["iso3"], s["source"], s["slug"], s["status"], s["features"]) for s in statuses],
        "iso3 string, source string, slug string, status string, features bigint",
    )


INSIDE_TAGGED = f"""{V.with_('tagged', 'edges1')}, inside AS (SELECT DISTINCT feature_id, brand, type FROM (SELECT feature_id, brand, type FROM tagged, edges1
        WHERE k % 2 = 0 AND {FI.IN_BBOX} AND {V.SQL_PARITY} GROUP BY feature_id, brand, type, k HAVING count(*) % 2 = 1))"""
TWO_CATEGORIES = RUN_CATEGORIES[:2]
TWO_COUNTS = "SELECT 'economy' AS slug, count(*) AS features FROM inside WHERE type = 'ECONOMY' UNION ALL SELECT 'branded', count(*) FROM inside WHERE brand IS NOT NULL AND type <> 'PROMO'"


def tagged_source(spark, d, name="osm", keep="true"):
    source = ExtractSource(spark, V.tagged_features(spark, d).select("feature_id", "tags", "geometry").where(keep), "2026-04-15")
    source.name = name
    return source


def nations_area(spark, d):
    return Boundary("NPL", FI.BBOX, FI.some_nations(spark, d), "nations")


@query("format_failure", f"{INSIDE_TAGGED} SELECT slug, 'partial' AS status, features, 'ok' AS geojson, 'unsupported format: gpkg' AS gpkg FROM ({TWO_COUNTS})")
def format_failure(spark, d):
    run = RunSpec(iso3="NPL", formats=("gpkg", "geojson"), categories=TWO_CATEGORIES)
    statuses, _ = X.run_export(spark, run, tagged_source(spark, d), nations_area(spark, d), V.scratch(spark, "run"), points=True, step=V.STEP)
    rows = [(s["slug"], s["status"], s["features"], s["formats"]["geojson"], s["formats"]["gpkg"]) for s in statuses]
    return spark.createDataFrame(rows, "slug string, status string, features bigint, geojson string, gpkg string")


@query(
    "resume_round_trip",
    f"""{INSIDE_TAGGED}, counted AS ({TWO_COUNTS}),
    runs AS (SELECT 1 AS run, 'geojson' AS formats, 'id,name,name_ne' AS columns UNION ALL SELECT 2, 'geojson', 'id,name,name_ne' UNION ALL SELECT 3, 'geojson,kml', 'id,name,name_ne' UNION ALL SELECT 4, 'geojson,kml', 'id,kind,name_ne')
    SELECT CAST(run AS INTEGER) AS run, slug, CASE WHEN run = 1 OR (run = 4 AND slug = 'economy') THEN 'ok' ELSE 'resumed' END AS status, features, formats,
        CASE WHEN slug = 'economy' THEN columns ELSE 'id,brand,name_ne' END AS columns
    FROM counted, runs""",
)
def resume_round_trip(spark, d):
    """The same run again, then with another format, then with another select list."""
    root, rows = V.scratch(spark, "run"), []
    other = X.replace(TWO_CATEGORIES[0], osm=X.replace(TWO_CATEGORIES[0].osm, select=("feature_id AS id", "tags['type'] AS kind")))
    runs = [(("geojson",), TWO_CATEGORIES), (("geojson",), TWO_CATEGORIES), (("geojson", "kml"), TWO_CATEGORIES), (("geojson", "kml"), (other, TWO_CATEGORIES[1]))]
    for number, (formats, categories) in enumerate(runs, 1):
        run = RunSpec(iso3="NPL", formats=formats, categories=categories)
        statuses, layers = X.run_export(spark, run, tagged_source(spark, d), nations_area(spark, d), root, points=True, step=V.STEP)
        for s in statuses:
            written = ",".join(sorted(f for f, how in s["formats"].items() if how == "ok"))
            rows.append((number, s["slug"], s["status"], s["features"], written, ",".join(c for c in layers[s["slug"]].columns if c != "geom")))
    return spark.createDataFrame(rows, "run int, slug string, status string, features bigint, formats string, columns string")


@query(
    "run_combined",
    f"""{INSIDE_TAGGED}, both_sources AS (SELECT 'osm' AS source, * FROM inside UNION ALL SELECT 'overture', * FROM inside WHERE feature_id LIKE '%7'),
    merged AS (SELECT 'economy' AS category, source FROM both_sources WHERE type = 'ECONOMY' UNION ALL SELECT 'branded', source FROM both_sources WHERE brand IS NOT NULL AND type <> 'PROMO')
    SELECT category, source, count(*) AS features, 3 * count(*) AS tiles FROM merged GROUP BY category, source""",
)
def run_combined(spark, d):
    run = RunSpec(iso3="NPL", formats=("geojson",), categories=TWO_CATEGORIES, tiles=True, min_zoom=0, max_zoom=2)
    sources = [tagged_source(spark, d, "overture", "feature_id LIKE '%7'"), tagged_source(spark, d)]
    found = X.run_combined(spark, run, sources, nations_area(spark, d), V.scratch(spark, "run"), points=True, step=V.STEP)
    tiles = found.tiles.groupBy("category", "source").agg(F.count("*").alias("tiles"))
    return found.metadata.select("category", "source", F.col("feature_count").alias("features")).join(tiles, ["category", "source"])


@query(
    "export_release_layer",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS source FROM part "
    f"WHERE p_partkey % 2 = 0 AND p_size % 5 <> 0 AND p_type = 'PROMO' AND p_size > 5",
)
def export_release_layer(spark, d):
    category = CategorySpec(
        "Places", overture=OvertureBlock(
            theme="places", feature_type="promo",
            select=("id", "names.primary AS name", "get(sources, 0).dataset AS source"), where=("num_floors > 5",),
        ),
    )
    run = RunSpec(iso3="NPL", categories=(category,))
    source = ReleaseSource(spark, write_release(spark, d), "2026-04-15.0")
    world = Boundary("NPL", WORLD_BBOX, None, "whole planet (boundary.geom: world)")
    query_ = source.query_for(run, category)
    # Boxes of the test rows stretch one degree past the world; only the earth test matters here.
    return X.build_layer(X.replace(query_, box=None), category, world, run).drop("geom")
