"""Scalar functions: text, geometry, grid and naming."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.functions import geom as G
from cartoweave.functions import grid, text, wkt
from cartoweave.operators import layers as L
from cartoweave.operators import report as R
from cartoweave.operators import resume as RS
from cartoweave.spec import TransliterateRule

@query(
    "slugify",
    "SELECT page_id, trim(lower(regexp_replace(url, '[^a-zA-Z0-9]+', '_', 'g')), '_') AS slug FROM pages",
)
def slugify(spark, d):
    return V.table(spark, d, "pages").select("page_id", text.slugify("url").alias("slug"))


@query(
    "title_case_category",
    "WITH w AS (SELECT p_partkey, unnest(string_split(trim(replace(p_name || '_of_the_' || p_type, '_', ' ')), ' ')) AS w, "
    "generate_subscripts(string_split(trim(replace(p_name || '_of_the_' || p_type, '_', ' ')), ' '), 1) AS i FROM part) "
    "SELECT p_partkey AS id, string_agg(CASE WHEN i > 1 AND lower(w) IN ('a','an','and','at','by','for','in','of','on','or','the','to') THEN lower(w) "
    "ELSE upper(w[1]) || lower(w[2:]) END, ' ' ORDER BY i) AS title FROM w GROUP BY p_partkey",
)
def title_case_category(spark, d):
    name = F.concat("p_name", F.lit("_of_the_"), "p_type")
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.title_case(name).alias("title"))


@query(
    "title_template",
    "SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'Roads of ' || r_name ELSE r_name || ' (' || upper(n_name) || '): Roads' END AS title, "
    "CASE WHEN n_nationkey % 2 = 0 THEN r_name || ' OpenStreetMap vector data' ELSE 'All of ' || r_name END AS combined "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def title_template(spark, d):
    df = V.table(spark, d, "nation").join(V.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    template = F.when(F.col("n_nationkey") % 3 != 0, F.lit("{country} ({iso3}): {category}")).otherwise(F.lit(""))
    whole = F.when(F.col("n_nationkey") % 2 != 0, F.lit("All of {country}"))
    return df.select(
        F.col("n_nationkey").alias("id"),
        text.title(template, F.lit("Roads"), F.col("r_name"), F.col("n_name")).alias("title"),
        text.combined_title(whole, F.col("r_name"), F.col("n_name"), text.source_name(F.lit("osm"))).alias("combined"),
    )


@query(
    "country_name",
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN c_name WHEN n_name IS NULL THEN 'NATION_' || (c_custkey % 30) "
    "WHEN n_nationkey % 2 = 0 THEN 'Common ' || n_nationkey ELSE 'Formal ' || n_nationkey END AS country "
    "FROM customer LEFT JOIN nation ON c_custkey % 30 = n_nationkey",
)
def country_name(spark, d):
    df = V.table(spark, d, "customer").selectExpr(
        "c_custkey AS id", "concat('nation_', c_custkey % 30) AS iso3", "CASE WHEN c_custkey % 10 = 0 THEN c_name END AS dataset_name"
    )
    names = V.table(spark, d, "nation").selectExpr(
        "n_name AS iso3", "CASE WHEN n_nationkey % 2 = 0 THEN concat('Common ', n_nationkey) END AS common_name", "concat('Formal ', n_nationkey) AS name"
    )
    return text.country_name(df, names).select("id", "country")


@query(
    "transliterate",
    "SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS text_latin, coalesce(CASE WHEN doc_id % 4 = 0 THEN lang END, replace(strip_accents(text), 'ß', 'ss')) AS shown FROM documents",
)
def transliterate(spark, d):
    docs = V.table(spark, d, "documents").selectExpr("doc_id", "text", "CASE WHEN doc_id % 4 = 0 THEN lang END AS text_en")
    rules = [TransliterateRule("text_latin", "text"), TransliterateRule("shown", "text", "text_en")]
    return text.transliterate(docs, rules).select("doc_id", "text_latin", "shown")


@query(
    "geom_extent",
    f"{V.with_('lines')} SELECT id, least(x1, x2) AS xmin, least(y1, y2) AS ymin, greatest(x1, x2) AS xmax, greatest(y1, y2) AS ymax FROM lines",
)
def geom_extent(spark, d):
    return V.line_features(spark, d).select("id", G.extent("geom").alias("b")).select("id", "b.*")


@query(
    "geom_kind",
    "SELECT 'node/' || c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'MULTIPOINT' ELSE 'POINT' END AS kind, 'points' AS label FROM customer "
    "UNION ALL SELECT 'way/' || o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'MULTILINESTRING' ELSE 'LINESTRING' END, 'lines' FROM orders "
    "UNION ALL SELECT 'area/' || s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END, 'polygons' FROM supplier",
)
def geom_kind(spark, d):
    return V.mixed_features(spark, d).select("id", G.kind("geom").alias("kind"), G.label("geom").alias("label"))


@query(
    "geom_label",
    "SELECT label, count(*) AS n FROM (SELECT 'points' AS label FROM customer UNION ALL SELECT 'lines' FROM orders UNION ALL SELECT 'polygons' FROM supplier) GROUP BY label",
)
def geom_label(spark, d):
    return V.mixed_features(spark, d).groupBy(G.label("geom").alias("label")).agg(F.count("*").alias("n"))


@query(
    "geom_centroid",
    f"{V.with_('pts', 'lines', 'squares')} SELECT 'node/' || id AS id, round(x, 6) AS cx, round(y, 6) AS cy FROM pts "
    "UNION ALL SELECT 'way/' || id, round((x1 + x2) / 2, 6), round((y1 + y2) / 2, 6) FROM lines "
    "UNION ALL SELECT 'area/' || id, round(x + s / 2, 6), round(y + s / 2, 6) FROM squares",
)
def geom_centroid(spark, d):
    df = V.mixed_features(spark, d).select("id", G.centroid("geom").alias("c"))
    return df.select("id", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query(
    "geom_centroid_admin",
    f"""{V.with_('edges1')}, m AS (SELECT k, sum((x1 * y2 - x2 * y1) / 2) AS a, sum((x1 + x2) * (x1 * y2 - x2 * y1) / 6) AS sx,
        sum((y1 + y2) * (x1 * y2 - x2 * y1) / 6) AS sy FROM edges1 GROUP BY k)
    SELECT k, round(sx / a, 6) AS cx, round(sy / a, 6) AS cy FROM m""",
)
def geom_centroid_admin(spark, d):
    df = V.admin1(spark, d).select("k", G.centroid("geom").alias("c"))
    return df.select("k", F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query(
    "geom_dump",
    "SELECT id, 'POINT' AS kind, count(*) AS parts FROM (SELECT 'node/' || c_custkey AS id FROM customer UNION ALL SELECT 'node/' || c_custkey FROM customer WHERE c_custkey % 4 = 0) GROUP BY id "
    "UNION ALL SELECT id, 'LINESTRING', count(*) FROM (SELECT 'way/' || o_orderkey AS id FROM orders UNION ALL SELECT 'way/' || o_orderkey FROM orders WHERE o_orderkey % 5 = 0) GROUP BY id "
    "UNION ALL SELECT id, 'POLYGON', count(*) FROM (SELECT 'area/' || s_suppkey AS id FROM supplier UNION ALL SELECT 'area/' || s_suppkey FROM supplier WHERE s_suppkey % 3 = 0) GROUP BY id",
)
def geom_dump(spark, d):
    parts = V.mixed_features(spark, d).select("id", F.explode(G.dump("geom")).alias("part"))
    return parts.groupBy("id", F.col("part.kind").alias("kind")).agg(F.count("*").alias("parts"))


@query(
    "geom_thin",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 6 END AS n FROM orders",
)
def geom_thin(spark, d):
    """Six-vertex lines; the fourth vertex of every other one lies 0.00005 off its chord."""
    x, y = V.lon("o_custkey"), V.lat("o_custkey")
    off = "CASE WHEN o_orderkey % 2 = 0 THEN 0.00005D ELSE 0.5D END"
    steps = [("0", "0"), ("1", "1"), ("2", "0"), ("3", off), ("4", "0"), ("5", "2")]
    ring = "array(" + ", ".join(f"struct({x} + {a} AS x, {y} + {b} AS y)" for a, b in steps) + ")"
    lines = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), G.line(F.expr(ring)).alias("geom"))
    return lines.select("id", F.size(G.vertices(G.thin("geom", 0.0001))).alias("n"))


def sql_number(expr: str) -> str:
    return f"regexp_replace(printf('%.7f', {expr}), '\\.?0+$', '')"


@query(
    "geom_to_text",
    f"{V.with_('pts', 'lines', 'squares')} SELECT 'node/' || id AS id, 'POINT (' || {sql_number('x')} || ' ' || {sql_number('y')} || ')' AS wkt FROM pts "
    f"UNION ALL SELECT 'way/' || id, 'LINESTRING (' || {sql_number('x1')} || ' ' || {sql_number('y1')} || ', ' || {sql_number('x2')} || ' ' || {sql_number('y2')} || ')' FROM lines "
    f"UNION ALL SELECT 'area/' || id, 'POLYGON ((' || {sql_number('x')} || ' ' || {sql_number('y')} || ', ' || {sql_number('x + s')} || ' ' || {sql_number('y')} || ', ' "
    f"|| {sql_number('x + s')} || ' ' || {sql_number('y + s')} || ', ' || {sql_number('x')} || ' ' || {sql_number('y + s')} || ', ' || {sql_number('x')} || ' ' || {sql_number('y')} || '))' FROM squares",
)
def geom_to_text(spark, d):
    parts = [
        (V.point_features(spark, d), "node/"), (V.line_features(spark, d), "way/"), (V.poly_features(spark, d), "area/"),
    ]
    out = None
    for df, prefix in parts:
        one = df.select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"), wkt.to_wkt("geom").alias("wkt"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "geom_from_text",
    f"{V.with_('lines')} SELECT id, 'MULTILINESTRING' AS kind, 2 AS parts, round(x1, 7) AS x1, round(y1, 7) AS y1, round(x2, 7) AS x2, round(y2, 7) AS y2 FROM lines",
)
def geom_from_text(spark, d):
    lines = V.line_features(spark, d)
    doubled = F.struct(F.lit("MULTILINESTRING").alias("kind"), F.concat("geom.parts", "geom.parts").alias("parts"))
    back = lines.select("id", wkt.to_wkt(doubled).alias("t")).select("id", wkt.from_wkt("t").alias("g"))
    second = F.col("g.parts")[1][0]
    return back.select(
        "id", F.col("g.kind").alias("kind"), F.size("g.parts").alias("parts"),
        F.round(second[0]["x"], 7).alias("x1"), F.round(second[0]["y"], 7).alias("y1"),
        F.round(second[1]["x"], 7).alias("x2"), F.round(second[1]["y"], 7).alias("y2"),
    )


@query(
    "mercator_xy",
    f"{V.with_('pts')} SELECT id, round(6378137e0 * radians(x), 3) AS mx, CASE WHEN y > -90 THEN round(6378137e0 * ln(tan(pi() / 4 + radians(y) / 2)), 3) END AS my, "
    "round(x, 6) AS lon, CASE WHEN y > -90 THEN round(y, 6) END AS lat FROM pts",
)
def mercator_xy(spark, d):
    p = V.pts(spark, d)
    # The pole itself lies at infinity.
    mx, my = grid.mercator_x(F.col("x")), F.when(F.col("y") > -90, grid.mercator_y(F.col("y")))
    return p.select(
        "id", F.round(mx, 3).alias("mx"), F.round(my, 3).alias("my"),
        F.round(grid.lon_of(mx), 6).alias("lon"), F.round(grid.lat_of(my), 6).alias("lat"),
    )


@query(
    "cell_ring",
    f"{V.with_('pts')}, c AS (SELECT id, least(CAST(floor((y + 90) / 2e0) AS BIGINT), 89) AS r, least(CAST(floor((x + 180) / 2e0) AS BIGINT), 179) AS c FROM pts), "
    "o(dr, dc) AS (SELECT a.range - 1, b.range - 1 FROM range(3) a, range(3) b) "
    "SELECT id, (r + dr) * 180 + ((c + dc + 180) % 180) AS cell FROM c, o WHERE r + dr BETWEEN 0 AND 89",
)
def cell_ring(spark, d):
    g = grid.lonlat(V.STEP)
    return V.pts(spark, d).select("id", F.explode(g.ring(g.cell(F.col("x"), F.col("y")))).alias("cell"))


@query(
    "config_fingerprint",
    "SELECT p_partkey AS id, substr(sha256('{\"clip\":\"' || CASE WHEN p_size % 2 = 0 THEN 'noclip' ELSE p_name END || '\",\"filter\":\"' || p_brand || '\"}'), 1, 12) AS fingerprint FROM part",
)
def config_fingerprint(spark, d):
    clip = F.when(F.col("p_size") % 2 != 0, F.col("p_name"))
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), RS.fingerprint(clip, F.col("p_brand")).alias("fingerprint"))


@query("release_date", "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS released FROM orders")
def release_date(spark, d):
    label = F.concat_ws(".", F.date_format("o_orderdate", "yyyy-MM-dd"), (F.col("o_orderkey") % 12).cast("string"))
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), RS.release_date(label).alias("released"))


@query(
    "snapshot_date",
    "SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN date_trunc('day', o_orderdate) WHEN 1 THEN TIMESTAMP '2026-04-15' ELSE TIMESTAMP '2000-01-01' END AS snapshot FROM orders",
)
def snapshot_date(spark, d):
    stored = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit("broken"))
    label = F.when(F.col("o_orderkey") % 3 == 1, F.lit("2026-04-15")).otherwise(F.lit("unknown"))
    when = RS.snapshot_date(stored, label, F.expr("timestamp '2000-01-01 00:00:00'"))
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), when.cast("timestamp_ntz").alias("snapshot"))


@query("percent_round", "SELECT l_orderkey AS id, round(100e0 * sum(l_linenumber) / (7 * count(*)), 2) AS share FROM lineitem GROUP BY 1")
def percent_round(spark, d):
    share = text.percent(F.sum("l_linenumber"), 7 * F.count("*"))
    return V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(share.alias("share"))


@query(
    "format_count",
    "SELECT o_orderkey AS id, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS full_count, "
    "CASE WHEN floor(o_totalprice) >= 1000 THEN CAST(round_even(floor(o_totalprice) / 1000, 0) AS BIGINT) || 'k' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS short_count FROM orders",
)
def format_count(spark, d):
    n = F.floor("o_totalprice")
    return V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), text.format_count(n).alias("full_count"), text.short_count(n).alias("short_count")
    )


def kinds_by_segment(spark, d):
    """Kinds per group: one kind for some groups, several for others."""
    df = V.table(spark, d, "orders").selectExpr(
        "o_custkey AS layer",
        "CASE WHEN o_custkey % 2 = 0 THEN 'POINT' ELSE element_at(array('POINT', 'LINESTRING', 'POLYGON'), cast(o_orderkey % 3 + 1 as int)) END AS kind",
    )
    return df.groupBy("layer", "kind").agg(F.count("*").alias("n"))


KINDS = (
    "k AS (SELECT o_custkey AS layer, CASE WHEN o_custkey % 2 = 0 THEN 'POINT' ELSE (['POINT', 'LINESTRING', 'POLYGON'])[o_orderkey % 3 + 1] END AS kind, "
    "count(*) AS n FROM orders GROUP BY ALL)"
)


@query("geometry_kpi", f"WITH {KINDS} SELECT layer, CASE WHEN count(*) = 1 THEN any_value(upper(kind[1]) || lower(kind[2:])) || 's' ELSE 'mixed' END AS label FROM k GROUP BY layer")
def geometry_kpi(spark, d):
    return R.sorted_kinds(kinds_by_segment(spark, d), ["layer"]).select("layer", R.geometry_kpi(F.col("kinds")).alias("label"))


@query(
    "geometry_phrase",
    f"WITH {KINDS} SELECT layer, string_agg(upper(kind[1]) || lower(kind[2:]) || ' ' || format('{{:,}}', n), ', ' ORDER BY n DESC, kind) AS phrase FROM k GROUP BY layer",
)
def geometry_phrase(spark, d):
    return R.sorted_kinds(kinds_by_segment(spark, d), ["layer"]).select("layer", R.geometry_phrase(F.col("kinds")).alias("phrase"))


@query(
    "artifact_parse",
    "SELECT p_partkey AS id, CASE WHEN p_size % 4 IN (0, 1) THEN ['points', 'lines'][p_size % 4 + 1] END AS geometry, CASE WHEN p_partkey % 2 = 0 THEN 'osm' ELSE 'overture' END AS source, "
    "CASE WHEN p_size % 4 = 3 THEN 'pmtiles' ELSE 'geojson' END AS format FROM part",
)
def artifact_parse(spark, d):
    source = "CASE WHEN p_partkey % 2 = 0 THEN 'osm' ELSE 'overture' END"
    name = (
        f"CASE WHEN p_size % 4 = 3 THEN concat('exp_npl_', lower(p_type), '_', {source}, '.pmtiles') "
        f"WHEN p_size % 4 = 2 THEN concat('exp_npl_', lower(p_type), '_', {source}, '_geojson.zip') "
        f"ELSE concat('exp_npl_', lower(p_type), '_', element_at(array('points', 'lines'), p_size % 4 + 1), '_', {source}, '_geojson.zip') END"
    )
    df = V.table(spark, d, "part").selectExpr("p_partkey AS id", f"{name} AS name")
    return df.select("id", L.parse_artifact(F.col("name")).alias("a")).select("id", "a.*")


@query(
    "layer_match_key",
    "SELECT p_partkey AS id, lower(p_type) || '|' || CASE WHEN p_size % 2 = 0 THEN 'osm' ELSE 'custom' END AS match_key, "
    "p_type || CASE WHEN p_size % 2 = 0 THEN ' (OSM)' ELSE ' (Custom)' END AS label FROM part",
)
def layer_match_key(spark, d):
    source = F.when(F.col("p_size") % 2 == 0, "osm").otherwise("custom")
    return V.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), R.match_key(F.lower("p_type"), source).alias("match_key"),
        R.layer_label(F.col("p_type"), source).alias("label"),
    )
