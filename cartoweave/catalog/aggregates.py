"""Profiles, reports, run roll-ups, ordered lists and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartoweave.catalog import views as V
from cartoweave.catalog.registry import query
from cartoweave.functions import geom as G
from cartoweave.operators import filters as FL
from cartoweave.operators import layers as L
from cartoweave.operators import profile as P
from cartoweave.operators import report as R
from cartoweave.operators import resume as RS
from cartoweave.session import staged
from cartoweave.sources import scans

# --- the profiled layer: one row per order line, several columns with NULLs ---

COLUMNS = ("name", "name_fr", "source", "brand", "size", "adm1_pcode", "adm2_pcode")


def layer(spark, d):
    """A layer per part type, with sparse columns."""
    return V.table(spark, d, "part").select(
        F.lower("p_type").alias("layer"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("name"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).alias("name_fr"),
        F.concat(F.lit("src"), (F.col("p_partkey") % 4).cast("string")).alias("source"),
        F.when(F.col("p_size") < 40, F.col("p_brand")).alias("brand"),
        F.col("p_size").alias("size"),
        F.when(F.col("p_size") > 10, F.concat(F.lit("N"), (F.col("p_size") % 7).cast("string"))).alias("adm1_pcode"),
        F.lit(None).cast("string").alias("adm2_pcode"),
        G.point(F.expr(V.lon("p_partkey")), F.expr(V.lat("p_partkey"))).alias("geom"),
    )


LAYER = f"""layer AS (SELECT lower(p_type) AS layer, CASE WHEN p_partkey % 5 <> 0 THEN p_name END AS name,
    CASE WHEN p_partkey % 3 = 0 THEN p_name END AS name_fr, 'src' || (p_partkey % 4) AS source,
    CASE WHEN p_size < 40 THEN p_brand END AS brand, p_size AS size,
    CASE WHEN p_size > 10 THEN 'N' || (p_size % 7) END AS adm1_pcode, CAST(NULL AS VARCHAR) AS adm2_pcode,
    {V.lon('p_partkey')} AS x, {V.lat('p_partkey')} AS y FROM part)"""
TYPES = {"size": "int"}

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT layer, {i} AS ord, '{c}' AS name, '{TYPES.get(c, 'string')}' AS type, CAST({c} AS VARCHAR) AS value FROM layer"
    for i, c in enumerate(COLUMNS)
) + ")"
STATS = """stats AS (SELECT layer, ord, name, type, count(*) AS total, count(*) - count(value) AS null_count,
    round(100e0 * (count(*) - count(value)) / count(*), 2) AS null_percent, count(DISTINCT value) AS distinct_count
    FROM long GROUP BY ALL)"""
TOP = """counted AS (SELECT layer, name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL),
    top AS (SELECT layer, name, value, n, CAST(row_number() OVER (PARTITION BY layer, name ORDER BY n DESC, value) AS INTEGER) AS rank FROM counted
        QUALIFY rank <= 5 AND count(*) OVER (PARTITION BY layer, name) <= 1000)"""
PROFILED = f"WITH {LAYER}, {LONG}, {STATS}"


def stats(spark, d):
    return P.column_report(layer(spark, d), ["layer"])


@query("profile_count", "SELECT count(*) AS feature_count FROM lineitem")
def profile_count(spark, d):
    return P.row_count(V.item_points(spark, d))


MIXED_KINDS = """mixed AS (
    SELECT CASE WHEN c_custkey % 4 = 0 THEN 'MULTIPOINT' ELSE 'POINT' END AS kind FROM customer
    UNION ALL SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'MULTILINESTRING' ELSE 'LINESTRING' END FROM orders
    UNION ALL SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END FROM supplier)"""


@query("profile_geometry_types", f"WITH {MIXED_KINDS} SELECT kind, count(*) AS n FROM mixed GROUP BY kind")
def profile_geometry_types(spark, d):
    return P.geometry_types(V.mixed_features(spark, d))


@query(
    "profile_bbox",
    f"{V.with_('lines')} SELECT min(least(x1, x2)) AS xmin, min(least(y1, y2)) AS ymin, max(greatest(x1, x2)) AS xmax, max(greatest(y1, y2)) AS ymax FROM lines",
)
def profile_bbox(spark, d):
    return P.extent(V.line_features(spark, d))


@query(
    "profile_nulls",
    f"{PROFILED} SELECT layer, CAST(ord AS INTEGER) AS ord, name, type, total, null_count, null_percent FROM stats",
)
def profile_nulls(spark, d):
    return P.null_stats(layer(spark, d), ["layer"])


@query("profile_distinct", f"{PROFILED} SELECT layer, CAST(ord AS INTEGER) AS ord, name, distinct_count FROM stats")
def profile_distinct(spark, d):
    return P.distinct_counts(layer(spark, d), ["layer"])


@query(
    "profile_distinct_items",
    "SELECT 0::INTEGER AS ord, 'l_partkey' AS name, count(DISTINCT l_partkey) AS distinct_count FROM lineitem "
    "UNION ALL SELECT 1, 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem UNION ALL SELECT 2, 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem "
    "UNION ALL SELECT 3, 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem",
)
def profile_distinct_items(spark, d):
    return P.distinct_counts(V.table(spark, d, "lineitem"), (), ["l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"])


@query("profile_top_values", f"{PROFILED}, {TOP} SELECT layer, name, rank, value, n FROM top")
def profile_top_values(spark, d):
    return P.top_values(layer(spark, d), ["layer"])


# Lines of orders by status and return flag: the layers whose profiles are stored.
KEPT = ("l_partkey", "l_suppkey", "l_orderkey", "l_discount", "l_heavy")
HEAVY = "CASE WHEN l_quantity > 40 THEN l_shipdate END"
ROLLED = " UNION ALL ".join(
    f"SELECT l_linestatus AS status, {i}::INTEGER AS ord, '{c}' AS name, count(*) AS total, count(*) - count({c}) AS null_count, "
    f"round(100e0 * (count(*) - count({c})) / count(*), 2) AS null_percent, true AS close FROM heavy GROUP BY l_linestatus"
    for i, c in enumerate(KEPT)
)


def _stored(spark, d):
    """The lines, and their stored profiles by status and return flag."""
    lines = V.table(spark, d, "lineitem").withColumn("l_heavy", F.expr(HEAVY))
    point = G.point(F.expr(V.lon("l_partkey")), F.expr(V.lat("l_partkey")))
    kept = lines.select("l_linestatus", "l_returnflag", *KEPT, "l_shipdate", point.alias("geom"))
    return kept, P.stored_profile(kept, ["l_linestatus", "l_returnflag"], KEPT, "l_shipdate")


@query("profile_rollup", f"WITH heavy AS (SELECT *, {HEAVY} AS l_heavy FROM lineitem) {ROLLED}")
def profile_rollup(spark, d):
    """Columns rolled up from stored profiles; distinct counts are held against the exact
    ones, four standard errors apart at most."""
    kept, stored = _stored(spark, d)
    columns = P.merged_profile(staged(stored).withColumnRenamed("l_linestatus", "status"), ["status"])["columns"]
    exact = P.distinct_counts(kept, ["l_linestatus"], KEPT).select(F.col("l_linestatus").alias("status"), "name", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.ceil(F.col("exact") * (4 * 1.04 / 2 ** (P.SKETCH_POWER / 2)))
    return columns.join(exact, ["status", "name"]).select("status", "ord", "name", "total", "null_count", "null_percent", close.alias("close"))


@query(
    "profile_rollup_table",
    f"""SELECT l_linestatus AS status, count(*) AS feature_count, count(DISTINCT l_returnflag) AS layers, min({V.lon('l_partkey')}) AS xmin, min({V.lat('l_partkey')}) AS ymin,
        max({V.lon('l_partkey')}) AS xmax, max({V.lat('l_partkey')}) AS ymax, CAST(min(l_shipdate) AS DATE) AS min_value, CAST(max(l_shipdate) AS DATE) AS max_value
    FROM lineitem GROUP BY l_linestatus""",
)
def profile_rollup_table(spark, d):
    _, stored = _stored(spark, d)
    table = P.merged_profile(staged(stored).withColumnRenamed("l_linestatus", "status"), ["status"])["table"]
    return table.withColumn("min_value", F.col("min_value").cast("date")).withColumn("max_value", F.col("max_value").cast("date"))


@query(
    "profile_temporal",
    "SELECT 'o_orderdate' AS column_name, min(o_orderdate) AS min_value, max(o_orderdate) AS max_value, count(o_orderdate) AS non_null_count, count(*) AS feature_count FROM orders",
)
def profile_temporal(spark, d):
    return P.temporal_bounds(V.table(spark, d, "orders"), "o_orderdate")


COMMA = "trim(format('{{:,}}', {0}))"


def comma(n: str) -> str:
    return f"format('{{:,}}', {n})"


@query(
    "profile_summary",
    f"""{PROFILED}, s AS (SELECT layer, count(*) AS cols, count_if(null_percent >= 50) AS sparse,
        string_agg(CASE WHEN null_percent >= 50 THEN name END, ', ' ORDER BY ord) AS names, any_value(total) AS total FROM stats GROUP BY layer)
    SELECT layer, {comma('total')} || ' features. geometry types: ' || {comma('total')} || ' POINT. ' ||
        CASE WHEN sparse > 0 THEN sparse || ' of ' || cols || ' columns are >=50% null (' || names || ')'
        ELSE 'all ' || cols || ' attribute columns have <50% null share' END || '.' AS summary FROM s""",
)
def profile_summary(spark, d):
    df = layer(spark, d)
    return P.summary(P.geometry_types(df, ["layer"]), P.null_stats(df, ["layer"]), ["layer"])


QUALITY = """quality AS (SELECT layer, CAST(count_if(100 - null_percent >= 50) AS BIGINT) AS well,
    CAST(count_if(100 - null_percent >= 25 AND 100 - null_percent < 50) AS BIGINT) AS partial, CAST(count_if(100 - null_percent < 25) AS BIGINT) AS rare,
    count(*) AS total_columns FROM stats GROUP BY layer)"""


@query(
    "quality_buckets",
    f"""{PROFILED}, {QUALITY} SELECT layer, well, partial, rare, total_columns, CASE WHEN total_columns = 0 THEN 'No attribute columns.'
        WHEN well = total_columns THEN 'All ' || total_columns || ' attribute columns are well-populated.'
        WHEN well = 0 THEN 'None of the ' || total_columns || ' attribute columns are well-populated.'
        ELSE well || ' of ' || total_columns || ' attribute columns are well-populated.' END AS caption FROM quality""",
)
def quality_buckets(spark, d):
    return R.quality(P.null_stats(layer(spark, d), ["layer"]), ["layer"])


@query("quality_named_percent", f"{PROFILED} SELECT layer, 100e0 - null_percent AS named_percent FROM stats WHERE name = 'name'")
def quality_named_percent(spark, d):
    return R.named_percent(P.null_stats(layer(spark, d), ["layer"]), ["layer"])


@query(
    "report_geometry_share",
    f"WITH {MIXED_KINDS} SELECT kind, count(*) AS n, round(100e0 * count(*) / (SELECT count(*) FROM mixed), 2) AS share FROM mixed GROUP BY kind",
)
def report_geometry_share(spark, d):
    return R.geometry_share(P.geometry_types(V.mixed_features(spark, d)))


@query(
    "report_source_mix",
    f"{PROFILED}, {TOP} SELECT t.layer, t.rank, t.value, t.n, round(100e0 * t.n / s.total, 2) AS share FROM top t JOIN stats s ON t.layer = s.layer AND s.name = 'source' WHERE t.name = 'source'",
)
def report_source_mix(spark, d):
    df = layer(spark, d)
    return R.source_mix(P.top_values(df, ["layer"], ["source"]), P.row_count(df, ["layer"]), ["layer"])


@query(
    "report_pcode_coverage",
    f"{PROFILED} SELECT layer, name, total - null_count AS tagged, 100e0 - null_percent AS coverage FROM stats WHERE name LIKE 'adm%_pcode'",
)
def report_pcode_coverage(spark, d):
    return R.admin_coverage(P.null_stats(layer(spark, d), ["layer"]), ["layer"])


@query(
    "report_admin_kpi",
    f"{PROFILED} SELECT layer, '1' AS level, 100e0 - null_percent AS coverage FROM stats WHERE name = 'adm1_pcode'",
)
def report_admin_kpi(spark, d):
    return R.deepest_admin(P.null_stats(layer(spark, d), ["layer"]), ["layer"])


@query("report_languages", f"{PROFILED} SELECT layer, CAST(2 AS BIGINT) AS n_languages, 'local, fr' AS languages FROM stats GROUP BY layer")
def report_languages(spark, d):
    return R.languages(P.null_stats(layer(spark, d), ["layer"]), ["layer"])


@query(
    "report_temporal_coverage",
    "SELECT p AS layer, 'seen' AS column_name, min(t) AS min_value, max(t) AS max_value, count(t) AS non_null_count, count(*) AS feature_count, "
    "round(100e0 * count(t) / count(*), 1) AS coverage FROM (SELECT o_orderpriority AS p, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS t FROM orders) GROUP BY p",
)
def report_temporal_coverage(spark, d):
    df = V.table(spark, d, "orders").selectExpr(
        "o_orderpriority AS layer", "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS seen"
    )
    return R.temporal_share(P.temporal_bounds(df, "seen", ["layer"]))


@query(
    "report_attribute_table",
    f"""{PROFILED}, {TOP} SELECT s.layer, CAST(s.ord AS INTEGER) AS ord, s.name, s.type, round(100e0 - null_percent, 2) AS coverage, distinct_count,
        coalesce((SELECT string_agg(t.value || ' ' || {comma('t.n')}, ' · ' ORDER BY t.rank) FROM top t WHERE t.layer = s.layer AND t.name = s.name),
        CASE WHEN distinct_count = 0 THEN 'all null' WHEN type = 'int' THEN 'numeric' ELSE 'n/a' END) AS top_values FROM stats s""",
)
def report_attribute_table(spark, d):
    df = layer(spark, d)
    return R.attribute_table(P.column_report(df, ["layer"]), P.top_values(df, ["layer"]), ["layer"])


def run_layers(spark, d):
    """(slug, source) layers with their order, label and license."""
    df = layer(spark, d).withColumn("slug", F.col("layer")).withColumn(
        "origin", F.when(F.col("source").isin("src0", "src1"), "osm").otherwise("overture")
    )
    return df.drop("layer", "source").withColumnRenamed("origin", "source")


RUN = f"""WITH {LAYER}, run AS (SELECT layer AS slug, CASE WHEN source IN ('src0', 'src1') THEN 'osm' ELSE 'overture' END AS source,
    name, name_fr, brand, size, adm1_pcode, adm2_pcode, x, y FROM layer),
    sums AS (SELECT slug, source, count(*) AS n, count(name) AS c1, count(name_fr) AS c2, count(brand) AS c3, count(size) AS c4,
        count(adm1_pcode) AS c5, count(adm2_pcode) AS c6 FROM run GROUP BY ALL)"""
WELL = " + ".join(f"CASE WHEN 100 - round(100e0 * (n - c{i}) / n, 2) >= 50 THEN 1 ELSE 0 END" for i in range(1, 7))
_PALETTE_ROWS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(R.PALETTE))


def category_table(df):
    """Configuration order and labels of the run's categories."""
    from pyspark.sql import Window

    slugs = df.select("slug").distinct()
    return slugs.withColumn("ord", F.row_number().over(Window.orderBy("slug")) - 1).withColumn("label", F.initcap("slug"))


@query(
    "landing_layers",
    f"""{RUN}, palette(i, colour) AS (VALUES {_PALETTE_ROWS}),
    placed AS (SELECT *, row_number() OVER (ORDER BY slug, source) - 1 AS position FROM sums)
    SELECT slug, source, CAST(position AS INTEGER) AS position, colour, upper(slug[1]) || slug[2:] || CASE source WHEN 'osm' THEN ' (OSM)' ELSE ' (Overture)' END AS label,
        CASE WHEN slug = 'promo' THEN 'n/a' ELSE 'ODbL' END AS license, {comma('n')} AS features,
        CAST(round_even(100 - round(100e0 * (n - c1) / n, 2), 0) AS BIGINT) || '%' AS named, ({WELL}) || '/6' AS populated, 'Point ' || {comma('n')} AS geometry
    FROM placed JOIN palette ON position % {len(R.PALETTE)} = i""",
)
def landing_layers(spark, d):
    df = run_layers(spark, d)
    by = ["slug", "source"]
    rows = P.row_count(df, by).join(category_table(df), "slug").withColumn(
        "license", F.when(F.col("slug") != "promo", F.lit("ODbL"))
    )
    return R.landing_rows(rows, P.null_stats(df, by), P.geometry_types(df, by))


@query("landing_bounds", f"{RUN} SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM run")
def landing_bounds(spark, d):
    return R.overall_bounds(P.extent(run_layers(spark, d), ["slug", "source"]))


@query(
    "default_source",
    "SELECT p AS layer, arg_max(s, (t, -ascii(s))) AS source, max(t) AS generated_utc FROM (SELECT o_orderpriority AS p, "
    "CASE o_orderkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'bespoke' END AS s, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS t FROM orders) GROUP BY p",
)
def default_source(spark, d):
    df = V.table(spark, d, "orders").selectExpr(
        "o_orderpriority AS layer", "CASE o_orderkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'bespoke' END AS source",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS generated_utc",
    )
    latest = df.groupBy("layer", "source").agg(F.max("generated_utc").alias("generated_utc"))
    return R.default_source(latest, ["layer"])


@query(
    "combined_temporal",
    "SELECT min(t) AS period_start, max(t) AS period_end FROM (SELECT o_orderdate AS t FROM orders WHERE o_orderkey % 5 <> 0)",
)
def combined_temporal(spark, d):
    text = "CASE WHEN o_orderkey % 5 = 0 THEN 'not a date' ELSE date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") END"
    layers = V.table(spark, d, "orders").selectExpr(f"{text} AS min_value", f"{text} AS max_value")
    return R.combined_period(layers).select(
        F.col("period_start").cast("timestamp_ntz").alias("period_start"), F.col("period_end").cast("timestamp_ntz").alias("period_end")
    )


@query(
    "dataset_license",
    "SELECT layer, CASE WHEN n = 1 AND l = 'hdx-odc-odbl' THEN l ELSE 'hdx-other' END AS license_id, "
    "CASE WHEN n = 1 AND l = 'hdx-odc-odbl' THEN NULL WHEN n = 1 THEN l ELSE 'Layers carry individual licences; see each layer''s metadata.' END AS license_other FROM ("
    "SELECT p_size AS layer, count(DISTINCT l) AS n, min(l) AS l FROM (SELECT p_size, CASE WHEN p_size % 3 = 0 THEN 'hdx-odc-odbl' WHEN p_size % 3 = 1 THEN 'CDLA' ELSE p_type END AS l FROM part) GROUP BY p_size)",
)
def dataset_license(spark, d):
    specs = V.table(spark, d, "part").selectExpr(
        "p_size AS layer", "CASE WHEN p_size % 3 = 0 THEN 'hdx-odc-odbl' WHEN p_size % 3 = 1 THEN 'CDLA' ELSE p_type END AS license"
    )
    return RS.dataset_license(specs, ["layer"])


@query(
    "dataset_tags",
    "WITH t AS (SELECT p_size AS layer, CASE WHEN p_partkey < 50 THEN -1 ELSE p_partkey END AS ord, tag, pos FROM (SELECT *, unnest([lower(p_type), lower(p_brand), 'geodata']) AS tag, unnest([0, 1, 2]) AS pos FROM part)), "
    "f AS (SELECT layer, tag, min((ord, pos)) AS place FROM t GROUP BY layer, tag) SELECT layer, string_agg(tag, ',' ORDER BY place, tag) AS tags FROM f GROUP BY layer",
)
def dataset_tags(spark, d):
    tagged = V.table(spark, d, "part").selectExpr(
        "p_size AS layer", "CASE WHEN p_partkey < 50 THEN -1 ELSE p_partkey END AS ord", "array(lower(p_type), lower(p_brand), 'geodata') AS tags"
    )
    return RS.dataset_tags(tagged, ["layer"]).withColumn("tags", F.array_join("tags", ","))


@query(
    "dataset_period",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2026-04-15' ELSE o_orderdate END AS period_start, "
    "CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2026-04-15' ELSE o_orderdate + INTERVAL 3 DAY END AS period_end FROM orders",
)
def dataset_period(spark, d):
    lo = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("timestamp_ntz"))
    hi = F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL 3 DAYS")
    p = RS.dataset_period(lo, hi, F.expr("TIMESTAMP_NTZ '2026-04-15 00:00:00'"))
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), p["start"].alias("period_start"), p["end"].alias("period_end"))


@query(
    "run_status_counts",
    "SELECT o_orderpriority AS run, CAST(count_if(s = 'ok') AS BIGINT) AS succeeded, CAST(count_if(s = 'failed') AS BIGINT) AS failed, CAST(count_if(s = 'skipped') AS BIGINT) AS skipped, CAST(count_if(s = 'empty') AS BIGINT) AS empty, count(*) AS total "
    "FROM (SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'ok' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'skipped' ELSE 'empty' END END AS s FROM orders) GROUP BY 1",
)
def run_status_counts(spark, d):
    results = V.table(spark, d, "orders").selectExpr(
        "o_orderpriority AS run",
        "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'ok' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'skipped' ELSE 'empty' END END AS status",
    )
    return RS.status_counts(results, ["run"])


@query(
    "geometry_labels",
    f"WITH {MIXED_KINDS} SELECT CASE WHEN kind LIKE '%POINT' THEN 'points' WHEN kind LIKE '%LINESTRING' THEN 'lines' ELSE 'polygons' END AS label, "
    "string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM mixed GROUP BY 1",
)
def geometry_labels(spark, d):
    return P.geometry_labels(V.mixed_features(spark, d)).withColumn("kinds", F.array_join("kinds", ","))


@query("distinct_kinds", f"WITH {MIXED_KINDS} SELECT DISTINCT kind FROM mixed")
def distinct_kinds(spark, d):
    return V.mixed_features(spark, d).select(G.kind("geom").alias("kind")).distinct()


@query("topk_values", "SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 5")
def topk_values(spark, d):
    return P.top_k(V.table(spark, d, "lineitem"), "l_partkey", 5)


@query("first_non_null", "SELECT min(p_brand) AS brand FROM part WHERE p_partkey % 10 <> 0")
def first_non_null(spark, d):
    df = V.tagged_features(spark, d).select(FL.map_value("tags", "brand").alias("brand"))
    return P.first_non_null(df, "brand")


@query(
    "order_layers",
    "WITH l AS (SELECT DISTINCT 'layer_' || p_size AS slug, p_size, CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source FROM part) "
    "SELECT slug, source, CASE WHEN p_size < 25 THEN CAST(p_size AS INTEGER) END AS ord, CASE source WHEN 'osm' THEN 0::INTEGER WHEN 'overture' THEN 1 ELSE 99 END AS rank FROM l",
)
def order_layers(spark, d):
    layers = V.table(spark, d, "part").selectExpr(
        "concat('layer_', p_size) AS slug", "CASE p_partkey % 3 WHEN 0 THEN 'osm' WHEN 1 THEN 'overture' ELSE 'other' END AS source"
    ).distinct()
    specs = V.table(spark, d, "nation").selectExpr("concat('layer_', n_nationkey) AS slug", "n_nationkey AS ord")
    return R.order_layers(layers, specs)


@query("order_artifacts", "SELECT 'part_' || p_partkey AS name, p_size * 1000 + p_partkey AS bytes FROM part ORDER BY bytes DESC, name")
def order_artifacts(spark, d):
    return L.order_artifacts(V.table(spark, d, "part").selectExpr("concat('part_', p_partkey) AS name", "p_size * 1000 + p_partkey AS bytes"))


@query("schema_probe", "SELECT p_partkey AS id, true AS has_tags, false AS has_names FROM part")
def schema_probe(spark, d):
    df = V.tagged_features(spark, d)
    return df.select(
        F.col("p_partkey").alias("id"), F.lit(scans.has_column(df, "tags")).alias("has_tags"), F.lit(scans.has_column(df, "names")).alias("has_names")
    )


@query(
    "merge_layers",
    "SELECT 'places' AS category, 'osm' AS source, c_name AS name, 'POINT' AS kind FROM customer UNION ALL "
    "SELECT 'roads', 'overture', NULL, 'LINESTRING' FROM orders UNION ALL SELECT 'buildings', 'osm', s_name, 'POLYGON' FROM supplier",
)
def merge_layers(spark, d):
    merged = L.merge_layers(
        [
            (V.point_features(spark, d), "places", "osm"),
            (V.line_features(spark, d), "roads", "overture"),
            (V.poly_features(spark, d), "buildings", "osm"),
        ]
    )
    return merged.select("category", "source", "name", G.kind("geom").alias("kind"))


@query(
    "tag_value_union",
    "SELECT n_nationkey AS id, CASE WHEN n_nationkey < 5 THEN r_name || ',' || n_name ELSE least(r_name, n_name) || ',' || greatest(r_name, n_name) END AS listed "
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def tag_value_union(spark, d):
    joined = V.table(spark, d, "nation").join(V.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    both = F.sort_array(F.array_union(F.array("n_name"), F.array("r_name", "n_name")))
    return joined.select(F.col("n_nationkey").alias("id"), F.array_join(both, ",").alias("listed"))


@query(
    "tag_coverage_by_layer",
    "SELECT o_orderpriority AS layer, count(*) AS features, count(CASE WHEN o_custkey % 4 <> 0 THEN 1 END) AS tagged FROM orders GROUP BY 1",
)
def tag_coverage_by_layer(spark, d):
    df = V.table(spark, d, "orders").selectExpr("o_orderpriority AS layer", "CASE WHEN o_custkey % 4 <> 0 THEN 'N1' END AS adm1_pcode")
    report = P.null_stats(df, ["layer"])
    tagged = R.admin_coverage(report, ["layer"]).select("layer", "tagged")
    return P.row_count(df, ["layer"]).join(tagged, "layer").select("layer", F.col("feature_count").alias("features"), "tagged")
