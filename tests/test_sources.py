"""Sources, sinks, layers, elements and resume on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import wkt
from cartoweave.operators import elements as E
from cartoweave.operators import layers as L
from cartoweave.operators import profile as P
from cartoweave.operators import report as R
from cartoweave.operators import resume as RS
from cartoweave.plans import export as X
from cartoweave.sources import scans, sinks
from cartoweave.sources.base import ExtractSource
from cartoweave.sources.boundary import boundary_from_geojson
from cartoweave.spec import CategorySpec, OsmBlock, RunSpec

GEOMS = [
    ("a", "POINT (1 2)"), ("b", "LINESTRING (0 0, 1 1)"), ("c", "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
    ("d", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"), ("e", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))"),
    ("f", "MULTIPOINT (1 2, 3 4)"),
]

POKHARA = json.dumps(
    {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {
        "type": "Polygon", "coordinates": [[[83.9, 28.1], [84.1, 28.1], [84.1, 28.3], [83.9, 28.3], [83.9, 28.1]]]}}]}
)


def shapes(spark):
    return spark.createDataFrame(GEOMS, "id string, w string").select("id", "w", wkt.from_wkt("w").alias("geom"))


def test_geoparquet_round_trip(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "g")
    sinks.write_geoparquet(shapes(spark), path)
    back = sinks.decode_wkb(spark.read.parquet(path))
    assert {r["id"]: r["t"] for r in back.select("id", wkt.to_wkt("geom").alias("t")).collect()} == dict(GEOMS)
    files = [f for f in (tmp_path / "g").iterdir() if f.suffix == ".parquet"]
    geo = [json.loads(pq.read_schema(f).metadata[b"geo"]) for f in files]
    assert all(g["primary_column"] == "geometry" and g["columns"]["geometry"]["encoding"] == "WKB" for g in geo)
    assert not (tmp_path / "g" / "_pending").exists()


def test_geoparquet_box_is_stored_and_reaches_the_scan(spark, tmp_path, capsys):
    import pyarrow.parquet as pq

    path = str(tmp_path / "g")
    spots = spark.range(400).select("id", wkt.from_wkt(F.format_string("LINESTRING (%d %d, %d 3)", F.col("id") % 20, (F.col("id") / 20).cast("int"), F.col("id") % 20 + 1)).alias("geom"))
    sinks.write_geoparquet(spots.repartition(3), path, cluster=True)
    for f in (tmp_path / "g").glob("*.parquet"):
        geo = json.loads(pq.read_schema(f).metadata[b"geo"])
        own = pq.read_table(f).column("bbox").to_pylist()
        assert geo["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
        assert geo["columns"]["geometry"]["bbox"] == [min(b["xmin"] for b in own), min(b["ymin"] for b in own), max(b["xmax"] for b in own), max(b["ymax"] for b in own)]
    found = sinks.read_geoparquet(spark, path, (5.5, 7.5, 7.0, 9.0))
    # Boxes run from x to x + 1 and between y and 3.
    expected = {i for i in range(400) if i % 20 <= 7 and i % 20 + 1 >= 5.5 and min(i // 20, 3) <= 9 and max(i // 20, 3) >= 7.5}
    assert {r["id"] for r in found.collect()} == expected
    found.explain("formatted")
    assert "LessThanOrEqual(bbox.xmin,7.0)" in capsys.readouterr().out


def test_kml_documents_are_well_formed(spark, tmp_path):
    import xml.etree.ElementTree as ET

    path = str(tmp_path / "k")
    df = shapes(spark).select("id", F.lit("a < b & c").alias("name"), "geom").repartition(2)
    sinks.write_kml(df, path)
    marks = 0
    for f in (tmp_path / "k").glob("part-*"):
        text = f.read_text()
        if text:
            marks += len(ET.fromstring(text)[0])
    assert marks == 6


def test_geojson_lines_parse(spark, tmp_path):
    path = str(tmp_path / "j")
    sinks.write_geojson(shapes(spark), path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    kinds = {x["properties"]["id"]: x["geometry"]["type"] for x in lines}
    assert kinds["d"] == "MultiPolygon" and len(lines) == 6


def test_split_groups_multi_kinds_and_drops_unknown(spark, tmp_path):
    odd = shapes(spark).unionByName(shapes(spark).where("id = 'a'").withColumn("geom", G.make("CURVE", F.col("geom.parts"))))
    labels = {r["label"]: r["kinds"] for r in P.geometry_labels(odd).collect()}
    assert labels == {"points": ["MULTIPOINT", "POINT"], "lines": ["LINESTRING", "MULTILINESTRING"], "polygons": ["MULTIPOLYGON", "POLYGON"]}
    sinks.write_split(odd, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6


def test_merge_layers_fills_missing_names(spark):
    a = shapes(spark).where("id = 'a'").select(F.lit("Main St").alias("name"), F.lit("primary").alias("highway"), "geom")
    b = shapes(spark).where("id = 'b'").select(F.lit("x").alias("klass"), "geom")
    got = sorted((r["category"], r["source"], r["name"]) for r in L.merge_layers([(a, "roads", "osm"), (b, "water", "overture")]).collect())
    assert got == [("roads", "osm", "Main St"), ("water", "overture", None)]
    with pytest.raises(ValueError):
        L.merge_layers([])


def test_empty_extract_gets_null_tags(spark):
    df = scans.ensure_tags(spark.createDataFrame([], "feature_id string"))
    assert dict(df.dtypes)["tags"] == "map<string,string>"


def test_releases_and_snapshots(spark):
    listing = spark.createDataFrame([("release/2026-04-15.9/",), ("release/2026-04-15.10/",), ("release/2025-01-01.0/",), ("x/",)], "prefix string")
    assert scans.latest_release(listing).first()["release"] == "2026-04-15.10"
    assert scans.latest_release(listing, "2020-01-01.0").first()["release"] == "2020-01-01.0"
    with pytest.raises(Exception, match="no release"):
        scans.latest_release(listing.where("prefix = 'x/'")).collect()
    names = spark.createDataFrame([("2026-01-01",), ("2026-02-01",)], "name string")
    assert scans.latest_snapshot(names).first()["snapshot"] == "2026-02-01"
    assert scans.latest_snapshot(names, "2026-01-01").first()["snapshot"] == "2026-01-01"
    with pytest.raises(Exception, match="no snapshot"):
        scans.latest_snapshot(names, "1999-01-01").collect()


def test_local_languages():
    """Every listed country: at most three, never English, in the listed order, any case."""
    for code, listed in scans.COUNTRY_LANGUAGES.items():
        rest = [x for x in listed.split() if x != "en"][:3]
        assert scans.languages_of(code) == scans.languages_of(code.lower()) == rest
    assert len(scans.COUNTRY_LANGUAGES) > 150
    assert scans.languages_of("QQA") == scans.languages_of(None) == []


def test_extract_lookup_prefers_country_over_state(spark):
    index = spark.createDataFrame(
        [("us", "USA", "north-america", ["US"], "u/us"), ("us/california", "California", "us", ["US"], "u/ca"),
         ("us-pr", "US and Puerto Rico", "north-america", ["US", "PR"], "u/uspr"), ("nepal", "Nepal", "asia", ["NP"], "u/nepal")],
        "id string, name string, parent string, codes array<string>, url string",
    )
    countries = spark.createDataFrame([("USA", "US"), ("NPL", "NP"), ("PRI", "PR"), ("ABW", "AW")], "iso3 string, iso2 string")
    got = {r["iso3"]: (r["extract_id"], r["md5_url"]) for r in scans.lookup_extract(index, countries, scans.CONTINENTS).collect()}
    assert got == {"USA": ("us", "u/us.md5"), "NPL": ("nepal", "u/nepal.md5"), "PRI": ("us-pr", "u/uspr.md5")}


def test_boundary_from_geojson(spark):
    b = boundary_from_geojson(spark, POKHARA, "npl")
    assert b.bbox == (83.9, 28.1, 84.1, 28.3) and b.iso3 == "NPL" and b.label == "user-provided"
    wide = boundary_from_geojson(spark, POKHARA, "npl", 5000)
    assert wide.label == "user-provided (buffered +5000m)" and wide.bbox[0] < 83.9 and wide.bbox[3] > 28.3
    assert boundary_from_geojson(spark, " World ").geoms is None
    with pytest.raises(ValueError):
        boundary_from_geojson(spark, POKHARA, "npl", -1)
    with pytest.raises(Exception, match="no coordinates"):
        boundary_from_geojson(spark, '{"type":"Polygon","coordinates":[]}')


def test_artifact_keys(spark):
    """All combinations against joining the parts that are there."""
    import itertools

    cases = list(itertools.product(["", "/bulk/v2//", "out"], ["qqa"], ["mills", ""], [None, "proj-7"], [None, "areas"], [True, False]))
    for prefix, iso3, slug, folder, geometry, nest in cases:
        cols = {"folder": F.lit(folder) if folder else None, "geometry": F.lit(geometry) if geometry else None, "nest_by_category": nest}
        got = spark.range(1).select(L.artifact_key(F.lit(prefix), F.lit(iso3), F.lit(slug), F.lit("f.zip"), **cols).alias("k")).first()["k"]
        parts = [prefix.strip("/"), folder or iso3.upper(), slug if nest else "", geometry or "", "f.zip"]
        assert got == "/".join(x for x in parts if x)


def test_resume_needs_the_same_snapshot_and_the_artifact(spark):
    manifest = spark.createDataFrame(
        [("NPL", "osm", "roads", "s1", "2026-01-01", "2026-01-02", True), ("NPL", "osm", "rivers", "s1", "2026-01-01", None, True),
         ("NPL", "osm", "schools", "s1", "2026-01-01", None, False)],
        "iso3 string, source string, slug string, snapshot string, built_utc string, uploaded_utc string, artifact_present boolean",
    )
    specs = spark.createDataFrame([("NPL", "osm", s, "s1") for s in ("roads", "rivers", "schools", "new")], "iso3 string, source string, slug string, snapshot string")
    todo = lambda done, df=specs: sorted(r["slug"] for r in RS.pending(df, manifest, done).collect())
    assert todo("uploaded") == ["new", "rivers", "schools"]
    assert todo("built") == ["new", "schools"]
    assert todo("uploaded", specs.withColumn("snapshot", F.lit("s2"))) == ["new", "rivers", "roads", "schools"]


def test_stale_levels(spark):
    remote = spark.createDataFrame([("g", 1, "2026-01-01"), ("g", 2, "2026-01-01"), ("g", 3, "")], "grp string, adm int, date string")
    local = spark.createDataFrame([(1, "2026-01-01"), (2, "2025-01-01")], "level int, date string")
    assert [r["level"] for r in RS.stale_levels(remote, local, "g", [1, 2]).collect()] == [2]
    for levels in ([3], [4]):
        with pytest.raises(Exception, match="no dated entry"):
            RS.stale_levels(remote, local, "g", levels).collect()


def test_metadata_names_and_panels(spark):
    specs = spark.createDataFrame([("buildings", 0, "Buildings"), ("roads", 1, "Roads"), ("roads_major", 2, "Major Roads")], "slug string, ord int, label string")
    names = spark.createDataFrame([("k_npl_buildings_osm_metadata.json",), ("k_npl_roads_major_osm_metadata.json",), ("other.json",)], "name string")
    got = {r["name"]: r["slug"] for r in L.match_slug(names, specs, F.lit("k_npl_")).collect()}
    assert got == {"k_npl_buildings_osm_metadata.json": "buildings", "k_npl_roads_major_osm_metadata.json": "roads"}
    layers = spark.createDataFrame([("buildings", "overture"), ("buildings", "osm"), ("roads", "osm"), ("gone", "osm")], "slug string, source string")
    panels = [(r["slug"], r["sources"]) for r in R.source_panels(layers, specs).orderBy("ord").collect()]
    assert panels == [("buildings", ["osm", "overture"]), ("roads", ["osm"])]


def test_staged_layers_outside_the_configuration_are_left_out(spark):
    staged = spark.createDataFrame([("overture", "buildings", "a"), ("overture", "rivers", "b"), ("overture", "roads", "c"), ("osm", "buildings", "d")], "source string, slug string, path string")
    specs = spark.createDataFrame([("buildings", "overture", True), ("roads", "overture", False)], "slug string, source string, tiles boolean")
    assert [r["path"] for r in L.mergeable_layers(staged, specs, "osm").collect()] == ["a"]


def test_multipolygon_relation_with_a_hole(spark):
    nodes = [(i, {}, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (9, 0), (9, 9), (0, 9), (2, 2), (4, 2), (4, 4), (2, 4)])]
    ndf = spark.createDataFrame(nodes, "id bigint, tags map<string,string>, x double, y double")
    ways = spark.createDataFrame([(1, {}, [0, 1, 2, 3, 0]), (2, {}, [4, 5, 6, 7, 4]), (3, {"highway": "path"}, [0, 99, 1])], "id bigint, tags map<string,string>, refs array<bigint>")
    rels = spark.createDataFrame([(7, {"natural": "water"}, [(1, "outer"), (2, "inner")])], "id bigint, tags map<string,string>, members array<struct<ref:bigint,role:string>>")
    got = {r["feature_id"]: r["t"] for r in E.assemble_features(ndf, ways, rels, {"natural": True, "highway": True}).select("feature_id", wkt.to_wkt("geom").alias("t")).collect()}
    assert got == {
        "way/3": "LINESTRING (0 0, 9 0)",
        "relation/7": "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0), (2 2, 4 2, 4 4, 2 4, 2 2)))",
    }


def test_holes_find_their_shells_in_a_large_relation(spark):
    """One relation with many shells and holes, two holes in every third shell."""
    nodes, ways, members = [], [], []

    def ring(wid, x, y, s, role):
        ids = []
        for dx, dy in ((0, 0), (s, 0), (s, s), (0, s)):
            nodes.append((len(nodes), {}, x + dx, y + dy))
            ids.append(len(nodes) - 1)
        ways.append((wid, {}, [*ids, ids[0]]))
        members.append((wid, role))

    for i in range(60):
        ring(i, float(i % 10), float(i // 10), 0.9, "outer")
        if i % 3 == 0:
            ring(1000 + i, i % 10 + 0.1, i // 10 + 0.1, 0.2, "inner")
            ring(2000 + i, i % 10 + 0.5, i // 10 + 0.5, 0.2, "inner")
    ndf = spark.createDataFrame(nodes, "id bigint, tags map<string,string>, x double, y double")
    wdf = spark.createDataFrame(ways, "id bigint, tags map<string,string>, refs array<bigint>")
    rels = spark.createDataFrame([(1, {"natural": "water"}, members)], "id bigint, tags map<string,string>, members array<struct<ref:bigint,role:string>>")
    geom = E.assemble_features(ndf, wdf, rels, step=0.5).where("feature_id = 'relation/1'").first()["geom"]
    assert [len(p) for p in geom["parts"]] == [3 if i % 3 == 0 else 1 for i in range(60)]


def test_export_run(spark, tmp_path):
    extract = spark.createDataFrame(
        [("way/1", {"building": "yes", "name": "घर"}, "POINT (84 28.2)"), ("way/2", {"highway": "primary"}, "LINESTRING (83 28.2, 85 28.2)"),
         ("way/3", {"building": "yes"}, "POINT (10 10)")],
        "feature_id string, tags map<string,string>, w string",
    ).select("feature_id", "tags", wkt.from_wkt("w").alias("geometry"))
    from cartoweave.spec import TransliterateRule

    categories = (
        CategorySpec("Buildings", osm=OsmBlock(filter={"building": True}, select=("feature_id AS id", "tags['name'] AS name")), transliterate=(TransliterateRule("name_latin", "name"),)),
        CategorySpec("Roads", osm=OsmBlock(filter={"highway": True}, select=("feature_id AS id",))),
        CategorySpec("Rivers", osm=OsmBlock(filter={"waterway": True}, select=("feature_id AS id",))),
        CategorySpec("Broken", osm=OsmBlock(filter={"building": True}, select=("no_such_column",))),
    )
    run = RunSpec(iso3="NPL", key="k", formats=("geojson", "kml", "geoparquet"), categories=categories)
    area = boundary_from_geojson(spark, POKHARA, "NPL")
    statuses, layers = X.run_export(spark, run, ExtractSource(spark, extract, "2026-01-01"), area, str(tmp_path), step=0.05)
    got = {s["slug"]: (s["status"], s["features"]) for s in statuses}
    assert got == {"buildings": ("ok", 1), "roads": ("ok", 1), "rivers": ("empty", 0), "broken": ("failed", 0)}
    row = layers["buildings"].first()
    assert row["name_latin"] == "ghr" and "name_ne" in layers["buildings"].columns
    assert (tmp_path / "npl" / "osm" / "roads" / "kml").exists()
    statuses, _ = X.run_export(spark, run, ExtractSource(spark, extract, "2026-01-01"), area, str(tmp_path), step=0.05, done=("buildings", "roads", "broken"))
    assert {s["slug"]: (s["status"], s["features"]) for s in statuses} == {"buildings": ("resumed", 1), "roads": ("resumed", 1), "rivers": ("empty", 0), "broken": ("failed", 0)}


def mills(spark, n, snapshot="s1", name="osm"):
    rows = [(f"way/{i}", {"man_made": "mill" if i % 3 else "kiln", "built": f"19{i % 90 + 10}-01-01"}, f"POINT ({84 + i / 1000} 28.2)") for i in range(n)]
    table = spark.createDataFrame(rows, "feature_id string, tags map<string,string>, w string").select("feature_id", "tags", wkt.from_wkt("w").alias("geometry"))
    source = ExtractSource(spark, table, snapshot)
    source.name = name
    return source


def mill_run(**more):
    select = ("feature_id AS id", "tags['man_made'] AS name", "to_timestamp(tags['built']) AS built")
    categories = (
        CategorySpec("Mills", osm=OsmBlock(filter={"man_made": "mill"}, select=select), temporal_column="built"),
        CategorySpec("Kilns", osm=OsmBlock(filter={"man_made": "kiln"}, select=select)),
    )
    return RunSpec(**({"iso3": "QQA", "key": "k", "formats": ("parquet", "geojson"), "categories": categories} | more))


WORLD_AREA = "world"


def test_every_format_beside_the_layer_and_twice(spark, tmp_path):
    run = mill_run(formats=("parquet", "geoparquet", "geojson", "kml"), resume=False)
    for _ in range(2):
        statuses, layers = X.run_export(spark, run, mills(spark, 30), boundary_from_geojson(spark, WORLD_AREA, "QQA"), str(tmp_path))
        assert {(s["slug"], s["status"], s["features"]) for s in statuses} == {("mills", "ok", 20), ("kilns", "ok", 10)}
        assert layers["mills"].count() == 20
    place = tmp_path / "qqa" / "osm" / "mills"
    assert spark.read.parquet(str(place / "parquet")).count() == 20
    assert spark.read.parquet(str(place / "geoparquet")).count() == 20
    assert spark.read.text(str(place / "geojson")).count() == 20
    assert not [f for f in (place / "geoparquet").iterdir() if f.name.startswith("_pending")]


def test_a_failing_format_costs_only_itself(spark, tmp_path):
    statuses, layers = X.run_export(spark, mill_run(formats=("gpkg", "geojson")), mills(spark, 9), boundary_from_geojson(spark, WORLD_AREA, "QQA"), str(tmp_path))
    assert {s["slug"]: (s["status"], s["formats"]["geojson"]) for s in statuses} == {"mills": ("partial", "ok"), "kilns": ("partial", "ok")}
    assert all("gpkg" in s["error"] for s in statuses) and set(layers) == {"mills", "kilns"}


def test_resume_by_manifest(spark, tmp_path):
    area = boundary_from_geojson(spark, WORLD_AREA, "QQA")
    go = lambda source, **more: {s["slug"]: (s["status"], s["features"]) for s in X.run_export(spark, mill_run(**more), source, area, str(tmp_path))[0]}
    assert go(mills(spark, 9)) == {"mills": ("ok", 6), "kilns": ("ok", 3)}
    assert go(mills(spark, 30)) == {"mills": ("resumed", 6), "kilns": ("resumed", 3)}
    assert go(mills(spark, 30, "s2")) == {"mills": ("ok", 20), "kilns": ("ok", 10)}
    assert go(mills(spark, 9, "s2"), resume=False) == {"mills": ("ok", 6), "kilns": ("ok", 3)}


def test_combined_run(spark, tmp_path):
    run = mill_run(tiles=True, min_zoom=0, max_zoom=2)
    found = X.run_combined(spark, run, [mills(spark, 12, name="overture"), mills(spark, 30)], boundary_from_geojson(spark, WORLD_AREA, "QQA"), str(tmp_path))
    counts = {(r["category"], r["source"]): r["count"] for r in found.merged.groupBy("category", "source").count().collect()}
    assert counts == {("mills", "osm"): 20, ("kilns", "osm"): 10, ("mills", "overture"): 8, ("kilns", "overture"): 4}
    assert [(s["source"], s["slug"]) for s in found.statuses] == [("osm", "mills"), ("osm", "kilns"), ("overture", "mills"), ("overture", "kilns")]
    assert found.tiles.where("z = 0").count() == 42
    assert {(r["category"], r["source"], r["feature_count"]) for r in found.metadata.collect()} == {(c, s, n) for (c, s), n in counts.items()}
    period = found.period.first()
    assert (period["period_start"].year, period["period_end"].year) == (1911, 1939)


def test_release_types_keep_their_own_columns(spark, tmp_path):
    base = f"{tmp_path}/2030-01-01.0"
    spark.range(3).selectExpr("cast(id as string) id", "0.5 AS confidence").write.parquet(f"{base}/theme=places/type=place")
    spark.range(4).selectExpr("cast(id as string) id", "7 AS num_floors").write.parquet(f"{base}/theme=buildings/type=building")
    places = scans.scan_release(spark, str(tmp_path), "2030-01-01.0", "places", "place")
    assert set(places.columns) == {"id", "confidence", "theme", "type", "filename"} and places.count() == 3
    assert "num_floors" in scans.scan_release(spark, str(tmp_path), "2030-01-01.0", "buildings", "building").columns


def test_theme_cache_twice(spark, tmp_path):
    specs = mill_run().categories
    for n in (30, 9):
        table = mills(spark, n).table
        manifest = sinks.write_theme_cache(table, specs, str(tmp_path / "c"), "s1")
    assert {r["theme"]: r["rows"] for r in manifest.collect()} == {"mills": 6, "kilns": 3}


def test_json_values_are_json(spark):
    from cartoweave.operators import filters as FL

    values = ["plain", 'a "quoted" \\ word', "tab\tand\nline", "é\u0001"]
    df = spark.createDataFrame([({"k": v},) for v in values], "tags map<string,string>").select(FL.json_value("tags", "k").alias("j"), F.col("tags")["k"].alias("v"))
    assert all(json.loads(r["j"]) == r["v"] for r in df.collect())
