import datetime as dt

from pyspark.sql import functions as F

from cartoweave.functions import wkt
from cartoweave.operators import profile as P
from cartoweave.operators import report as R

ROWS = [
    (1, "A", "cafe", "POINT(83.5 28.5)"),
    (2, "B", "cafe", "POINT(83.6 28.6)"),
    (3, "C", None, "POINT(83.7 28.7)"),
    (4, None, "restaurant", "POLYGON((1 1, 2 1, 2 2, 1 2, 1 1))"),
    (5, "E", "bar", "LINESTRING(0 0, 1 1)"),
]


def layer(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "id int, name string, amenity string, wkt string")
    return df.withColumn("geom", wkt.from_wkt("wkt")).drop("wkt")


def test_profile_of_a_small_layer(spark):
    p = P.profile(layer(spark))
    table = p["table"].first()
    assert table["feature_count"] == 5
    assert (table["xmin"], table["ymin"], table["xmax"], table["ymax"]) == (0.0, 0.0, 83.7, 28.7)
    assert {r["kind"]: r["n"] for r in p["geometry"].collect()} == {"POINT": 3, "POLYGON": 1, "LINESTRING": 1}
    columns = {r["name"]: r for r in p["columns"].collect()}
    assert set(columns) == {"id", "name", "amenity"}
    assert (columns["id"]["null_count"], columns["id"]["null_percent"], columns["id"]["distinct_count"]) == (0, 0.0, 5)
    assert columns["name"]["null_percent"] == 20.0
    assert columns["amenity"]["distinct_count"] == 3
    top = p["top_values"].where("name = 'amenity' AND rank = 1").first()
    assert (top["value"], top["n"]) == ("cafe", 2)
    assert p["summary"].first()["summary"] == (
        "5 features. geometry types: 3 POINT, 1 LINESTRING, 1 POLYGON. all 3 attribute columns have <50% null share."
    )


def test_empty_layer(spark):
    empty = layer(spark).where("false")
    p = P.profile(empty)
    table = p["table"].first()
    assert table["feature_count"] == 0 and table["xmin"] is None
    assert p["summary"].first()["summary"] == "Empty dataset."
    assert {r["null_percent"] for r in p["columns"].collect()} == {0.0}
    assert {r["distinct_count"] for r in p["columns"].collect()} == {0}


def test_all_null_geometry_has_zero_bounds(spark):
    df = layer(spark).withColumn("geom", F.when(F.lit(False), F.col("geom")))
    assert tuple(P.extent(df).first()) == (0.0, 0.0, 0.0, 0.0)


def test_temporal_bounds(spark):
    days = [dt.datetime(2023, 1, 15, 10), dt.datetime(2024, 6, 30, 12, 30), dt.datetime(2025, 12, 1, 8), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(days)], "id int, update_time timestamp")
    row = P.temporal_bounds(df, "update_time").first()
    assert (row["min_value"], row["max_value"], row["non_null_count"]) == (days[0], days[2], 3)
    assert R.temporal_share(P.temporal_bounds(df, "update_time")).first()["coverage"] == 75.0
    assert P.temporal_bounds(df, "missing") is None
    gone = P.temporal_bounds(df.where("update_time IS NULL"), "update_time").first()
    assert (gone["min_value"], gone["non_null_count"]) == (None, 0)


def test_long_columns_have_no_top_values(spark):
    df = spark.range(1001).selectExpr("id", "id % 3 AS few")
    names = {r["name"] for r in P.top_values(df).collect()}
    assert names == {"few"}
    assert P.top_values(df).count() == 3


def test_approximate_distinct_is_close(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS few")
    got = {r["name"]: r["distinct_count"] for r in P.distinct_counts(df, approx=True).collect()}
    assert got["few"] == 7 and abs(got["id"] - 5000) < 500


def columns_frame(spark, rows):
    return spark.createDataFrame(
        [(i, n, "string", 500, int(500 * p / 100), p, 3) for i, (n, p) in enumerate(rows)],
        "ord int, name string, type string, total bigint, null_count bigint, null_percent double, distinct_count bigint",
    )


def test_quality_and_report_tables(spark):
    cols = columns_frame(spark, [("name", 50.0), ("name_ne", 70.0), ("adm1_pcode", 1.0), ("adm2_pcode", 100.0), ("name_latin_x", 99.0)])
    q = R.quality(cols).first()
    assert (q["well"], q["partial"], q["rare"], q["total_columns"]) == (2, 1, 2, 5)
    assert q["caption"] == "2 of 5 attribute columns are well-populated."
    assert R.named_percent(cols).first()["named_percent"] == 50.0
    assert R.languages(cols).first()["languages"] == "local, ne"
    admin = R.deepest_admin(cols).first()
    assert (admin["level"], admin["coverage"]) == ("1", 99.0)
    off = R.deepest_admin(cols.where("name = 'name'")).first()
    assert (off["level"], off["coverage"]) == ("off", None)
    assert R.named_percent(cols.where("name <> 'name'")).first()["named_percent"] is None


def test_many_rows_on_one_value(spark):
    """A third of all rows on one value changes nothing in the counts."""
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id % 400) END AS v")
    top = P.top_values(df).where("rank = 1").first()
    assert (top["value"], top["n"]) == ("hot", 1000)


def test_profiles_merge_without_the_layers(spark, tmp_path):
    a, b = layer(spark).withColumn("side", F.lit("a")), layer(spark, ROWS[:3]).withColumn("side", F.lit("b"))
    b = b.drop("amenity").withColumn("note", F.lit("new"))
    for part in (a, b):
        P.stored_profile(part, ["side"]).write.mode("append").parquet(str(tmp_path / "profiles"))
    merged = P.merged_profile(spark.read.parquet(str(tmp_path / "profiles")))
    whole = a.unionByName(b, allowMissingColumns=True)
    table = merged["table"].first()
    assert (table["feature_count"], table["layers"]) == (8, 2)
    assert tuple(table[c] for c in ("xmin", "ymin", "xmax", "ymax")) == tuple(P.extent(whole).first())
    fields = ("name", "total", "null_count", "null_percent", "distinct_count")
    want = {tuple(r[c] for c in fields) for r in P.column_report(whole, (), ["id", "name", "amenity", "note"]).collect()}
    assert {tuple(r[c] for c in fields) for r in merged["columns"].collect()} == want


def test_stored_profiles_of_nothing(spark):
    empty = P.stored_profile(layer(spark).where("false").withColumn("side", F.lit("a")), ["side"])
    merged = P.merged_profile(empty)
    assert (merged["table"].first()["feature_count"], merged["columns"].count()) == (0, 0)


def test_a_profile_counts_values_once(spark, monkeypatch):
    calls = []
    counted = P.value_counts
    monkeypatch.setattr(P, "value_counts", lambda *a, **k: calls.append(1) or counted(*a, **k))
    P.profile(layer(spark))
    assert len(calls) == 1
