import pytest
from pyspark.sql import functions as F

from cartoweave.functions import text
from cartoweave.functions import wkt
from cartoweave.spec import TransliterateRule as Rule


NAMES = [
    (21, "नदी पुल", None, "ndii pul"), (22, "Озеро Байкал", "Lake Baikal", "Ozero Baikal"), (23, "Old Mill", "Old Mill", "Old Mill"),
    (24, None, None, None), (25, None, "Spare name", None), (26, "Señor Müller, Žižkov, Ørsted", None, "Senor Muller, Zizkov, Orsted"),
]


def names(spark):
    return spark.createDataFrame([r[:3] for r in NAMES], "id int, name string, name_en string")


def test_transliteration_prefers_the_given_column(spark):
    out = text.transliterate(names(spark), [Rule("name_latin", "name", "name_en")])
    got = {r["id"]: r["name_latin"] for r in out.collect()}
    assert got == {i: preferred or latin for i, _, preferred, latin in NAMES}


def test_transliteration_without_preference_replaces_and_chains(spark):
    df = names(spark).withColumn("name_latin", F.lit("old"))
    out = text.transliterate(df, [Rule("name_latin", "name"), Rule("again", "name_latin")])
    got = {r["id"]: (r["name_latin"], r["again"]) for r in out.collect()}
    assert got == {i: (latin, latin) for i, _, _, latin in NAMES}
    assert text.transliterate(df, []).columns == df.columns


def test_transliteration_checks_columns(spark):
    for rule in (Rule("t", "missing"), Rule("t", "name", "missing"), Rule("t", "id"), Rule("", "name")):
        with pytest.raises(ValueError):
            text.transliterate(names(spark), [rule])


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "name,want",
    [
        ("buildings", "Buildings"), ("education_facilities", "Education Facilities"), ("points_of_interest", "Points of Interest"),
        ("the_RIVERS and lakes", "The Rivers and Lakes"),
    ],
)
def test_title_case(spark, name, want):
    assert one(spark, text.title_case(F.lit(name))) == want


def test_slug(spark):
    for name, want in (("Land Use (all)", "land_use_all"), ("__A-b__", "a_b")):
        assert one(spark, text.slugify(F.lit(name))) == want == text.slug_of(name)


def test_titles(spark):
    t = lambda template: one(spark, text.title(F.lit(template), F.lit("Roads"), F.lit("Nepal"), F.lit("npl")))
    assert t("") == "Roads of Nepal"
    assert t("{country} ({iso3}) - {category}") == "Nepal (NPL) - Roads"
    assert one(spark, text.title(None, F.lit("Roads"), F.lit(""), F.lit("npl"))) == "Roads of NPL"


def test_country_name(spark):
    known = spark.createDataFrame([("VNM", "Vietnam", "Viet Nam"), ("NPL", None, "Nepal")], "iso3 string, common_name string, name string")
    df = spark.createDataFrame([("vnm", None), ("NPL", None), ("NPL", "Pokhara Valley"), ("zzz", "")], "iso3 string, dataset_name string")
    assert [r["country"] for r in text.country_name(df, known).orderBy("country").collect()] == ["Nepal", "Pokhara Valley", "Vietnam", "ZZZ"]


def test_counts(spark):
    assert one(spark, text.format_count(F.lit(1234567))) == "1,234,567"
    assert [one(spark, text.short_count(F.lit(n))) for n in (999, 1000, 12345)] == ["999", "1k", "12k"]
    assert one(spark, text.percent(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, text.percent(F.lit(0), F.lit(0))) == 0.0


WKTS = [
    "POINT (1.5 -2)", "LINESTRING (0 0, 1 1, 2 0.5)", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))",
    "MULTIPOINT ((1 2), (3 4))", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.5 5.2, 5.6 5.2, 5.6 5.3, 5.5 5.2)))",
]


def test_wkt_and_geojson_round_trip(spark):
    df = spark.createDataFrame([(w,) for w in WKTS], "w string").withColumn("geom", wkt.from_wkt("w"))
    back = df.select("w", (wkt.to_wkt("geom")).alias("t"), wkt.to_geojson("geom").alias("j"))
    json_back = wkt.from_geojson(F.get_json_object("j", "$.type"), F.get_json_object("j", "$.coordinates"))
    for r in back.select("w", "t", wkt.to_wkt(json_back).alias("t2")).collect():
        want = r["w"].replace("MULTIPOINT ((1 2), (3 4))", "MULTIPOINT (1 2, 3 4)")
        assert r["t"] == want and r["t2"] == want
    assert one(spark, wkt.from_wkt(F.lit("CIRCULARSTRING(0 0, 1 1)"))) is None
