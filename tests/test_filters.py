import random

import pytest
from pyspark.sql import functions as F

from cartoweave.operators import filters as FL
from cartoweave.spec import CategorySpec, OsmBlock, RunSpec, select_category


def spec(name, tag_filter, enabled=True):
    return CategorySpec(name, osm=OsmBlock(enabled=enabled, filter=tag_filter))


def allows(tag_filter, key, value):
    """Whether the filter lets a tag through, by sets."""
    wanted = tag_filter.get(key, False)
    if wanted is True or wanted == "*":
        return True
    return value in ({wanted} if isinstance(wanted, str) else set(wanted or ()))


@pytest.mark.parametrize("seed", range(6))
def test_union_lets_through_what_any_category_does(seed):
    r = random.Random(seed)
    keys, values = ["surface", "cuisine", "voltage"], ["v0", "v1", "v2", "v3"]
    draw = lambda: r.choice([True, "*", r.choice(values), r.sample(values, 2), r.sample(values, 3)])
    filters = [{k: draw() for k in r.sample(keys, r.randrange(1, 4))} for _ in range(r.randrange(1, 5))]
    on = [r.random() < 0.8 for _ in filters]
    merged = FL.union_filter([spec(f"part {i}", f, e) for i, (f, e) in enumerate(zip(filters, on))])
    for key in keys:
        for value in [*values, "none of them"]:
            assert allows(merged, key, value) == any(e and allows(f, key, value) for f, e in zip(filters, on))


def test_union_of_nothing():
    assert FL.union_filter([]) == {}


def tags_frame(spark):
    rows = [
        (1, {"building": "yes", "name": "o'reilly"}), (2, {"highway": "primary"}), (3, {"amenity": "school"}), (4, {}), (5, None),
    ]
    return spark.createDataFrame(rows, "id int, tags map<string,string>")


@pytest.mark.parametrize(
    "tag_filter,want",
    [
        ({"building": True}, {1}),
        ({"building": "*"}, {1}),
        ({"amenity": ["school", "college"], "highway": "primary"}, {2, 3}),
        ({"name": "o'reilly"}, {1}),
        ({}, {1, 2, 3, 4, 5}),
        ({"building": False}, set()),
    ],
)
def test_tag_predicate(spark, tag_filter, want):
    kept = tags_frame(spark).where(FL.tag_predicate(tag_filter)).collect()
    assert {r["id"] for r in kept} == want


def test_filter_values():
    with pytest.raises(ValueError):
        FL.normalise_value(3.5)
    with pytest.raises(ValueError):
        FL.normalise_filter({})
    assert FL.normalise_filter({"k": "*", "l": ["b", "a", "b"]}) == {"k": True, "l": ["a", "b"]}


def test_categorise_gives_each_feature_to_every_category_it_matches(spark):
    specs = [spec("Built", {"building": True}), spec("Named", {"name": True}), spec("Off", {"highway": True}, False)]
    got = sorted((r["id"], r["category"]) for r in FL.categorise(tags_frame(spark), specs).collect())
    assert got == [(1, "built"), (1, "named")]


def test_inject_local_names():
    fields = ["feature_id AS id", "tags['name:en'] AS name_en", "tags['height'] AS height"]
    got = FL.inject_local_names(fields, ["ne", "fr"])
    assert got[2:4] == ["tags['name:ne'] AS name_ne", "tags['name:fr'] AS name_fr"]
    assert got[4] == "tags['height'] AS height"
    kept = FL.inject_local_names([*fields, "tags['name:ne'] AS name_ne"], ["ne"])
    assert sum("name_ne" in f for f in kept) == 1
    assert FL.inject_local_names(["a"], ["ne"])[-1].endswith("name_ne")


def test_not_in_drops_nulls_and_blank_conditions_are_skipped(spark):
    df = spark.createDataFrame([("dam",), ("river",), (None,)], "class string")
    assert [r["class"] for r in FL.where_all(df, ["", "class NOT IN ('dam')"]).collect()] == ["river"]


def test_bbox_filters_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr(
        "id", "named_struct('xmin', id * 1.0D, 'xmax', id * 1.0D, 'ymin', 0.0D, 'ymax', 0.0D) AS bbox", "'a' AS other"
    ).write.parquet(path)
    df = spark.read.parquet(path).where(FL.bbox_overlaps(F.col("bbox"), (2, -1, 4, 1))).select("id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(bbox.xmin,4.0)" in plan
    assert "other" not in plan.split("ReadSchema")[1]
    assert sorted(r["id"] for r in df.collect()) == [2, 3, 4]


def test_select_category():
    run = RunSpec(iso3="NPL", categories=(spec("Land Use", {"landuse": True}), spec("Roads", {"highway": True})))
    assert [c.name for c in select_category(run, "land-use").categories] == ["Land Use"]
    with pytest.raises(ValueError, match="Land Use, Roads"):
        select_category(run, "rivers")


def test_identity():
    assert RunSpec(iso3="NPL").identity == "npl"
    assert RunSpec(folder="project_1").identity == "project_1"
    with pytest.raises(ValueError):
        RunSpec().identity
