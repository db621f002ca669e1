"""One run for many areas: all boundaries of a table in one job.

An extract is read once. Features meet all boundaries in one join on the cell, whose
index is keyed by area and cell, and are staged with the area they belong to. Each
category is then written once for all areas, partitioned by area; what other areas left
under the same root stays (dynamic overwrite). The status of every area and category
comes from one aggregate over what was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions import text
from cartoweave.functions.grid import DEFAULT_STEP
from cartoweave.operators import filters as FL
from cartoweave.operators import spatial as S
from cartoweave.sources import sinks
from cartoweave.sources.base import ExtractSource
from cartoweave.sources.boundary import boundary_bbox, parse_geojson
from cartoweave.spec import CategorySkipped, CategorySpec, RunSpec


@dataclass(frozen=True)
class Many:
    """``statuses``: (iso3, slug, status, error, features). ``layers``: each category for
    all areas, read back from what was written."""

    statuses: DataFrame
    layers: dict[str, DataFrame]

    def area(self, slug: str, iso3: str) -> DataFrame:
        return self.layers[slug].where(F.col("iso3") == iso3.upper())


def areas_from_geojson(documents: DataFrame, iso3: str = "iso3", column: str = "text") -> DataFrame:
    """``(iso3, geom)`` of a table of documents; an area may have several geometries."""
    return parse_geojson(documents, column).select(F.upper(F.col(iso3)).alias("iso3"), "geom")


def assign(source: ExtractSource, categories: Sequence[CategorySpec], areas: DataFrame, root: str, step: float = DEFAULT_STEP) -> DataFrame:
    """Features of all categories with ``iso3`` and ``category``, staged by category. Boxes
    of the areas reach the scan first."""
    box = tuple(boundary_bbox(areas).first())
    wanted = source.table.where(FL.tag_predicate(FL.union_filter(list(categories))))
    stored = "bbox" if "bbox" in wanted.columns else None
    inside = S.assign_areas(FL.build_where(wanted, box, (), stored), areas, ["iso3"], "feature_id", step, "geometry")
    rows = FL.categorise(inside, categories)
    rows.write.mode("overwrite").partitionBy("category").parquet(root)
    return source.spark.read.schema(rows.schema).parquet(root)


def export_many(
    spark: SparkSession, run: RunSpec, source: ExtractSource, areas: DataFrame, root: str, step: float = DEFAULT_STEP
) -> Many:
    """Every category of ``run`` for every area of ``areas(iso3, geom)``, under
    ``root/<source>/<slug>/iso3=..``. A failing category costs itself in all areas; an
    area without features of a category is ``empty``. ``run.iso3`` is not read: local
    names follow no single country here."""
    areas = areas.select(F.upper("iso3").alias("iso3"), "geom")
    served = [c for c in run.categories if c.osm.enabled]
    staged = assign(source, served, areas, f"{root}/_stage/{source.name}", step) if served else None
    layers: dict[str, DataFrame] = {}
    outcome: list[tuple[str, str, str | None]] = []
    for category in run.categories:
        path = f"{root}/{source.name}/{category.slug}"
        try:
            query = source.query_for(run, category)
            rows = FL.where_all(staged.where(F.col("category") == category.slug), query.where)
            layer = FL.project(rows, [*query.select, "iso3"], "geometry")
            layer = text.transliterate(layer, category.transliterate)
            _replace_areas(layer, areas, path)
            layers[category.slug] = sinks.read_areas(spark, path, sinks.with_bbox(layer).schema).drop("bbox")
            outcome.append((category.slug, "ok", None))
        except CategorySkipped as skipped:
            outcome.append((category.slug, "skipped", str(skipped)))
        except Exception as problem:  # noqa: BLE001 - one category must not stop the rest
            outcome.append((category.slug, "failed", str(problem)))
    return Many(_statuses(areas, layers, outcome), layers)


def _replace_areas(layer: DataFrame, areas: DataFrame, path: str) -> None:
    """Write the layer's areas over what an earlier run left of them. An area of this run
    without a feature now has nothing that would replace its folder, so it gets an empty one."""
    sinks.write_areas(layer, path)
    found = layer.select("iso3").distinct()
    empty = sinks.with_bbox(layer).drop("iso3").limit(0)
    for r in areas.select("iso3").distinct().join(found, "iso3", "left_anti").collect():
        empty.write.mode("overwrite").parquet(f"{path}/iso3={r['iso3']}")


def _statuses(areas: DataFrame, layers: dict[str, DataFrame], outcome: list[tuple]) -> DataFrame:
    """A row for each area and category of the run."""
    asked = [F.struct(F.lit(s).alias("slug"), F.lit(o).alias("outcome"), F.lit(e).cast("string").alias("error")) for s, o, e in outcome]
    every = areas.select("iso3").distinct().select("iso3", F.inline(F.array(*asked)))
    counts = [df.select("iso3", F.lit(slug).alias("slug")) for slug, df in layers.items()]
    if counts:
        counted = reduce(DataFrame.unionByName, counts).groupBy("iso3", "slug").agg(F.count(F.lit(1)).alias("features"))
        every = every.join(counted, ["iso3", "slug"], "left")
    else:
        every = every.withColumn("features", F.lit(0).cast("long"))
    features = F.coalesce("features", F.lit(0))
    status = F.when((F.col("outcome") == "ok") & (features == 0), "empty").otherwise(F.col("outcome"))
    return every.select("iso3", "slug", status.alias("status"), "error", features.alias("features"))
