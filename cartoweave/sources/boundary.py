"""Export areas: GeoJSON given by the user, or the whole world."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import wkt
from cartoweave.operators import spatial as S
from cartoweave.functions.grid import DEFAULT_STEP

WORLD = "world"
WORLD_BBOX = (-180.0, -90.0, 180.0, 90.0)

_GEOMETRY = "struct<type:string,coordinates:string>"
_DOCUMENT = (
    f"struct<type:string,coordinates:string,geometry:{_GEOMETRY},"
    f"features:array<struct<geometry:{_GEOMETRY}>>,geometries:array<{_GEOMETRY}>>"
)


def parse_geojson(df: DataFrame, column: str = "text") -> DataFrame:
    """One row per geometry in the documents of ``column``, added as ``geom``: a bare
    geometry, a Feature, a FeatureCollection or a GeometryCollection."""
    doc = F.col("_d")
    own = F.struct(doc["type"].alias("type"), doc["coordinates"].alias("coordinates"))
    geometries = (
        F.when(doc["type"] == "FeatureCollection", F.transform(doc["features"], lambda f: f["geometry"]))
        .when(doc["type"] == "GeometryCollection", doc["geometries"])
        .when(doc["type"] == "Feature", F.array(doc["geometry"]))
        .otherwise(F.array(own))
    )
    parsed = df.withColumn("_d", F.from_json(column, _DOCUMENT)).withColumn("_g", F.explode(geometries))
    geom = wkt.from_geojson(F.col("_g.type"), F.col("_g.coordinates"))
    return parsed.withColumn("geom", geom).where("geom IS NOT NULL").drop("_d", "_g")


def boundary_bbox(boundary: DataFrame, by=(), geom: str = "geom") -> DataFrame:
    """The box around all coordinates; having none is an error."""
    b = G.extent(geom)
    boxes = boundary.select(*by, b.alias("b")).groupBy(*by).agg(
        F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"), F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax")
    )
    problem = F.raise_error(F.lit("no coordinates found in the geometry")).cast("double")
    return boxes.withColumn("xmin", F.coalesce("xmin", problem))


@dataclass(frozen=True)
class Boundary:
    """``geoms`` is None for the whole world, where every filter is a no-op."""

    iso3: str
    bbox: tuple[float, float, float, float]
    geoms: DataFrame | None
    label: str
    buffer_metres: float = 0.0

    def keep(self, features: DataFrame, id_col: str, geom: str = "geom", points: bool = False, step: float = DEFAULT_STEP):
        """The features that belong to this area."""
        if self.geoms is None:
            return features
        if self.buffer_metres > 0:
            return S.near_boundary(features, self.geoms, self.buffer_metres, id_col, step, geom)
        if points:
            # Single points take the short road; whatever else the table holds does not.
            single = features.where(F.col(geom)["kind"] == "POINT")
            first = F.col(geom)["parts"][0][0][0]
            xy = single.withColumn("_x", first["x"]).withColumn("_y", first["y"])
            inside = S.points_within(xy, S.boundary_index(self.geoms, step), id_col, "_x", "_y").drop("_x", "_y")
            rest = features.where(F.col(geom)["kind"] != "POINT")
            if rest.isEmpty():
                return inside
            return inside.unionByName(S.intersects_boundary(rest, self.geoms, id_col, step, geom))
        return S.intersects_boundary(features, self.geoms, id_col, step, geom)


def boundary_from_geojson(spark: SparkSession, text: str, iso3: str = "", buffer_metres: float = 0.0) -> Boundary:
    if buffer_metres < 0:
        raise ValueError(f"the buffer must be >= 0 metres; got {buffer_metres}")
    if text.strip().lower() == WORLD:
        return Boundary(iso3.upper(), WORLD_BBOX, None, "whole planet (boundary.geom: world)")
    geoms = parse_geojson(spark.createDataFrame([(text,)], "text string")).select("geom")
    bbox = tuple(boundary_bbox(geoms).first())
    label = "user-provided"
    if buffer_metres > 0:
        bbox = S.buffered_bbox(bbox, buffer_metres, spark)
        label = f"{label} (buffered +{buffer_metres:g}m)"
    return Boundary(iso3.upper(), bbox, geoms, label, buffer_metres)
