"""A whole run: scan, filter, tag, name, profile, write, remember.

The expensive, shared part (boundary test and admin tagging) is done once for all
categories of an extract and written to a staging table partitioned by category;
each category then reads only its own partition. Driver code composes jobs and
keeps one status row per category.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions import text
from cartoweave.functions.grid import DEFAULT_STEP
from cartoweave.operators import admin as A
from cartoweave.operators import filters as FL
from cartoweave.operators import layers as LY
from cartoweave.operators import profile as P
from cartoweave.operators import report as R
from cartoweave.operators import resume as RS
from cartoweave.sources import sinks
from cartoweave.sources.base import ExtractSource, Source, SourceQuery
from cartoweave.sources.boundary import Boundary
from cartoweave.spec import SOURCE_RANK, UNRANKED, CategorySkipped, CategorySpec, RunSpec


@dataclass(frozen=True)
class Tagging:
    """Admin polygons (level, pcode, name, adm0_*, geom) and the grid they are cut to."""

    admin: DataFrame
    levels: tuple[int, ...] = A.LEVELS
    step: float = DEFAULT_STEP


def category_features(
    query: SourceQuery, boundary: Boundary, geometry: str = "geometry", points: bool = False,
    step: float = DEFAULT_STEP,
) -> DataFrame:
    """The category's rows inside the boundary, before the select list."""
    cheap = FL.build_where(query.table, boundary.bbox, query.where, query.box, geometry)
    return boundary.keep(cheap, query.id_col, geometry, points, step)


def build_layer(
    query: SourceQuery, category: CategorySpec, boundary: Boundary, run: RunSpec,
    tagging: Tagging | None = None, geometry: str = "geometry", points: bool = False, step: float = DEFAULT_STEP,
    lookups: Lookups | None = None, by_cell: bool = False,
) -> DataFrame:
    """One category from scan to named, tagged layer. ``by_cell`` keeps, per level, whether
    the cell alone gave the code."""
    rows = category_features(query, boundary, geometry, points, step)
    layer = FL.project(rows, list(query.select), geometry)
    if tagging is not None and not category.skip_pcodes:
        mode = A.resolve_mode(run.boundary_resolution, category.boundary_resolution)
        levels = [n for n in run.pcode_levels if n in tagging.levels]
        lookup = lookups.of(mode) if lookups is not None else None
        layer = A.tag_admin(layer, tagging.admin, run.iso3, levels, mode, tagging.step, lookup=lookup, by_cell=by_cell)
    return text.transliterate(layer, category.transliterate)


class Lookups:
    """One admin lookup per mode, built when first asked for and shared by all
    categories of a run."""

    def __init__(self, tagging: Tagging | None, run: RunSpec):
        self.tagging, self.levels, self.built = tagging, run.pcode_levels, {}

    def of(self, mode: str) -> A.AdminLookup | None:
        if mode not in self.built:
            levels = [n for n in self.levels if n in self.tagging.levels]
            self.built[mode] = A.lookup_for(self.tagging.admin, levels, mode, self.tagging.step)
        return self.built[mode]

    def release(self) -> None:
        for lookup in self.built.values():
            if lookup is not None:
                lookup.release()
        self.built.clear()


def stage_extract(
    source: ExtractSource, run: RunSpec, boundary: Boundary, root: str, points: bool = False, step: float = DEFAULT_STEP
) -> DataFrame:
    """One scan for all categories: union filter, boundary test, a row per category,
    written partitioned by category."""
    enabled = [c for c in run.categories if c.osm.enabled]
    wanted = source.table.where(FL.tag_predicate(FL.union_filter(enabled)))
    box = "bbox" if "bbox" in wanted.columns else None
    inside = boundary.keep(FL.build_where(wanted, boundary.bbox, (), box), "feature_id", "geometry", points, step)
    FL.categorise(inside, enabled).write.mode("overwrite").partitionBy("category").parquet(root)
    return source.spark.read.schema(
        FL.categorise(inside, enabled).schema
    ).parquet(root)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A layer an earlier run left, if it is still there."""
    try:
        return spark.read.parquet(path).drop("bbox")
    except AnalysisException:
        return None


def layer_config(run: RunSpec, category: CategorySpec, boundary: Boundary, tagging: Tagging | None) -> str:
    """Fingerprint of what shapes a category's layer: its blocks with filters and select
    lists, names, area and tagging. Formats are not part of it: they are written from the
    layer."""
    tagged = tagging is not None and not category.skip_pcodes
    mode = A.resolve_mode(run.boundary_resolution, category.boundary_resolution) if tagged else None
    levels = [n for n in run.pcode_levels if n in tagging.levels] if tagged else []
    area = (boundary.bbox, boundary.label, boundary.buffer_metres)
    blocks = [asdict(category.osm), asdict(category.overture)]
    for block in blocks:
        block.pop("tiles")
    return RS.config_key(blocks, [asdict(t) for t in category.transliterate], area, mode, levels)


def finished_layers(spark: SparkSession, run: RunSpec, source: Source, root: str, configs: dict[str, str]) -> dict[str, tuple[str, list[str]]]:
    """Slugs that the manifest has as built for the source's snapshot with the settings of
    ``configs``, with their layers' paths and the formats written from them."""
    snapshot, iso3 = source.peek_snapshot(run), run.iso3.upper()
    manifest = RS.read_state(spark, f"{root}/_state")
    specs = spark.createDataFrame(
        [(iso3, source.name, slug, snapshot, config) for slug, config in configs.items()],
        "iso3 string, source string, slug string, snapshot string, config string",
    )
    todo = RS.pending(specs, manifest, "built").select("iso3", "source", "slug")
    state = RS.latest_state(manifest).join(specs.select("iso3", "source", "slug"), ["iso3", "source", "slug"], "left_semi")
    rows = state.join(todo, ["iso3", "source", "slug"], "left_anti").select("slug", "formats").collect()
    return {r["slug"]: (f"{root}/{run.identity}/{source.name}/{r['slug']}/{LAYER}", list(r["formats"] or [])) for r in rows}


# Where a run keeps each layer; no format writes there.
LAYER = "_layer"


def run_export(
    spark: SparkSession, run: RunSpec, source: Source, boundary: Boundary, root: str,
    tagging: Tagging | None = None, points: bool = False, step: float = DEFAULT_STEP,
    done: Sequence[str] | None = None, formats: Sequence[str] | None = None, metadata: bool = False,
) -> tuple[list[dict], dict[str, DataFrame]]:
    """Builds and writes every category. Returns a status row per category and the
    layers as read back from what was written.

    A failing category does not stop the others, and a failing format costs that format
    alone (``formats`` of the status row). Categories that the manifest under ``root``
    has as built for this snapshot with the same settings, or that ``done`` lists, are
    ``resumed`` when their layer is still there: formats they lack are written from it.
    ``run.resume`` off builds all anew. ``tags`` of a status row has what tagging found,
    counted while the layer was written.
    """
    ident = run.identity
    source.prepare(run)
    statuses: list[dict] = []
    layers: dict[str, DataFrame] = {}
    staged = None
    world = replace(boundary, geoms=None)
    base = f"{root}/{ident}/{source.name}"
    configs = {c.slug: layer_config(run, c, boundary, tagging) for c in run.categories}
    if done is not None:
        finished = {slug: (f"{base}/{slug}/{LAYER}", []) for slug in done}
    else:
        finished = finished_layers(spark, run, source, root, configs) if run.resume and configs else {}
    kept = {slug: (df, have) for slug, (path, have) in finished.items() if (df := _stored(spark, path)) is not None}
    lookups = Lookups(tagging, run)
    entries: list[dict] = []
    snapshot = source.peek_snapshot(run)
    for category in run.categories:
        status = {
            "iso3": run.iso3.upper(), "source": source.name, "slug": category.slug, "status": "ok", "error": None, "features": 0, "formats": {},
        }
        statuses.append(status)
        wanted = list(category.formats or formats or run.formats)
        path = f"{base}/{category.slug}"

        def remember(formats: Sequence[str]) -> None:
            entries.append({
                "iso3": run.iso3.upper(), "source": source.name, "slug": category.slug, "snapshot": snapshot,
                "built_utc": datetime.now(timezone.utc), "artifact_present": True, "path": f"{path}/{LAYER}",
                "features": status["features"], "config": configs[category.slug], "formats": sorted(formats),
            })

        if category.slug in kept:
            layers[category.slug], have = kept[category.slug]
            status.update(status="resumed", features=layers[category.slug].count(), formats={f: "ok" for f in have if f in wanted})
            missing = [f for f in wanted if f not in have] if done is None else []
            if missing:
                _write_formats(layers[category.slug], path, missing, run, status)
                remember([*have, *(f for f in missing if status["formats"][f] == "ok")])
            continue
        if not wanted:
            status.update(status="skipped", error="no output formats configured")
            continue
        try:
            query = source.query_for(run, category)
            area = boundary
            if isinstance(source, ExtractSource):
                if staged is None:
                    staged = stage_extract(source, run, boundary, f"{root}/_stage/{ident}/{source.name}", points, step)
                query = replace(query, table=staged.where(F.col("category") == category.slug))
                area = world
            counted = tagging is not None and not category.skip_pcodes
            layer = build_layer(query, category, area, run, tagging, points=points, step=step, lookups=lookups, by_cell=counted)
            if counted:
                levels = [n for n in run.pcode_levels if n in tagging.levels]
                layer, seen = A.observe_tags(layer, levels)
            sinks.write_layer(layer, f"{path}/{LAYER}")
            if counted:
                status["tags"] = [r.asDict() for r in A.observed_report(spark, seen.get, levels).collect()]
            layer = spark.read.parquet(f"{path}/{LAYER}").drop("bbox")
            count = layer.count()
        except CategorySkipped as skipped:
            status.update(status="skipped", error=str(skipped))
            continue
        except Exception as problem:  # noqa: BLE001 - one category must not stop the rest
            status.update(status="failed", error=str(problem))
            continue
        status["features"] = count
        if count == 0:
            status["status"] = "empty"
            continue
        layers[category.slug] = layer
        _write_formats(layer, path, wanted, run, status)
        if metadata:
            period = layer_period(layer, category.temporal_column)
            described = layer_metadata(layer, category.slug, source.name, snapshot or "")
            sinks.write_layer_metadata(P.pair(described, period, ()) if period is not None else described, f"{path}/_metadata")
        if status["status"] == "ok":
            remember(wanted)
    RS.record_state(spark, f"{root}/_state", entries)
    lookups.release()
    return statuses, layers


def _write_formats(layer: DataFrame, path: str, wanted: Sequence[str], run: RunSpec, status: dict) -> None:
    """Writes the formats, each at its own risk, and notes how it went."""
    failed = {}
    for fmt in wanted:
        try:
            write_format(layer, f"{path}/{fmt}", fmt, run.split_by_geometry)
            status["formats"][fmt] = "ok"
        except Exception as problem:  # noqa: BLE001 - one format must not stop the others
            status["formats"][fmt] = failed[fmt] = str(problem)
    if failed:
        status["error"] = "; ".join(f"{f}: {e}" for f, e in failed.items())
        status["status"] = "failed" if len(failed) == len(wanted) else "partial"


def layer_period(layer: DataFrame, column: str | None) -> DataFrame | None:
    """One row ``min_value, max_value`` of the layer's time column, if it has one."""
    if column is None or column not in layer.columns:
        return None
    return layer.agg(F.min(column).cast("string").alias("min_value"), F.max(column).cast("string").alias("max_value"))


def write_format(layer: DataFrame, path: str, fmt: str, split: bool = False) -> None:
    if fmt == "geojson":
        sinks.write_split(layer, path, "geojson") if split else sinks.write_geojson(layer, path)
    elif fmt == "kml":
        sinks.write_by_label(layer, path, sinks.write_kml) if split else sinks.write_kml(layer, path)
    elif fmt == "geoparquet":
        sinks.write_by_label(layer, path, sinks.write_geoparquet) if split else sinks.write_geoparquet(layer, path)
    elif fmt == "parquet":
        sinks.write_split(layer, path, "parquet") if split else sinks.write_layer(layer, path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


@dataclass(frozen=True)
class Combined:
    """What a run over several sources leaves: a status row per category and source, all
    layers as one table, its tiles, and one metadata row per layer."""

    statuses: list[dict]
    merged: DataFrame | None
    tiles: DataFrame | None
    metadata: DataFrame | None
    period: DataFrame | None


def run_combined(
    spark: SparkSession, run: RunSpec, sources: Sequence[Source], boundary: Boundary, root: str,
    tagging: Tagging | None = None, points: bool = False, step: float = DEFAULT_STEP,
) -> Combined:
    """All sources one after the other, then their layers together: merged by source rank
    and configuration order, tiled where ``run.tiles`` asks for it, described in one
    file, with the period all of them cover."""
    statuses: list[dict] = []
    found: list[tuple[DataFrame, str, str]] = []
    described: list[DataFrame] = []
    periods: list[DataFrame] = []
    tiled: list[tuple[DataFrame, str, str]] = []
    for source in sorted(sources, key=lambda x: SOURCE_RANK.get(x.name, UNRANKED)):
        rows, layers = run_export(spark, run, source, boundary, root, tagging, points, step, metadata=True)
        statuses += rows
        for category in run.categories:
            layer = layers.get(category.slug)
            if layer is None:
                continue
            entry = (layer, category.slug, source.name)
            found.append(entry)
            block = category.overture if source.name == "overture" else category.osm
            if block.tiles:
                tiled.append(entry)
            described.append(layer_metadata(layer, category.slug, source.name, source.peek_snapshot(run) or ""))
            if (period := layer_period(layer, category.temporal_column)) is not None:
                periods.append(period)
    if not found:
        return Combined(statuses, None, None, None, None)
    place = f"{root}/{run.identity}/_combined"
    LY.merge_layers(found).write.mode("overwrite").partitionBy("category", "source").parquet(f"{place}/layers")
    merged = spark.read.parquet(f"{place}/layers")
    tiles = None
    if run.tiles and tiled:
        pyramid = LY.tile_pyramid(LY.merge_layers(tiled), run.min_zoom, run.max_zoom)
        pyramid.write.mode("overwrite").partitionBy("z").parquet(f"{place}/tiles")
        tiles = spark.read.parquet(f"{place}/tiles")
    table = described[0]
    for more in described[1:]:
        table = table.unionByName(more, allowMissingColumns=True)
    # One row per layer of the configuration: a single small file.
    document = table.agg(F.collect_list(F.struct(*table.columns)).alias("layers")).select(F.lit(run.identity).alias("dataset"), "layers")
    document.coalesce(1).write.mode("overwrite").json(f"{place}/metadata")
    metadata = spark.read.schema(document.schema).json(f"{place}/metadata").select(F.explode("layers").alias("l")).select("l.*")
    period = None
    if periods:
        every = periods[0]
        for more in periods[1:]:
            every = every.unionByName(more)
        period = R.combined_period(every)
    return Combined(statuses, merged, tiles, metadata, period)


def profile_layers(layers: dict[str, DataFrame], temporal: dict[str, str] | None = None) -> dict[str, dict[str, DataFrame]]:
    """Profile tables per layer; ``temporal`` names a layer's time column."""
    return {slug: P.profile(df, (), (temporal or {}).get(slug)) for slug, df in layers.items()}


def layer_metadata(layer: DataFrame, category: str, source: str, snapshot: str) -> DataFrame:
    """One row of layer metadata: counts, extent and columns as a nested record."""
    columns = P.column_report(layer).select(
        F.struct("ord", "name", "type", "null_count", "null_percent", "distinct_count").alias("c")
    ).agg(F.sort_array(F.collect_list("c")).alias("columns"))
    kinds = P.geometry_types(layer).agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "kind", "n"))).alias("k"))
    kinds = kinds.select(F.transform("k", lambda e: F.struct(e["kind"].alias("kind"), e["n"].alias("n"))).alias("geometry_types"))
    table = P.pair(P.row_count(layer), P.extent(layer), ())
    return P.pair(P.pair(table, kinds, ()), columns, ()).select(
        F.lit(category).alias("category"), F.lit(source).alias("source"), F.lit(snapshot).alias("snapshot"), "*"
    )
