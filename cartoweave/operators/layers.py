"""Merging layers, tiling them and deciding which staged layers belong to a run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions import tiles as TL
from cartoweave.operators.report import source_rank
from cartoweave.session import staged, tasks


def merge_layers(layers: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """``(category, source, name, geom)`` of all layers; ``name`` is NULL for a layer
    without one."""
    if not layers:
        raise ValueError("merge_layers needs at least one layer")

    def one(df: DataFrame, category: str, source: str) -> DataFrame:
        name = F.col("name").cast("string") if "name" in df.columns else F.lit(None).cast("string")
        return df.select(
            F.lit(category).alias("category"), F.lit(source).alias("source"), name.alias("name"), "geom"
        )

    return reduce(DataFrame.unionByName, [one(*layer) for layer in layers])


def tile_pyramid(df: DataFrame, min_zoom: int = 0, max_zoom: int = 12, geom: str = "geom", expand: bool = True) -> DataFrame:
    """``z, x, y, full`` and the feature's columns, a row for each tile that a feature
    reaches; ``geom`` is what lies in the tile, in units of ``tiles.EXTENT`` from its upper
    left corner.

    Tiles come from their parents: what a parent holds of a feature is cut to its four
    children, so nothing is tried where the feature is not. A tile that an area fills is
    not split: it is ``full``, and stands for all its descendants down to ``max_zoom``, so
    a large area costs its outline. ``expand`` lists those descendants as rows too. Every
    level is staged, since the next one starts from it."""
    columns = [c for c in df.columns if c != geom]
    # A small file of features makes many tiles: they are dealt out before they are cut.
    spread = df.where(F.size(G.as_col(geom)["parts"]) > 0).repartition(tasks(df.sparkSession))
    located = spread.select(*columns, G.as_col(geom)["kind"].alias("_kind"), TL.unit_parts(G.as_col(geom)).alias("_parts"))
    apart = F.endswith("_kind", F.lit("POINT"))
    levels = [_point_tiles(located.where(apart), columns, min_zoom, max_zoom)]
    now = _cut_to(_first_tiles(located.where(~apart), min_zoom))
    for zoom in range(min_zoom, max_zoom + 1):
        now = staged(now)
        levels.append(now.drop("_box"))
        if zoom == max_zoom or now.where("NOT full").isEmpty():
            break
        # Children are numbered from twice their parent's place on.
        corner = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (0, 1) for dy in (0, 1)]))
        split = now.where("NOT full").withColumn("_c", corner).withColumn("z", F.col("z") + 1)
        split = split.withColumn("x", 2 * F.col("x") + F.col("_c.dx")).withColumn("y", 2 * F.col("y") + F.col("_c.dy")).drop("_c", "full")
        now = _cut_children(split)
    every = reduce(DataFrame.unionByName, levels)
    if expand:
        every = _expanded(every, max_zoom)
    local = TL.local_parts(F.col("_parts"), F.col("x"), F.col("y"), F.col("z"))
    whole = F.when(F.startswith("_kind", F.lit("MULTI")) | (F.size("_parts") < 2), F.col("_kind")).otherwise(F.concat(F.lit("MULTI"), F.col("_kind")))
    shaped = every.withColumn(geom, G.make(whole, local))
    return shaped.select("z", "x", "y", "full", *df.columns)


def _borders(zoom: Column, x: Column, y: Column) -> tuple[Column, Column, Column, Column]:
    n = F.pow(F.lit(2.0), zoom)
    return x / n, (x + 1) / n, y / n, (y + 1) / n


def _cut_to(rows: DataFrame) -> DataFrame:
    """Rows whose parts reach their tile, cut to it, with ``full`` and the box of what is
    left. The cut is made once: a filter on it would be pushed below and cut again."""
    return rows.select(*[c for c in rows.columns if c != "_parts"], F.inline(_cut()))


def _cut() -> Column:
    x0, x1, y0, y1 = box = _borders(F.col("z"), F.col("x"), F.col("y"))
    kind = F.col("_kind")
    cut = F.transform(F.array(TL.cut_parts(kind, F.col("_parts"), *box)), lambda p: F.struct(p.alias("_parts"), TL.fills(kind, p, *box).alias("full"), _box_of(p).alias("_box")))
    return F.filter(cut, lambda c: TL.reaches(c["_parts"], x1, y1))


def _cut_children(rows: DataFrame) -> DataFrame:
    """``_cut_to`` for what was cut to the parent tiles, ``_box`` around it: children that
    the box does not reach are left out, and what lies in one child is not cut again."""
    x0, x1, y0, y1 = _borders(F.col("z"), F.col("x"), F.col("y"))
    b = F.col("_box")
    near = rows.where((b["x1"] >= x0) & ((b["x0"] < x1) | (x1 >= 1.0)) & (b["y1"] >= y0) & ((b["y0"] < y1) | (y1 >= 1.0)))
    within = (b["x0"] >= x0) & (b["x1"] <= x1) & (b["y0"] >= y0) & (b["y1"] <= y1)
    # A part as large as the tile may fill it, or be its hole.
    smaller = (b["x1"] - b["x0"] < x1 - x0) | (b["y1"] - b["y0"] < y1 - y0)
    same = F.array(F.struct(F.col("_parts"), F.lit(False).alias("full"), b.alias("_box")))
    held = F.when(within & smaller, same).otherwise(_cut())
    return near.select(*[c for c in rows.columns if c not in ("_parts", "_box")], F.inline(held))


def _box_of(parts: Column) -> Column:
    return G.once(F.flatten(F.flatten(parts)), lambda v: F.struct(
        F.array_min(F.transform(v, lambda p: p["x"])).alias("x0"), F.array_max(F.transform(v, lambda p: p["x"])).alias("x1"),
        F.array_min(F.transform(v, lambda p: p["y"])).alias("y0"), F.array_max(F.transform(v, lambda p: p["y"])).alias("y1"),
    ))


def _first_tiles(rows: DataFrame, zoom: int) -> DataFrame:
    """Features with the tiles of the first zoom that their boxes touch."""
    n = F.lit(float(1 << zoom))
    last = F.lit((1 << zoom) - 1).cast("bigint")
    def place(c: str) -> Column:
        return F.least(F.floor(F.col(f"_b.{c}") * n).cast("bigint"), last)

    spread = rows.withColumn("_b", _box_of(F.col("_parts"))).withColumn("z", F.lit(zoom)).withColumn("x", F.explode(F.sequence(place("x0"), place("x1"))))
    return spread.withColumn("y", F.explode(F.sequence(place("y0"), place("y1")))).drop("_b")


def _point_tiles(rows: DataFrame, columns: Sequence[str], min_zoom: int, max_zoom: int) -> DataFrame:
    """Points by zoom: each tile with the points that fall into it."""
    leveled = rows.withColumn("z", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))))
    n = F.pow(F.lit(2.0), F.col("z"))

    def place(u: Column) -> Column:
        return F.least(F.floor(u * n), n - 1).cast("bigint")

    tile = lambda p: F.struct(place(p[0][0]["x"]).alias("x"), place(p[0][0]["y"]).alias("y"))
    spread = leveled.withColumn("_t", F.explode(F.array_distinct(F.transform("_parts", tile))))
    own = F.filter("_parts", lambda p: tile(p) == F.col("_t"))
    return spread.select(*columns, "_kind", own.alias("_parts"), "z", F.col("_t.x").alias("x"), F.col("_t.y").alias("y"), F.lit(False).alias("full"))


def _expanded(tiles: DataFrame, max_zoom: int) -> DataFrame:
    """Full tiles with all their descendants."""
    deeper = tiles.where("full").withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(max_zoom) - F.col("z"))))
    side = F.pow(F.lit(2.0), F.col("_d")).cast("bigint")
    spread = deeper.withColumn("_x", F.explode(F.sequence(F.col("x") * side, (F.col("x") + 1) * side - 1)))
    spread = spread.withColumn("_y", F.explode(F.sequence(F.col("y") * side, (F.col("y") + 1) * side - 1)))
    moved = spread.withColumn("z", F.col("z") + F.col("_d")).withColumn("x", F.col("_x")).withColumn("y", F.col("_y"))
    x0, x1, y0, y1 = _borders(F.col("z"), F.col("x"), F.col("y"))

    def corner(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    ring = F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1), corner(x0, y0))
    return tiles.where("NOT full").unionByName(moved.withColumn("_parts", F.array(F.array(ring))).select(*tiles.columns))


def tile_counts(tiles: DataFrame, layer: str) -> DataFrame:
    """Features per tile of the one named layer."""
    return tiles.groupBy("z", "x", "y").agg(F.lit(layer).alias("layer"), F.count("*").alias("n"))


def mergeable_layers(staged: DataFrame, specs: DataFrame, own_source: str) -> DataFrame:
    """Staged layers of other sources that this configuration still has and still
    tiles. ``staged``: (source, slug, path); ``specs``: (slug, source, tiles), with a
    missing (slug, source) meaning tiles are on."""
    known = specs.select("slug").distinct()
    off = specs.where("NOT tiles").select("slug", "source").distinct()
    return (
        staged.where(F.col("source") != own_source)
        .join(known, "slug", "left_semi")
        .join(off, ["slug", "source"], "left_anti")
    )


def match_slug(names: DataFrame, specs: DataFrame, prefix: Column) -> DataFrame:
    """Which category a ``{key}_{iso3}_{slug}_{source}_metadata.json`` belongs to: the
    first in configuration order whose slug follows the prefix.

    The candidates of a name are its own beginnings up to each underscore, so this
    is an equi-join on the slug.
    """
    rest = F.when(F.startswith(F.col("name"), prefix), F.substr(F.col("name"), F.length(prefix) + 1))
    tokens = names.withColumn("_t", F.split(rest, "_"))
    starts = F.transform(
        F.sequence(F.lit(1), F.size("_t") - 1), lambda i: F.array_join(F.slice("_t", F.lit(1), i), "_")
    )
    candidates = tokens.where(F.size("_t") > 1).select("name", F.explode(starts).alias("slug"))
    return (
        candidates.join(specs.select("slug", "ord"), "slug")
        .groupBy("name")
        .agg(F.min(F.struct("ord", "slug"))["slug"].alias("slug"))
    )


def parse_artifact(name: Column) -> Column:
    """``struct<geometry, source, format>`` read off an artifact's file name
    ``..._[geometry_]<source>_<format>.zip``; a tileset ``..._<source>.pmtiles`` has
    the format ``pmtiles``."""
    stem = F.regexp_replace(name, r"\.[^.]+$", "")
    tokens = F.split(stem, "_")
    tiles = F.endswith(name, F.lit(".pmtiles"))
    labels = F.array_intersect(F.array(*[F.lit(x) for x in G.GEOMETRY_LABELS]), tokens)
    return F.struct(
        F.get(labels, F.lit(0)).alias("geometry"),
        F.when(tiles, F.element_at(tokens, -1)).when(F.size(tokens) >= 3, F.element_at(tokens, -2)).alias("source"),
        F.when(tiles, F.lit("pmtiles")).otherwise(F.element_at(tokens, -1)).alias("format"),
    )


def artifact_name(prefix: Column, slug: Column, geometry: Column, source: Column, fmt: Column) -> Column:
    """``{prefix}_{slug}[_geometry][_source]_{format}.zip``."""
    blank = F.lit("")
    stem = F.concat_ws("_", prefix, slug, F.nullif(geometry, blank), F.nullif(source, blank), fmt)
    return F.concat(stem, F.lit(".zip"))


def artifact_key(
    prefix: Column, iso3: Column, slug: Column, filename: Column,
    folder: Column | None = None, geometry: Column | None = None, nest_by_category: bool = True,
) -> Column:
    """``prefix/(folder or ISO3)/[category]/[geometry]/filename`` without stray slashes."""
    blank = F.lit("")

    def segment(c: Column | None) -> Column:
        return F.nullif(F.btrim(c, F.lit("/")), blank) if c is not None else F.lit(None).cast("string")

    place = F.coalesce(segment(folder), segment(F.upper(iso3)))
    middle = [segment(slug)] if nest_by_category else []
    return F.concat_ws("/", segment(prefix), place, *middle, segment(geometry), filename)


def order_artifacts(artifacts: DataFrame) -> DataFrame:
    return artifacts.orderBy(F.desc("bytes"), "name")


def layer_order(source: Column, ord_: Column) -> list[Column]:
    return [source_rank(source), ord_]
