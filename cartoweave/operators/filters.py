"""Projections and predicates of a category: select lists, boxes, tag filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.spec import CategorySpec, TagFilter

WILDCARD = "*"


def project(df: DataFrame, fields: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """The select list with the geometry appended as ``geom``."""
    return df.selectExpr(*fields, f"{geometry} AS geom")


def list_first(items: Column | str) -> Column:
    """First element of a list, NULL when it is empty."""
    return F.get(G.as_col(items), 0)


def map_value(m: Column | str, key: str) -> Column:
    return G.as_col(m)[key]


def json_value(m: Column | str, key: str) -> Column:
    """The map's value as JSON text, in quotes, control characters escaped."""
    value = G.as_col(m)[key]
    wrapped = F.to_json(F.struct(value.alias("v")))
    # Between ``{"v":`` and the closing brace.
    return F.when(value.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def inject_local_names(fields: Sequence[str], languages: Sequence[str]) -> list[str]:
    """Adds ``tags['name:<lang>'] AS name_<lang>`` after ``name_en`` (else at the
    end), unless the alias already occurs somewhere in the list."""
    out = list(fields)
    present = "\n".join(out)
    at = next(
        (i + 1 for i, f in enumerate(out) if "AS name_en" in f or f.endswith(" name_en")), len(out)
    )
    extra = [f"tags['name:{lang}'] AS name_{lang}" for lang in languages if f"name_{lang}" not in present]
    return out[:at] + extra + out[at:]


def bbox_overlaps(box: Column, bbox: tuple[float, float, float, float]) -> Column:
    minx, miny, maxx, maxy = (float(v) for v in bbox)
    return (
        (box["xmin"] <= maxx) & (box["xmax"] >= minx) & (box["ymin"] <= maxy) & (box["ymax"] >= miny)
    )


def on_earth(box: Column) -> Column:
    """No vertex outside lon +-180 / lat +-90."""
    return (box["ymin"] >= -90.0) & (box["ymax"] <= 90.0) & (box["xmin"] >= -180.0) & (box["xmax"] <= 180.0)


def where_all(df: DataFrame, conditions: Iterable[str]) -> DataFrame:
    """AND of the conditions, blank ones skipped."""
    for condition in conditions:
        if condition and condition.strip():
            df = df.where(F.expr(f"({condition})"))
    return df


def build_where(
    df: DataFrame,
    bbox: tuple[float, float, float, float],
    conditions: Iterable[str] = (),
    box: str | None = "bbox",
    geom: str = "geometry",
) -> DataFrame:
    """The cheap part of the category filter: box, Earth, user conditions. A stored
    ``bbox`` struct lets the first two reach the parquet scan. The exact boundary
    test (``spatial.intersects_boundary``) goes on top of the rows left over."""
    if box is not None:
        df = df.where(bbox_overlaps(F.col(box), bbox)).where(on_earth(F.col(box)))
    else:
        df = df.where(G.once(G.extent(geom), lambda b: bbox_overlaps(b, bbox) & on_earth(b)))
    return where_all(df, conditions)


def normalise_value(value):
    """One spelling per filter value: ``True``, a string, or a sorted list of
    distinct strings. ``"*"`` means any value; ``False`` adds nothing."""
    if value == WILDCARD:
        return True
    if isinstance(value, bool) or value is None:
        return bool(value)
    if isinstance(value, str):
        return value
    if isinstance(value, (list, tuple, set)):
        return sorted({v for v in value if isinstance(v, str)})
    raise ValueError(f"unsupported tag filter value: {value!r}")


def normalise_filter(tag_filter: TagFilter) -> TagFilter:
    if not tag_filter:
        raise ValueError("the tag filter is empty")
    return {key: normalise_value(value) for key, value in tag_filter.items()}


def tag_predicate(tag_filter: TagFilter, tags: str = "tags") -> Column:
    """OR over the keys. An empty filter keeps every row; one whose values are all
    ``False`` keeps none."""
    if not tag_filter:
        return F.lit(True)
    clauses = []
    for key, value in tag_filter.items():
        value = normalise_value(value)
        found = F.col(tags)[key]
        if value is True:
            clauses.append(found.isNotNull())
        elif isinstance(value, str):
            clauses.append(found == value)
        elif value:
            clauses.append(found.isin(*value))
    return reduce(lambda a, b: a | b, clauses, F.lit(False)) if clauses else F.lit(False)


def union_filter(specs: Iterable[CategorySpec]) -> TagFilter:
    """One filter that lets through what any enabled category wants."""
    merged: TagFilter = {}
    for spec in specs:
        if not spec.osm.enabled:
            continue
        for key, value in spec.osm.filter.items():
            value = normalise_value(value)
            if key not in merged:
                merged[key] = value
            elif merged[key] is True or value is True:
                merged[key] = True
            else:
                merged[key] = value_union(merged[key], value)
    return merged


def value_union(a, b) -> list[str]:
    both = [v for side in (a, b) for v in ([side] if isinstance(side, str) else side or [])]
    return sorted(set(both))


def union_rows(rules: DataFrame) -> DataFrame:
    """The same over rows ``(category, key, value)``, a NULL value meaning any."""
    return rules.select("key", "value").distinct().groupBy("key").agg(
        F.bool_or(F.col("value").isNull()).alias("any_value"),
        F.sort_array(F.collect_set("value")).alias("listed"),
    ).select("key", "any_value", F.when(~F.col("any_value"), F.col("listed")).alias("listed"))


def categorise(df: DataFrame, specs: Iterable[CategorySpec], tags: str = "tags") -> DataFrame:
    """One scan for all categories: a row per (feature, category) it belongs to."""
    slugs = [
        F.when(tag_predicate(s.osm.filter, tags), F.lit(s.slug)) for s in specs if s.osm.enabled
    ]
    if not slugs:
        return df.withColumn("category", F.lit(None).cast("string")).where("false")
    return df.withColumn("category", F.explode(F.array_compact(F.array(*slugs))))


def resolve_formats(specs: DataFrame, run_formats: Sequence[str]) -> DataFrame:
    """Category formats override the run's. GeoParquet is kept apart from the
    downloads; a category without any format is skipped."""
    run = F.array(*[F.lit(f) for f in run_formats]).cast("array<string>")
    wanted = F.when(F.size("formats") > 0, F.col("formats")).otherwise(run)
    return specs.withColumn("wanted", wanted).select(
        *[c for c in specs.columns if c != "formats"],
        F.array_except("wanted", F.array(F.lit("geoparquet"))).alias("downloads"),
        F.array_contains("wanted", "geoparquet").alias("geoparquet"),
        F.when(F.size("wanted") == 0, "skipped").otherwise("wanted").alias("status"),
    )


def dataset_identity(iso3: Column | str, folder: Column | str) -> Column:
    ident = F.coalesce(F.nullif(F.lower(G.as_col(iso3)), F.lit("")), F.nullif(G.as_col(folder), F.lit("")))
    return F.coalesce(ident, F.raise_error(F.lit("iso3 or folder is required")).cast("string"))
