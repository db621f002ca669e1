"""Layer profiles: counts, extents, null shares, distinct and top values, time range.

Every function takes ``by``, the columns that name a layer, so that all layers of
a run are profiled in the same pass. Column statistics come from one aggregate;
distinct and top values share one table of value counts (``counts``), whose partial
sums are formed before the shuffle.

``stored_profile`` keeps what merges: totals, nulls, extents, a time range and a sketch of
the distinct values. ``merged_profile`` rolls such rows up without reading a layer again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions.text import format_count, percent
from cartoweave.session import staged

# How many top values are listed, and the most distinct values a
# column may have to be listed at all.
TOP_VALUES = 5
MAX_DISTINCT = 1000

GEOMETRY_COLUMNS = ("geom", "geometry", "bbox")

# A sketch has two to the power of this many counters, a byte each: the distinct counts
# rolled up from it have a standard error below one percent.
SKETCH_POWER = 14


def pair(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two per-layer tables; without layer columns both are of a single layer."""
    if by:
        return a.join(b, list(by))
    return a.withColumn("_one", F.lit(0)).join(b.withColumn("_one", F.lit(0)), "_one").drop("_one")


def attributes(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in GEOMETRY_COLUMNS and c not in by]


def row_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("feature_count"))


def geometry_types(df: DataFrame, by: Sequence[str] = (), geom: str = "geom") -> DataFrame:
    return df.groupBy(*by, F.col(geom)["kind"].alias("kind")).agg(F.count("*").alias("n"))


def extent(df: DataFrame, by: Sequence[str] = (), geom: str = "geom", box: str | None = None) -> DataFrame:
    """The union of the extents: no bounds for an empty table, zeros where every
    geometry is NULL."""
    b = F.col(box) if box is not None else G.extent(geom)
    boxes = df.select(*by, b.alias("_b"))
    n = F.count("*")

    def bound(aggregate: Column) -> Column:
        return F.when(n > 0, F.coalesce(aggregate, F.lit(0.0)))

    return boxes.groupBy(*by).agg(
        bound(F.min("_b.xmin")).alias("xmin"),
        bound(F.min("_b.ymin")).alias("ymin"),
        bound(F.max("_b.xmax")).alias("xmax"),
        bound(F.max("_b.ymax")).alias("ymax"),
    )


def null_stats(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``(by..., ord, name, type, total, null_count, null_percent)``: all columns in
    one aggregate, then turned into rows."""
    columns = list(columns) if columns is not None else attributes(df, by)
    types = dict(df.dtypes)
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(c).alias("name"), F.lit(types[c]).alias("type"),
                (F.col("total") - F.col(f"_n{i}")).alias("null_count"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(*by, "total", F.inline(rows)).withColumn(
        "null_percent", percent(F.col("null_count"), F.col("total"))
    )


def as_text(df: DataFrame, column: str) -> Column:
    """A value as it is counted: nested ones as JSON."""
    nested = dict(df.dtypes)[column].startswith(("array", "map", "struct"))
    value = F.col(f"`{column}`")
    return F.to_json(value) if nested else value.cast("string")


def value_counts(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``(by..., name, value, n)`` over all attribute columns, values as text."""
    columns = list(columns) if columns is not None else attributes(df, by)
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), as_text(df, c).alias("value")) for c in columns])
    return (
        df.select(*by, F.inline(pairs))
        .where("value IS NOT NULL")
        .groupBy(*by, "name", "value")
        .agg(F.count("*").alias("n"))
    )


def distinct_counts(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """``(by..., ord, name, distinct_count)``; NULL is not a value. ``approx`` trades
    the exact count for one pass of sketches."""
    columns = list(columns) if columns is not None else attributes(df, by)
    ordinal = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    if approx:
        counts = df.groupBy(*by).agg(
            *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(columns)]
        )
        rows = F.array(
            *[
                F.struct(F.lit(i).alias("ord"), F.lit(c).alias("name"), F.col(f"_n{i}").alias("distinct_count"))
                for i, c in enumerate(columns)
            ]
        )
        return counts.select(*by, F.inline(rows))
    counted = value_counts(df, by, columns).groupBy(*by, "name").agg(F.count("*").alias("distinct_count"))
    # A column that is NULL throughout has no value rows; it still counts as 0.
    all_columns = F.array(*[F.struct(F.lit(c).alias("name")) for c in columns])
    layers = df.groupBy(*by).agg(F.count("*").alias("_t")).select(*by, F.inline(all_columns))
    return (
        layers.join(counted, [*by, "name"], "left")
        .select(*by, ordinal[F.col("name")].alias("ord"), "name",
                F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count"))
    )


def top_values(
    df: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    k: int = TOP_VALUES,
    max_distinct: int = MAX_DISTINCT,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``(by..., name, rank, value, n)`` for columns with 1 to ``max_distinct``
    distinct values, ties in order of the value. The ranking only ever sees those
    columns, so a window holds at most ``max_distinct`` rows."""
    counts = value_counts(df, by, columns) if counts is None else counts
    listed = (
        counts.groupBy(*by, "name").agg(F.count("*").alias("_d")).where(F.col("_d") <= max_distinct)
    )
    window = Window.partitionBy(*by, "name").orderBy(F.desc("n"), F.asc("value"))
    return (
        counts.join(listed.select(*by, "name"), [*by, "name"], "left_semi")
        .withColumn("rank", F.row_number().over(window))
        .where(F.col("rank") <= k)
        .select(*by, "name", "rank", "value", "n")
    )


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of one column."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("value")).limit(k)


def first_non_null(df: DataFrame, column: str) -> DataFrame:
    """One row with some non-NULL value: the smallest, so that runs agree."""
    return df.agg(F.min(column).alias(column))


def temporal_bounds(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame | None:
    """Range and non-NULL count of a time column; None when there is no such column."""
    if column not in df.columns:
        return None
    return df.groupBy(*by).agg(
        F.lit(column).alias("column_name"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
        F.count(column).alias("non_null_count"),
        F.count("*").alias("feature_count"),
    )


def geometry_labels(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Kinds present, grouped by output class; kinds without a class are left out."""
    kinds = df.select(F.col(geom)["kind"].alias("kind")).distinct()
    return (
        kinds.withColumn("label", G.label_of_kind(F.col("kind")))
        .where("label IS NOT NULL")
        .groupBy("label")
        .agg(F.sort_array(F.collect_list("kind")).alias("kinds"))
    )


def column_report(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """``(by..., ord, name, type, null_count, null_percent, distinct_count)``."""
    counts = value_counts(df, by, columns) if counts is None else counts
    distinct = counts.groupBy(*by, "name").agg(F.count("*").alias("distinct_count"))
    # A column that is NULL throughout has no value rows; it still counts as 0.
    return null_stats(df, by, columns).join(distinct, [*by, "name"], "left").select(
        *by, "ord", "name", "type", "total", "null_count", "null_percent",
        F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias("distinct_count"),
    )


def stored_profile(
    df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, temporal: str | None = None,
    geom: str = "geom", power: int = SKETCH_POWER,
) -> DataFrame:
    """``(by..., total, xmin, ymin, xmax, ymax, first, last, columns)``, one row per layer
    from one aggregate; ``columns`` is ``array<(ord, name, type, filled, sketch)>``. The
    row's size does not depend on the number of features."""
    columns = list(columns) if columns is not None else attributes(df, by)
    types = dict(df.dtypes)
    time = F.col(temporal).cast("timestamp") if temporal is not None else F.lit(None).cast("timestamp")
    read = df.select(
        *by, G.extent(geom).alias("_b"), time.alias("_time"), *[as_text(df, c).alias(f"_v{i}") for i, c in enumerate(columns)]
    )
    measures = [
        F.count("*").alias("total"), F.min("_b.xmin").alias("xmin"), F.min("_b.ymin").alias("ymin"),
        F.max("_b.xmax").alias("xmax"), F.max("_b.ymax").alias("ymax"), F.min("_time").alias("first"), F.max("_time").alias("last"),
    ]
    for i in range(len(columns)):
        measures += [F.count(f"_v{i}").alias(f"_n{i}"), F.hll_sketch_agg(f"_v{i}", power).alias(f"_s{i}")]
    found = read.groupBy(*by).agg(*measures)
    listed = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(c).alias("name"), F.lit(types[c]).alias("type"),
                F.col(f"_n{i}").alias("filled"), F.col(f"_s{i}").alias("sketch"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return found.select(*by, "total", "xmin", "ymin", "xmax", "ymax", "first", "last", listed.alias("columns"))


def merged_profile(stored: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The profile of several layers taken together, from their stored profiles: ``table``
    has counts, extent and time range, ``columns`` the null shares and the estimated
    distinct counts. A layer without a column counts as NULL there."""
    table = stored.groupBy(*by).agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("feature_count"), F.count("*").alias("layers"), F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        F.min("first").alias("min_value"), F.max("last").alias("max_value"),
    )
    # Counts and sketches are merged per task before the shuffle.
    merged = stored.select(*by, F.inline("columns")).groupBy(*by, "name").agg(
        F.min("ord").alias("ord"), F.min("type").alias("type"), F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch", True)).alias("distinct_count"),
    )
    totals = table.select(*by, F.col("feature_count").alias("total"))
    columns = pair(merged, totals, by).withColumn("null_count", F.col("total") - F.col("filled"))
    columns = columns.withColumn("null_percent", percent(F.col("null_count"), F.col("total")))
    return {"table": table, "columns": columns.select(*by, "ord", "name", "type", "total", "null_count", "null_percent", "distinct_count")}


def _plain(number: Column) -> Column:
    return format_count(number)


def summary(kinds: DataFrame, columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., summary)``: one sentence per layer from ``geometry_types`` and
    ``column_report`` (or ``null_stats``) rows."""
    mix = kinds.groupBy(*by).agg(
        F.sum("n").alias("_n"),
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "kind", "n"))).alias("_kinds"),
    )
    sparse = F.col("null_percent") >= 50.0
    shares = columns.groupBy(*by).agg(
        F.count("*").alias("_cols"),
        F.sort_array(F.collect_list(F.when(sparse, F.struct("ord", "name")))).alias("_sparse"),
    )
    joined = pair(mix, shares, by)
    mix_text = F.array_join(
        F.transform("_kinds", lambda k: F.concat(_plain(k["n"]), F.lit(" "), F.coalesce(k["kind"], F.lit("None")))), ", "
    )
    names = F.array_join(F.transform("_sparse", lambda s: s["name"]), ", ")
    attrs = F.when(
        F.size("_sparse") > 0,
        F.concat(F.size("_sparse").cast("string"), F.lit(" of "), F.col("_cols").cast("string"),
                 F.lit(" columns are >=50% null ("), names, F.lit(")")),
    ).otherwise(F.concat(F.lit("all "), F.col("_cols").cast("string"), F.lit(" attribute columns have <50% null share")))
    text = F.concat(_plain(F.col("_n")), F.lit(" features. geometry types: "), mix_text, F.lit(". "), attrs, F.lit("."))
    return joined.select(
        *by, F.when(F.coalesce("_n", F.lit(0)) == 0, F.lit("Empty dataset.")).otherwise(text).alias("summary")
    )


def profile(df: DataFrame, by: Sequence[str] = (), temporal: str | None = None, geom: str = "geom") -> dict[str, DataFrame]:
    """All profile tables of the layers in ``df``. The values are counted once, and
    written, since distinct and top values both start from the counts."""
    counts = staged(value_counts(df, by))
    columns = column_report(df, by, counts=counts)
    kinds = geometry_types(df, by, geom)
    out = {
        "table": pair(row_count(df, by), extent(df, by, geom), by),
        "geometry": kinds,
        "columns": columns,
        "top_values": top_values(df, by, counts=counts),
        "summary": summary(kinds, columns, by),
    }
    if temporal is not None:
        bounds = temporal_bounds(df, temporal, by)
        if bounds is not None:
            out["temporal"] = bounds
    return out
