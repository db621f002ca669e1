"""The tables behind a layer report, computed from profile tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.functions.text import format_count, source_label
from cartoweave.operators.profile import pair
from cartoweave.spec import SOURCE_RANK, UNRANKED

# Coverage from which a column counts as well or partly populated.
WELL_PERCENT = 50.0
PARTIAL_PERCENT = 25.0

# Layer colours, used in this order and cycled.
PALETTE = (
    "#e6194B", "#3cb44b", "#f58231", "#4363d8", "#911eb4",
    "#008080", "#f032e6", "#9A6324", "#800000", "#808000",
    "#000075", "#e6194B", "#46f0f0", "#bcf60c", "#fabebe",
    "#aaffc3", "#ffd8b1", "#808080", "#ffe119", "#e6beff",
)

PCODE = r"^adm(.*)_pcode$"
NAME_LANGUAGE = r"^name_([a-z]{2,3})$"


def coverage_bucket(coverage: Column) -> Column:
    return (
        F.when(coverage >= WELL_PERCENT, "well").when(coverage >= PARTIAL_PERCENT, "partial").otherwise("rare")
    )


def _text(number: Column) -> Column:
    return number.cast("string")


def quality(columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Columns per coverage bucket with a caption, one row per layer."""
    bucket = coverage_bucket(100.0 - F.col("null_percent"))
    counted = columns.groupBy(*by).agg(
        F.count_if(bucket == "well").alias("well"),
        F.count_if(bucket == "partial").alias("partial"),
        F.count_if(bucket == "rare").alias("rare"),
        F.count("*").alias("total_columns"),
    )
    total, well = F.col("total_columns"), F.col("well")
    # Wording of the caption.
    tail = F.lit(" attribute columns are well-populated.")
    caption = (
        F.when(total == 0, F.lit("No attribute columns."))
        .when(well == total, F.concat(F.lit("All "), _text(total), tail))
        .when(well == 0, F.concat(F.lit("None of the "), _text(total), tail))
        .otherwise(F.concat(_text(well), F.lit(" of "), _text(total), tail))
    )
    return counted.withColumn("caption", caption)


def named_percent(columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of features with a name; NULL for a layer without such a column."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 - F.col("null_percent")))
    return columns.groupBy(*by).agg(F.max(F.when(F.col("name") == "name", share)).alias("named_percent"))


def geometry_share(kinds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return kinds.withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(whole), 2))


def source_mix(top: DataFrame, counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of the top ``source`` values, where there is more than one.
    ``counts`` holds the feature count per layer."""
    rows = top.where("name = 'source'")
    several = Window.partitionBy(*by) if by else Window.partitionBy("name")
    rows = rows.withColumn("_k", F.count("*").over(several)).where("_k > 1").drop("_k")
    rows = pair(rows, counts, by)
    return rows.select(
        *by, "rank", "value", "n", F.round(100.0 * F.col("n") / F.greatest("feature_count", F.lit(1)), 2).alias("share")
    )


def admin_coverage(columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return columns.where(F.col("name").rlike(PCODE)).select(
        *by, "name",
        (F.col("total") - F.col("null_count")).alias("tagged"),
        (100.0 - F.col("null_percent")).alias("coverage"),
    )


def deepest_admin(columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Coverage of the deepest level that has any code; ``off`` without one."""
    populated = F.when(
        F.col("name").rlike(PCODE) & (F.col("null_percent") < 100.0), F.struct("name", "null_percent")
    )
    best = columns.groupBy(*by).agg(F.max(populated).alias("best"))
    return best.select(
        *by,
        F.coalesce(F.regexp_extract("best.name", PCODE, 1), F.lit("off")).alias("level"),
        (100.0 - F.col("best.null_percent")).alias("coverage"),
    )


def languages(columns: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The languages names come in, in column order: ``name`` is local and
    ``name_xx`` is that language."""
    code = F.nullif(F.regexp_extract("name", NAME_LANGUAGE, 1), F.lit(""))
    label = F.when(F.col("name") == "name", F.lit("local")).otherwise(code)
    listed = columns.select(*by, "ord", label.alias("label"))
    kept = F.sort_array(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("ord", "label"))))
    return listed.groupBy(*by).agg(kept.alias("l")).select(
        *by, F.size("l").cast("bigint").alias("n_languages"),
        F.coalesce(F.nullif(F.array_join(F.transform("l", lambda e: e["label"]), ", "), F.lit("")), F.lit("none")).alias("languages"),
    )


def temporal_share(bounds: DataFrame) -> DataFrame:
    """Adds the share of features that carry the time column, in percent."""
    share = F.when(
        F.col("feature_count") > 0, F.round(100.0 * F.col("non_null_count") / F.col("feature_count"), 1)
    ).otherwise(F.lit(0.0))
    return bounds.withColumn("coverage", share)


# Column types shown as numeric in the attribute table.
NUMERIC_TYPES = r"^(tinyint|smallint|int|bigint|float|double|decimal)"


def attribute_table(columns: DataFrame, top: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    keys = [*by, "name"]
    lists = top.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "value", "n"))).alias("t"))
    shown = F.array_join(
        F.transform("t", lambda e: F.concat(e["value"], F.lit(" "), format_count(e["n"]))), " · "
    )
    coverage = F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 - F.col("null_percent")))
    return columns.join(lists, keys, "left").select(
        *by, "ord", "name", "type", F.round(coverage, 2).alias("coverage"), "distinct_count",
        F.when(F.col("t").isNotNull(), shown)
        .when(F.col("distinct_count") == 0, F.lit("all null"))
        .when(F.lower("type").rlike(NUMERIC_TYPES), F.lit("numeric"))
        .otherwise(F.lit("n/a")).alias("top_values"),
    )


def sorted_kinds(kinds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., kinds)``: kind and count structs, most frequent first."""
    items = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "kind", "n")))
    return kinds.groupBy(*by).agg(items.alias("kinds"))


def geometry_kpi(kinds: Column) -> Column:
    one = kinds[0]["kind"]
    return (
        F.when(F.size(kinds) == 0, F.lit("n/a"))
        .when(F.size(kinds) == 1, F.concat(F.initcap(one), F.lit("s")))
        .otherwise(F.lit("mixed"))
    )


def geometry_phrase(kinds: Column) -> Column:
    """``Point 1,234, Polygon 5``, most frequent first."""
    text = F.array_join(
        F.transform(kinds, lambda k: F.concat(F.initcap(k["kind"]), F.lit(" "), format_count(k["n"]))), ", "
    )
    return F.when(F.size(kinds) == 0, F.lit("n/a")).otherwise(text)


def source_rank(source: Column) -> Column:
    rank = F.lit(UNRANKED)
    for name, value in SOURCE_RANK.items():
        rank = F.when(source == name, F.lit(value)).otherwise(rank)
    return rank


def match_key(category: Column, source: Column) -> Column:
    return F.concat_ws("|", category, source)


def layer_label(label: Column, source: Column) -> Column:
    return F.concat(label, F.lit(" ("), source_label(source), F.lit(")"))


def source_panels(layers: DataFrame, specs: DataFrame) -> DataFrame:
    """``layers``: (slug, source, ...), ``specs``: (slug, ord, label). One row per
    category of the configuration, its sources in rank order."""
    known = layers.join(specs, "slug")
    rank = source_rank(F.col("source"))
    return (
        known.select("slug", "ord", "label", rank.alias("r"), "source").distinct()
        .groupBy("slug", "ord", "label")
        .agg(F.sort_array(F.collect_list(F.struct("r", "source"))).alias("s"))
        .select("slug", "ord", "label", F.transform("s", lambda e: e["source"]).alias("sources"))
    )


def order_layers(layers: DataFrame, specs: DataFrame) -> DataFrame:
    """Layers by source rank, then configuration order, unknown categories last."""
    last = F.lit(2**31 - 1)
    return (
        layers.join(specs.select("slug", "ord"), "slug", "left")
        .withColumn("rank", source_rank(F.col("source")))
        .orderBy("rank", F.coalesce("ord", last), "slug")
    )


def landing_rows(
    layers: DataFrame, columns: DataFrame, kinds: DataFrame, palette: Sequence[str] = PALETTE
) -> DataFrame:
    """One row per (category, source). ``layers``: (slug, source, ord, label, license,
    feature_count); ``columns`` and ``kinds`` are profile tables by (slug, source).
    Colours follow the display order and start over when they run out."""
    by = ["slug", "source"]
    ordered = Window.orderBy("ord", "rank")
    colours = F.array(*[F.lit(c) for c in palette])
    rows = (
        layers.withColumn("rank", source_rank(F.col("source")))
        .withColumn("position", F.row_number().over(ordered) - 1)
        .withColumn("colour", F.element_at(colours, (F.pmod(F.col("position"), F.lit(len(palette))) + 1).cast("int")))
    )
    return (
        rows.join(quality(columns, by), by, "left")
        .join(named_percent(columns, by), by, "left")
        .join(sorted_kinds(kinds, by), by, "left")
        .select(
            *by, "position", "colour", layer_label(F.col("label"), F.col("source")).alias("label"),
            F.coalesce("license", F.lit("n/a")).alias("license"),
            format_count("feature_count").alias("features"),
            F.coalesce(F.concat(F.bround("named_percent", 0).cast("bigint").cast("string"), F.lit("%")), F.lit("n/a")).alias("named"),
            F.concat_ws("/", F.col("well").cast("string"), F.col("total_columns").cast("string")).alias("populated"),
            geometry_phrase(F.coalesce("kinds", F.array())).alias("geometry"),
        )
    )


def overall_bounds(boxes: DataFrame, boundary: tuple | None = None) -> DataFrame:
    """The export boundary's box, else the union of the layer extents."""
    union = boxes.agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax")
    )
    if boundary is None:
        return union
    names = ("xmin", "ymin", "xmax", "ymax")
    return union.select(*[F.lit(float(v)).alias(n) for n, v in zip(names, boundary)])


def default_source(layers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The most recently generated source, ties to the first by name."""
    latest = layers.groupBy(*by, "source").agg(F.max("generated_utc").alias("generated_utc"))
    newest = Window.partitionBy(*by).orderBy(F.desc("generated_utc"), F.asc("source"))
    return latest.withColumn("_r", F.row_number().over(newest)).where("_r = 1").drop("_r")


def combined_period(layers: DataFrame, lo: str = "min_value", hi: str = "max_value") -> DataFrame:
    """Earliest start and latest end over the layers; text that is no timestamp is
    ignored, text without a zone is UTC."""
    return layers.agg(
        F.min(F.try_to_timestamp(lo)).alias("period_start"), F.max(F.try_to_timestamp(hi)).alias("period_end")
    )
