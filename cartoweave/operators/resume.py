"""What the next run may skip, and the facts a finished run leaves behind."""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions.text import format_count


STATE_SCHEMA = (
    "iso3 string, source string, slug string, snapshot string, built_utc timestamp, uploaded_utc timestamp, "
    "artifact_present boolean, path string, features bigint, config string, formats array<string>"
)


def record_state(spark: SparkSession, path: str, entries: list[dict]) -> None:
    """Appends the run's entries, one per category at most, to the manifest."""
    if entries:
        names = [f.split()[0] for f in STATE_SCHEMA.split(", ")]
        rows = [tuple(e.get(n) for n in names) for e in entries]
        spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, empty where no run has left one yet."""
    try:
        spark.read.text(path)
    except AnalysisException:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).json(path)


def latest_state(manifest: DataFrame) -> DataFrame:
    """The newest entry per (iso3, source, slug) of an append-only manifest."""
    more = [c for c in ("config", "formats") if c in manifest.columns]
    entry = F.struct("built_utc", "uploaded_utc", "snapshot", "artifact_present", *more)
    return (
        manifest.groupBy("iso3", "source", "slug")
        .agg(F.max(entry).alias("e"))
        .select("iso3", "source", "slug", "e.*")
    )


def pending(specs: DataFrame, manifest: DataFrame, done: str = "uploaded") -> DataFrame:
    """Categories still to do for their snapshot. ``uploaded`` needs an upload stamp;
    ``built`` needs a build stamp and the artifact still in place. A build of another
    snapshot does not count."""
    state = latest_state(manifest)
    if done == "uploaded":
        finished = state.where("uploaded_utc IS NOT NULL")
    elif done == "built":
        finished = state.where("built_utc IS NOT NULL AND artifact_present")
    else:
        raise ValueError(f"done must be 'uploaded' or 'built', got {done!r}")
    keys = ["iso3", "source", "slug", "snapshot"]
    # A category built with other settings does not count either, where both sides tell.
    keys += [c for c in ("config",) if c in specs.columns and c in finished.columns]
    return specs.join(finished.select(*keys), keys, "left_anti")


def config_key(*settings) -> str:
    """First 12 hex digits of the SHA-256 of the settings that shape a category's layer."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:12]


def stale_levels(remote: DataFrame, local: DataFrame, group: str, levels) -> DataFrame:
    """Admin levels whose local copy is missing or of another date than upstream.
    A requested level that upstream lacks, or lists without a date, is an error."""
    wanted = remote.sparkSession.createDataFrame([(int(n),) for n in levels], "level int")
    upstream = remote.where(F.col("grp") == group).groupBy(F.col("adm").cast("int").alias("level")).agg(
        F.max("date").alias("upstream_date")
    )
    problem = F.concat(F.lit(f"no dated entry for group {group} level "), F.col("level").cast("string"))
    dated = wanted.join(upstream, "level", "left").withColumn(
        "upstream_date",
        F.when(F.coalesce("upstream_date", F.lit("")) != "", F.col("upstream_date")).otherwise(
            F.raise_error(problem).cast("string")
        ),
    )
    here = local.select(F.col("level").cast("int").alias("level"), F.col("date").alias("local_date"))
    return dated.join(here, "level", "left").where("NOT (local_date <=> upstream_date)")


def status_counts(results: DataFrame, by=()) -> DataFrame:
    return results.groupBy(*by).agg(
        *[
            F.count_if(F.col("status") == s).alias(name)
            for s, name in (("ok", "succeeded"), ("failed", "failed"), ("skipped", "skipped"), ("empty", "empty"))
        ],
        F.count("*").alias("total"),
    )


def fingerprint(clip: Column, tag_filter: Column) -> Column:
    """First 12 hex digits of the SHA-256 of the settings that shape a cached
    extract: the clip settings (``noclip`` when not clipped) and the union filter."""
    payload = F.to_json(F.struct(F.coalesce(clip, F.lit("noclip")).alias("clip"), tag_filter.alias("filter")))
    return F.substring(F.sha2(payload, 256), 1, 12)


def release_date(release: Column) -> Column:
    return F.to_date(F.split_part(release, F.lit("."), F.lit(1)))


def snapshot_date(manifest_value: Column, label: Column, now: Column | None = None) -> Column:
    """The manifest's snapshot, else the label, else now, as a UTC timestamp."""
    return F.coalesce(
        F.try_to_timestamp(manifest_value), F.try_to_timestamp(label), now if now is not None else F.current_timestamp()
    )


def dataset_license(specs: DataFrame, by=()) -> DataFrame:
    """The one license all categories share: the open database licence keeps its id,
    any other is named as text; several are left to the layers."""
    ids = specs.select(*by, "license").distinct().groupBy(*by).agg(
        F.count("*").alias("_n"), F.min("license").alias("_l")
    )
    shared = F.col("_n") == 1
    # License ids and wording of the catalogue.
    is_open = shared & (F.col("_l") == "hdx-odc-odbl")
    return ids.select(
        *by,
        F.when(is_open, F.lit("hdx-odc-odbl")).otherwise(F.lit("hdx-other")).alias("license_id"),
        F.when(is_open, F.lit(None).cast("string"))
        .when(shared, F.col("_l"))
        .otherwise(F.lit("Layers carry individual licences; see each layer's metadata."))
        .alias("license_other"),
    )


def dataset_tags(tagged: DataFrame, by=()) -> DataFrame:
    """Dataset tags, then category tags in configuration order, first occurrence
    kept. ``tagged``: (by..., ord, tags) with ord -1 for the dataset's own."""
    seen = tagged.select(*by, "ord", F.posexplode("tags").alias("pos", "tag"))
    first = seen.groupBy(*by, "tag").agg(F.min(F.struct("ord", "pos")).alias("at"))
    return first.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("at", "tag"))).alias("t")).select(
        *by, F.transform("t", lambda e: e["tag"]).alias("tags")
    )


def dataset_period(lo: Column, hi: Column, snapshot: Column) -> Column:
    """The time bounds when both are known, else the snapshot's day."""
    both = lo.isNotNull() & hi.isNotNull()
    return F.struct(
        F.when(both, lo).otherwise(snapshot).alias("start"), F.when(both, hi).otherwise(snapshot).alias("end")
    )


def export_manifest(results: DataFrame) -> DataFrame:
    """One descriptor per artifact: the facts of a run's README as columns.

    ``results``: (iso3, boundary, xmin, ymin, xmax, ymax, category, format,
    feature_count, source, snapshot, license, license_url).
    """

    def four(c: str) -> Column:
        return F.format_string("%.4f", F.col(c))

    return results.select(
        F.upper("iso3").alias("iso3"),
        "boundary",
        F.concat(F.lit("("), F.concat_ws(", ", four("xmin"), four("ymin"), four("xmax"), four("ymax")), F.lit(")")).alias("bbox"),
        F.col("category").alias("dataset"),
        "format",
        format_count("feature_count").alias("features"),
        "source",
        "snapshot",
        "license",
        F.coalesce("license_url", F.lit("(not specified)")).alias("license_url"),
    )
