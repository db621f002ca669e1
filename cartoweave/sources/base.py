"""What a source hands to a run: a table, how to filter it, where it came from."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from cartoweave.operators.filters import inject_local_names, tag_predicate
from cartoweave.sources import scans
from cartoweave.spec import CategorySkipped, CategorySpec, RunSpec


@dataclass(frozen=True)
class SourceQuery:
    table: DataFrame
    select: list[str]
    where: list[str]
    box: str | None
    dataset_source: str
    snapshot: str
    id_col: str
    extra: dict = field(default_factory=dict)


class Source(Protocol):
    name: str

    def prepare(self, run: RunSpec) -> None: ...

    def query_for(self, run: RunSpec, category: CategorySpec) -> SourceQuery: ...

    def peek_snapshot(self, run: RunSpec) -> str | None:
        """The snapshot a run would use, if it can be told without reading data."""
        ...


class ReleaseSource:
    """Hive-partitioned releases: ``root/<release>/theme=../type=../*``."""

    name = "overture"

    def __init__(self, spark: SparkSession, root: str, release: str):
        self.spark, self.root, self.release = spark, root, release

    def prepare(self, run: RunSpec) -> None:
        return None

    def peek_snapshot(self, run: RunSpec) -> str | None:
        return self.release

    def query_for(self, run: RunSpec, category: CategorySpec) -> SourceQuery:
        block = category.overture
        if not block.enabled:
            raise CategorySkipped(f"{category.name}: overture disabled for category")
        if not block.theme or not block.feature_type:
            raise CategorySkipped(f"{category.name}: overture theme or feature type missing")
        table = scans.scan_release(self.spark, self.root, self.release, block.theme, block.feature_type)
        return SourceQuery(
            table, list(block.select), list(block.where), "bbox", f"OvertureMap {self.release}", self.release, "id"
        )


class ExtractSource:
    """A cached extract ``(feature_id, tags, geometry[, bbox])`` of one snapshot."""

    name = "osm"

    def __init__(self, spark: SparkSession, table: DataFrame, snapshot: str, dataset_source: str = "OpenStreetMap"):
        self.spark, self.table, self.snapshot, self.dataset_source = spark, scans.ensure_tags(table), snapshot, dataset_source

    def prepare(self, run: RunSpec) -> None:
        return None

    def peek_snapshot(self, run: RunSpec) -> str | None:
        return self.snapshot

    def query_for(self, run: RunSpec, category: CategorySpec) -> SourceQuery:
        if not category.osm.enabled:
            raise CategorySkipped(f"{category.name}: osm disabled for category")
        languages = scans.languages_of(run.iso3)
        select = inject_local_names(category.osm.select, languages)
        table = self.table.where(tag_predicate(category.osm.filter))
        box = "bbox" if scans.has_column(self.table, "bbox") else None
        return SourceQuery(
            table, select, list(category.osm.where), box, self.dataset_source, self.snapshot, "feature_id"
        )
