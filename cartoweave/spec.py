"""What a run asks for: categories with their filters, select lists and options."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from cartoweave.functions.text import slug_of

TagFilter = dict[str, Any]

# Order of the sources wherever several meet; others come last.
SOURCE_RANK = {"osm": 0, "overture": 1}
UNRANKED = 99


class CategorySkipped(RuntimeError):
    """Raised by a source for a category it does not serve."""


@dataclass(frozen=True)
class OsmBlock:
    enabled: bool = True
    select: tuple[str, ...] = ()
    where: tuple[str, ...] = ()
    filter: TagFilter = field(default_factory=dict)
    tiles: bool = True


@dataclass(frozen=True)
class OvertureBlock:
    enabled: bool = True
    theme: str = ""
    feature_type: str = ""
    select: tuple[str, ...] = ()
    where: tuple[str, ...] = ()
    tiles: bool = True


@dataclass(frozen=True)
class TransliterateRule:
    target: str
    source: str
    prefer: str | None = None


@dataclass(frozen=True)
class CategorySpec:
    name: str
    formats: tuple[str, ...] | None = None
    skip_pcodes: bool = False
    boundary_resolution: str | None = None
    title: str | None = None
    tags: tuple[str, ...] = ("geodata",)
    license: str = "hdx-odc-odbl"
    license_url: str | None = None
    osm: OsmBlock = field(default_factory=OsmBlock)
    overture: OvertureBlock = field(default_factory=OvertureBlock)
    transliterate: tuple[TransliterateRule, ...] = ()
    temporal_column: str | None = None

    @property
    def slug(self) -> str:
        return slug_of(self.name)


@dataclass(frozen=True)
class RunSpec:
    iso3: str = ""
    key: str = ""
    folder: str = ""
    prefix: str = ""
    formats: tuple[str, ...] = ("geojson", "kml")
    categories: tuple[CategorySpec, ...] = ()
    pcodes: bool = False
    pcode_levels: tuple[int, ...] = (1, 2, 3, 4)
    boundary_resolution: str = "geos"
    split_by_geometry: bool = False
    nest_by_category: bool = True
    nest_by_geometry: bool = False
    name_include_source: bool = True
    resume: bool = True
    tiles: bool = False
    min_zoom: int = 0
    max_zoom: int = 12

    @property
    def identity(self) -> str:
        """Lower-case ISO3, else the folder id."""
        ident = self.iso3.lower() or self.folder
        if not ident:
            raise ValueError("iso3 or folder is required")
        return ident


def select_category(run: RunSpec, theme: str | None) -> RunSpec:
    """The run restricted to the one category named ``theme``."""
    if theme is None:
        return run
    kept = tuple(c for c in run.categories if c.slug == slug_of(theme))
    if not kept:
        available = ", ".join(c.name for c in run.categories) or "<none>"
        raise ValueError(f"theme {theme!r} not found. Available: {available}")
    return replace(run, categories=kept)
