"""A square lon/lat grid in column arithmetic: cells, rings, web-map tiles."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# About 2.3 km and 5.4 square km at the equator.
DEFAULT_STEP = 1.0 / 48.0

# Fixed value: sphere radius of EPSG:3857, in metres.
EARTH_RADIUS = 6378137.0


@dataclass(frozen=True)
class Grid:
    """Square cells over a plane; cells are numbered row by row from the lower left."""

    step: float
    x0: float
    y0: float
    width: float
    height: float

    @property
    def n_cols(self) -> int:
        return int(math.ceil(self.width / self.step - 1e-9))

    @property
    def n_rows(self) -> int:
        return int(math.ceil(self.height / self.step - 1e-9))

    def col(self, x: Column) -> Column:
        raw = F.floor((x - F.lit(self.x0)) / F.lit(self.step)).cast("bigint")
        return F.greatest(F.lit(0), F.least(raw, F.lit(self.n_cols - 1))).cast("bigint")

    def row(self, y: Column) -> Column:
        raw = F.floor((y - F.lit(self.y0)) / F.lit(self.step)).cast("bigint")
        return F.greatest(F.lit(0), F.least(raw, F.lit(self.n_rows - 1))).cast("bigint")

    def cell_of(self, row: Column, col: Column) -> Column:
        return (row * F.lit(self.n_cols) + col).cast("bigint")

    def cell(self, x: Column, y: Column) -> Column:
        return self.cell_of(self.row(y), self.col(x))

    def row_of(self, cell: Column) -> Column:
        return F.floor(cell / F.lit(self.n_cols)).cast("bigint")

    def col_of(self, cell: Column) -> Column:
        return (cell % F.lit(self.n_cols)).cast("bigint")

    def centre_x(self, col: Column) -> Column:
        return (col.cast("double") + F.lit(0.5)) * F.lit(self.step) + F.lit(self.x0)

    def centre_y(self, row: Column) -> Column:
        return (row.cast("double") + F.lit(0.5)) * F.lit(self.step) + F.lit(self.y0)

    def right_x(self, col: Column) -> Column:
        return (col.cast("double") + F.lit(1.0)) * F.lit(self.step) + F.lit(self.x0)

    def ring(self, cell: Column) -> Column:
        """The cell and its neighbours: columns wrap round the globe, rows stop
        at the poles."""
        row, col = self.row_of(cell), self.col_of(cell)
        cells = F.array(
            *[
                F.when(
                    (row + dr >= 0) & (row + dr < self.n_rows),
                    self.cell_of(row + dr, F.pmod(col + dc, F.lit(self.n_cols))),
                )
                for dr in (-1, 0, 1)
                for dc in (-1, 0, 1)
            ]
        )
        return F.array_distinct(F.array_compact(cells))


def lonlat(step: float = DEFAULT_STEP) -> Grid:
    return Grid(step, -180.0, -90.0, 360.0, 180.0)


def metres(step: float) -> Grid:
    """A grid over the EPSG:3857 plane up to 89.9 degrees of latitude and beyond."""
    half = 5.0e7
    return Grid(step, -half, -half, 2 * half, 2 * half)


def mercator_x(x: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(x)


def mercator_y(y: Column) -> Column:
    return F.lit(EARTH_RADIUS) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(y) / 2))


def lon_of(mx: Column) -> Column:
    return F.degrees(mx / F.lit(EARTH_RADIUS))


def lat_of(my: Column) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(my / F.lit(EARTH_RADIUS))) - F.lit(math.pi / 2))


# Fixed value: latitude where the square Web-Mercator world ends.
MERCATOR_MAX_LAT = 85.0511287798066


def tile_x(x: Column, zoom: Column) -> Column:
    n = F.pow(F.lit(2.0), zoom)
    raw = F.floor((x + F.lit(180.0)) / F.lit(360.0) * n)
    return F.greatest(F.lit(0.0), F.least(raw, n - 1)).cast("bigint")


def tile_y(y: Column, zoom: Column) -> Column:
    n = F.pow(F.lit(2.0), zoom)
    lat = F.greatest(F.lit(-MERCATOR_MAX_LAT), F.least(F.lit(MERCATOR_MAX_LAT), y))
    r = F.radians(lat)
    raw = F.floor(
        (F.lit(1.0) - F.log(F.tan(r) + F.lit(1.0) / F.cos(r)) / F.lit(math.pi)) / F.lit(2.0) * n
    )
    return F.greatest(F.lit(0.0), F.least(raw, n - 1)).cast("bigint")
