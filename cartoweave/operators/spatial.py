"""Spatial predicates as equi-joins on grid cells.

A polygon set is turned once into a cell index: for every cell a polygon touches,
whether the cell centre lies inside and which edges pass through the cell. The
ray-crossing parity of any point in the cell then follows from that one row:
walking from the centre to the point, only the listed edges can change it. So a
point meets its polygon through one join on the cell number, with no aggregation
afterwards, however many edges the polygon has elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions.grid import DEFAULT_STEP, Grid, lat_of, lonlat, lon_of, mercator_x, mercator_y, metres
from cartoweave.session import measured, measured_with

# Most edges one index row carries, and most that a cell holds of all polygons before it
# is cut into finer ones. A fine cell holding more of one polygon is spread over several
# rows, whose parities are added up per point.
EDGES_PER_ROW = 512

# Fine rows may exceed the edges they come from by this factor each way.
FINE_GROWTH = 8.0

# Slack around cells when edges are assigned to them, in units of the plane.
PAD = 1e-9


def polygon_edges(polys: DataFrame, keys: Sequence[str], geom: str = "geom") -> DataFrame:
    return (
        polys.select(*keys, F.explode(G.edges(geom)).alias("e"))
        .select(*keys, "e.x1", "e.y1", "e.x2", "e.y2")
        .where("x1 <> x2 OR y1 <> y2")
    )


def cover_runs(edges: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Scanline fill: per polygon and grid row, the spans whose cell centres are
    inside. Edges cross row centres at sorted x positions; consecutive pairs bound
    the inside, which takes care of holes and multiple parts alike."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    crossings = (
        edges.select(
            *keys, "x1", "y1", "x2", "y2",
            F.explode(F.sequence(grid.row(lo), grid.row(hi))).alias("row"),
        )
        .withColumn("yc", grid.centre_y(F.col("row")))
        .where("(y1 > yc) <> (y2 > yc)")
        .select(*keys, "row", F.expr("(x2 - x1) * (yc - y1) / (y2 - y1) + x1").alias("xc"))
    )
    per_row = Window.partitionBy(*keys, "row").orderBy("xc")
    return (
        crossings.withColumn("n", F.row_number().over(per_row))
        .withColumn("xn", F.lead("xc").over(per_row))
        .where("n % 2 = 1 AND xn IS NOT NULL")
        .select(*keys, "row", F.col("xc").alias("xa"), F.col("xn").alias("xb"))
    )


def cell_cover(
    polys: DataFrame, keys: Sequence[str], step: float = DEFAULT_STEP, geom: str = "geom"
) -> DataFrame:
    """``(keys..., cell)``: the cells whose centre the polygon contains."""
    grid = lonlat(step)
    return _cover(polygon_edges(polys, keys, geom), keys, grid).select(*keys, "cell")


def _cover(edges: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    runs = cover_runs(edges, keys, grid)
    cols = F.sequence(grid.col(F.col("xa")), grid.col(F.col("xb")))
    return (
        runs.select(*keys, "row", "xa", "xb", F.explode(cols).alias("col"))
        .withColumn("xm", grid.centre_x(F.col("col")))
        .where("xm >= xa AND xm < xb")
        .select(*keys, grid.cell_of(F.col("row"), F.col("col")).alias("cell"))
    )


def edge_cells(edges: DataFrame, grid: Grid, pad: float = PAD) -> DataFrame:
    """Adds ``cell``: one row per cell the edge passes through or comes within
    ``pad`` of. A steep edge is cut row by row, so the cost follows its length."""
    rows = F.sequence(
        grid.row(F.least("y1", "y2") - F.lit(pad)), grid.row(F.greatest("y1", "y2") + F.lit(pad))
    )
    cut = edges.withColumn("_row", F.explode(rows))
    row_lo = grid.centre_y(F.col("_row")) - F.lit(grid.step / 2 + pad)
    row_hi = grid.centre_y(F.col("_row")) + F.lit(grid.step / 2 + pad)

    def x_at(y: Column) -> Column:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1"))))
        return F.col("x1") + t * (F.col("x2") - F.col("x1"))

    flat = F.col("y1") == F.col("y2")
    xa = F.when(flat, F.col("x1")).otherwise(x_at(row_lo))
    xb = F.when(flat, F.col("x2")).otherwise(x_at(row_hi))
    cols = F.sequence(
        grid.col(F.least(xa, xb) - F.lit(pad)), grid.col(F.greatest(xa, xb) + F.lit(pad))
    )
    return (
        cut.withColumn("_col", F.explode(cols))
        .withColumn("cell", grid.cell_of(F.col("_row"), F.col("_col")))
        .drop("_row", "_col")
    )


def _flips(e: Column, x: Column, y: Column, right: Column) -> Column:
    """1 when edge ``e`` counts at (x, y), relative to the cell's right side.

    The ray from the point crosses the edge, or, for an edge that runs out through
    the right side, its outer end lies above the ray: what happens to the outline
    beyond the cell is settled by where it leaves.
    """
    hit = G.ray_hits(e, x, y)
    leaves = (e["x1"] > right) != (e["x2"] > right)
    outer_above = F.when(e["x1"] > right, e["y1"] > y).otherwise(e["y2"] > y)
    return (hit != (leaves & outer_above)).cast("int")


def _flip_count(edges: Column, x: Column, y: Column, right: Column) -> Column:
    return F.coalesce(
        F.aggregate(edges, F.lit(0), lambda n, e: n + _flips(e, x, y, right)), F.lit(0)
    )


@dataclass(frozen=True)
class FineCells:
    """Cells crowded with edges, cut into ``nx`` by ``ny`` finer ones.

    ``cells``: (cell, nx, ny). ``rows``: (keys..., cell, sub, right, base, edges), where
    ``sub`` numbers the fine cells of a cell row by row and ``right`` is the side the
    parity is told from. A polygon with very many edges in a fine cell has several rows.
    """

    cells: DataFrame
    rows: DataFrame


@dataclass(frozen=True)
class CellIndex:
    """``rows``: (keys..., cell, fine, owned, base, n_edges, edges).

    ``owned`` says the cell centre is inside. ``base`` is the parity before the
    listed edges are counted. ``edges`` is NULL where no edge touches the cell, and in
    cells that are ``fine``: more edges than one row carries touch them, and what lies
    there is told by ``crowded``, which is None if there is no such cell.
    """

    grid: Grid
    keys: tuple[str, ...]
    rows: DataFrame
    crowded: FineCells | None

    def release(self) -> None:
        self.rows.unpersist()
        if self.crowded:
            self.crowded.rows.unpersist()
            self.crowded.cells.unpersist()

    def parity(self, x: Column, y: Column, edges: Column | None = None, base: Column | None = None, right: Column | None = None):
        edges = F.col("edges") if edges is None else edges
        base = F.col("base") if base is None else base
        right = self.grid.right_x(self.grid.col(x)) + F.lit(PAD) if right is None else right
        return (base + _flip_count(edges, x, y, right)) % 2


def build_index(
    polys: DataFrame,
    keys: Sequence[str],
    step: float = DEFAULT_STEP,
    geom: str = "geom",
    edges_per_row: int = EDGES_PER_ROW,
) -> CellIndex:
    grid = lonlat(step)
    edges = polygon_edges(polys, keys, geom)
    inside = _cover(edges, keys, grid)
    border = edge_cells(edges, grid)
    # Cells crowded with edges are few; only those are cut.
    crowded = _crowded_cells(border, keys, grid, edges_per_row)
    edge = F.struct("x1", "y1", "x2", "y2")
    row, col = grid.row_of(F.col("cell")), grid.col_of(F.col("cell"))
    at_centre = _flips(F.col("edge"), grid.centre_x(col), grid.centre_y(row), grid.right_x(col) + F.lit(PAD))
    touched = border.select(*keys, "cell", F.lit(0).alias("inside"), edge.alias("edge"))
    touched = touched.withColumn("flips", at_centre).unionByName(
        inside.select(
            *keys, "cell", F.lit(1).alias("inside"), F.lit(None).cast(G.EDGE_TYPE).alias("edge"), F.lit(0).alias("flips")
        )
    )
    rows = (
        touched.join(crowded.select("cell", F.lit(True).alias("fine")), "cell", "left")
        .withColumn("listed", F.when(F.col("fine").isNull(), F.col("edge")))
        .groupBy(*keys, "cell")
        .agg(
            F.max("inside").alias("inside"),
            F.sum("flips").alias("flips"),
            F.count("edge").alias("n_edges"),
            F.coalesce(F.max("fine"), F.lit(False)).alias("fine"),
            F.collect_list("listed").alias("edges"),
        )
        .withColumn("edges", F.expr("nullif(edges, cast(array() as array<" + G.EDGE_TYPE + ">))"))
        .select(
            *keys, "cell", "fine",
            (F.col("inside") == 1).alias("owned"),
            ((F.col("inside") + F.col("flips")) % 2).cast("int").alias("base"),
            "n_edges", "edges",
        )
    )
    kept, facts = measured_with(rows, F.max("fine").alias("fine"))
    fine = _fine_cells(border, kept, crowded, keys, grid, edges_per_row) if facts["fine"] else None
    return CellIndex(grid, tuple(keys), kept, fine)


def _crowded_cells(border: DataFrame, keys: Sequence[str], grid: Grid, edges_per_row: int) -> DataFrame:
    """``(cell, nx, ny)`` of cells with more edges than one row carries. Fine cells hold
    about a quarter of that; they are narrow where edges are steep and flat where edges
    are, fewer where polygons overlap, and never so small that an edge passes many."""
    row, col = grid.row_of(F.col("cell")), grid.col_of(F.col("cell"))

    def share(lo: Column, hi: Column, centre: Column) -> Column:
        half = F.lit(grid.step / 2)
        return F.greatest(F.lit(0.0), F.least(hi, centre + half) - F.greatest(lo, centre - half)) / F.lit(grid.step)

    wide = share(F.least("x1", "x2"), F.greatest("x1", "x2"), grid.centre_x(col))
    high = share(F.least("y1", "y2"), F.greatest("y1", "y2"), grid.centre_y(row))
    per_polygon = border.groupBy(*keys, "cell").agg(F.count("*").alias("n"), F.sum(wide).alias("w"), F.sum(high).alias("h"))
    cells = per_polygon.groupBy("cell").agg(
        F.sum("n").alias("n"), F.count("*").alias("p"), (F.sum("w") / F.sum("n")).alias("w"), (F.sum("h") / F.sum("n")).alias("h")
    )
    wanted = F.greatest(F.lit(1.0), F.least(F.col("n") / max(edges_per_row / 4, 1.0), 4 * F.col("n") / F.col("p")))
    most = lambda share: F.greatest(F.lit(1.0), F.when(F.col(share) > 0, FINE_GROWTH / F.col(share)).otherwise(wanted))
    even = F.when(F.col("h") > 0, F.sqrt(wanted * F.col("w") / F.col("h"))).otherwise(wanted)
    ny = F.floor(F.greatest(F.lit(1.0), F.least(even, wanted, most("h"))))
    nx = F.greatest(F.lit(1), F.floor(F.least(F.ceil(wanted / F.col("ny")), most("w"))))
    return cells.where(F.col("n") > edges_per_row).withColumn("ny", ny.cast("bigint")).select("cell", nx.cast("bigint").alias("nx"), "ny")


class _Fine:
    """Column arithmetic of fine cells, from ``cell``, ``nx`` and ``ny`` of a row."""

    def __init__(self, grid: Grid):
        half = F.lit(grid.step / 2)
        self.left = grid.centre_x(grid.col_of(F.col("cell"))) - half
        self.low = grid.centre_y(grid.row_of(F.col("cell"))) - half
        self.width, self.height = F.lit(grid.step) / F.col("nx"), F.lit(grid.step) / F.col("ny")

    def raw_col(self, x: Column) -> Column:
        return F.floor((x - self.left) / self.width).cast("bigint")

    def raw_row(self, y: Column) -> Column:
        return F.floor((y - self.low) / self.height).cast("bigint")

    def sub(self, x: Column, y: Column) -> Column:
        col = F.greatest(F.lit(0), F.least(self.raw_col(x), F.col("nx") - 1))
        row = F.greatest(F.lit(0), F.least(self.raw_row(y), F.col("ny") - 1))
        return (row * F.col("nx") + col).cast("bigint")

    def centre_x(self, col: Column) -> Column:
        return self.left + (col.cast("double") + F.lit(0.5)) * self.width

    def centre_y(self, row: Column) -> Column:
        return self.low + (row.cast("double") + F.lit(0.5)) * self.height

    def right_x(self, col: Column) -> Column:
        return self.left + (col.cast("double") + F.lit(1.0)) * self.width

    def rows_of(self, lo: Column, hi: Column) -> Column:
        return self._within(self.raw_row(lo), self.raw_row(hi), F.col("ny"))

    def cols_of(self, lo: Column, hi: Column) -> Column:
        return self._within(self.raw_col(lo), self.raw_col(hi), F.col("nx"))

    @staticmethod
    def _within(first: Column, last: Column, n: Column) -> Column:
        """What lies in the cell of a range, NULL if nothing does."""
        first, last = F.greatest(first, F.lit(0)), F.least(last, n - 1)
        return F.when(first <= last, F.sequence(first, last))


def _fine_edge_cells(edges: DataFrame, grid: Grid) -> DataFrame:
    """Adds ``sub``: rows with ``cell``, ``nx`` and ``ny`` once per fine cell the edge
    passes through or comes close to."""
    fine, pad = _Fine(grid), F.lit(PAD)
    cut = edges.withColumn("_row", F.explode(fine.rows_of(F.least("y1", "y2") - pad, F.greatest("y1", "y2") + pad)))
    half = fine.height / 2 + pad

    def x_at(y: Column) -> Column:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1"))))
        return F.col("x1") + t * (F.col("x2") - F.col("x1"))

    flat = F.col("y1") == F.col("y2")
    middle = fine.centre_y(F.col("_row"))
    xa = F.when(flat, F.col("x1")).otherwise(x_at(middle - half))
    xb = F.when(flat, F.col("x2")).otherwise(x_at(middle + half))
    cols = fine.cols_of(F.least(xa, xb) - pad, F.greatest(xa, xb) + pad)
    return cut.withColumn("_col", F.explode(cols)).withColumn("sub", F.col("_row") * F.col("nx") + F.col("_col")).drop("_row", "_col")


def _fine_cover(edges: DataFrame, rows: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """``(keys..., cell, nx, ny, sub)``: fine cells whose centre is inside. Their parity
    differs from ``base`` by the edges right of the centre that its row crosses, and by
    those that leave the cell on the right and end above. So each of these changes all
    centres left of some place, and what is inside between two places is one run."""
    fine = _Fine(grid)
    where = [*keys, "cell", "nx", "ny"]
    right = grid.right_x(grid.col_of(F.col("cell"))) + F.lit(PAD)
    yc = fine.centre_y(F.col("row"))
    crossing = edges.withColumn("row", F.explode(fine.rows_of(F.least("y1", "y2"), F.greatest("y1", "y2")))).withColumn("yc", yc)
    crossing = crossing.where("(y1 > yc) <> (y2 > yc)").withColumn("xc", F.expr("(x2 - x1) * (yc - y1) / (y2 - y1) + x1"))
    # Centres left of the crossing, by the comparison that the parity makes.
    near = F.greatest(F.lit(0), F.least(F.col("nx"), F.ceil((F.col("xc") - fine.left) / fine.width - 0.5))).cast("bigint")
    at = F.col("at")
    exact = F.when((at > 0) & ~(fine.centre_x(at - 1) < F.col("xc")), at - 1).when((at < F.col("nx")) & (fine.centre_x(at) < F.col("xc")), at + 1).otherwise(at)
    crossing = crossing.withColumn("at", near).select(*where, "row", exact.alias("at"), F.lit(1).alias("n"))
    every_row = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ny") - 1))
    leaving = edges.where((F.col("x1") > right) != (F.col("x2") > right)).withColumn("outer", F.when(F.col("x1") > right, F.col("y1")).otherwise(F.col("y2")))
    leaving = leaving.withColumn("row", every_row).where(F.col("outer") > yc).select(*where, "row", F.col("nx").alias("at"), F.lit(1).alias("n"))
    from_base = rows.select(*where, "base").withColumn("row", every_row).select(*where, "row", F.col("nx").alias("at"), F.col("base").alias("n"))
    turns = crossing.unionByName(leaving).unionByName(from_base).groupBy(*where, "row", "at").agg(F.sum("n").alias("n"))
    along = Window.partitionBy(*where, "row").orderBy(F.desc("at"))
    runs = turns.withColumn("odd", F.sum("n").over(along) % 2 == 1).withColumn("to", F.coalesce(F.lead("at").over(along), F.lit(0)))
    cols = F.explode(F.sequence(F.col("to"), F.col("at") - 1))
    return runs.where("odd AND to < at").withColumn("_col", cols).select(*where, (F.col("row") * F.col("nx") + F.col("_col")).alias("sub"))


def _fine_cells(border: DataFrame, rows: DataFrame, crowded: DataFrame, keys: Sequence[str], grid: Grid, edges_per_row: int) -> FineCells:
    cells = measured(crowded)
    edges = border.join(cells, "cell").persist(StorageLevel.MEMORY_AND_DISK)
    where = [*keys, "cell", "nx", "ny", "sub"]
    inside = _fine_cover(edges, rows.where("fine").join(cells, "cell"), keys, grid)
    border = _fine_edge_cells(edges, grid)
    spread = (
        border.groupBy(*where).agg(F.count("*").alias("n")).where(F.col("n") > edges_per_row)
        .select(*where, F.ceil(F.col("n") / edges_per_row).cast("bigint").alias("pieces"))
    )
    fine = _Fine(grid)
    col, row = F.col("sub") % F.col("nx"), F.floor(F.col("sub") / F.col("nx"))
    right = fine.right_x(col) + F.lit(PAD)
    edge = F.struct("x1", "y1", "x2", "y2")
    touched = border.select(*where, F.lit(0).alias("inside"), edge.alias("edge"))
    touched = touched.withColumn("flips", _flips(F.col("edge"), fine.centre_x(col), fine.centre_y(row), right))
    touched = touched.unionByName(
        inside.select(*where, F.lit(1).alias("inside"), F.lit(None).cast(G.EDGE_TYPE).alias("edge"), F.lit(0).alias("flips"))
    )
    piece = F.when(F.col("edge").isNull(), 0).otherwise(F.pmod(F.xxhash64("edge"), F.coalesce("pieces", F.lit(1))))
    listed = (
        touched.join(spread, where, "left")
        .groupBy(*where, piece.cast("int").alias("piece"))
        .agg((F.max("inside") + F.sum("flips")).alias("base"), F.collect_list("edge").alias("edges"))
        .select(*keys, "cell", "sub", right.alias("right"), (F.col("base") % 2).cast("int").alias("base"), "edges")
    )
    kept = measured(listed)
    edges.unpersist()
    return FineCells(cells, kept)


def boundary_index(boundary: DataFrame, step: float = DEFAULT_STEP, geom: str = "geom", keys: Sequence[str] = ()) -> CellIndex:
    """Index of a boundary of any number of polygons, each part on its own key, so
    that overlapping or repeated parts do not cancel out. ``keys`` tell several
    boundaries in one table apart."""
    parts = (
        boundary.select(*keys, F.explode(G.dump(geom)).alias("geom"))
        .withColumn("_b", F.xxhash64(F.col("geom.parts")))
        .dropDuplicates([*keys, "_b"])
    )
    return build_index(parts, [*keys, "_b"], step)


def pip_pairs(
    points: DataFrame,
    index: CellIndex,
    id_cols: Sequence[str],
    x: str = "x",
    y: str = "y",
    same: Sequence[str] = (),
) -> DataFrame:
    """``(id_cols..., keys...)`` for every polygon that contains the point. ``same``
    names keys the points carry too: only polygons of equal keys are looked at."""
    keys = [k for k in index.keys if k not in same]
    ids = [c for c in id_cols if c not in same]
    place = [c for c in (x, y) if c not in ids]
    located = points.select(*same, *ids, *place, index.grid.cell(F.col(x), F.col(y)).alias("cell"))
    out = [*same, *ids, *keys]
    holds = index.parity(F.col(x), F.col(y)) == 1
    whole = located.join(index.rows.where("NOT fine"), ["cell", *same]).where(holds).select(*out)
    if not index.crowded:
        return whole
    spread = crowded_pairs(located.select(*same, x, y), index, x, y, same)
    return whole.unionByName(located.join(spread, [*same, x, y]).select(*out))


def crowded_pairs(points: DataFrame, index: CellIndex, x: str = "x", y: str = "y", same: Sequence[str] = ()) -> DataFrame:
    """``(same..., x, y, keys...)``: places in crowded cells and the polygons that hold
    them, each once, found by the fine cell of the place. Whether a polygon holds a place depends on the place alone, so the
    parities are added up per place, and every row at it takes part in what was found."""
    keys = [k for k in index.keys if k not in same]
    places = points.select(*same, x, y).distinct().withColumn("cell", index.grid.cell(F.col(x), F.col(y)))
    fine = places.join(index.crowded.cells, "cell").withColumn("sub", _Fine(index.grid).sub(F.col(x), F.col(y)))
    return (
        fine.join(index.crowded.rows, ["cell", "sub", *same])
        .withColumn("_p", index.parity(F.col(x), F.col(y), right=F.col("right")))
        .groupBy(*same, x, y, *keys)
        .agg(F.sum("_p").alias("_n"))
        .where("_n % 2 = 1")
        .select(*same, x, y, *keys)
    )


def pip_join(
    points: DataFrame,
    polys: DataFrame,
    id_cols: Sequence[str],
    keys: Sequence[str],
    step: float = DEFAULT_STEP,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    return pip_pairs(points, build_index(polys, keys, step), id_cols, x, y)


def points_within(
    points: DataFrame, boundary: CellIndex, id_col: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """Points inside any polygon of the boundary, with all their columns.

    The usual boundary needs no shuffle of the points: the semi join carries the
    exact test. Only rows in cells crowded with edges take another road, by place.
    """
    px, py = F.col(x), F.col(y)
    located = points.withColumn("_cell", boundary.grid.cell(px, py))
    light = boundary.rows.where("NOT fine").select("cell", "base", "edges")
    on = (F.col("_cell") == F.col("cell")) & (boundary.parity(px, py) == 1)
    if not boundary.crowded:
        return located.join(light, on, "left_semi").drop("_cell")
    # A cell may hold light parts as well as crowded ones: its rows are asked about both
    # at once, so that none comes out twice.
    crowded = crowded_cells(boundary)
    inside = located.join(crowded, "_cell", "left_anti").join(light, on, "left_semi").drop("_cell")
    rest = located.join(crowded, "_cell", "left_semi")
    places = rest.select(F.col(x).alias("_x"), F.col(y).alias("_y")).distinct()
    found = pip_pairs(places, boundary, ["_x", "_y"], "_x", "_y").select("_x", "_y").distinct()
    held = rest.join(found, (px == F.col("_x")) & (py == F.col("_y")), "left_semi")
    return inside.unionByName(held.select(*inside.columns))


def crowded_cells(index: CellIndex) -> DataFrame:
    """``_cell``: cells that hold more edges than one row lists."""
    return index.crowded.cells.select(F.col("cell").alias("_cell"))


def intersects_boundary(
    features: DataFrame,
    boundary: DataFrame,
    id_col: str,
    step: float = DEFAULT_STEP,
    geom: str = "geom",
    boundary_geom: str = "geom",
    coarse_step: float = 5.0,
) -> DataFrame:
    """Whole features that share a point with the boundary polygons (no clipping).

    A feature qualifies when a part starts inside, when one of its segments meets
    a boundary edge, or when it contains a boundary ring outright. Most features
    lie within one cell: they are settled by one semi join that carries the whole
    test, and are not shuffled when the index is small. The others are spread over
    the cells they touch and come back by id.
    """
    near, far, ids = _sharing(features, boundary, id_col, step, geom, boundary_geom, coarse_step)
    return near.unionByName(far.join(ids.distinct(), id_col, "left_semi").select(*near.columns))


def _sharing(features, boundary, id_col, step, geom, boundary_geom="geom", coarse_step=5.0):
    """Features settled by their cell, the others, and ids of those among the others that
    share a point with the boundary, some more than once."""
    index = boundary_index(boundary, step, boundary_geom)
    rings = boundary.select(F.explode(F.flatten(G.as_col(boundary_geom)["parts"])).alias("r"))
    located = features.withColumn("_cell", _single_cell(geom, index.grid))
    single = index.rows.where("NOT fine").select("cell", "base", "edges")
    on = (F.col("_cell") == F.col("cell")) & _meets_cell(F.col(geom), index, F.col("edges"), F.col("base"))
    far = located.where("_cell IS NULL")
    settled = located
    if index.crowded:
        crowded = crowded_cells(index)
        # Rows in crowded cells go the far road, and only that one.
        settled = located.join(crowded, "_cell", "left_anti")
        far = far.unionByName(located.join(crowded, "_cell", "left_semi").select(*far.columns))
    near = settled.join(single, on, "left_semi").drop("_cell").select(*features.columns)
    far = far.drop("_cell").select(*features.columns)
    return near, far, _touching(far, rings, index, (), id_col, geom, coarse_step)


def assign_areas(
    features: DataFrame, areas: DataFrame, keys: Sequence[str], id_col: str, step: float = DEFAULT_STEP, geom: str = "geom",
    coarse_step: float = 5.0,
) -> DataFrame:
    """The features with ``keys`` of every area they share a point with, a row for each:
    many boundaries in one join on the cell. ``areas`` has the keys and ``geom``; areas
    may overlap, and a key may have several rows."""
    index = boundary_index(areas, step, "geom", keys)
    rings = areas.select(*keys, F.explode(F.flatten(F.col("geom")["parts"])).alias("r"))
    located = features.withColumn("_cell", _single_cell(geom, index.grid))
    # What areas have in a cell is bounded by their number and the edges a row lists.
    listed = index.rows.where("NOT fine").groupBy(F.col("cell").alias("_cell")).agg(
        F.collect_list(F.struct(F.struct(*keys).alias("area"), "base", "edges")).alias("_areas")
    )
    far = located.where("_cell IS NULL")
    settled = located
    if index.crowded:
        crowded = crowded_cells(index)
        settled = located.join(crowded, "_cell", "left_anti")
        far = far.unionByName(located.join(crowded, "_cell", "left_semi").select(*far.columns))
    held = F.filter("_areas", lambda a: _meets_cell(F.col(geom), index, a["edges"], a["base"]))
    near = settled.join(listed, "_cell").withColumn("_area", F.explode(F.array_distinct(F.transform(held, lambda a: a["area"]))))
    columns = [*features.columns, *keys]
    near = near.select(*features.columns, *[F.col(f"_area.{k}").alias(k) for k in keys])
    far = far.select(*features.columns)
    pairs = _touching(far, rings, index, keys, id_col, geom, coarse_step).distinct()
    return near.unionByName(far.join(pairs, id_col).select(*columns))


def _single_cell(geom: str, grid: Grid) -> Column:
    """The cell a feature lies in, NULL if it reaches into several."""
    return G.once(
        G.extent(geom),
        lambda b: F.when(
            (grid.col(b["xmin"] - PAD) == grid.col(b["xmax"] + PAD))
            & (grid.row(b["ymin"] - PAD) == grid.row(b["ymax"] + PAD)),
            grid.cell(b["xmin"], b["ymin"]),
        ),
    )


def _meets_cell(geom: Column, index: CellIndex, edges: Column, base: Column) -> Column:
    """The whole test for a feature that lies in the joined cell: all that the
    boundary can do to it is listed there."""
    starts_inside = F.exists(G.part_starts(geom), lambda v: index.parity(v["x"], v["y"], edges, base) == 1)
    crosses = F.exists(
        G.edges(geom), lambda own: F.exists(edges, lambda b: G.segments_meet(own, b))
    )
    holds_ring = F.endswith(geom["kind"], F.lit("POLYGON")) & F.exists(
        edges, lambda b: G.contains_xy(geom, b["x1"], b["y1"])
    )
    apart = F.endswith(geom["kind"], F.lit("POINT"))
    more = F.when(edges.isNotNull() & ~apart, crosses | holds_ring).otherwise(F.lit(False))
    return F.coalesce(starts_inside, F.lit(False)) | more


def _touching(features, rings, index, keys, id_col, geom, coarse_step):
    """``(id, keys...)``, some pairs more than once. Features are taken apart once, into segments and
    the starts of their parts, which meet the index in one join; geometries stay behind."""

    def piece(x1, y1, x2, y2, start):
        return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), F.lit(start).alias("start"))

    apart = F.endswith(G.kind(geom), F.lit("POINT"))
    begins = F.transform(G.part_starts(geom), lambda v: piece(v["x"], v["y"], v["x"], v["y"], True))
    segments = F.transform(G.edges(geom), lambda e: piece(e["x1"], e["y1"], e["x2"], e["y2"], False))
    parts = features.select(id_col, F.explode(F.when(apart, begins).otherwise(F.concat(begins, segments))).alias("e")).select(id_col, "e.*")
    grid = index.grid
    own = F.struct("x1", "y1", "x2", "y2")
    inside = (F.col("cell") == grid.cell(F.col("x1"), F.col("y1"))) & (index.parity(F.col("x1"), F.col("y1")) == 1)
    meets = F.coalesce(F.exists("edges", lambda b: G.segments_meet(own, b)), F.lit(False))
    spread = edge_cells(parts, grid)
    hits = spread.join(index.rows.where("NOT fine"), "cell").where(F.when(F.col("start"), inside).otherwise(meets)).select(id_col, *keys)
    if index.crowded:
        finer = _fine_edge_cells(spread.where("NOT start").join(index.crowded.cells, "cell"), grid)
        hits = hits.unionByName(finer.join(index.crowded.rows, ["cell", "sub"]).where(meets).select(id_col, *keys))
        starts = parts.where("start").select(id_col, F.col("x1").alias("_x"), F.col("y1").alias("_y"))
        places = crowded_pairs(starts, index, "_x", "_y")
        hits = hits.unionByName(starts.join(places, ["_x", "_y"]).select(id_col, *keys))
    areas = features.where(F.endswith(G.kind(geom), F.lit("POLYGON"))).select(id_col, F.col(geom).alias("geom"))
    holding = _holding(areas, rings, grid.step, keys, id_col, coarse_step)
    return hits.unionByName(holding)


def _holding(areas, rings, step, keys, id_col, coarse_step):
    """Polygon features that contain a boundary ring outright, told by its start.

    A first look compares each feature's box with one box of ring starts per coarse
    cell; the few left are indexed and meet the starts cell by cell.
    """
    coarse = lonlat(coarse_step)
    starts = rings.select(*keys, F.col("r")[0]["x"].alias("x"), F.col("r")[0]["y"].alias("y")).distinct()
    boxes = starts.groupBy(coarse.cell(F.col("x"), F.col("y")).alias("_c")).agg(
        F.min("x").alias("x1"), F.min("y").alias("y1"), F.max("x").alias("x2"), F.max("y").alias("y2")
    )
    boxed = areas.select(id_col, G.extent("geom").alias("_box"))
    rows = F.sequence(coarse.row(F.col("_box.ymin")), coarse.row(F.col("_box.ymax")))
    cols = F.sequence(coarse.col(F.col("_box.xmin")), coarse.col(F.col("_box.xmax")))
    spread = (
        boxed.withColumn("_r", F.explode(rows)).withColumn("_k", F.explode(cols))
        .withColumn("_c", coarse.cell_of(F.col("_r"), F.col("_k")))
    )
    overlap = "_box.xmin <= x2 AND _box.xmax >= x1 AND _box.ymin <= y2 AND _box.ymax >= y1"
    likely = spread.join(boxes, "_c").where(overlap).select(id_col).distinct()
    parts = areas.join(likely, id_col, "left_semi").select(id_col, F.posexplode(G.dump("geom")).alias("_part", "geom"))
    index = build_index(parts, [id_col, "_part"], step)
    return pip_pairs(starts, index, keys).select(id_col, *keys)


def near_boundary(
    features: DataFrame, boundary: DataFrame, distance: float, id_col: str, step: float = DEFAULT_STEP, geom: str = "geom"
) -> DataFrame:
    """Whole features of any kind that share a point with the boundary or come within
    ``distance`` metres (EPSG:3857) of it. Whatever lies inside, crosses an edge or
    holds a ring shares a point; the rest is near by one of its segments."""
    if distance < 0:
        raise ValueError(f"the distance must be >= 0; got {distance}")
    if distance == 0:
        return intersects_boundary(features, boundary, id_col, step, geom)
    # Only ids are asked for: no geometry is moved before the last join.
    settled, _, others = _sharing(features.select(id_col, geom), boundary, id_col, step, geom)
    sharing = settled.select(id_col).unionByName(others)
    near = near_segments(features, polygon_edges(boundary, [], "geom"), distance, id_col, geom)
    return features.join(sharing.unionByName(near).distinct(), id_col, "left_semi")


def near_segments(features: DataFrame, edges: DataFrame, distance: float, id_col: str, geom: str = "geom") -> DataFrame:
    """Ids of features with a segment or point within ``distance`` metres of an edge.

    Two segments are that close when some point of the one lies in a cell that the other
    comes within ``distance`` of: edges are listed in all of those, segments in the cells
    they pass. The cell grows with the distance, so an edge is listed a few times."""
    grid = metres(max(2 * distance, 2_000.0))
    listed = measured(edge_cells(_in_metres(edges), grid, distance).withColumnRenamed("cell", "_cell").select(
        "_cell", F.struct("x1", "y1", "x2", "y2").alias("_edge")
    ))
    own = features.select(id_col, F.explode(G.edges(geom)).alias("e")).select(id_col, "e.*")
    spread = edge_cells(_in_metres(own, id_col), grid, 1e-3)
    close = G.segment_distance(F.struct("x1", "y1", "x2", "y2"), F.col("_edge")) <= distance
    return spread.join(listed, (F.col("cell") == F.col("_cell")) & close, "left_semi").select(id_col)


def _in_metres(edges: DataFrame, *keep: str) -> DataFrame:
    return edges.select(
        *keep, mercator_x(F.col("x1")).alias("x1"), mercator_y(_clamped("y1")).alias("y1"),
        mercator_x(F.col("x2")).alias("x2"), mercator_y(_clamped("y2")).alias("y2"),
    )


def within_distance(
    points: DataFrame,
    boundary: DataFrame,
    distance: float,
    id_col: str,
    step: float = DEFAULT_STEP,
    geom: str = "geom",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Points inside the boundary or at most ``distance`` metres (EPSG:3857) from it."""
    if distance < 0:
        raise ValueError(f"the distance must be >= 0; got {distance}")
    index = boundary_index(boundary, step, geom)
    if distance == 0:
        return points_within(points, index, id_col, x, y)
    near = near_edges(points, polygon_edges(boundary, [], geom), distance, id_col, x, y)
    inside = points_within(points, index, id_col, x, y).select(id_col)
    return points.join(inside.unionByName(near).distinct(), id_col, "left_semi")


def near_edges(
    points: DataFrame, edges: DataFrame, distance: float, id_col: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """Ids of points within ``distance`` metres of an edge.

    Edges are listed in every metre-grid cell they come within ``distance`` of, so
    a point only looks at its own cell.
    """
    grid = metres(max(2 * distance, 2_000.0))
    listed = measured(edge_cells(_in_metres(edges), grid, distance))
    located = points.select(
        id_col, mercator_x(F.col(x)).alias("_mx"), mercator_y(_clamped(y)).alias("_my")
    ).withColumn("_cell", grid.cell(F.col("_mx"), F.col("_my")))
    own = F.struct("x1", "y1", "x2", "y2")
    close = G.segment_point_distance(own, F.col("_mx"), F.col("_my")) <= distance
    return located.join(listed, (F.col("_cell") == F.col("cell")) & close, "left_semi").select(id_col)


def _clamped(y: str) -> Column:
    """Latitudes stop short of the poles, which lie at infinity in this plane."""
    return F.greatest(F.lit(-89.9), F.least(F.lit(89.9), F.col(y)))


def buffered_bbox(bbox: tuple[float, float, float, float], distance: float, spark) -> tuple:
    """The bbox grown by ``distance`` metres in the EPSG:3857 plane."""
    if distance < 0:
        raise ValueError(f"the distance must be >= 0; got {distance}")
    row = spark.range(1).select(
        lon_of(mercator_x(F.lit(bbox[0])) - distance),
        lat_of(mercator_y(F.lit(bbox[1])) - distance),
        lon_of(mercator_x(F.lit(bbox[2])) + distance),
        lat_of(mercator_y(F.lit(bbox[3])) + distance),
    ).first()
    return tuple(row)
