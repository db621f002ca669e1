"""Administrative codes for features.

The admin polygons of a country are turned once into a lookup with one row per
grid cell, holding for every level who owns the cell and, where nobody does, what
the fallback needs. Features then meet all levels in a single left join on the
cell number, which never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions.grid import DEFAULT_STEP, Grid, lonlat
from cartoweave.operators import spatial as S
from cartoweave.session import measured, measured_with

LEVELS = (1, 2, 3, 4)

# The configuration words for the two fallbacks.
RESOLUTIONS = ("h3_neighbor", "geos")

# Extra mode: the exact test for every feature, not only for the residuals.
STRICT = "strict"

# Cells along one side of a lookup block, and the size from which a lookup is
# folded into blocks. Smaller ones are broadcast as they are.
BLOCK = 16
BLOCKS_FROM = 200_000

# Most edges listed in one lookup cell; beyond it the cell's features are matched
# by a count per feature instead.
MAX_CELL_EDGES = 2048


def resolve_mode(run: str | None, category: str | None = None) -> str:
    """The category's choice of fallback overrides the run's; a typo raises."""
    mode = category or run or "geos"
    if mode not in RESOLUTIONS and mode != STRICT:
        raise ValueError(f"boundary_resolution must be one of {list(RESOLUTIONS)}, got {mode!r}")
    return mode


def mode_column(run: Column, category: Column) -> Column:
    """``resolve_mode`` over columns; an unknown word raises when the job runs."""
    mode = F.coalesce(category, run, F.lit("geos"))
    return F.when(mode.isin(*RESOLUTIONS, STRICT), mode).otherwise(
        F.raise_error(F.concat(F.lit("unknown boundary_resolution: "), mode)).cast("string")
    )


def stack_levels(levels: dict[int, DataFrame]) -> DataFrame:
    """Per-level tables from ``scan_admin`` as one table with a ``level`` column."""
    out = None
    for level, df in sorted(levels.items()):
        df = df.withColumn("level", F.lit(level))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("levels must be non-empty")
    return out


def adm0_seed(admin: DataFrame, iso3: str) -> DataFrame:
    """One row ``(adm0_pcode, adm0_name)`` from the shallowest level having data;
    the ISO3 code with a NULL name where no level names a country."""
    best = admin.where("adm0_pcode IS NOT NULL").agg(
        F.min(F.struct("level", "adm0_pcode", "adm0_name")).alias("s")
    )
    return best.select(
        F.coalesce("s.adm0_pcode", F.lit(iso3.upper())).alias("adm0_pcode"),
        F.col("s.adm0_name").alias("adm0_name"),
    )


def level_summary(admin: DataFrame) -> DataFrame:
    """Per level: polygons, polygons with a code and the smallest country code and
    name (at most one row per level)."""
    country = F.when(F.col("adm0_pcode").isNotNull(), F.struct("adm0_pcode", "adm0_name"))
    return admin.groupBy("level").agg(
        F.count("*").alias("polygons"), F.count("pcode").alias("coded"), F.min(country).alias("adm0")
    )


@dataclass(frozen=True)
class AdminLookup:
    """``rows``: ``cell`` and per level ``L<n>`` a struct of owner and fallback.

    In a large lookup, ``blocks`` holds one row for every square of ``BLOCK`` x
    ``BLOCK`` cells that all have the same owners, in place of its cells. That
    leaves ``rows`` with the cells near a border.
    """

    grid: Grid
    levels: tuple[int, ...]
    rows: DataFrame
    blocks: DataFrame | None
    index: S.CellIndex | None
    crowded: bool

    def release(self) -> None:
        self.rows.unpersist()
        if self.blocks is not None:
            self.blocks.unpersist()
        if self.index is not None:
            self.index.release()


def cell_owners(cover: DataFrame) -> DataFrame:
    """One owner per (level, cell): the smallest code among those that cover it."""
    return cover.groupBy("level", "cell").agg(F.min(F.struct("pcode", "name")).alias("owner"))


def neighbour_majority(cover: DataFrame, grid: Grid) -> DataFrame:
    """For cells without an owner but next to owned ones: the code that owns most
    of the neighbours, ties to the smaller code. Depends on the cell alone, so it
    is worked out once per cell rather than once per feature."""
    hits = (
        cover.withColumn("near", F.explode(grid.ring(F.col("cell"))))
        .groupBy("level", F.col("near").alias("cell"), "pcode", "name")
        .agg(F.count("*").alias("hits"))
    )
    ranked = hits.groupBy("level", "cell").agg(
        F.min(F.struct((-F.col("hits")).alias("rank"), "pcode", "name")).alias("best")
    )
    owned = cover.select("level", "cell").distinct()
    return ranked.join(owned, ["level", "cell"], "left_anti").select(
        "level", "cell", F.struct("best.pcode", "best.name").alias("near")
    )


def build_lookup(
    admin: DataFrame,
    levels: Sequence[int],
    mode: str = "geos",
    step: float = DEFAULT_STEP,
    max_cell_edges: int = MAX_CELL_EDGES,
    blocks_from: int = BLOCKS_FROM,
) -> AdminLookup:
    """``admin``: (level, pcode, name, geom). Built once per country and mode."""
    grid = lonlat(step)
    keys = ["level", "pcode", "name"]
    polys = admin.where("pcode IS NOT NULL").select(*keys, "geom")
    index = None
    if mode == "h3_neighbor":
        cover = measured(S.cell_cover(polys, keys, step))
        per_level = cell_owners(cover).withColumn("near", F.lit(None).cast("struct<pcode:string,name:string>"))
        per_level = per_level.unionByName(
            neighbour_majority(cover, grid).withColumn("owner", F.lit(None).cast("struct<pcode:string,name:string>"))
        )
        found = F.struct(F.col("owner"), F.col("near"))
    else:
        index = S.build_index(polys, keys, step)
        cells = index.rows.groupBy("level", "cell").agg(
            F.min(F.when(F.col("owned"), F.struct("pcode", "name"))).alias("owner"),
            F.sum("n_edges").alias("n_edges"),
            F.max("fine").alias("fine"),
        )
        if mode == STRICT:
            # Only a cell without edges is the same polygon's all over.
            cells = cells.withColumn("owner", F.when(F.col("n_edges") == 0, F.col("owner")))
        cells = cells.withColumn(
            "busy", F.expr(f"owner IS NULL AND (fine OR n_edges > {int(max_cell_edges)})")
        )
        open_cells = cells.where("owner IS NULL AND NOT busy").select("level", "cell")
        candidates = (
            index.rows.join(open_cells, ["level", "cell"], "left_semi")
            .groupBy("level", "cell")
            .agg(F.sort_array(F.collect_list(F.struct("pcode", "name", "base", "edges"))).alias("candidates"))
        )
        per_level = cells.join(candidates, ["level", "cell"], "left")
        found = F.struct("owner", "candidates", "busy")
    wide = per_level.groupBy("cell").agg(
        *[F.first(F.when(F.col("level") == n, found), ignorenulls=True).alias(f"L{n}") for n in levels]
    )
    busy = F.lit(False)
    if index is not None:
        for n in levels:
            busy = busy | F.coalesce(F.col(f"L{n}.busy"), F.lit(False))
    wide, facts = measured_with(wide, F.max(busy).alias("busy"))
    if mode == "h3_neighbor":
        cover.unpersist()
    blocks = None
    if facts["rows"] >= blocks_from:
        wide, blocks = _fold(wide, grid, levels)
    crowded = bool(facts["busy"])
    return AdminLookup(grid, tuple(levels), wide, blocks, index, crowded)


def lookup_for(
    admin: DataFrame, levels: Sequence[int] = LEVELS, mode: str = "geos", step: float = DEFAULT_STEP
) -> AdminLookup | None:
    """The lookup that ``tag_admin`` would build for itself, to be shared by several
    calls; None where no level has codes. The caller releases it."""
    wanted = set(levels)
    coded = sorted(r["level"] for r in level_summary(admin).collect() if r["level"] in wanted and r["coded"] > 0)
    if not coded:
        return None
    return build_lookup(admin.where(F.col("level").isin(*coded)), coded, mode, step)


def _fold(wide: DataFrame, grid: Grid, levels: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """The cells that differ within their block, and the blocks of equal cells."""
    owners = F.struct(*[F.col(f"L{n}.owner").alias(f"O{n}") for n in levels])
    settled = F.lit(True)
    for n in levels:
        settled = settled & F.coalesce(F.col(f"L{n}").isNull() | F.col(f"L{n}.owner").isNotNull(), F.lit(False))
    blocked = wide.withColumn("block", block_of(grid, F.col("cell")))
    blocks = measured(
        blocked.groupBy("block")
        .agg(
            F.count("*").alias("n"), F.bool_and(settled).alias("settled"),
            F.min(owners).alias("lo"), F.max(owners).alias("hi"),
        )
        .where((F.col("n") == BLOCK * BLOCK) & F.col("settled") & (F.col("lo") == F.col("hi")))
        .select("block", F.col("lo").alias("owners"))
    )
    rest = measured(blocked.join(blocks.select("block"), "block", "left_anti").drop("block"))
    wide.unpersist()
    return rest, blocks


def block_of(grid: Grid, cell: Column) -> Column:
    across = -(-grid.n_cols // BLOCK)
    row, col = F.floor(grid.row_of(cell) / BLOCK), F.floor(grid.col_of(cell) / BLOCK)
    return (row * across + col).cast("bigint")


def with_centroid(df: DataFrame, geom: str = "geom") -> DataFrame:
    c = df.withColumn("_c", G.centroid(geom))
    return c.withColumn("cx", F.col("_c.x")).withColumn("cy", F.col("_c.y")).drop("_c")


def with_cell(df: DataFrame, step: float = DEFAULT_STEP, x: str = "cx", y: str = "cy") -> DataFrame:
    return df.withColumn("cell", lonlat(step).cell(F.col(x), F.col(y)))


def cell_join(df: DataFrame, owners: DataFrame) -> DataFrame:
    """Left join on the cell against one owner per cell; rows are never multiplied."""
    flat = owners.select("cell", "owner.pcode", "owner.name")
    return df.join(flat, "cell", "left")


def residuals(df: DataFrame, column: str = "pcode") -> DataFrame:
    return df.where(F.col(column).isNull())


def with_fallback(df: DataFrame, fallback: DataFrame, id_col: str) -> DataFrame:
    """``COALESCE(own, fallback)`` for ``pcode`` and ``name``; ``fallback`` has at
    most one row per id."""
    fb = fallback.select(id_col, F.col("pcode").alias("_pcode"), F.col("name").alias("_name"))
    return (
        df.join(fb, id_col, "left")
        .withColumn("pcode", F.coalesce("pcode", "_pcode"))
        .withColumn("name", F.coalesce("name", "_name"))
        .drop("_pcode", "_name")
    )


def neighbor_join(res: DataFrame, cover: DataFrame, grid: Grid, id_col: str) -> DataFrame:
    """Residual features to the majority code of their cell's neighbours."""
    near = neighbour_majority(cover, grid).select("cell", "near.pcode", "near.name")
    return res.select(id_col, "cell").join(near, "cell").select(id_col, "pcode", "name")


def code_columns(levels: Sequence[int]) -> list[str]:
    names = ["adm0_pcode", "adm0_name"]
    for n in levels:
        names += [f"adm{n}_pcode", f"adm{n}_name"]
    return names


def ensure_levels(df: DataFrame, levels: Sequence[int], adm0: Row | None, iso3: str) -> DataFrame:
    """The code columns a country without admin data still gets: the ISO3 code and
    typed NULLs. Columns already present are left alone."""
    pcode = adm0["adm0_pcode"] if adm0 else iso3.upper()
    name = adm0["adm0_name"] if adm0 else None
    given = {"adm0_pcode": pcode, "adm0_name": name}
    for column in code_columns(levels):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(given.get(column)).cast("string"))
    return df


def tag_admin(
    features: DataFrame,
    admin: DataFrame,
    iso3: str,
    levels: Sequence[int] = LEVELS,
    mode: str = "geos",
    step: float = DEFAULT_STEP,
    geom: str = "geom",
    id_col: str | None = None,
    lookup: AdminLookup | None = None,
    by_cell: bool = False,
) -> DataFrame:
    """Adds ``adm0_*`` and ``adm<level>_*``; attributes keep their order, ``geom``
    and then the codes come last. Levels without codes become typed NULLs. Features in
    cells too crowded with edges to be listed are matched by their place; ``id_col`` is
    not needed for it. ``by_cell`` adds ``adm<level>_by_cell``: whether the cell alone
    gave the code, before any fallback.
    """
    levels = sorted(set(levels))
    if not levels:
        raise ValueError("levels must be non-empty")
    attributes = [c for c in features.columns if c != geom]
    order = [*attributes, geom, *code_columns(levels)]
    told = [f"adm{n}_by_cell" for n in levels] if by_cell else []

    def untold(df: DataFrame) -> DataFrame:
        return df.select(*order, *[F.lit(False).alias(c) for c in told])

    summary = {r["level"]: r for r in level_summary(admin).collect()}
    if not any(n in summary for n in levels):
        return untold(ensure_levels(features, levels, None, iso3))
    adm0 = next((summary[n]["adm0"] for n in levels if n in summary and summary[n]["adm0"]), None)
    coded = [n for n in levels if n in summary and summary[n]["coded"] > 0]
    if not coded:
        return untold(ensure_levels(features, levels, adm0, iso3))

    if lookup is None:
        lookup = build_lookup(admin.where(F.col("level").isin(*coded)), coded, mode, step)
    cx, cy = F.col("_c.x"), F.col("_c.y")
    tagged = features.withColumn("_c", G.centroid(geom)).withColumn("_cell", lookup.grid.cell(cx, cy))
    tagged = tagged.join(lookup.rows.withColumnRenamed("cell", "_cell"), "_cell", "left")
    found = {n: _settle(lookup, n, cx, cy) for n in lookup.levels}
    if lookup.blocks is not None:
        blocks = lookup.blocks.withColumnRenamed("block", "_block")
        tagged = tagged.withColumn("_block", block_of(lookup.grid, F.col("_cell"))).join(blocks, "_block", "left")
        found = {n: F.coalesce(F.col(f"owners.O{n}"), c) for n, c in found.items()}
    tagged = tagged.withColumns({f"_t{n}": c for n, c in found.items()})
    if lookup.crowded:
        tagged = _settle_crowded(tagged, lookup, cx, cy)
    codes = {}
    for n in lookup.levels:
        codes[f"adm{n}_pcode"], codes[f"adm{n}_name"] = F.col(f"_t{n}.pcode"), F.col(f"_t{n}.name")
    for n in levels if by_cell else ():
        codes[f"adm{n}_by_cell"] = _owned(lookup, n) if n in lookup.levels else F.lit(False)
    tagged = tagged.withColumns(codes)
    return ensure_levels(tagged, levels, adm0, iso3).select(*order, *told)


def _settle(lookup: AdminLookup, level: int, cx: Column, cy: Column) -> Column:
    """The code of one level from the joined lookup row."""
    here = F.col(f"L{level}")
    if lookup.index is None:
        return F.coalesce(here["owner"], here["near"])
    holding = F.filter(
        here["candidates"],
        lambda c: lookup.index.parity(cx, cy, c["edges"], c["base"]) == 1,
    )
    named = F.transform(holding, lambda c: F.struct(c["pcode"].alias("pcode"), c["name"].alias("name")))
    return F.coalesce(here["owner"], F.get(named, 0))


def _owned(lookup: AdminLookup, level: int) -> Column:
    """Whether the feature's cell, or the block of cells around it, has an owner."""
    owner = F.col(f"L{level}.owner")
    if lookup.blocks is not None:
        owner = F.coalesce(F.col(f"owners.O{level}"), owner)
    return owner.isNotNull()


def _settle_crowded(tagged: DataFrame, lookup: AdminLookup, cx: Column, cy: Column) -> DataFrame:
    any_busy = F.lit(False)
    for n in lookup.levels:
        any_busy = any_busy | F.coalesce(F.col(f"L{n}.busy"), F.lit(False))
    places = tagged.where(any_busy).select(cx.alias("_x"), cy.alias("_y")).distinct()
    pairs = S.pip_pairs(places, lookup.index, ["_x", "_y"], "_x", "_y")
    found = pairs.groupBy("_x", "_y").agg(
        *[
            F.min(F.when(F.col("level") == n, F.struct("pcode", "name"))).alias(f"_f{n}")
            for n in lookup.levels
        ]
    )
    tagged = tagged.join(found, (cx == F.col("_x")) & (cy == F.col("_y")), "left")
    for n in lookup.levels:
        tagged = tagged.withColumn(f"_t{n}", F.coalesce(f"_t{n}", f"_f{n}"))
    return tagged


def tag_report(tagged: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Per level: features, features with a code, share without one."""
    counts = tagged.agg(
        F.count("*").alias("total"), *[F.count(f"adm{n}_pcode").alias(f"m{n}") for n in levels]
    )
    rows = F.array(
        *[F.struct(F.lit(n).alias("level"), F.col(f"m{n}").alias("matched")) for n in levels]
    )
    share = F.when(F.col("total") > 0, 100.0 * (F.col("total") - F.col("r.matched")) / F.col("total"))
    return counts.select("total", F.explode(rows).alias("r")).select(
        F.col("r.level").alias("level"),
        "total",
        F.col("r.matched").alias("matched"),
        F.round(F.coalesce(share, F.lit(0.0)), 2).alias("null_percent"),
        F.when(F.col("r.matched") > 0, "tagged").otherwise("empty").alias("state"),
    )


def observe_tags(tagged: DataFrame, levels: Sequence[int]) -> tuple[DataFrame, Observation]:
    """The layer without its ``by_cell`` columns, and an observation that fills while the
    layer is written: nothing is read a second time for the report."""
    metrics = [F.count(F.lit(1)).alias("total")]
    for n in levels:
        metrics += [F.count_if(F.col(f"adm{n}_by_cell")).alias(f"cell{n}"), F.count(f"adm{n}_pcode").alias(f"final{n}")]
    seen = Observation()
    return tagged.observe(seen, *metrics).drop(*[f"adm{n}_by_cell" for n in levels]), seen


def observed_report(spark: SparkSession, seen: dict, levels: Sequence[int]) -> DataFrame:
    """Per level what was counted while a layer was written: features, those matched by
    their cell, the residual that went to the fallback, those matched in the end, the
    share without a code and the state of the level."""
    total = seen["total"]
    rows = []
    for n in levels:
        cell, final = seen[f"cell{n}"], seen[f"final{n}"]
        rows.append((n, total, cell, total - cell, final, total, "tagged" if final else "empty"))
    table = spark.createDataFrame(rows, "level int, total long, by_cell long, residual long, matched long, of long, state string")
    share = F.when(F.col("of") > 0, 100.0 * (F.col("of") - F.col("matched")) / F.col("of")).otherwise(0.0)
    return table.select("level", "total", "by_cell", "residual", "matched", F.round(share, 2).alias("null_percent"), "state")
