"""From element tables (nodes, ways, relations) to features, and polygon extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.functions import geom as G
from cartoweave.functions.grid import DEFAULT_STEP
from cartoweave.operators import spatial as S
from cartoweave.operators.filters import tag_predicate
from cartoweave.session import staged

# Tag keys that make a closed way an area.
AREA_KEYS = (
    "building", "landuse", "natural", "leisure", "amenity", "boundary", "place", "shop", "tourism",
    "water", "aeroway", "office", "historic", "military", "area:highway", "building:part",
)
# Types of relations that are areas.
RING_TYPES = ("multipolygon", "boundary")
STRATEGIES = ("simple", "complete_ways", "smart")


def is_area(tags: Column) -> Column:
    yes = F.coalesce(tags["area"], F.lit("")) == "yes"
    no = F.coalesce(tags["area"], F.lit("")) == "no"
    keyed = F.arrays_overlap(F.map_keys(tags), F.array(*[F.lit(k) for k in AREA_KEYS]))
    return yes | (F.coalesce(keyed, F.lit(False)) & ~no)


def way_vertices(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(id, vertices)``: the positions of a way's nodes in order. A way has at most
    a few thousand nodes by the data model, so one way's list is small; nodes that
    are missing from the extract are left out."""
    refs = ways.select("id", F.posexplode("refs").alias("i", "ref"))
    at = nodes.select(F.col("id").alias("ref"), "x", "y")
    return (
        refs.join(at, "ref")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("v"))
        .select("id", F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("vertices"))
    )


def assemble_features(
    nodes: DataFrame,
    ways: DataFrame,
    relations: DataFrame | None = None,
    tag_filter: dict | None = None,
    step: float = DEFAULT_STEP,
) -> DataFrame:
    """``(feature_id, tags, geom)`` with *all* tags of every element the filter lets
    through, and ``status``. nodes: (id, tags, x, y); ways: (id, tags, refs); relations:
    (id, tags, members<ref, role[, type]>). Of relations whose ``type`` tag is missing,
    multipolygon or boundary, the member ways are joined to rings at their end nodes.
    ``status`` is ``open`` for relations some of whose ways close no ring; those ways
    add nothing to the geometry.
    """
    wanted = tag_predicate(tag_filter or {})
    points = nodes.where(F.size("tags") > 0).where(wanted).select(
        F.concat(F.lit("node/"), F.col("id").cast("string")).alias("feature_id"), "tags", G.point("x", "y").alias("geom"),
        F.lit("whole").alias("status"),
    )
    kept = ways.where(wanted)
    shaped = kept.select("id", "tags").join(way_vertices(kept, nodes), "id")
    v = F.col("vertices")
    closed_way = (F.size(v) >= 4) & (F.element_at(v, 1) == F.element_at(v, -1))
    lines = shaped.where(F.size(v) >= 2).select(
        F.concat(F.lit("way/"), F.col("id").cast("string")).alias("feature_id"), "tags",
        F.when(closed_way & is_area(F.col("tags")), G.polygon(v)).otherwise(G.line(v)).alias("geom"),
        F.lit("whole").alias("status"),
    )
    out = points.unionByName(lines)
    if relations is not None:
        kind = F.coalesce(F.col("tags")["type"], F.lit(RING_TYPES[0]))
        out = out.unionByName(_multipolygons(relations.where(wanted).where(kind.isin(*RING_TYPES)), ways, nodes, step))
    return out


def member_ways(relations: DataFrame) -> DataFrame:
    """``(rel, id, role)`` of the members that are ways; inner or outer, the latter also
    where the role is left out."""
    fields = relations.schema["members"].dataType.elementType.names
    members = relations.select(F.col("id").alias("rel"), F.explode("members").alias("m"))
    if "type" in fields:
        members = members.where(F.coalesce(F.lower("m.type"), F.lit("way")).isin("way", "w"))
    role = F.when(F.col("m.role") == "inner", "inner").when(F.coalesce(F.col("m.role"), F.lit("")).isin("outer", ""), "outer")
    return members.select("rel", F.col("m.ref").alias("id"), role.alias("role")).where("role IS NOT NULL").distinct()


def _doubled(state: DataFrame, key: list[str], rounds: int, **merged: Column) -> DataFrame:
    """``state(key..., w, jump, rounds, ...)`` after pointer doubling: each round a walk takes
    over the pointer of the walk it points at, and merges its own values with ``_name``,
    those found there. A group stays for its own ``rounds``; then its walks are settled and
    are neither read nor written again."""
    settled = []
    for done in range(rounds):
        if done:
            settled.append(state.where(F.col("rounds") == done))
        open_ = state.where(F.col("rounds") > done)
        ahead = open_.select(*key, F.col("w").alias("jump"), F.col("jump").alias("_jump"), *[F.col(c).alias(f"_{c}") for c in merged])
        values = [merged[c].alias(c) if c in merged else F.col("_jump").alias(c) if c == "jump" else F.col(c) for c in state.columns]
        state = staged(open_.join(ahead, [*key, "jump"], "left").select(*values))
    for part in settled:
        state = state.unionByName(part)
    return state


def close_rings(members: DataFrame, ways: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rel, role, way, ring)``, the ring named by its least way, and ``(rel)`` of the
    relations with ways left over.

    Ways of one relation and role that end in the same node follow each other; where
    more than two end, they pair off in the order of their ids. Each open way is walked
    in both directions. Pointers double every round, so the rounds of a relation grow with
    the log of its own ways, and it leaves when they are over, while larger ones go on:
    first they find the least way that each walk comes by, or that it ends, then how far
    each way is from there, which orders the ring.
    """
    used = ways.join(members.select("id").distinct(), "id", "left_semi")
    ends = used.where(F.size("refs") >= 2).select(
        "id", F.element_at("refs", 1).alias("first"), F.element_at("refs", -1).alias("last"), F.size("refs").alias("n")
    )
    shaped = way_vertices(used, nodes)
    placed = members.join(ends, "id")
    whole = placed.where("first = last AND n >= 4").join(shaped, "id").where(F.size("vertices") >= 3).select(
        "rel", "role", F.col("id").alias("way"), G.closed(F.col("vertices")).alias("ring")
    )
    loose = staged(placed.where("first <> last").select("rel", "role", "id", "first", "last"))
    odd = placed.where("first = last AND n < 4").select("rel")
    key = ["rel", "role"]
    # Twice as many walks as ways.
    sizes = loose.groupBy(*key).agg(F.greatest(F.lit(1), F.ceil(F.log2(2.0 * F.count("*"))).cast("int")).alias("rounds"))
    rounds = sizes.agg(F.max("rounds")).first()[0]
    if not rounds:
        return whole, odd.distinct()
    # A walk along a way is twice its id, plus one for the way back.
    walks = loose.select(*key, (F.col("id") * 2).alias("w"), F.col("first").alias("at")).unionByName(
        loose.select(*key, (F.col("id") * 2 + 1).alias("w"), F.col("last").alias("at"))
    )
    order = Window.partitionBy(*key, "at").orderBy("w")
    number = F.row_number().over(order)
    partner = F.when(number % 2 == 1, F.lead("w").over(order)).otherwise(F.lag("w").over(order))
    back = F.col("w").bitwiseXOR(F.lit(1).cast("bigint"))
    follow = staged(walks.select(*key, back.alias("w"), partner.alias("next")).join(sizes, key))

    state = follow.select(*key, "w", F.col("next").alias("jump"), F.least("w", F.coalesce("next", "w")).alias("least"), "rounds")
    state = _doubled(state, key, rounds, least=F.least("least", F.coalesce("_least", "least")))
    # Of the two directions of a ring, the one that walks its least way forward.
    walked = state.where("jump IS NOT NULL AND least % 2 = 0").select(*key, "w", "least")
    chain = walked.join(follow, [*key, "w"]).withColumn("jump", F.when(F.col("next") != F.col("least"), F.col("next")))
    chain = staged(chain.select(*key, "w", "least", "jump", F.col("jump").isNotNull().cast("int").alias("left"), "rounds"))
    chain = _doubled(chain, key, rounds, left=F.col("left") + F.coalesce("_left", F.lit(0)))
    forward = F.col("w") % 2 == 0
    v = F.when(forward, F.col("vertices")).otherwise(F.reverse("vertices"))
    # The last vertex of a way is the first of the next.
    piece = F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0)))
    joined = (
        chain.withColumn("id", F.floor(F.col("w") / 2).cast("bigint")).join(shaped, "id")
        .groupBy(*key, "least")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("o"), piece.alias("v")))).alias("p"))
        .select(*key, F.floor(F.col("least") / 2).cast("bigint").alias("way"), F.flatten(F.transform("p", lambda e: e["v"])).alias("ring"))
        .where(F.size("ring") >= 3)
        .select(*key, "way", G.closed(F.col("ring")).alias("ring"))
    )
    unclosed = state.where("jump IS NULL").select("rel").unionByName(odd).distinct()
    return whole.unionByName(joined), unclosed


def _multipolygons(relations: DataFrame, ways: DataFrame, nodes: DataFrame, step: float) -> DataFrame:
    """Outer rings become shells; an inner ring is a hole of the outer ring that contains
    its first vertex."""
    rings, unclosed = close_rings(member_ways(relations), ways, nodes)
    outer = rings.where("role = 'outer'").select("rel", F.col("way").alias("shell"), F.col("ring").alias("outer"))
    inner = rings.where("role = 'inner'").select("rel", F.col("way").alias("hole"), F.col("ring").alias("inner"))
    # Only shells of relations that have holes are indexed; a hole then meets the
    # shells of its own relation in its own cell.
    shells = outer.join(inner.select("rel").distinct(), "rel", "left_semi").select(
        "rel", "shell", G.make("POLYGON", F.array(F.array("outer"))).alias("geom")
    )
    starts = inner.select("rel", "hole", F.col("inner")[0]["x"].alias("x"), F.col("inner")[0]["y"].alias("y"))
    index = S.build_index(shells, ["rel", "shell"], step)
    owner = S.pip_pairs(starts, index, ["rel", "hole"], same=["rel"]).groupBy("rel", "hole").agg(F.min("shell").alias("shell"))
    holes = (
        inner.join(owner, ["rel", "hole"])
        .groupBy("rel", "shell")
        .agg(F.sort_array(F.collect_list(F.struct("hole", F.col("inner").alias("ring")))).alias("hs"))
    )
    parts = outer.join(holes, ["rel", "shell"], "left").select(
        "rel", "shell",
        F.concat(F.array("outer"), F.coalesce(F.transform("hs", lambda h: h["ring"]), F.array())).alias("part"),
    )
    geoms = parts.groupBy("rel").agg(F.sort_array(F.collect_list(F.struct("shell", "part"))).alias("ps"))
    marked = unclosed.select(F.col("rel").alias("id"), F.lit("open").alias("_open"))
    return relations.select("id", "tags").join(geoms.withColumnRenamed("rel", "id"), "id").join(marked, "id", "left").select(
        F.concat(F.lit("relation/"), F.col("id").cast("string")).alias("feature_id"), "tags",
        G.make("MULTIPOLYGON", F.transform("ps", lambda p: p["part"])).alias("geom"),
        F.coalesce("_open", F.lit("whole")).alias("status"),
    )


def extract_elements(
    nodes: DataFrame,
    ways: DataFrame,
    boundary: DataFrame,
    strategy: str = "complete_ways",
    relations: DataFrame | None = None,
    step: float = DEFAULT_STEP,
) -> dict[str, DataFrame]:
    """Elements inside a polygon. ``simple``: nodes inside, and the ways touching them
    with their refs cut to those nodes. ``complete_ways``: the ways stay whole and
    bring all their nodes. ``smart``: relations with a member kept bring their other
    member ways, and those their nodes."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {list(STRATEGIES)}, got {strategy!r}")
    inside = S.points_within(nodes, S.boundary_index(boundary, step), "id")
    inside_ids = inside.select(F.col("id").alias("ref"))
    refs = ways.select("id", F.posexplode("refs").alias("i", "ref"))
    held = refs.join(inside_ids, "ref", "left_semi")
    if strategy == "simple":
        cut = held.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("i", "ref"))).alias("r")).select(
            "id", F.transform("r", lambda e: e["ref"]).alias("refs")
        )
        attributes = [c for c in ways.columns if c != "refs"]
        return {"nodes": inside, "ways": ways.select(*attributes).join(cut, "id")}

    way_ids = held.select("id").distinct()
    out: dict[str, DataFrame] = {}
    if strategy == "smart" and relations is not None:
        members = relations.select(F.col("id").alias("rel"), F.explode("members").alias("m")).select(
            "rel", F.col("m.ref").alias("id")
        )
        touched = members.join(way_ids, "id", "left_semi").select("rel").distinct()
        more = members.join(touched, "rel", "left_semi").select("id")
        way_ids = way_ids.unionByName(more).distinct()
        out["relations"] = relations.join(touched.withColumnRenamed("rel", "id"), "id", "left_semi")
    whole = ways.join(way_ids, "id", "left_semi")
    node_ids = (
        refs.join(way_ids, "id", "left_semi").select(F.col("ref").alias("id"))
        .unionByName(inside.select("id")).distinct()
    )
    out["ways"] = whole
    out["nodes"] = nodes.join(node_ids, "id", "left_semi")
    return out
