"""Rings joined from member ways, against outlines cut at random."""

import random

import pytest

from cartoweave.functions import wkt
from cartoweave.operators import elements as E

MEMBERS = "array<struct<ref:bigint,role:string,type:string>>"


def build(spark, outlines, relations, cut_seed):
    """Cuts each closed outline into ways at random places, some reversed. ``relations``:
    id -> (tags, [(outline, role)])."""
    r = random.Random(cut_seed)
    nodes, ways, members = [], [], {}
    for name, outline in outlines.items():
        ids = []
        for x, y in outline:
            nodes.append((len(nodes) + 1, {}, float(x), float(y)))
            ids.append(len(nodes))
        cuts = sorted(r.sample(range(len(ids)), r.randrange(1, min(5, len(ids)))))
        loop = ids[cuts[0] :] + ids[: cuts[0]] + [ids[cuts[0]]]
        at = [c - cuts[0] for c in cuts] + [len(ids)]
        members[name] = []
        for a, b in zip(at, at[1:]):
            refs = loop[a : b + 1]
            if r.random() < 0.5:
                refs.reverse()
            ways.append((len(ways) + 1, {}, refs))
            members[name].append(len(ways))
    rels = []
    for rel, (tags, parts) in relations.items():
        listed = [(w, role, "way") for name, role in parts for w in members[name]]
        r.shuffle(listed)
        rels.append((rel, tags, listed))
    return nodes, ways, rels, members


def frames(spark, nodes, ways, rels):
    return (
        spark.createDataFrame(nodes, "id bigint, tags map<string,string>, x double, y double"),
        spark.createDataFrame(ways, "id bigint, tags map<string,string>, refs array<bigint>"),
        spark.createDataFrame(rels, f"id bigint, tags map<string,string>, members {MEMBERS}"),
    )


def canonical(ring):
    """A closed ring without its start and direction."""
    body = [(v["x"], v["y"]) for v in ring[:-1]]
    turns = [body[i:] + body[:i] for i in range(len(body))]
    back = body[::-1]
    turns += [back[i:] + back[:i] for i in range(len(back))]
    return min(tuple(t) for t in turns)


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_outlines_come_back(spark, seed):
    r = random.Random(seed)
    outlines, relations = {}, {}
    for k in range(12):
        x = 10 * k
        outlines[f"o{k}"] = [(x, 0), (x + 8, 0), (x + 8, 3), (x + 9, 5), (x + 8, 8), (x + 4, 9), (x, 8), (x - 0.5, 4)]
        outlines[f"i{k}"] = square(x + 2, 2, 1)
        outlines[f"j{k}"] = square(x + 5, 5, 1)
        parts = [(f"o{k}", r.choice(["outer", ""])), (f"i{k}", "inner"), (f"j{k}", "inner")]
        relations[100 + k] = ({"natural": "water", "type": r.choice(["multipolygon", "boundary"])}, parts)
    nodes, ways, rels, _ = build(spark, outlines, relations, seed)
    got = E.assemble_features(*frames(spark, nodes, ways, rels), {"natural": True}, step=2.0).where("feature_id LIKE 'relation/%'").collect()
    assert {x["feature_id"] for x in got} == {f"relation/{100 + k}" for k in range(12)}
    for x in got:
        k = int(x["feature_id"].split("/")[1]) - 100
        (part,) = x["geom"]["parts"]
        want = [canonical([{"x": float(a), "y": float(b)} for a, b in [*o, o[0]]]) for o in (outlines[f"o{k}"], outlines[f"i{k}"], outlines[f"j{k}"])]
        rings = [canonical([v.asDict() for v in ring]) for ring in part]
        assert rings[0] == want[0] and sorted(rings[1:]) == sorted(want[1:])
        assert x["status"] == "whole"


def test_ways_that_close_nothing_are_reported(spark):
    nodes = [(i + 1, {}, float(x), float(y)) for i, (x, y) in enumerate([*square(0, 0, 2), *square(5, 5, 1)])]
    ways = [(1, {}, [1, 2, 3]), (2, {}, [3, 4, 1]), (3, {}, [5, 6, 7])]
    rels = [
        (1, {"natural": "wood"}, [(1, "outer", "way"), (2, "outer", "way")]),
        (2, {"natural": "wood"}, [(1, "outer", "way"), (2, "outer", "way"), (3, "outer", "way"), (1, "label", "node")]),
        (3, {"natural": "wood"}, [(3, "outer", "way")]),
        (4, {"natural": "wood", "type": "route"}, [(1, "outer", "way"), (2, "outer", "way")]),
        # A node member of the same number as a way is not that way.
        (5, {"natural": "wood"}, [(1, "outer", "way"), (2, "outer", "node")]),
    ]
    out = E.assemble_features(*frames(spark, nodes, ways, rels), {"natural": True}).select("feature_id", "status", wkt.to_wkt("geom").alias("t")).collect()
    got = {x["feature_id"]: (x["status"], x["t"]) for x in out}
    square_text = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)))"
    assert got == {"relation/1": ("whole", square_text), "relation/2": ("open", square_text)}


def test_many_ways_in_one_ring(spark):
    import math

    n = 150
    nodes = [(i, {}, math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    ways = [(i, {}, [i, (i + 1) % n] if i % 3 else [(i + 1) % n, i]) for i in range(n)]
    rels = [(1, {"boundary": "x"}, [(i, "outer", "way") for i in range(n)])]
    (row,) = E.assemble_features(*frames(spark, nodes, ways, rels), {"boundary": True}).collect()
    (ring,) = row["geom"]["parts"][0]
    want = [{"x": x, "y": y} for _, _, x, y in nodes]
    assert canonical([v.asDict() for v in ring]) == canonical([*want, want[0]])


def test_settled_relations_leave_the_rounds(spark, monkeypatch):
    outlines = {f"s{k}": square(4 * k, 0, 2) for k in range(10)}
    nodes, ways, rels, _ = build(spark, outlines, {100 + k: ({"natural": "wood"}, [(f"s{k}", "outer")]) for k in range(10)}, 3)
    first, n = len(nodes) + 1, 40
    nodes += [(first + i, {}, 100.0 + i, float(i * (n - i))) for i in range(n)]
    ways += [(1000 + i, {}, [first + i, first + (i + 1) % n]) for i in range(n)]
    rels.append((1, {"natural": "wood"}, [(1000 + i, "outer", "way") for i in range(n)]))
    written = []
    kept = E.staged

    def noted(df):
        out = kept(df)
        if {"jump", "least"} <= set(out.columns):
            written.append({r["rel"] for r in out.select("rel").distinct().collect()})
        return out

    monkeypatch.setattr(E, "staged", noted)
    got = E.assemble_features(*frames(spark, nodes, ways, rels), {"natural": True}, step=2.0).where("feature_id LIKE 'relation/%'").collect()
    assert {x["feature_id"] for x in got} == {"relation/1", *(f"relation/{100 + k}" for k in range(10))}
    assert {x["status"] for x in got} == {"whole"}
    assert len(written[0]) > 1 and written[-1] == {1}
