"""WKB by offsets against a value-by-value writer."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest

from cartoweave.sources import sinks

GEOM = pa.struct([
    ("kind", pa.string()),
    ("parts", pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))),
])


def by_hand(row, order="<"):
    """WKB of one geometry, a number at a time."""
    if row is None or row["kind"] not in sinks.WKB_CODES or not row["parts"]:
        return None

    def ring(r):
        return b"".join(struct.pack(order + "dd", v["x"], v["y"]) for v in r)

    def head(kind):
        return struct.pack(order + "BI", order == "<", sinks.WKB_CODES[kind])

    def single(kind, part):
        if kind == "POINT":
            return head(kind) + ring(part[0][:1])
        if kind == "LINESTRING":
            return head(kind) + struct.pack(order + "I", len(part[0])) + ring(part[0])
        return head(kind) + struct.pack(order + "I", len(part)) + b"".join(struct.pack(order + "I", len(r)) + ring(r) for r in part)

    kind = row["kind"]
    if kind.startswith("MULTI"):
        return head(kind) + struct.pack(order + "I", len(row["parts"])) + b"".join(single(kind[5:], p) for p in row["parts"])
    return single(kind, row["parts"][0])


def made(seed, n=200):
    """Geometries of every kind, nulls among them."""
    r = np.random.default_rng(seed)

    def ring(k):
        return [{"x": float(x), "y": float(y)} for x, y in r.normal(size=(k, 2))]

    def part(kind):
        if kind.endswith("POINT"):
            return [ring(1)]
        if kind.endswith("LINESTRING"):
            return [ring(int(r.integers(0, 6)))]
        return [ring(int(r.integers(0, 7))) for _ in range(r.integers(1, 5))]

    rows = []
    for _ in range(n):
        kind = r.choice([*sinks.WKB_CODES, "none"])
        if kind == "none":
            rows.append(None)
        else:
            rows.append({"kind": str(kind), "parts": [part(kind) for _ in range(r.integers(1, 5) if kind.startswith("MULTI") else 1)]})
    return rows


@pytest.mark.parametrize("seed", range(8))
def test_every_kind_is_written_and_read(seed):
    rows = made(seed)
    found, kinds, bounds = sinks.encode_wkb(pa.array(rows, GEOM))
    assert found.to_pylist() == [by_hand(r) for r in rows]
    assert kinds == {r["kind"] for r in rows if r}
    xs = [v["x"] for r in rows if r for p in r["parts"] for ring in p for v in ring]
    assert bounds[0] == min(xs) and bounds[2] == max(xs)
    assert sinks.decode_wkb_array(found).to_pylist() == rows


def test_slices_count_their_own_rows_only():
    rows = made(11)
    found, kinds, bounds = sinks.encode_wkb(pa.array(rows, GEOM).slice(50, 30))
    assert found.to_pylist() == [by_hand(r) for r in rows[50:80]]
    assert kinds == {r["kind"] for r in rows[50:80] if r}
    whole, _, _ = sinks.encode_wkb(pa.array(rows, GEOM))
    assert sinks.decode_wkb_array(whole.slice(50, 30)).to_pylist() == rows[50:80]


def test_other_forms_are_read():
    rows = [r for r in made(12) if r]
    coded = [by_hand(r, "<>"[i % 2]) for i, r in enumerate(rows)]
    assert sinks.decode_wkb_array(pa.array(coded, pa.binary())).to_pylist() == rows
    # Outer value little-endian, member big-endian.
    mixed = struct.pack("<BII", 1, 4, 1) + struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    height = struct.pack("<BIddd", 1, 1001, 5.0, 6.0, 7.0)
    tagged = struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, 8.0, 9.0)
    collection = struct.pack("<BII", 1, 7, 0)
    back = sinks.decode_wkb_array(pa.array([mixed, None, height, tagged, collection, b""], pa.binary())).to_pylist()
    point = lambda x, y: [[[{"x": x, "y": y}]]]
    assert back == [
        {"kind": "MULTIPOINT", "parts": point(3.0, 4.0)}, None, {"kind": "POINT", "parts": point(5.0, 6.0)},
        {"kind": "POINT", "parts": point(8.0, 9.0)}, None, None,
    ]


def test_nothing_and_empty_parts():
    assert sinks.encode_wkb(pa.array([], GEOM))[0].to_pylist() == []
    assert sinks.decode_wkb_array(pa.array([], pa.binary())).to_pylist() == []
    rows = [None, {"kind": "LINESTRING", "parts": []}, {"kind": "GEOMETRYCOLLECTION", "parts": [[[{"x": 1.0, "y": 2.0}]]]}, {"kind": "POLYGON", "parts": [[]]}]
    found, kinds, bounds = sinks.encode_wkb(pa.array(rows, GEOM))
    assert found.to_pylist() == [None, None, None, struct.pack("<BII", 1, 3, 0)]
    assert kinds == {"POLYGON"} and bounds is None
    assert sinks.decode_wkb_array(found).to_pylist() == [None, None, None, {"kind": "POLYGON", "parts": [[]]}]
