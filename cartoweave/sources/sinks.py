"""Writing layers. Every writer runs on the executors; nothing passes the driver."""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from cartoweave.functions import geom as G
from cartoweave.functions import wkt
from cartoweave.functions.grid import DEFAULT_STEP, lonlat
from cartoweave.operators.filters import categorise
from cartoweave.session import ship_package

# A row group of a GeoParquet file ends at the first of these.
ROW_GROUP_ROWS, ROW_GROUP_BYTES = 100_000, 64 << 20


def with_bbox(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumn("bbox", G.extent(geom))


def clustered(df: DataFrame, step: float = DEFAULT_STEP, partitions: int | None = None) -> DataFrame:
    """Rows with a ``bbox`` ranged and sorted by grid cell, so that a box filter skips row
    groups. A cell holding much of the data is spread by a second key."""
    box = F.col("bbox")
    cell = lonlat(step).cell((box["xmin"] + box["xmax"]) / 2, (box["ymin"] + box["ymax"]) / 2)
    keyed = df.withColumn("_cell", cell).withColumn("_x", box["xmin"])
    keys = ["_cell", "_x"]
    ranged = keyed.repartitionByRange(partitions, *keys) if partitions else keyed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop(*keys)


def write_clustered(df: DataFrame, path: str, step: float = DEFAULT_STEP, geom: str = "geom", partitions: int | None = None) -> None:
    """An extract sorted by grid cell."""
    (
        clustered(with_bbox(df, geom), step, partitions)
        .write.mode("overwrite")
        .option("compression", "zstd").option("parquet.block.size", str(32 * 1024 * 1024))
        .parquet(path)
    )


def write_layer(df: DataFrame, path: str, geom: str = "geom", mode: str = "overwrite") -> None:
    """The full layer as parquet: attributes, the geometry struct and its box."""
    with_bbox(df, geom).write.mode(mode).option("compression", "zstd").parquet(path)


def write_areas(df: DataFrame, path: str, geom: str = "geom") -> None:
    """A layer of several areas, a folder each. Areas of ``df`` replace those of the same
    name; others stay. Rows are not gathered by area, so a large one is many files."""
    boxed = with_bbox(df, geom)
    boxed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("iso3").parquet(path)


def read_areas(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer of several areas as ``write_areas`` left it; ``iso3`` is text whatever it
    looks like."""
    return spark.read.schema(schema).parquet(path)


def write_geojson(df: DataFrame, path: str, geom: str = "geom") -> None:
    """Newline-delimited GeoJSON Features."""
    properties = [c for c in df.columns if c not in (geom, "bbox")]
    df.select(wkt.to_feature(geom, properties).alias("value")).write.mode("overwrite").text(path)


KML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'
KML_TAIL = "</Document></kml>"


def _kml_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wraps the placemarks of one output file; a file without any stays empty."""

    def line(text: str, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([text], type=schema.field(0).type)], schema=schema)

    opened = None
    for batch in batches:
        if batch.num_rows and opened is None:
            opened = batch.schema
            yield line(KML_HEAD, opened)
        yield batch
    if opened is not None:
        yield line(KML_TAIL, opened)


def write_by_label(df: DataFrame, path: str, write, geom: str = "geom") -> None:
    """``write`` once per geometry class (three at most), each into its own folder."""
    labelled = with_label(df, geom)
    for label in G.GEOMETRY_LABELS:
        own = labelled.where(F.col("geometry_label") == label).drop("geometry_label")
        if not own.isEmpty():
            write(own, f"{path}/geometry_label={label}", geom)


def write_kml(df: DataFrame, path: str, geom: str = "geom") -> None:
    """KML documents, one per output file."""
    properties = [c for c in df.columns if c not in (geom, "bbox")]
    ship_package(df.sparkSession)
    marks = df.select(wkt.to_placemark(geom, properties).alias("value"))
    marks.mapInArrow(_kml_document, "value string").write.mode("overwrite").text(path)


def with_label(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Adds ``geometry_label``; kinds without a class are dropped."""
    return df.withColumn("geometry_label", G.label(geom)).where("geometry_label IS NOT NULL")


def write_split(df: DataFrame, path: str, fmt: str = "parquet", geom: str = "geom") -> None:
    """One output per geometry class, Multi kinds together with their single form."""
    labelled = with_label(df, geom)
    if fmt == "parquet":
        with_bbox(labelled, geom).write.mode("overwrite").partitionBy("geometry_label").parquet(path)
    elif fmt == "geojson":
        properties = [c for c in df.columns if c not in (geom, "bbox")]
        labelled.select(wkt.to_feature(geom, properties).alias("value"), "geometry_label").write.mode(
            "overwrite"
        ).partitionBy("geometry_label").text(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")


def stage_layers(df: DataFrame, root: str) -> None:
    """Layers with ``iso3``, ``source`` and ``slug`` columns under one staging root;
    a later run replaces only the layers it carries."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("iso3", "source", "slug").parquet(f"{root.rstrip('/')}/_layers")
    )


def staged_layers(spark: SparkSession, root: str, iso3: str, exclude_source: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{root.rstrip('/')}/_layers").where(F.col("iso3") == iso3.upper())
    return df.where(F.col("source") != exclude_source) if exclude_source is not None else df


def write_theme_cache(
    df: DataFrame, specs, root: str, snapshot: str, themes: Sequence[str] | None = None,
    existing: Sequence[str] = (),
) -> DataFrame:
    """One partition per category holding all tags; a theme that is written again is
    replaced, those in ``existing`` and all others are kept. Returns the manifest (theme, path, rows) read back from what was written."""
    wanted = [
        s for s in specs
        if s.osm.enabled and s.osm.filter and (not themes or s.slug in themes) and s.slug not in existing
    ]
    cached = categorise(df, wanted).withColumnRenamed("category", "theme").withColumn("snapshot", F.lit(snapshot))
    cached.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot", "theme").parquet(root)
    back = df.sparkSession.read.parquet(root).where(F.col("snapshot") == snapshot)
    path = F.concat_ws("/", F.lit(root), F.concat(F.lit("snapshot="), "snapshot"), F.concat(F.lit("theme="), "theme"))
    return (
        back.withColumn("snapshot", F.lit(snapshot)).groupBy("snapshot", "theme").agg(F.count("*").alias("rows")).withColumn("path", path)
    )


def cached_themes(spark: SparkSession, root: str, snapshot: str) -> list[str]:
    """Themes a snapshot already has (a handful of partition names)."""
    rows = spark.read.parquet(root).where(F.col("snapshot") == snapshot).select("theme").distinct()
    return sorted(r["theme"] for r in rows.collect())


def write_layer_metadata(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_layer_metadata(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


# --- GeoParquet -----------------------------------------------------------

# WKB codes of the geometry kinds.
WKB_CODES = {
    "POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6,
}


def _before(sizes: np.ndarray) -> np.ndarray:
    """Sum of all sizes before each one, and of all at the end."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _put(out: np.ndarray, data: np.ndarray, at: np.ndarray, values: np.ndarray | int, kind: str) -> None:
    """Writes ``values`` as little-endian numbers at the bytes ``at``, which hold no vertices."""
    coded = np.broadcast_to(np.asarray(values, kind), at.shape).copy().view(np.uint8).reshape(len(at), np.dtype(kind).itemsize)
    places = at[:, None] + np.arange(coded.shape[1])
    out[places] = coded
    data[places] = False


def encode_wkb(geoms: pa.StructArray) -> tuple[pa.Array, set[str], list[float] | None]:
    """Little-endian WKB of a batch of geometry structs, with the kinds written and their
    bounds. Where each header goes follows from the offsets of parts, rings and vertices;
    the vertices of the whole batch fill what lies between in one piece. Rows of unknown
    kind or without parts are null; a point without vertex has no numbers."""
    n = len(geoms)
    names = geoms.field("kind").to_pylist()
    code = np.array([WKB_CODES.get(k, 0) for k in names], np.int64)
    parts = geoms.field("parts")
    rings = parts.values
    points = rings.values.values
    part_at, ring_at, vertex_at = (a.offsets.to_numpy().astype(np.int64) for a in (parts, rings, rings.values))
    if not n:
        return pa.array([], type=pa.binary()), set(), None
    ring_at = ring_at[part_at[0] : part_at[-1] + 1]
    vertex_at = vertex_at[ring_at[0] : ring_at[-1] + 1]
    xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False)[vertex_at[0] : vertex_at[-1]] for c in ("x", "y")]).astype("<f8")
    part_at, ring_at, vertex_at = part_at - part_at[0], ring_at - ring_at[0], vertex_at - vertex_at[0]

    written = geoms.is_valid().to_numpy(zero_copy_only=False) & (code > 0) & (np.diff(part_at) > 0)
    multi = code > 3
    row = np.repeat(np.arange(n), np.diff(part_at))
    single = np.where(multi, code - 3, code)[row]
    # A simple kind is its first part; a point or line its first ring, a point its first vertex.
    own_part = written[row] & (multi[row] | (np.arange(len(row)) == part_at[row]))
    part = np.repeat(np.arange(len(row)), np.diff(ring_at))
    area, is_point = single[part] == 3, single[part] == 1
    own_ring = own_part[part] & (area | (np.arange(len(part)) == ring_at[part]))
    vertices = np.where(own_ring, np.diff(vertex_at), 0)
    vertices = np.where(is_point, np.minimum(vertices, 1), vertices)
    ring = np.repeat(np.arange(len(part)), np.diff(vertex_at))
    xy = xy[np.arange(len(xy)) - vertex_at[ring] < vertices[ring]]

    has_vertex = np.bincount(part, weights=vertices, minlength=len(row)) > 0
    bare = own_part & (single == 1) & ~has_vertex
    head = np.where(single == 1, 5, 9)
    ring_size = own_ring * np.where(area, 4, 0) + 16 * vertices
    ring_sum = _before(ring_size)
    part_size = own_part * (head + ring_sum[ring_at[1:]] - ring_sum[ring_at[:-1]] + 16 * bare)
    part_sum = _before(part_size)
    row_size = written * (9 * multi + part_sum[part_at[1:]] - part_sum[part_at[:-1]])
    row_start = _before(row_size)
    part_start = row_start[row] + 9 * multi[row] + part_sum[:-1] - part_sum[part_at[row]]
    ring_start = part_start[part] + head[part] + ring_sum[:-1] - ring_sum[ring_at[part]]

    out = np.zeros(int(row_start[-1]), np.uint8)
    data = np.ones(len(out), bool)
    some = np.flatnonzero(written & multi)
    for starts, codes, counts in (
        (row_start[some], code[some], np.diff(part_at)[some]),
        (part_start[own_part], single[own_part], None),
    ):
        _put(out, data, starts, 1, "u1")
        _put(out, data, starts + 1, codes, "<u4")
        if counts is not None:
            _put(out, data, starts + 5, counts, "<u4")
    lines, areas = own_part & (single == 2), own_part & (single == 3)
    in_part = np.bincount(part, weights=vertices, minlength=len(row)).astype(np.int64)
    _put(out, data, part_start[lines] + 5, in_part[lines], "<u4")
    _put(out, data, part_start[areas] + 5, np.diff(ring_at)[areas], "<u4")
    some = own_ring & area
    _put(out, data, ring_start[some], vertices[some], "<u4")
    for shift in (5, 13):
        _put(out, data, part_start[bare] + shift, np.nan, "<f8")
    out[data] = xy.reshape(-1).view(np.uint8)

    mask = np.packbits(written, bitorder="little")
    buffers = [pa.py_buffer(mask), pa.py_buffer(row_start.astype(np.int32)), pa.py_buffer(out)]
    bounds = [*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist()] if len(xy) else None
    kinds = {k for k, w in zip(names, written.tolist()) if w}
    return pa.Array.from_buffers(pa.binary(), n, buffers), kinds, bounds


def read_wkb(data: bytes) -> tuple[str | None, list[list[np.ndarray]]]:
    """Kind and parts of one WKB value, a ring being an array of (x, y) rows; heights
    and SRIDs are skipped."""
    names = {v: k for k, v in WKB_CODES.items()}

    def read(at: int):
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 9 if code & 0x20000000 else 5
        extra = int(bool(code & 0x80000000)) + int(bool(code & 0x40000000))
        code &= 0x0FFFFFFF
        width = 2 + max(extra, {0: 0, 1: 1, 2: 1, 3: 2}.get(code // 1000, 0))
        kind = names.get(code % 1000)
        if kind is None:
            return None, [], at

        def count(at: int):
            return struct.unpack_from(order + "I", data, at)[0], at + 4

        def ring(n: int, at: int):
            flat = np.frombuffer(data, dtype=order + "f8", count=n * width, offset=at)
            return flat.reshape(n, width)[:, :2], at + 8 * n * width

        if kind == "POINT":
            r, at = ring(1, at)
            return kind, [[r]], at
        n, at = count(at)
        if kind == "LINESTRING":
            r, at = ring(n, at)
            return kind, [[r]], at
        if kind == "POLYGON":
            rings = []
            for _ in range(n):
                m, at = count(at)
                r, at = ring(m, at)
                rings.append(r)
            return kind, [rings], at
        parts = []
        for _ in range(n):
            _, inner, at = read(at)
            parts.extend(inner)
        return kind, parts, at

    kind, parts, _ = read(0)
    return kind, parts


def _plain_wkb(data: bytes | None) -> bytes | None:
    """The value in the plain form: little-endian, two numbers a vertex, no SRID."""
    kind, parts = read_wkb(data) if data else (None, [])
    if kind is None:
        return None

    def rings(found: list[np.ndarray]) -> bytes:
        return b"".join(struct.pack("<I", len(r)) + r.astype("<f8").tobytes() for r in found)

    def single(name: str, part: list[np.ndarray]) -> bytes:
        start = struct.pack("<BI", 1, WKB_CODES[name])
        if name == "POINT":
            return start + part[0].astype("<f8").tobytes()
        return start + (rings(part) if name == "LINESTRING" else struct.pack("<I", len(part)) + rings(part))

    if not kind.startswith("MULTI"):
        return single(kind, parts[0])
    return struct.pack("<BII", 1, WKB_CODES[kind], len(parts)) + b"".join(single(kind[5:], p) for p in parts)


def _walk(data: np.ndarray, start: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the parts of plain values begin, where the vertices of their rings begin, how
    many these are, and which values have members that are not plain. All values take a
    step at a time: the head of a part, or a ring of an area."""

    def number(at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(data[at[:, None] + np.arange(4)]).view("<u4").reshape(-1).astype(np.int64)

    multi = code > 3
    at = np.where(multi, start + 9, start)
    members, areas = np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
    members[multi] = number(start[multi] + 5)
    odd = np.zeros(len(at), bool)
    empty = np.zeros(0, np.int64)
    parts, rings, counts = [empty], [empty], [empty]

    def ring(rows: np.ndarray, many: np.ndarray) -> None:
        rings.append(at[rows])
        counts.append(many)
        at[rows] += 16 * many

    while True:
        rows = np.flatnonzero((areas > 0) & ~odd)
        if len(rows):
            many = number(at[rows])
            at[rows] += 4
            ring(rows, many)
            areas[rows] -= 1
        rows = np.flatnonzero((areas == 0) & (members > 0) & ~odd)
        if not len(rows):
            if not ((areas > 0) & ~odd).any():
                return *map(np.concatenate, (parts, rings, counts)), odd
            continue
        kind = np.where(data[at[rows]] == 1, number(at[rows] + 1), 0)
        odd[rows] = kind != np.where(code[rows] > 3, code[rows] - 3, code[rows])
        kind, rows = kind[~odd[rows]], rows[~odd[rows]]
        parts.append(at[rows].copy())
        at[rows] += 5
        members[rows] -= 1
        ring(rows[kind == 1], np.ones(int((kind == 1).sum()), np.int64))
        many = number(at[rows[kind > 1]])
        at[rows[kind > 1]] += 4
        counted = kind[kind > 1]
        ring(rows[kind > 1][counted == 2], many[counted == 2])
        areas[rows[kind > 1][counted == 3]] = many[counted == 3]


def decode_wkb_array(values: pa.Array) -> pa.StructArray:
    """A batch of WKB values as geometry structs: values are walked together and their
    vertices taken out in one piece. Values in another form than the plain one (byte order,
    heights, SRID) are first rewritten one by one; empty and unknown ones are null."""
    values = pa.concat_arrays([values.cast(pa.binary())])
    n = len(values)
    sizes = np.diff(_offsets(values)) * values.is_valid().to_numpy(zero_copy_only=False)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    begin = _offsets(values)[:-1]
    filled = np.flatnonzero(sizes >= 9)
    code = np.zeros(n, np.int64)
    code[filled] = np.ascontiguousarray(data[begin[filled][:, None] + np.arange(1, 5)]).view("<u4").reshape(-1)
    plain = np.zeros(n, bool)
    plain[filled] = (data[begin[filled]] == 1) & (code[filled] >= 1) & (code[filled] <= 6)
    rows = np.flatnonzero(plain)
    parts, rings, counts, odd = _walk(data, begin[rows], code[rows])
    strange = np.concatenate([np.flatnonzero(~plain & (sizes > 0)), rows[odd]])
    if len(strange):
        rewritten = values.to_pylist()
        for i in strange.tolist():
            rewritten[i] = _plain_wkb(rewritten[i])
        return decode_wkb_array(pa.array(rewritten, pa.binary()))

    # Bytes come in the order of rows, parts and rings.
    order = np.argsort(rings, kind="stable")
    rings, counts, parts = rings[order], counts[order], np.sort(parts)
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, rings, 1)
    np.add.at(edges, rings + 16 * counts, -1)
    xy = data[np.cumsum(edges[:-1]) > 0].view("<f8").reshape(-1, 2)
    part_at = np.searchsorted(parts, np.append(begin, len(data)))
    # The byte before the vertices is the ring's own even if it has none.
    ring_at = np.append(np.searchsorted(rings - 1, parts), len(rings))

    def lists(offsets: np.ndarray, items: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), items)

    vertices = pa.StructArray.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], names=["x", "y"])
    nested = lists(part_at, lists(ring_at, lists(_before(counts), vertices)))
    names = {v: k for k, v in WKB_CODES.items()}
    kinds = pa.array([names[c] if p else None for c, p in zip(code.tolist(), plain.tolist())], pa.string())
    return pa.StructArray.from_arrays([kinds, nested], names=["kind", "parts"], mask=pa.array(~plain))


def _offsets(values: pa.Array) -> np.ndarray:
    """Offsets of a binary array that is no slice."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset).astype(np.int64)


def decode_wkb(df: DataFrame, column: str = "geometry", target: str = "geom") -> DataFrame:
    """Replaces a WKB column by the geometry struct, batch by batch at the scan edge."""
    ship_package(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name != column]
    order = df.select(*[f.name for f in keep], column)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(f.name) for f in keep] + [decode_wkb_array(batch.column(column))]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in keep] + [target])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [f"{target} {G.GEOM_TYPE}"])
    return order.mapInArrow(convert, schema)


class _Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class GeoParquetWriter(DataSourceArrowWriter):
    """Writes one file per task into a folder of the job's own; the commit makes the
    files of the successful attempts visible, so retried tasks leave no duplicates, and
    removes what was there before when the job overwrites."""

    def __init__(self, path: str, geometry: str, overwrite: bool = False):
        self.path, self.geometry, self.overwrite = path.rstrip("/"), geometry, overwrite
        self.pending = f"_pending-{uuid.uuid4().hex}"

    def _fs(self):
        from pyarrow import fs

        # ``write_geoparquet`` hands over paths with a scheme.
        if "://" not in self.path and not self.path.startswith("file:"):
            return fs.LocalFileSystem(), self.path
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.parquet as pq

        fs, root = self._fs()
        name, writer, kinds, bounds = None, None, set(), None
        held: list[pa.Table] = []

        def flush() -> None:
            if held:
                writer.write_table(pa.concat_tables(held), row_group_size=ROW_GROUP_ROWS)
                held.clear()

        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                wkb, seen, box = encode_wkb(batch.column(self.geometry))
                kinds.update(seen)
                if box is not None:
                    b = bounds or box
                    bounds = [min(b[0], box[0]), min(b[1], box[1]), max(b[2], box[2]), max(b[3], box[3])]
                rest = [n for n in batch.schema.names if n != self.geometry]
                table = pa.Table.from_arrays([batch.column(n) for n in rest] + [wkb], rest + ["geometry"])
                if writer is None:
                    name = f"part-{uuid.uuid4().hex}.parquet"
                    fs.create_dir(f"{root}/{self.pending}", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/{self.pending}/{name}", table.schema, filesystem=fs, compression="zstd", store_schema=False)
                # Batches are smaller than row groups should be.
                if held and (sum(t.num_rows for t in held) + table.num_rows > ROW_GROUP_ROWS or sum(t.nbytes for t in held) + table.nbytes > ROW_GROUP_BYTES):
                    flush()
                held.append(table)
            flush()
        finally:
            if writer is not None:
                covered = "bbox" in writer.schema.names
                writer.add_key_value_metadata({"geo": json.dumps(geo_metadata(kinds, bounds, covered))})
                writer.close()
        return _Written(name)

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector, FileType

        fs, root = self._fs()
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for info in fs.get_file_info(FileSelector(root)):
                if info.type == FileType.File:
                    fs.delete_file(info.path)
        for m in messages:
            if m is not None and m.name:
                fs.move(f"{root}/{self.pending}/{m.name}", f"{root}/{m.name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow.fs import FileType

        fs, root = self._fs()
        if fs.get_file_info(f"{root}/{self.pending}").type == FileType.Directory:
            fs.delete_dir(f"{root}/{self.pending}")


def geo_metadata(kinds: set[str], bounds: list[float] | None, covered: bool = False) -> dict:
    """The ``geo`` key of a file: kinds and bounds of its rows and, if rows have a ``bbox``,
    where readers find it."""
    column = {
        "encoding": "WKB",
        "geometry_types": sorted(G.GEOJSON_KINDS[k] for k in kinds if k in G.GEOJSON_KINDS),
    }
    if bounds:
        column["bbox"] = bounds
    if covered:
        column["covering"] = {"bbox": {c: ["bbox", c] for c in ("xmin", "ymin", "xmax", "ymax")}}
    return {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column}}


class GeoParquetDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cartoweave_geoparquet"

    def writer(self, schema, overwrite: bool) -> GeoParquetWriter:
        return GeoParquetWriter(self.options["path"], self.options.get("geometry", "geom"), overwrite)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark itself would give it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def write_geoparquet(df: DataFrame, path: str, geom: str = "geom", mode: str = "overwrite", cluster: bool = False) -> None:
    """GeoParquet files: WKB ``geometry``, the box of each row in ``bbox`` and the ``geo``
    footer key that names both. ``cluster`` sorts by grid cell first, one shuffle more, so
    that readers of a box skip files and row groups."""
    ship_package(df.sparkSession)
    df.sparkSession.dataSource.register(GeoParquetDataSource)
    boxed = with_bbox(df, geom)
    target = qualified(df.sparkSession, path)
    if target.startswith("file:/") and not target.startswith("file:///"):
        target = target.replace("file:/", "file:///")
    (clustered(boxed) if cluster else boxed).write.format("cartoweave_geoparquet").mode(mode).option("geometry", geom).save(target)


def read_geoparquet(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, target: str = "geom") -> DataFrame:
    """GeoParquet with its geometry as a struct, for rows whose ``bbox`` meets ``box`` if
    one is given: the test on the stored box reaches the parquet scan, so only what is left
    is decoded."""
    rows = spark.read.parquet(path)
    if box is not None:
        west, south, east, north = box
        b = F.col("bbox")
        rows = rows.where((b["xmin"] <= east) & (b["xmax"] >= west) & (b["ymin"] <= north) & (b["ymax"] >= south))
    return decode_wkb(rows, target=target)
