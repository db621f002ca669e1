"""Near-dedup by SimHash fingerprints and pigeonring filtering.

Fingerprints of 64 bits are cut into ``SEGMENTS`` segments on a ring. When two differ
in at most ``t`` bits, some segment starts a chain whose every prefix of ``k`` segments
differs in at most ``k * t / SEGMENTS`` bits. The first segments of such a chain, whose
budget is below one bit, are equal: they are the join key, one row per start. Within a
key the whole chain is tested, and only pairs that pass reach the full Hamming check.

Only distinct fingerprints travel, so copies cost nothing; a key with more than
``CROWD`` fingerprints goes on to longer keys (the next segments hold at most one
differing bit, so all but one of them are equal), which leaves at most 2^16
fingerprints to a key. Within a key, only the edges of a spanning forest are returned.

Larger distances (``max_distance`` above ``SEGMENTS // 2 - 1``) leave no selective key on
the ring and are refused.

Defined results: null or blank text has fingerprint 0, which links like any other; rows
that repeat a ``doc_id`` are each judged by their own text; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoweave.llm.common import as_bytes, one_of_each, prepare, staged, texts
from cartoweave.llm.components import components

SEGMENTS = 8
WIDTH = 64 // SEGMENTS
SEED = 42
CROWD = 512
BLOCK = 1 << 16
CHUNK = 1 << 15


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle of ``words`` words, repeats included; A-Z lower-cased."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    joined = b" ".join(parts)
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[: len(parts) - words])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :])], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(text, words)) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    source = texts(docs, id_col, text_col)
    kind = source.schema["__id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, fp long")


def _mask(start: int, count: int) -> int:
    """The bits of ``count`` segments from ``start`` on round the ring, as a signed long."""
    value = 0
    for k in range(count):
        value |= ((1 << WIDTH) - 1) << (WIDTH * ((start + k) % SEGMENTS))
    return value - (1 << 64) if value >> 63 else value


def chain_keys(fp: Column, max_distance: int) -> Column:
    """One key per start: the segments whose cumulative budget is below one bit."""
    equal = SEGMENTS if max_distance == 0 else -(-SEGMENTS // max_distance) - 1
    return F.array(*[F.struct(F.lit(i).alias("start"), fp.bitwiseAND(F.lit(_mask(i, equal))).alias("bits")) for i in range(SEGMENTS)])


def longer_keys(fp: Column, start: Column) -> Column:
    """For distance 2: three equal segments, then four of which at most one differs."""
    options = F.array()
    whens = None
    for i in range(SEGMENTS):
        made = []
        for j in range(3, 7):
            mask = _mask(i, 7) & ~_mask((i + j) % SEGMENTS, 1)
            made.append(F.struct(F.lit(SEGMENTS + i * SEGMENTS + j).alias("start"), fp.bitwiseAND(F.lit(mask)).alias("bits")))
        options = F.array(*made)
        whens = F.when(start == i, options) if whens is None else whens.when(start == i, options)
    return whens


def chain_passes(diff: np.ndarray, start: np.ndarray, max_distance: int) -> np.ndarray:
    """Whether the chain from ``start`` keeps each of its prefixes within budget."""
    ok = np.ones(len(diff), bool)
    total = np.zeros(len(diff), np.int64)
    low = np.uint64((1 << WIDTH) - 1)
    for k in range(SEGMENTS):
        shift = (WIDTH * ((start + k) % SEGMENTS)).astype(np.uint64)
        total += np.bitwise_count((diff >> shift) & low)
        ok &= total * SEGMENTS <= (k + 1) * max_distance
    return ok


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest_edges(starts: np.ndarray, bits: np.ndarray, prints: np.ndarray, max_distance: int) -> tuple[list[int], list[int]]:
    """Rows sorted by key: edges of a spanning forest of the linked pairs within each key."""
    left, right, forest = [], [], _Forest()
    values = prints.view(np.uint64)
    rows = np.arange(len(prints))
    step = 1
    while len(rows):
        rows = rows[rows + step < len(prints)]
        rows = rows[(bits[rows] == bits[rows + step]) & (starts[rows] == starts[rows + step])]
        if not len(rows):
            break
        diff = values[rows] ^ values[rows + step]
        begin = starts[rows]
        begin = np.where(begin < 0, -1 - begin, np.where(begin >= SEGMENTS, begin // SEGMENTS - 1, begin))
        near = chain_passes(diff, begin, max_distance)
        near[near] = np.bitwise_count(diff[near]) <= max_distance
        for at in rows[near].tolist():
            a, b = int(prints[at]), int(prints[at + step])
            if forest.join(a, b):
                left.append(a)
                right.append(b)
        step += 1
    return left, right


def _linker(max_distance: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, rows]).combine_chunks() if held is not None and held.num_rows else rows
            if held.num_rows < CHUNK:
                continue
            start, bits = (held.column(i).to_numpy() for i in (0, 1))
            changes = np.flatnonzero((start[1:] != start[:-1]) | (bits[1:] != bits[:-1]))
            if not len(changes):
                continue
            cut = int(changes[-1]) + 1
            yield _edges(held.slice(0, cut), schema)
            held = held.slice(cut)
        if held is not None and held.num_rows:
            yield _edges(held, schema)

    def _edges(rows: pa.Table, schema: pa.Schema) -> pa.RecordBatch:
        start, bits, prints = (rows.column(i).to_numpy() for i in range(3))
        left, right = _forest_edges(np.asarray(start, np.int64), bits, np.ascontiguousarray(prints), max_distance)
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    return run


def _edges_of(keyed: DataFrame, max_distance: int) -> DataFrame:
    return (
        keyed.select("start", "bits", "fp")
        .repartition("start", "bits")
        .sortWithinPartitions("start", "bits", "fp")
        .mapInArrow(_linker(max_distance), "a long, b long")
    )


def _in_block_pairs(keyed: DataFrame, crowd: int) -> DataFrame:
    """Crowded keys cut into blocks of about ``crowd`` fingerprints; each pair of blocks
    is a key of its own, so every pair still meets and no group outgrows a task."""
    crowded = staged(keyed.groupBy("start", "bits").count().where(F.col("count") > crowd).select("start", "bits", F.ceil(F.col("count") / crowd).cast("int").alias("blocks")))
    marked = keyed.join(crowded, ["start", "bits"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    split = marked.where(F.col("blocks").isNotNull()).select("start", "bits", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = F.xxhash64("start", "bits", F.least("own", "other"), F.greatest("own", "other"))
    return marked.where(F.col("blocks").isNull()).select("start", "bits", "fp").unionByName(split.select((F.lit(-1) - F.col("start")).alias("start"), pair.alias("bits"), "fp"))


def links(prints: DataFrame, max_distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that join all within ``max_distance``."""
    if max_distance >= SEGMENTS // 2:
        raise ValueError(f"the ring has no selective keys at {max_distance} bits")
    keyed = prints.select("fp", F.explode(chain_keys(F.col("fp"), max_distance)).alias("key")).select("fp", "key.start", "key.bits")
    if max_distance < 2:
        # Keys of 56 bits and more: at most 256 fingerprints share one.
        return _edges_of(keyed, max_distance)
    if max_distance != 2:
        return _edges_of(_in_block_pairs(keyed, crowd), max_distance)
    crowded = staged(keyed.groupBy("start", "bits").count().where(F.col("count") > crowd).select("start", "bits", F.lit(True).alias("crowded")))
    marked = keyed.join(crowded, ["start", "bits"], "left")
    few = _edges_of(marked.where(F.col("crowded").isNull()), max_distance)
    many = (
        keyed.join(crowded.select("start", "bits"), ["start", "bits"], "left_semi")
        .select("fp", F.explode(longer_keys(F.col("fp"), F.col("start"))).alias("key"))
        .select("fp", "key.start", "key.bits")
    )
    return few.unionByName(_edges_of(many, max_distance))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document: the component is the
    smallest ``doc_id`` reachable over links of at most ``max_distance`` bits."""
    prepare(docs.sparkSession)
    prints = staged(fingerprints(docs, id_col, text_col, words))
    own = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = staged(links(prints.select("fp").distinct(), max_distance, crowd))
    rooted = components(linked)
    whole = own.join(rooted.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = staged(whole)
    # A root without links is its own class, and its least document is at hand already.
    classes = rooted.select("root").distinct().join(whole, "root").groupBy("root").agg(F.min("least").alias("component_id"))
    labels = whole.join(classes, "root", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return prints.select("doc_id", "fp").join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, the one of least id, all columns kept."""

    def find(rows: DataFrame) -> DataFrame:
        return near_components(rows, "row", "text", **options).withColumnRenamed("component_id", "keep_id")

    return one_of_each(docs, id_col, text_col, find)
