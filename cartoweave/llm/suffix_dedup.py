"""Removal of long byte strings that occur more than once, by sorting suffixes.

Only suffixes that can have an equal are sorted. Each 200-byte string holds 169 grams of
32 bytes; the least hash among them is its key, so equal strings share a key. A document
is a chain of regions, the runs of strings with one key (about 85 strings each, 284
bytes). Keys seen once are done. For the others one copy of each distinct region is
brought to the task of its key, and there all suffixes that start a 200-byte string are
sorted deep-shallow: a multikey sort by 8-byte characters to a shallow depth, then blind
tries for the groups that still agree. Suffixes equal over 200 bytes, counted with the
number of copies of their regions, mark what is removed; the marks travel back to every
copy of a region.

A key with more than ``CROWD`` distinct regions (a passage with many surroundings) is not
sorted in one task: its strings are counted by a 128-bit digest, with partial counts.

Defined results: null text is empty; texts below 200 bytes lose nothing; rows that repeat
a ``doc_id`` are each a text of their own, and equal rows lose what they share; rows
without id lose and take away like all others; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoweave.llm.common import as_bytes, prepare, slices, staged, texts

LENGTH = 200
GRAM = 32
WORD = 8
SHALLOW = 3
# About as many regions as fill one batch of SORT_BYTES.
CROWD = 8192
SORT_BYTES = 2 << 20
BLOCK = 1 << 20
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_MIX = np.random.default_rng(12).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position, by doubling."""
    h, size, step = _BYTES[data], 1, 0
    while size < GRAM:
        h = h[:-size] * _MIX[step] + (h[size:] ^ (h[size:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        size, step = 2 * size, step + 1
    h *= _MIX[step]
    return h ^ (h >> np.uint64(31))


def window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least value among each ``width`` in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


def regions(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``key, start, strings, seen``: runs of ``length``-byte strings with one least gram
    hash; ``seen`` is 2 where that gram may occur twice in the region, else 1."""
    total = len(text) - length + 1
    if total <= 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    width = length - GRAM + 1
    keys, starts, seen = [], [], []
    for at in range(0, total, BLOCK):
        part = np.frombuffer(text[at : at + BLOCK + length - 1], np.uint8)
        grams = gram_hashes(part)
        least = window_least(grams, width)
        begin = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        key = least[begin]
        # Grams of each region: those of its first string and one more for each other.
        spread = np.diff(np.append(begin, len(least))) + width - 1
        offset = np.cumsum(spread) - spread
        gram = np.arange(spread.sum()) + np.repeat(begin - offset, spread)
        twice = np.add.reduceat(grams[gram] == np.repeat(key, spread), offset) > 1
        many = np.where(twice, 2, 1)
        if keys and keys[-1][-1] == key[0]:
            # One region over a block's border: not looked into, so taken for repeating.
            seen[-1][-1] = 2
            begin, key, many = begin[1:], key[1:], many[1:]
        if len(key):
            keys.append(key)
            starts.append(begin + at)
            seen.append(many)
    key, start = np.concatenate(keys), np.concatenate(starts)
    return key, start, np.diff(np.append(start, total)), np.concatenate(seen)


def _region_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                docs, tags = batch.column(0), batch.column(1)
                row, key, print_, start, count, seen = [], [], [], [], [], []
                for i, text in enumerate(as_bytes(batch.column(2))):
                    k, s, n, m = regions(text, length)
                    row.append(np.full(len(k), i))
                    key.append(k)
                    start.append(s)
                    count.append(n)
                    seen.append(m)
                    print_ += [xxhash.xxh3_64_intdigest(text[a : a + c + length - 1]) for a, c in zip(s.tolist(), n.tolist())]
                at = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.take(at),
                        tags.take(at),
                        pa.array(np.concatenate(key).view(np.int64)),
                        pa.array(np.array(print_, np.uint64).view(np.int64)),
                        pa.array(np.concatenate(start).astype(np.int32)),
                        pa.array(np.concatenate(count).astype(np.int32)),
                        pa.array(np.concatenate(seen).astype(np.int32)),
                    ],
                    names=["doc_id", "tag", "key", "print", "start", "strings", "seen"],
                )

    return run


def _region_texts(length: int):
    """Texts of the wanted regions of each document."""
    names = ["key", "print", "copies", "crowded", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                out: list[list] = [[], [], [], [], []]
                for text, wanted in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                    for w in wanted:
                        out[0].append(w["key"])
                        out[1].append(w["print"])
                        out[2].append(w["copies"])
                        out[3].append(w["crowded"])
                        out[4].append(text[w["start"] : w["start"] + w["strings"] + length - 1])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return run


def _groups(order_keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order by the keys (last first), and the group number of each sorted row."""
    order = np.lexsort(order_keys)
    new = np.zeros(len(order), bool)
    for k in order_keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def repeated_suffixes(data: np.ndarray, at: np.ndarray, weight: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the suffixes at ``at`` equal another one over ``length`` bytes (a suffix
    of weight two or more equals itself). ``data`` needs ``WORD`` spare bytes at its end."""
    words = np.ndarray((len(data) - WORD + 1,), ">u8", buffer=data, strides=(1,))
    depth_of_all = -(-length // WORD)
    rest = length - (depth_of_all - 1) * WORD

    def word(rows: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        value = words[at[rows] + WORD * depth].astype(np.uint64)
        if rest < WORD:
            last = depth == depth_of_all - 1
            cut = np.uint64(8 * (WORD - rest))
            value = np.where(last, value >> cut << cut, value)
        return value

    out = weight >= 2
    rows = np.arange(len(at))
    group = np.zeros(len(at), np.int64)

    # Shallow: one 8-byte character after the other, only rows that still have equals.
    for depth in range(min(SHALLOW, depth_of_all)):
        order, number = _groups([word(rows, depth), group])
        rows, group = rows[order], number
        size = np.bincount(group)
        keep = size[group] > 1
        rows, group = rows[keep], group[keep]
        if not len(rows):
            return out
    if depth_of_all <= SHALLOW:
        out[rows] = True
        return out

    # Deep: a blind trie per group, a level at a time. All members of a group agree up to
    # its depth. Its first member is followed to the end; the others leave it at the
    # character where they differ, which is all that the trie keeps of them.
    depth = np.full(len(rows), SHALLOW)
    while len(rows):
        first = np.concatenate([[True], group[1:] != group[:-1]])
        leader = rows[first][np.cumsum(first) - 1]
        leave, branch = np.full(len(rows), depth_of_all), np.zeros(len(rows), np.uint64)
        active = np.flatnonzero(rows != leader)
        d = depth.copy()
        while len(active):
            own = word(rows[active], d[active])
            differ = own != word(leader[active], d[active])
            gone = active[differ]
            leave[gone], branch[gone] = d[gone], own[differ]
            active = active[~differ]
            d[active] += 1
            active = active[d[active] < depth_of_all]
        same = leave == depth_of_all
        number = np.cumsum(first) - 1
        alike = np.bincount(number[same], minlength=number[-1] + 1)
        out[rows[same & (alike[number] > 1)]] = True
        rows, group, depth, branch = rows[~same], number[~same], leave[~same], branch[~same]
        if not len(rows):
            break
        order, number = _groups([branch, depth, group])
        size = np.bincount(number)
        keep = size[number] > 1
        rows, depth, group = rows[order][keep], depth[order][keep] + 1, number[keep]
    return out


def _spans(marks: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"from": int(a), "to": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _sorter(length: int):
    """Rows sorted by key: the repeated strings of each region, as runs of their starts."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        body = rows.column("body").to_pylist()
        sizes = np.array([len(b) for b in body])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        count = sizes - length + 1
        data = np.frombuffer(b"".join([*body, b"\0" * (WORD + length)]), np.uint8)
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) + np.repeat(begin - (ends - count), count)
        found = repeated_suffixes(data, at, np.repeat(rows.column("copies").to_numpy(), count), length)
        key, print_, spans = [], [], []
        keys, prints = rows.column("key").to_pylist(), rows.column("print").to_pylist()
        for i, (lo, hi) in enumerate(zip((ends - count).tolist(), ends.tolist())):
            if found[lo:hi].any():
                key.append(keys[i])
                print_.append(prints[i])
                spans.append(_spans(found[lo:hi]))
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(print_, pa.int64()), pa.array(spans, _SPANS)], names=["key", "print", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = None, 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            size += pa.compute.sum(pa.compute.binary_length(batch.column(3))).as_py() or 0
            held = pa.concat_tables([held, rows]) if held is not None else rows
            if size < SORT_BYTES:
                continue
            key = held.column("key").to_numpy()
            change = np.flatnonzero(key[1:] != key[:-1])
            if not len(change):
                continue
            cut = int(change[-1]) + 1
            yield solve(held.slice(0, cut))
            held = held.slice(cut)
            size = sum(pa.compute.sum(pa.compute.binary_length(c)).as_py() or 0 for c in held.column("body").chunks)
        if held is not None and held.num_rows:
            yield solve(held)

    return run


def _digests(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, print_, copies, body = (batch.column(c)[i].as_py() for c in range(4))
                n = len(body) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * n, pa.int64()),
                        pa.array([print_] * n, pa.int64()),
                        pa.array([copies] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array([xxhash.xxh3_128_digest(body[k : k + length]) for k in range(n)], pa.binary()),
                    ],
                    names=["key", "print", "copies", "at", "digest"],
                )

    return run


def _crowded_spans(bodies: DataFrame, length: int) -> DataFrame:
    each = bodies.select("key", "print", "copies", "body").mapInArrow(_digests(length), "key long, print long, copies long, at int, digest binary")
    twice = each.groupBy("digest").agg(F.sum("copies").alias("seen")).where("seen > 1").select("digest")
    marked = each.join(twice, "digest").groupBy("key", "print").agg(F.array_sort(F.collect_list("at")).alias("at"))
    # Each string is a run of its own here; runs are joined where the bytes are removed.
    return marked.select("key", "print", F.transform("at", lambda a: F.struct(a.alias("from"), (a + 1).alias("to"))).alias("spans"))


def _by_row(source: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``source`` with what was ``found`` for its rows; a null ``doc_id`` equals another."""
    right = found.withColumnsRenamed({"doc_id": "__id", "tag": "__tag"})
    return source.join(right, source["doc_id"].eqNullSafe(right["__id"]) & (source["tag"] == right["__tag"]), how).drop("__id", "__tag")


def repeated_regions(source: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``doc_id, tag, runs`` of ``source(doc_id, tag, text)``: starts of repeated strings,
    as runs, for every document that has any."""
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = staged(source.mapInArrow(_region_rows(length), f"doc_id {kind}, tag long, key long, print long, start int, strings int, seen int"))
    shared = rows.groupBy("key").agg(F.sum("seen").alias("all")).where("all > 1").select("key")
    found = staged(rows.drop("seen").join(shared, "key"))
    distinct = staged(found.groupBy("key", "print").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "tag", "start", "strings")).alias("at")))
    crowded = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("key", F.lit(True).alias("crowded"))
    wanted = (
        distinct.join(crowded, "key", "left")
        .select(
            F.col("at.doc_id").alias("doc_id"),
            F.col("at.tag").alias("tag"),
            F.struct("key", "print", "copies", F.coalesce("crowded", F.lit(False)).alias("crowded"), "at.start", "at.strings").alias("region"),
        )
        .groupBy("doc_id", "tag")
        .agg(F.collect_list("region").alias("wanted"))
    )
    bodies = _by_row(source, wanted, "inner").select("text", "wanted").mapInArrow(_region_texts(length), "key long, print long, copies long, crowded boolean, body binary")
    bodies = staged(bodies)
    sorted_spans = (
        bodies.where(~F.col("crowded"))
        .select("key", "print", "copies", "body")
        .repartition("key")
        .sortWithinPartitions("key", "print")
        .mapInArrow(_sorter(length), "key long, print long, spans array<struct<from:int,to:int>>")
    )
    spans = sorted_spans.unionByName(_crowded_spans(bodies.where("crowded"), length))
    return (
        found.join(spans, ["key", "print"])
        .select("doc_id", "tag", F.explode(F.transform("spans", lambda s: F.struct((s["from"] + F.col("start")).alias("from"), (s["to"] + F.col("start")).alias("to")))).alias("run"))
        .groupBy("doc_id", "tag")
        .agg(F.collect_set("run").alias("runs"))
    )


def _remover(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, runs in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                kept, removed, spans, end = [], 0, 0, 0
                for a, b in sorted((r["from"], r["to"] + length - 1) for r in runs or ()):
                    if a > end or not spans:
                        kept.append(text[end:a])
                        spans += 1
                        removed += b - a
                        end = b
                    elif b > end:
                        removed += b - end
                        end = b
                kept.append(text[end:])
                out[0].append(len(text))
                out[1].append(removed)
                out[2].append(spans)
                out[3].append(b"".join(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())], names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row: ``kept`` are the bytes
    outside every ``length``-byte string that starts anywhere else as well."""
    prepare(docs.sparkSession)
    source = texts(docs, id_col, text_col).select(F.col("__id").alias("doc_id"), F.xxhash64("__text").alias("tag"), F.col("__text").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    runs = staged(repeated_regions(source, length, crowd))
    return (
        _by_row(source, runs, "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(_remover(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut out of the text; a character cut in two goes
    whole. Texts that lose nothing stay as they are, null ones too. All columns are kept
    in place, and ``chars_col``, where there is one, follows the text."""
    prepare(docs.sparkSession)
    source = texts(docs, id_col, text_col).select(F.col("__id").alias("doc_id"), F.xxhash64("__text").alias("tag"), F.col("__text").alias("text"))
    runs = staged(repeated_regions(source, length)).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.col("runs").alias("__runs"))

    @F.arrow_udf("string")
    def without(text: pa.Array, runs: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(text.to_pylist(), runs.to_pylist()):
            if t is None or r is None:
                out.append(t)
                continue
            data = t.encode()
            kept, end = [], 0
            for a, b in sorted((x["from"], x["to"] + length - 1) for x in r):
                if a > end:
                    kept.append(data[end:a].decode("utf-8", "ignore"))
                end = max(end, b)
            kept.append(data[end:].decode("utf-8", "ignore"))
            out.append("".join(kept))
        return pa.array(out, pa.string())

    tagged = docs.withColumn("__hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = tagged.join(runs, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__tag")), "left")
    changed = joined.withColumn(text_col, F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(without(F.col(text_col), F.col("__runs"))))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        changed = changed.withColumn(chars_col, F.when(F.col("__runs").isNull(), F.col(chars_col)).otherwise(F.length(text_col).cast(kind)))
    return changed.select(*docs.columns)
