"""Exact dedup with the frequent digests taken out of the shuffle.

Every task keeps a Misra-Gries summary of the digests it sees. Merged, the summaries
hold every digest that more than ``rows / (counters + 1)`` rows share. Those are counted
exactly (a partial count per task), and the verified winners, at most ``counters`` rows
of 64 bytes, are broadcast: their rows are settled where they are read. The rest is
shuffled on the digest, where by the guarantee no group exceeds that share.

Defined results: null text equals the empty text; rows that repeat a ``doc_id`` are each
judged by their own text, and ``drop_copies`` keeps one row of each text; rows without id
come after the others; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.llm.common import one_of_each, prepare, staged, texts

COUNTERS = 1024
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text):
    return F.regexp_replace(text, SPACES, " ")


def misra_gries(items, counters: int) -> dict:
    """Summary of ``items``: any item above ``len / (counters + 1)`` is among the keys."""
    held: dict = {}
    for item in items:
        if item in held:
            held[item] += 1
        elif len(held) < counters:
            held[item] = 1
        else:
            held = {k: v - 1 for k, v in held.items() if v > 1}
    return held


def _summaries(counters: int):
    schema = pa.schema([("digest", pa.binary()), ("seen", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (d for batch in batches for d in batch.column(0).to_pylist())
        held = misra_gries(stream, counters)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], schema=schema)

    return run


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified heavy hitters of column ``digest``: ``digest, keep_id, group_size``; at most ``counters`` rows."""
    rows = digests.count()
    merged = (
        digests.select("digest")
        .mapInArrow(_summaries(counters), "digest binary, seen long")
        .groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "digest")
        .limit(counters)
        .select("digest")
    )
    return (
        digests.join(F.broadcast(merged), "digest")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") * F.lit(counters + 1) > F.lit(rows))
        .where(F.col("group_size") > 1)
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``. Rows
    without id stay only where no row with one has their text."""
    prepare(docs.sparkSession)
    digests = staged(
        texts(docs, id_col, text_col).select(
            F.col("__id").alias("doc_id"), F.unhex(F.sha2(normalised(F.col("__text")).cast("binary"), 256)).alias("digest")
        )
    )
    winners = staged(heavy_digests(digests, counters).coalesce(1))
    heavy = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "digest", "doc_id", F.min("doc_id").over(group).alias("keep_id"), F.count(F.lit(1)).over(group).alias("group_size")
    )
    return light.unionByName(heavy).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each text, the one of least id, all columns kept."""
    return one_of_each(docs, id_col, text_col, lambda rows: exact_dedup(rows, "row", "text", counters))
