"""What the operators here share: tables, staging and Arrow helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoweave.session import checkpoint_dir, ship_package

# Rows and bytes handed to Python at a time: documents may be long and what is made of them
# takes many times their size, so both are small.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for jobs that hand batches to Python, and the package on the executors."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, and a
    lost executor costs no more than its unfinished tasks."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, named ``__id`` and ``__text``; null text is empty. The
    names cannot clash with other columns of the input, which are not read."""
    return df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))


def row_key(id_col: str, text_col: str) -> Column:
    """A row by its id and text. Rows without id come last; equal ones have equal keys."""
    own = F.col(id_col)
    return F.struct(own.isNull().alias("absent"), own.alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"))


def one_of_each(docs: DataFrame, id_col: str, text_col: str, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` with one row of each group, the one of least id and text, all columns kept.

    ``find`` gets ``row, text`` and returns ``doc_id, keep_id``, both keys of rows, for
    every row. Of rows that agree in id and text one stays, whatever their other columns."""
    rows = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    found = staged(find(rows).select("doc_id", "keep_id"))
    gone = staged(found.where("doc_id <> keep_id").select(F.col("doc_id").alias("__gone")).distinct())
    twice = staged(found.where("doc_id = keep_id").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__twice")))
    left = docs.withColumn("__row", row_key(id_col, text_col)).join(gone, F.col("__row") == F.col("__gone"), "left_anti")
    if twice.isEmpty():
        return left.drop("__row")
    # Maps have no hash; which of two rows stays that differ in nothing else is open.
    order = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    again = left.join(twice, F.col("__row") == F.col("__twice"), "left_semi").groupBy("__row").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*order)).alias("kept"))
    return left.join(twice, F.col("__row") == F.col("__twice"), "left_anti").drop("__row").unionByName(again.select("kept.*"))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each string, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, text_index: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``most`` bytes of text, or a single row."""
    start = size = 0
    lengths = pa.compute.binary_length(batch.column(text_index)).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def gaps(parts: list) -> list[int]:
    """Places of ``None`` in ``parts``."""
    out: list[int] = []
    at = -1
    for _ in range(parts.count(None)):
        at = parts.index(None, at + 1)
        out.append(at)
    return out
