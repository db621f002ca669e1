"""Session settings the jobs rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Runtime settings that suit every job in this package. They are ordinary SQL
# settings, so a cluster session keeps whatever else it was started with.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot cell, node or value even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cartoweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Building long column expressions is several times faster without call sites.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session that names none (local tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="cartoweave-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application. Only the writers and
    readers that run Python in tasks need it there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cartoweave-package-")) / "cartoweave"
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def tasks(spark: SparkSession) -> int:
    """How many parts rows are dealt into where each makes much work: no fewer than two
    a core, no fewer than a shuffle has."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again. Loops need it: a plan that
    refers to itself twice a round would double every time."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> DataFrame:
    """Keep ``df`` and fill it once, so that the join planner sees its true size.

    Tables made by exploding ranges (cell covers, neighbour rings) look far
    smaller to the planner than they are. Once stored, their statistics are the
    measured bytes: below the broadcast threshold they are broadcast, above it
    they are shuffled on the join key. Lost blocks are rebuilt from lineage.
    """
    return measured_with(df)[0]


def measured_with(df: DataFrame, *aggregates) -> tuple[DataFrame, Row]:
    """``measured``, and the aggregates of the table from the same job."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.agg(F.count(F.lit(1)).alias("rows"), *aggregates).first()
