"""Session settings shared by tests, the benchmark and the command-line plans.

A cluster normally supplies its own session; nothing else in the package
builds one.  Only correctness-relevant settings are forced here (ANSI, UTC,
adaptive execution); sizing stays with the cluster configuration.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 256 << 20  # stored input that one slice of the keys should stand for
MOST_SLICES = 4  # each slice reads the input again
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app_name: str = "cadastre",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, the cluster's own where it names one.

    A private folder is created only when neither the context nor
    ``spark.checkpoint.dir`` has one, which is the single-machine test case.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = configured or tempfile.mkdtemp(prefix="cadastre-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write go at once, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, *more: DataFrame) -> DataFrame:
    """Rows written once as Parquet below the checkpoint folder and read back.

    For frames that are costly and read several times; the files outlive a lost executor.  Frames of the
    same columns are written one after the other, and the shuffle files of one go before the next starts.
    """
    spark = df.sparkSession
    folder = posixpath.join(ensure_checkpoint_dir(spark), "stored", uuid.uuid4().hex)
    with _shuffles_dropped(spark):
        for part in (df, *more):
            part.write.mode("append").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def slice_count(df: DataFrame) -> int:
    """Slices that keep the shuffles of one near ``SLICE_BYTES`` of the files read, ``MOST_SLICES`` at most."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return max(1, min(MOST_SLICES, -(-read // SLICE_BYTES)))


def key_slices(df: DataFrame, keys: Sequence[str], count: int) -> list[DataFrame]:
    """The rows cut into ``count`` frames by a hash of their keys; every row, NULL keys too, is in one of them."""
    if count == 1:
        return [df]
    place = F.pmod(F.xxhash64(*keys), F.lit(count))
    return [df.where(place == i) for i in range(count)]
