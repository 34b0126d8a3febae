"""Shared folder, stored intermediate tables, and row-to-block helpers of the operators."""

from __future__ import annotations

import ctypes
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """Folder of this application below ``spark.checkpoint.dir``, which every machine reaches.

    Only where that setting is missing (tests, one machine) a private folder takes its place.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = (spark.conf.get("spark.checkpoint.dir", None)
                or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            base = tempfile.mkdtemp(prefix="llm-work-")
        _FOLDERS[app] = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
        _ship_package(spark, _FOLDERS[app])
    return _FOLDERS[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: work behind it is not repeated by a later stage or after a lost executor.
    """
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small_if_counted(keys: DataFrame, label: str, rows: int = 1_000_000) -> DataFrame:
    """Narrow keys, stored and counted: broadcast where they are at most ``rows``, else left to the planner.

    The planner's estimate alone turns a join with texts into a shuffle of all texts long before that.
    """
    keys = stored(keys, label)
    return F.broadcast(keys) if keys.count() <= rows else keys


def _ship_package(spark: SparkSession, folder: str) -> None:
    """Hand the package to the executors, which may not have it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    write_file(f"{folder}/code.zip", packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/code.zip")


def write_file(uri: str, data: bytes) -> None:
    """Write a whole file under another name first, so that readers never see half of it."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, path)


def read_file(uri: str) -> bytes:
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_stream(path) as source:
        return source.read()


def blocks(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes at a time (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start)


def give_back() -> None:
    """Return memory that a worker has freed to the system, which its executor's limit counts until then."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)
