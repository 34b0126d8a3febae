"""Files of the landing area: look up, list, move by rename."""

from __future__ import annotations

import posixpath
import time
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return filesystem.exists(target)


def find(spark: SparkSession, folder: str, name: str) -> str:
    path = posixpath.join(folder, name)
    if not exists(spark, path):
        raise FileNotFoundError(f"no file {path}")
    return path


def make_folder(spark: SparkSession, folder: str) -> None:
    filesystem, target = _filesystem(spark, folder)
    filesystem.mkdirs(target)


def remove_folder(spark: SparkSession, folder: str) -> None:
    filesystem, target = _filesystem(spark, folder)
    filesystem.delete(target, True)


def old_folders(spark: SparkSession, folder: str, hours: float) -> list[str]:
    """Folders directly below ``folder`` that were last changed so many hours ago or earlier."""
    filesystem, target = _filesystem(spark, folder)
    if not filesystem.exists(target):
        return []
    before = (time.time() - hours * 3600) * 1000
    return sorted(f.getPath().toString() for f in filesystem.listStatus(target)
                  if f.isDirectory() and f.getModificationTime() <= before)


def head(spark: SparkSession, path: str, size: int) -> tuple[bytes, bool]:
    """The first bytes of a file and whether that is all of it."""
    filesystem, target = _filesystem(spark, path)
    length = filesystem.getFileStatus(target).getLen()
    stream = filesystem.open(target)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(min(size, length)))
    finally:
        stream.close()
    return bytes(data), length <= size


def listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(archivo, longitud, modificado)`` of the files of a path; their content is not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("_metadata.file_name").alias("archivo"), F.col("_metadata.file_size").alias("longitud"),
        F.col("_metadata.file_modification_time").alias("modificado"))


def move_all(spark: SparkSession, names: Iterable[str], source: str, target: str, later: Sequence[str] = ()) -> None:
    """Move files from one folder to another, some at a time in parallel.

    A file that is in the target, or in a folder that comes ``later``, has been moved already.
    """
    def one(name: str) -> None:
        if exists(spark, posixpath.join(source, name)):
            move(spark, posixpath.join(source, name), target)
        elif not any(exists(spark, posixpath.join(f, name)) for f in (target, *later)):
            raise FileNotFoundError(f"no file {posixpath.join(source, name)}")

    with ThreadPoolExecutor(16) as pool:
        for some in batched(names, 1024):
            list(pool.map(one, some))


def move(spark: SparkSession, path: str, folder: str) -> str:
    """Rename a file into another folder of the same store, replacing an older copy."""
    filesystem, source = _filesystem(spark, path)
    if not filesystem.exists(source):
        raise FileNotFoundError(f"no file {path}")
    destination = posixpath.join(folder, posixpath.basename(path))
    _, target = _filesystem(spark, destination)
    filesystem.mkdirs(target.getParent())
    if filesystem.exists(target):
        filesystem.delete(target, False)
    if not filesystem.rename(source, target):
        raise OSError(f"could not move {path} to {destination}")
    return destination
