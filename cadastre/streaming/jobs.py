"""Micro-batch jobs over arriving files.

Every job may replay a batch after a failure.  Appends therefore overwrite
the partition of their batch number.  The upsert is repeatable by nature, and
the buckets that a stopped batch had switched already carry its number in
their location: a replay leaves them alone and does the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cadastre.operators.clean import clean_transactions
from cadastre.operators.rows import FieldRule, check_rows, quarantined_rows, usable_rows
from cadastre.schemas import LOADED_AT, TableSpec
from cadastre.sinks.catalog import Warehouse
from cadastre.sinks.loading import run_load

BATCH = "_batch"


def batch_table(spec: TableSpec, name: str | None = None,
                extra: Sequence[tuple[str, str]] = ()) -> TableSpec:
    """The table with one partition per micro-batch, as the append jobs need it."""
    return replace(spec, name=name or spec.name, partition_by=(BATCH,), unit="",
                   columns=(*spec.columns, *extra, (BATCH, "bigint")))


def arriving_csv(spark: SparkSession, folder: str, columns: Sequence[str],
                 archive: str | None = None, delimiter: str = ",",
                 files_per_batch: int | None = None) -> DataFrame:
    """Stream of text rows from CSV files; with ``archive`` committed files are moved there.

    The checkpoint of the query that reads it remembers every file, so each is
    ingested once.  A committed file is archived when a later batch runs.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (spark.readStream.schema(schema).option("header", True).option("sep", delimiter)
              .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # an empty field is the empty text, as in the batch reader
    return reader.csv(folder).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def _start(stream: DataFrame, warehouse: Warehouse, checkpoint: str,
           body: Callable[[DataFrame, int, Warehouse], None], continuous: bool) -> StreamingQuery:
    def run(rows: DataFrame, batch: int) -> None:
        # a batch belongs to the query's own session, and so must the tables it meets
        body(rows, batch, Warehouse(rows.sparkSession, warehouse.root))

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(stream: DataFrame, warehouse: Warehouse, table: str, checkpoint: str,
           continuous: bool = False) -> StreamingQuery:
    """Append arriving rows to a raw table made by :func:`batch_table`."""
    def body(rows: DataFrame, batch: int, tables: Warehouse) -> None:
        tables.overwrite_partition(table, BATCH, batch, rows)

    return _start(stream, warehouse, checkpoint, body, continuous)


def upsert(stream: DataFrame, warehouse: Warehouse, table: str, checkpoint: str,
           keys: Sequence[str] = ("id",),
           cleaner: Callable[[DataFrame], DataFrame] = clean_transactions,
           continuous: bool = False) -> StreamingQuery:
    """Clean each batch, keep one row per key and merge it into the staging table.

    A batch reads and writes the buckets of its keys only.
    """
    def body(rows: DataFrame, batch: int, tables: Warehouse) -> None:
        if LOADED_AT not in rows.columns:
            rows = rows.withColumn(LOADED_AT, F.current_timestamp())
        run_load(tables, table, cleaner(rows), "UPSERT", list(keys),
                 required=list(keys), unique_source=True, token=f"{name}-{batch}")

    name = ledger_name(checkpoint)
    return _start(stream, warehouse, checkpoint, body, continuous)


def ledger_name(checkpoint: str) -> str:
    """Name of the stream that owns a checkpoint, the same in every run of it."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def check(stream: DataFrame, rules: Sequence[FieldRule], warehouse: Warehouse, valid: str,
          quarantine: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """Route each row to the valid or the quarantine table by the row rules."""
    def body(rows: DataFrame, batch: int, tables: Warehouse) -> None:
        checked = check_rows(rows, rules).persist()
        try:
            tables.overwrite_partition(valid, BATCH, batch, usable_rows(checked))
            tables.overwrite_partition(quarantine, BATCH, batch, quarantined_rows(checked))
        finally:
            checked.unpersist()

    return _start(stream, warehouse, checkpoint, body, continuous)
