"""The layer steps: raw, staging, consumption.

Each step returns 0 or 1 and records its run; the reason of a failure is in
the log and in the audit row.
"""

from __future__ import annotations

import logging
import posixpath
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cadastre.contracts import FEATURES_CONTRACT, TEST_CONTRACT, TRAIN_CONTRACT
from cadastre.operators.clean import clean_transactions
from cadastre.operators.contracts import Contract, validate_all
from cadastre.operators.features import MINIMUM_PRICE, TRAIN_PERCENT, build_features, split_rows
from cadastre.operators.profile import raw_counts
from cadastre.schemas import FEATURE_SET_AT, RAW_MANIFEST
from cadastre.sinks.audit import record_run
from cadastre.sinks.catalog import Warehouse, full_name
from cadastre.sinks.loading import Load, Prepared, key_list, prepare_sync, require_values, run_load
from cadastre.sinks.manifest import Run, begin, open_run
from cadastre.sinks.units import RUN
from cadastre.sources import files
from cadastre.sources.control import SourceParameters, consumption_tables, source_parameters
from cadastre.sources.csv import count_lines, read_csv
from cadastre.sources.json_pages import page_order, read_pages
from cadastre.sources.flatten import flatten
from cadastre.sources.rest import DEFAULT_LIMIT, read_rest
from cadastre.sources.tables import align
from cadastre.sources.xml import read_xml

log = logging.getLogger(__name__)

# Rows are sorted by these inside each file, so that filters on them skip row groups.
STAGING_ORDER = ("fecha", "ciudad", "tipo")


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Workspace:
    """Where the steps read and write, and the settings they share."""

    warehouse: Warehouse
    landing: str = ""
    processing: str = ""
    processed: str = ""
    train_percent: int = TRAIN_PERCENT
    price_minimum: int = MINIMUM_PRICE
    contracts: Mapping[str, Contract] = field(default_factory=lambda: {
        "FEATURES": FEATURES_CONTRACT, "TRAIN": TRAIN_CONTRACT, "TEST": TEST_CONTRACT})
    # "after": contracts judge the published tables; "before": nothing that
    # breaks a contract is ever published
    publish: str = "after"
    rest_options: Mapping[str, Any] = field(default_factory=dict)
    xml_options: Mapping[str, Any] = field(default_factory=dict)
    clock: Callable[[], datetime] = utc_now

    @property
    def spark(self):
        return self.warehouse.spark


@dataclass
class Counts:
    read: int = 0
    inserted: int = 0
    rejected: int = 0


def _step(workspace: Workspace, name: str, source: str,
          body: Callable[[SourceParameters, Counts], None]) -> int:
    """Run a step body between its parameter lookup and its audit row."""
    started, counts = workspace.clock(), Counts()
    try:
        parameters = source_parameters(workspace.warehouse, name)
        if parameters is None:
            raise LookupError(f"source {name!r} is not configured")
        body(parameters, counts)
    except Exception as exc:
        message = f"{type(exc).__name__}: {exc}"
        log.error("%s failed for %r: %s", source, name, message)
        record_run(workspace.warehouse, name, source, started, "ERROR", counts.read,
                   counts.inserted, counts.rejected, message, workspace.clock())
        return 1
    record_run(workspace.warehouse, name, source, started, "OK", counts.read,
               counts.inserted, counts.rejected, None, workspace.clock())
    return 0


# --- raw ---------------------------------------------------------------------
@dataclass(frozen=True)
class RawInput:
    """What a raw reader needs: the moved files and the columns to fill."""

    workspace: Workspace
    parameters: SourceParameters
    name: str
    table: str
    run: Run

    @property
    def path(self) -> str:
        return posixpath.join(self.workspace.processing, self.name)

    @property
    def target(self):
        schema = self.workspace.warehouse.table(self.table).schema
        defaults = self.workspace.warehouse.defaults(self.table)
        return type(schema)([f for f in schema.fields if f.name not in defaults])


def _csv_rows(raw: RawInput) -> tuple[DataFrame, int | None]:
    spark, path = raw.workspace.spark, raw.path
    lines = count_lines(spark, path).agg(F.sum("lines")).first()[0] or 0
    return read_csv(spark, path, raw.target.names), lines


def _xml_rows(raw: RawInput) -> tuple[DataFrame, int | None]:
    options = dict(raw.workspace.xml_options)
    root = options.get("root", {"unit": "unit"})
    group = options.get("group_column", "country")
    fields = [c for c in raw.target.names if c not in root.values() and c != group]
    rows = read_xml(raw.workspace.spark, raw.path, fields, **options)
    return align(rows, raw.target), None


def _json_rows(raw: RawInput) -> tuple[DataFrame, int | None]:
    order = raw.run.files().select(F.col("archivo").alias("page"), F.col("posicion").alias("position"))
    pages = read_pages(raw.workspace.spark, raw.workspace.processing, order)
    return align(flatten(pages), raw.target), None


def _rest_rows(raw: RawInput) -> tuple[DataFrame, int | None]:
    rows = read_rest(raw.workspace.spark, raw.parameters.need("url_api"), raw.target.names,
                     limit=raw.parameters["limit_pagina"] or DEFAULT_LIMIT,
                     **raw.workspace.rest_options)
    return rows, None


# Format name -> reader; extend it to support another format.
RAW_READERS: dict[str, Callable[[RawInput], tuple[DataFrame, int | None]]] = {
    "CSV": _csv_rows, "XML": _xml_rows, "JSON": _json_rows, "API": _rest_rows,
}


def _arrival(workspace: Workspace, name: str, kind: str) -> Run:
    """The open run of a source, or a new one for what has arrived."""
    house, spark, now = workspace.warehouse, workspace.spark, workspace.clock()
    begun = open_run(house, name)
    if kind == "API":
        nothing = spark.createDataFrame(
            [(None, None, None, None)], "posicion bigint, archivo string, longitud bigint, modificado timestamp")
        return begun or begin(house, name, nothing, now, uuid.uuid4().hex)
    start = posixpath.join(workspace.landing, name)
    if begun and files.exists(spark, start):
        if not begun.holds(name, tuple(files.listing(spark, start).select("longitud", "modificado").first())):
            begun.close(now)  # another file has taken its place
            begun = None
    if begun:
        return begun
    files.find(spark, workspace.landing, name)
    if kind == "JSON":
        order = page_order(spark, start).select(F.col("page").alias("archivo"), F.col("position").alias("posicion"))
        listed = files.listing(spark, workspace.landing, "*.json").join(order, "archivo")
    else:
        listed = files.listing(spark, start).withColumn("posicion", F.lit(0).cast("bigint"))
    return begin(house, name, listed, now)


def run_raw(workspace: Workspace, name: str) -> int:
    """Find the source, move it to processing, append it to its raw table, archive it.

    The step may be stopped anywhere and run again: its manifest says what belongs to the run, and
    its rows become visible in the raw table at once, and once.
    """
    def body(parameters: SourceParameters, counts: Counts) -> None:
        spark = workspace.spark
        kind = (parameters["tipo_archivo"] or "").upper()
        if kind not in RAW_READERS:
            raise ValueError(f"format {kind!r} is not supported; use one of {sorted(RAW_READERS)}")
        table = full_name(parameters.need("tabla_raw"), "raw")
        house = workspace.warehouse
        house.require(table, RAW_MANIFEST.name)
        run = _arrival(workspace, name, kind)
        if kind != "API":
            files.move_all(spark, run.names(), workspace.landing, workspace.processing, [workspace.processed])
        if house.has_run(table, run.name):
            counts.read = counts.inserted = house.stored(table).where(F.col(RUN) == run.name).count()
        else:
            rows, counted = RAW_READERS[kind](RawInput(workspace, parameters, name, table, run))
            written = Observation()
            folder = house.write_run(table, run.name, rows.observe(written, F.count(F.lit(1)).alias("n")))
            counts.inserted = written.get["n"]
            counts.read = counts.inserted if counted is None else counted
            counts.rejected = max(counts.read - counts.inserted, 0)
            if kind != "CSV" and counts.inserted == 0:
                raise ValueError(f"source {name!r} has no records")
            house.publish(table, folder, [run.name])
        if kind != "API":
            files.move_all(spark, run.names(), workspace.processing, workspace.processed)
        run.close(workspace.clock())

    return _step(workspace, name, "raw", body)


# --- staging -----------------------------------------------------------------
def run_staging(workspace: Workspace, name: str,
                cleaner: Callable[[DataFrame], DataFrame] = clean_transactions,
                cleaned_key: tuple[str, ...] = ("id",)) -> int:
    """Clean the raw table and load it under the configured strategy."""
    def body(parameters: SourceParameters, counts: Counts) -> None:
        warehouse = workspace.warehouse
        raw = full_name(parameters.need("tabla_raw"), "raw")
        staging = full_name(parameters.need("tabla_staging"), "staging")
        warehouse.require(raw, staging)
        rows = warehouse.table(raw)
        total = raw_counts(rows).first()
        counts.read, counts.rejected = total["total"], total["blank"]
        if counts.read == 0:
            log.warning("raw table %s is empty, nothing to load", raw)
            return
        keys = parameters["columnas_llave"]
        order = [c for c in STAGING_ORDER if c in warehouse.table(staging).columns]
        result = run_load(
            warehouse, staging, cleaner(rows), parameters["tipo_extraccion"], keys,
            required=cleaned_key, sort_by=order,
            unique_source=set(cleaned_key) <= set(key_list(keys)))
        counts.inserted = result.affected

    return _step(workspace, name, "staging", body)


# --- consumption -------------------------------------------------------------
def run_consumption(workspace: Workspace, name: str) -> int:
    """Build features, train and test, then judge them by their contracts."""
    def body(parameters: SourceParameters, counts: Counts) -> None:
        warehouse = workspace.warehouse
        staging = full_name(parameters.need("tabla_staging"), "staging")
        tables = {r: full_name(t, "consumption")
                  for r, t in consumption_tables(warehouse, name).items()}
        warehouse.require(staging, *tables.values())
        rows = warehouse.table(staging)
        counts.read = rows.count()
        if counts.read == 0:
            log.warning("staging table %s is empty, nothing to build", staging)
            return
        now = workspace.clock()
        source = require_values(
            build_features(rows, workspace.train_percent, workspace.price_minimum),
            ["propiedad_id"])
        stamps = {FEATURE_SET_AT: F.lit(now.isoformat()).cast("timestamp")}
        def prepare(role: str, rows: DataFrame, defaults: dict) -> Prepared:
            return prepare_sync(Load(warehouse, tables[role], rows, ("propiedad_id",), defaults, STAGING_ORDER))

        loads = {"FEATURES": prepare("FEATURES", source, stamps)}
        counts.inserted = loads["FEATURES"].result.inserted + loads["FEATURES"].result.updated
        # both splits read the files just written: the features are computed once
        features = loads["FEATURES"].rows(warehouse)
        for role, label in (("TRAIN", "train"), ("TEST", "test")):
            loads[role] = prepare(role, split_rows(features, label), {})

        def judge() -> None:
            validate_all(
                [((lambda r=r: loads[r].rows(warehouse)), c) for r, c in workspace.contracts.items()], now)

        if workspace.publish == "before":
            judge()
        for load in loads.values():
            load.publish(warehouse)
        if workspace.publish != "before":
            judge()

    return _step(workspace, name, "consumption", body)


def run_in_order(*steps: Callable[[], int]) -> int:
    """Run steps one after the other, stopping at the first that fails."""
    for step in steps:
        code = step()
        if code:
            return code
    return 0
