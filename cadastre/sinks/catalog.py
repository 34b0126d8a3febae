"""Catalog tables on Parquet with versioned folders.

A table is an external Parquet table whose folder holds one sub-folder per
version.  Appends add files to the current version.  A rewrite goes to a new
folder and the catalog is pointed at it by ``ALTER TABLE .. SET LOCATION`` once
the write has committed, so readers see the old rows or the new ones, and a
failed or repeated job leaves the table as it was.

A table with units (:mod:`cadastre.sinks.units`) is partitioned by them, and each
has its own location: a load replaces the units it touches and no others.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.schemas import TableSpec
from cadastre.sinks import units
from cadastre.sinks.units import Unit
from cadastre.sources import files

DEFAULT_KEY = "CURRENT_DEFAULT"
_UNIT, _SORT = "cadastre.unit", "cadastre.sort"


def full_name(reference: str, default_database: str | None = None) -> str:
    """``db.table`` (or ``catalog.db.table``) from a reference that may lack the database."""
    parts = [p for p in (reference or "").strip().strip("`").split(".")]
    if not all(parts) or len(parts) > 3:
        raise ValueError(f"table reference {reference!r} is empty or malformed")
    if len(parts) == 1:
        if not default_database:
            raise ValueError(f"table reference {reference!r} has no database and no default is set")
        return f"{default_database}.{parts[0]}"
    return ".".join(parts)


class Warehouse:
    """Tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- definitions --------------------------------------------------------
    def create(self, spec: TableSpec, replace: bool = False) -> None:
        database = spec.name.rsplit(".", 1)[0]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if replace:
            self.spark.sql(f"DROP TABLE IF EXISTS {spec.name}")
        columns = []
        for name, kind in spec.columns:
            text = f"`{name}` {kind}"
            if name in spec.defaults:
                text += f" DEFAULT {spec.defaults[name]}"
            columns.append(text)
        partition_by, properties = spec.partition_by, ""
        if spec.unit:
            unit = Unit.parse(spec.unit)
            columns += [f"{units.DIGEST} bigint", unit.ddl]
            partition_by = (unit.name,)
            properties = f"TBLPROPERTIES ('{_UNIT}' = '{unit.text}', '{_SORT}' = '{','.join(spec.sort_by)}')"
        partitioned = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        comment = "COMMENT '" + spec.comment.replace("'", "''") + "'" if spec.comment else ""
        # Partitions other than units are found below the current folder rather than listed
        # in the catalog, whose entries would keep pointing at the previous version.
        setting = "spark.sql.hive.manageFilesourcePartitions"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "true" if spec.unit else "false")
        try:
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {spec.name} ({', '.join(columns)}) USING parquet "
                f"{partitioned} LOCATION '{self._new_folder(spec.name)}' {comment} {properties}")
        finally:
            self.spark.conf.set(setting, before)

    def add_columns(self, name: str, columns: Sequence[tuple[str, str]]) -> list[str]:
        """Add the columns that are absent; returns their names."""
        present = set(self.spark.table(name).columns)
        missing = [(c, t) for c, t in columns if c not in present]
        if missing:
            text = ", ".join(f"`{c}` {t}" for c, t in missing)
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({text})")
        return [c for c, _ in missing]

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def require(self, *names: str) -> None:
        for name in names:
            if not self.exists(name):
                raise LookupError(f"table {name} does not exist; create it first")

    def table(self, name: str) -> DataFrame:
        """The current rows; a listing cached by this session is dropped first.

        Another session (a stream's, another job's) may have published a newer
        version or added files since.
        """
        return self.stored(name).drop(*units.HIDDEN)

    def stored(self, name: str) -> DataFrame:
        """The current rows with the unit and the digest of each, where the table has them."""
        self.require(name)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def unit(self, name: str) -> Unit | None:
        text = self._property(name, _UNIT)
        return Unit.parse(text) if text else None

    def _property(self, name: str, key: str) -> str | None:
        value = self.spark.sql(f"SHOW TBLPROPERTIES {name} ('{key}')").first()["value"]
        return None if "does not have property" in value else value

    def defaults(self, name: str) -> dict[str, str]:
        """Columns with a default and the expression they default to."""
        return {f.name: f.metadata[DEFAULT_KEY] for f in self.table(name).schema.fields
                if DEFAULT_KEY in f.metadata}

    def truncate(self, *names: str) -> None:
        """Empty the tables, each by an atomic move to an empty version."""
        for name in names:
            self.swap(name, self.table(name).limit(0))

    # --- writes -------------------------------------------------------------
    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows by column name; absent columns take their default."""
        self._shaped(name, self._with_defaults(name, rows)).write.insertInto(name)

    def _with_defaults(self, name: str, rows: DataFrame) -> DataFrame:
        defaults = self.defaults(name)
        return rows.withColumns({c: F.expr(defaults.get(c, "NULL"))
                                 for c in self.table(name).columns if c not in rows.columns})

    def has_run(self, name: str, run: str) -> bool:
        return self.spark.sql(f"SHOW PARTITIONS {name}").where(F.col("partition") == f"{units.RUN}={run}").count() > 0

    def write_run(self, name: str, run: str, rows: DataFrame) -> str:
        """Write the rows of a run to a folder of their own; ``publish`` with ``[run]`` shows them, all at once."""
        folder = self._new_folder(name)
        self._shaped(name, self._with_defaults(name, rows), run).write.partitionBy(units.RUN).parquet(folder)
        return folder

    def _shaped(self, name: str, rows: DataFrame, run: str | None = None) -> DataFrame:
        """The table's columns in order and type, with unit and digest where it has them."""
        schema = self.stored(name).schema
        shaped = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                               for f in schema.fields if f.name not in units.HIDDEN])
        unit = self.unit(name)
        if not unit:
            return shaped
        if unit.name == units.RUN:
            value = F.lit(run or uuid.uuid4().hex).alias(units.RUN)
            return shaped.select("*", F.lit(None).cast("bigint").alias(units.DIGEST), value)
        data = [c for c in shaped.columns if c not in self.defaults(name)]
        return shaped.select("*", units.digest(data), unit.value())

    def overwrite_partition(self, name: str, column: str, value: int, rows: DataFrame) -> None:
        """Replace one partition; repeating the call gives the same table."""
        target = self.table(name)
        defaults = self.defaults(name)
        columns = [
            (F.col(f"`{c}`") if c in rows.columns else F.expr(defaults.get(c, "NULL")))
            .cast(target.schema[c].dataType).alias(c) for c in target.columns if c != column]
        session = rows.sparkSession
        view = f"rows_{uuid.uuid4().hex}"
        rows.select(*columns).createOrReplaceTempView(view)
        try:
            session.sql(f"INSERT OVERWRITE {name} PARTITION ({column} = {int(value)}) "
                        f"SELECT * FROM {view}")
        finally:
            session.catalog.dropTempView(view)

    def write_version(self, name: str, rows: DataFrame, sort_by: Sequence[str] = (),
                      token: str | None = None) -> str:
        """Write rows to a new folder of the table without making it current.

        Units are sorted by the bits of their sort columns in turn.  ``token`` becomes part of the
        folder's path, see :meth:`units_of`.
        """
        partitions = self._partitions(name)
        shaped = self._shaped(name, rows)
        if partitions:
            # adaptive execution splits a crowded partition and joins small ones
            shaped = shaped.hint("rebalance", *partitions)
        order = [F.col(c) for c in sort_by]
        if self.unit(name):
            order = list(sort_by) or [c for c in (self._property(name, _SORT) or "").split(",") if c]
            month = self.unit(name).name == units.MONTH
            order = [units.interleaved(order, shaped.schema, month)] if order else []
        if partitions or order:
            shaped = shaped.sortWithinPartitions(*partitions, *order)
        folder = self._new_folder(name, token)
        writer = shaped.write.mode("errorifexists")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(folder)
        return folder

    def version(self, name: str, folder: str) -> DataFrame:
        """Rows of a written version, current or not."""
        return self.spark.read.schema(self.stored(name).schema).parquet(folder).drop(*units.HIDDEN)

    def publish(self, name: str, folder: str, values: Sequence | None = None) -> None:
        """Make a written version the current one; of a table with units those of ``values`` only."""
        unit = self.unit(name)
        if unit:
            known = {self._unit_value(unit, r["partition"]) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
            if values is None:
                written = self.spark.read.schema(self.stored(name).schema).parquet(folder)
                values = known | {r[0] for r in written.select(unit.name).distinct().collect()}
            for value in sorted(values):
                self._point(name, unit, value, posixpath.join(folder, f"{unit.name}={value}"), value in known)
        else:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)

    def _point(self, name: str, unit: Unit, value, folder: str, known: bool) -> None:
        """Point one unit at a folder, which holds no file where the unit lost all its rows."""
        files.make_folder(self.spark, folder)
        part = f"PARTITION ({unit.name} = {value if unit.count else repr(value)})"
        if known:
            self.spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}'")
        else:
            self.spark.sql(f"ALTER TABLE {name} ADD {part} LOCATION '{folder}'")

    @staticmethod
    def _unit_value(unit: Unit, text: str):
        value = unquote(text.split("=", 1)[1])
        return int(value) if unit.count else value

    def units_of(self, name: str, values: Sequence, token: str) -> set:
        """Those of the given units whose rows were written under the token: the ledger of applied loads."""
        unit = self.unit(name)
        found = set()
        for path in units.within(self.stored(name), unit, values).inputFiles():
            if f"/t={token}/" in path:
                part = next(p for p in path.split("/") if p.startswith(f"{unit.name}="))
                found.add(self._unit_value(unit, part))
        return found

    def remove_old_versions(self, name: str, keep_hours: float = 24 * 7) -> list[str]:
        """Delete version folders that the table no longer uses and that are old enough; returns them.

        A version of which a single unit is still in use stays whole.
        """
        root = posixpath.join(self.root, *name.split("."))
        used = [f"{path}/" for path in self.stored(name).inputFiles()]
        used.append(self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"] + "/")
        removed = []
        for folder in files.old_folders(self.spark, root, keep_hours):
            if not any(f"/{'/'.join(folder.split('/')[-len(name.split('.')) - 1:])}/" in path for path in used):
                files.remove_folder(self.spark, folder)
                removed.append(folder)
        return removed

    def swap(self, name: str, rows: DataFrame, sort_by: Sequence[str] = ()) -> str:
        """Write a new version and make it current; returns its folder."""
        folder = self.write_version(name, rows, sort_by)
        self.publish(name, folder)
        return folder

    def _partitions(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]

    def _new_folder(self, name: str, token: str | None = None) -> str:
        # a fresh name per attempt: a retried job never meets half-written files
        folder = posixpath.join(self.root, *name.split("."), f"v={uuid.uuid4().hex}")
        return posixpath.join(folder, f"t={token}") if token else folder

    def stage(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """Rows written once beside the tables and read back, and their folder."""
        folder = posixpath.join(self.root, "_stage", uuid.uuid4().hex)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder), folder

    def drop_stage(self, folder: str) -> None:
        files.remove_folder(self.spark, folder)
