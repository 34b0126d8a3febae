"""What a raw run takes in, written down before anything is moved.

A run is named by its files (name, length, modification time), so the same arrival has the same name
whenever it is looked at.  Its rows are one unit of the raw table.  A run that was stopped is found
by its open manifest and goes on where it stands: files that were moved are left where they are, and
rows that are in the table are not read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.schemas import RAW_MANIFEST
from cadastre.sinks.catalog import Warehouse

FOUND, ARCHIVED = "found", "archived"


@dataclass(frozen=True)
class Run:
    warehouse: Warehouse
    source: str
    name: str

    def files(self) -> DataFrame:
        """``(posicion, archivo)`` of the run, none for a service."""
        return (self.warehouse.table(RAW_MANIFEST.name).where(
            (F.col("run") == self.name) & (F.col("evento") == FOUND) & F.col("archivo").isNotNull())
            .select("posicion", "archivo"))

    def holds(self, name: str, status: tuple) -> bool:
        """Whether a file is in the manifest with this length and modification time."""
        row = self.warehouse.table(RAW_MANIFEST.name).where(
            (F.col("run") == self.name) & (F.col("archivo") == name)).select("longitud", "modificado").first()
        return row is not None and tuple(row) == status

    def names(self) -> Iterator[str]:
        """File names in order, a partition at a time on the driver."""
        for row in self.files().orderBy("posicion").select("archivo").toLocalIterator():
            yield row["archivo"]

    def close(self, now: datetime) -> None:
        row = self.warehouse.spark.createDataFrame([(self.source, self.name, ARCHIVED, now)],
                                                   "nombre_archivo string, run string, evento string, registrado timestamp")
        self.warehouse.append(RAW_MANIFEST.name, row)


def open_run(warehouse: Warehouse, source: str) -> Run | None:
    """The latest run of the source that was begun and not ended."""
    rows = warehouse.table(RAW_MANIFEST.name).where(F.col("nombre_archivo") == source)
    found = (rows.groupBy("run").agg(F.max("registrado").alias("at"), F.max(F.col("evento") == ARCHIVED).alias("done"))
             .where("not done").orderBy(F.desc("at")).select("run").first())
    return Run(warehouse, source, found["run"]) if found else None


def begin(warehouse: Warehouse, source: str, listed: DataFrame, now: datetime, salt: str = "") -> Run:
    """Write the manifest of a new run; ``listed`` has ``posicion, archivo, longitud, modificado``.

    ``salt`` tells runs apart that have no files to be named by.
    """
    entry = F.concat_ws("|", "posicion", "archivo", "longitud", F.col("modificado").cast("string"))
    # sums of hashes: one row comes to the driver, whatever the number of files
    digest = listed.agg(F.count("*"), F.sum(F.xxhash64(entry).cast("decimal(38,0)")),
                        F.bit_xor(F.xxhash64(F.lit(1), entry))).first()
    name = hashlib.md5("\x00".join((source, salt, *map(str, digest))).encode()).hexdigest()
    warehouse.append(RAW_MANIFEST.name, listed.withColumns({
        "nombre_archivo": F.lit(source), "run": F.lit(name), "evento": F.lit(FOUND), "registrado": F.lit(now)}))
    return Run(warehouse, source, name)
