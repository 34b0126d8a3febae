"""Control tables: what to ingest and which consumption tables to build."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Any

from pyspark.sql import functions as F

from cadastre.schemas import CONSUMPTION_PARAMETERS, INGEST_PARAMETERS
from cadastre.sinks.catalog import Warehouse
from cadastre.sources.tables import role_map

log = logging.getLogger(__name__)

ROLES = ("FEATURES", "TRAIN", "TEST")


@dataclass(frozen=True)
class SourceParameters:
    """The ingest row of one source and its consumption rows in load order."""

    ingest: dict[str, Any]
    consumption: tuple[dict[str, Any], ...]

    def __getitem__(self, name: str) -> Any:
        return self.ingest.get(name)

    def need(self, name: str) -> Any:
        value = self.ingest.get(name)
        if not value:
            raise ValueError(f"parameter {name} of {self.ingest['nombre_archivo']!r} is empty")
        return value


def source_parameters(warehouse: Warehouse, name: str,
                      active_only: bool = True) -> SourceParameters | None:
    """Parameters of one source, None (with a warning) when it is not configured.

    Both tables hold a handful of rows per source; only those are collected.
    """
    rows = (warehouse.table(INGEST_PARAMETERS.name)
            .where(F.col("nombre_archivo") == name).limit(1).collect())
    if not rows:
        log.warning("no ingest parameters for %r", name)
        return None
    consumption = warehouse.table(CONSUMPTION_PARAMETERS.name).where(F.col("nombre_archivo") == name)
    if active_only:
        consumption = consumption.where("activo")
    ordered = consumption.orderBy("orden_carga", "tabla_consumption").collect()
    return SourceParameters(rows[0].asDict(), tuple(r.asDict() for r in ordered))


def consumption_tables(warehouse: Warehouse, name: str) -> dict[str, str]:
    """Table per role; every role must be configured."""
    active = warehouse.table(CONSUMPTION_PARAMETERS.name).where(
        (F.col("nombre_archivo") == name) & F.col("activo"))
    roles = {r["rol"]: r["tabla"] for r in role_map(active).collect()}
    if not roles:
        raise ValueError(f"no consumption tables are configured for {name!r}")
    missing = [r for r in ROLES if r not in roles]
    if missing:
        raise ValueError(f"no consumption table for the roles {missing}")
    return {r: roles[r] for r in ROLES}
