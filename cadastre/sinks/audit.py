"""One row per run of a step."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from cadastre.schemas import AUDIT
from cadastre.sinks.catalog import Warehouse

log = logging.getLogger(__name__)

MESSAGE_LIMIT = 1024


def record_run(warehouse: Warehouse, name: str, source: str, started: datetime, state: str,
               read: int = 0, inserted: int = 0, rejected: int = 0,
               message: str | None = None, finished: datetime | None = None) -> bool:
    """Append an audit row; a failure to do so is logged and never raised."""
    finished = finished or datetime.now(timezone.utc)
    row = (name, source, started, finished, state, int(read), int(inserted), max(int(rejected), 0),
           message[:MESSAGE_LIMIT] if message else None, started.date())
    try:
        frame = warehouse.spark.createDataFrame([row], AUDIT.schema)
        warehouse.append(AUDIT.name, frame.coalesce(1))
        return True
    except Exception as exc:  # the audit must not turn a good run into a failed one
        log.error("run of %s could not be recorded: %s", name, exc)
        return False
