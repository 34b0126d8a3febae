"""Load a frame into a stored table under a named strategy."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cadastre.operators import merge
from cadastre.sinks.catalog import Warehouse
from cadastre.sinks.units import DIGEST, HIDDEN, Unit, digest, outside, within


@dataclass(frozen=True)
class LoadResult:
    inserted: int = 0
    updated: int = 0
    deleted: int = 0

    @property
    def affected(self) -> int:
        return self.inserted + self.updated + self.deleted


@dataclass(frozen=True)
class Load:
    """Everything a strategy needs to know about one load."""

    warehouse: Warehouse
    table: str
    source: DataFrame
    keys: tuple[str, ...]
    defaults: dict[str, Column]
    sort_by: tuple[str, ...] = ()
    unique_source: bool = False
    #: name of the load, by which a repeated one knows the units it has done already
    token: str | None = None


Strategy = Callable[[Load], LoadResult]
STRATEGIES: dict[str, Strategy] = {}


def strategy(name: str) -> Callable[[Strategy], Strategy]:
    """Register a strategy; names are compared without regard to case."""
    def add(function: Strategy) -> Strategy:
        STRATEGIES[name.upper()] = function
        return function
    return add


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Count actions while the rows are written: no second pass over the data."""
    counts = Observation()
    counted = rows.observe(
        counts,
        F.count_if(F.col(merge.ACTION) == "insert").alias("inserted"),
        F.count_if(F.col(merge.ACTION) == "update").alias("updated"))
    return counted.drop(merge.ACTION), counts


def _need_keys(load: Load, name: str) -> None:
    if not load.keys:
        raise ValueError(f"{name} needs at least one key column")


def _refuse_repeated(load: Load, target: DataFrame, name: str) -> None:
    if load.unique_source:
        return
    repeated = merge.repeated_source_keys(load.source, target, load.keys).take(1)
    if repeated:
        raise ValueError(f"{name} source holds a stored key more than once: {repeated[0]}")


@contextmanager
def _staged(load: Load) -> Iterator[Load]:
    """The load with its source written once: it is read for its units, its keys and its rows."""
    unit, rows = load.warehouse.unit(load.table), load.source
    if unit:
        # units and digests depend on the types
        schema = load.warehouse.table(load.table).schema
        rows = rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in rows.columns]).select("*", unit.value())
    staged, folder = load.warehouse.stage(rows)
    try:
        yield replace(load, source=staged)
    finally:
        load.warehouse.drop_stage(folder)


def _touched(load: Load, unit: Unit) -> list:
    """Units that hold a row of the staged source or a stored row of one of its keys."""
    found = load.source.select(unit.name)
    if not unit.fixed_by(load.keys):
        # keys and units are all that is read of the stored rows
        stored = load.warehouse.stored(load.table).select(*load.keys, unit.name)
        found = found.union(stored.join(load.source.select(*load.keys), list(load.keys), "left_semi").select(unit.name))
    return sorted(r[0] for r in found.distinct().collect())


@dataclass(frozen=True)
class Prepared:
    """A load that is written but not published: the rows of ``units``, or of the table if that is None."""

    table: str
    folder: str
    units: list | None
    result: LoadResult

    def rows(self, warehouse: Warehouse) -> DataFrame:
        """The table as it will be."""
        written = warehouse.version(self.table, self.folder)
        if self.units is None:
            return written
        kept = outside(warehouse.stored(self.table), warehouse.unit(self.table), self.units)
        return kept.drop(*HIDDEN).unionByName(written) if self.units else kept.drop(*HIDDEN)

    def publish(self, warehouse: Warehouse) -> LoadResult:
        if self.units is None or self.units:
            warehouse.publish(self.table, self.folder, self.units)
        return self.result


@strategy("FULL")
def load_full(load: Load) -> LoadResult:
    """Replace all rows."""
    rows, counts = _observed(merge.full_load(load.source, load.defaults))
    load.warehouse.swap(load.table, rows, load.sort_by)
    return LoadResult(inserted=counts.get["inserted"])


@strategy("INCREMENTAL")
def load_incremental(load: Load) -> LoadResult:
    """Append rows with new keys; stored files are not touched."""
    _need_keys(load, "INCREMENTAL")
    with _staged(load) as staged:
        unit, target = load.warehouse.unit(load.table), load.warehouse.stored(load.table)
        if unit and unit.fixed_by(load.keys):
            target = within(target, unit, _touched(staged, unit))
        rows, counts = _observed(
            merge.incremental_load(staged.source, target, load.keys, load.defaults))
        load.warehouse.append(load.table, rows.drop(*HIDDEN))
        return LoadResult(inserted=counts.get["inserted"])


@strategy("UPSERT")
def load_upsert(load: Load) -> LoadResult:
    """Update known keys and add new ones in a new version of the units they touch, or of the table."""
    _need_keys(load, "UPSERT")
    if not [c for c in load.source.columns if c not in load.keys]:
        raise ValueError("UPSERT needs at least one column besides the keys")
    house, unit = load.warehouse, load.warehouse.unit(load.table)
    with _staged(load) as staged:
        source, target, touched = staged.source, house.stored(load.table), None
        if unit:
            touched = _touched(staged, unit)
            if load.token and unit.fixed_by(load.keys):
                done = house.units_of(load.table, touched, load.token)
                touched = [u for u in touched if u not in done]
                source = within(source, unit, touched)
            target = within(target, unit, touched)
        source, target = source.drop(*HIDDEN), target.drop(*HIDDEN)
        _refuse_repeated(replace(load, source=source), target, "UPSERT")
        rows, counts = _observed(merge.upsert_load(source, target, load.keys, load.defaults))
        folder = house.write_version(load.table, rows, load.sort_by, load.token)
        result = LoadResult(counts.get["inserted"], counts.get["updated"])
        return Prepared(load.table, folder, touched, result).publish(house)


@strategy("SYNC")
def load_sync(load: Load, touch: bool = False) -> LoadResult:
    """Make the table equal to the source, dropping what the source lacks."""
    return prepare_sync(load, touch).publish(load.warehouse)


def prepare_sync(load: Load, touch: bool = False) -> Prepared:
    """Write what a synchronising load changes.

    Of a table with units keys and digests are compared first, and only units with a new, changed or
    vanished row are read and written; ``touch`` renews the default columns, hence every unit.
    """
    _need_keys(load, "SYNC")
    house, unit = load.warehouse, load.warehouse.unit(load.table)
    if not unit:
        target = house.table(load.table)
        _refuse_repeated(load, target, "SYNC")
        before = target.count()
        rows, counts = _observed(merge.sync_load(load.source, target, load.keys, load.defaults, touch))
        folder = house.write_version(load.table, rows, load.sort_by)
        inserted, updated = counts.get["inserted"], counts.get["updated"]
        return Prepared(load.table, folder, None, LoadResult(inserted, updated, before - updated))
    with _staged(load) as staged:
        source, target = staged.source, house.stored(load.table)
        data = [c for c in target.columns if c in source.columns and c not in HIDDEN]
        found = merge.compare_digests(source.select("*", digest(data)), target, load.keys,
                                      unit.name, DIGEST).collect()  # one row per unit
        if not load.unique_source and any(r["repeated"] for r in found):
            _refuse_repeated(staged, target, "SYNC")
        touched = sorted(r["unit"] for r in found if r["touched"] or touch)
        result = LoadResult(*(sum(r[c] for r in found) for c in ("inserted", "updated", "deleted")))
        if not touched:
            return Prepared(load.table, "", [], result)
        # stored stamps of rows that moved here come from units that are touched, too
        rows = merge.sync_load(within(source, unit, touched).drop(*HIDDEN),
                               within(target, unit, touched).drop(*HIDDEN), load.keys, load.defaults, touch)
        folder = house.write_version(load.table, rows.drop(merge.ACTION), load.sort_by)
        return Prepared(load.table, folder, touched, result)


def key_list(text: str | None) -> tuple[str, ...]:
    """Key columns from a comma-separated parameter."""
    return tuple(k.strip() for k in (text or "").split(",") if k.strip())


def require_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job that writes these rows when a required column is NULL."""
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.raise_error(F.lit(f"column {c} must not be NULL"))) for c in columns})


def run_load(warehouse: Warehouse, table: str, source: DataFrame,
             strategy_name: str | None = None, keys: str | Sequence[str] | None = None,
             required: Sequence[str] = (), sort_by: Sequence[str] = (),
             unique_source: bool = False, now: Column | None = None,
             token: str | None = None) -> LoadResult:
    """Dispatch a load; the default strategy is INCREMENTAL.

    Columns with a default are filled by it (or by ``now``), never by the source.  An UPSERT of a table
    with buckets that is repeated under its ``token`` skips the buckets that are done.
    """
    name = (strategy_name or "INCREMENTAL").strip().upper()
    if name not in STRATEGIES:
        raise ValueError(f"load strategy {name!r} is unknown; available: {sorted(STRATEGIES)}")
    defaults = warehouse.defaults(table)
    data_columns = [c for c in warehouse.table(table).columns if c not in defaults]
    wanted = key_list(keys) if isinstance(keys, str) or keys is None else tuple(keys)
    absent = [k for k in wanted if k not in data_columns]
    if absent:
        raise ValueError(f"key columns not in {table}: {absent}")
    rows = require_values(source.select(*data_columns), required)
    # one timestamp for the whole load, as a literal: a retried task writes the same value
    session = source.sparkSession
    stamps = {
        c: now if now is not None else F.lit(session.sql(f"SELECT {e}").first()[0])
        for c, e in defaults.items()}
    return STRATEGIES[name](Load(
        warehouse, table, rows, wanted, stamps, tuple(sort_by), unique_source, token))
