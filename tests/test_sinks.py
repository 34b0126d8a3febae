"""Catalog tables, load strategies and the audit log."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cadastre.schemas import (
    AUDIT, INGEST_PARAMETERS, INGEST_PARAMETERS_ADDED, RAW_AUCTIONS, STAGING_TRANSACTIONS, TableSpec)
from cadastre.sinks.audit import record_run
from cadastre.sinks.catalog import Warehouse, full_name
from cadastre.sinks.loading import STRATEGIES, key_list, run_load
from conftest import rows_of

TABLE = TableSpec("staging.items", (("id", "string"), ("v", "bigint"), ("at", "timestamp")),
                  {"at": "current_timestamp()"})
OLD = dt.datetime(2001, 1, 1)


@pytest.fixture
def house(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.create(TABLE, replace=True)
    stored = spark.createDataFrame([("a", 1, OLD), ("b", 2, OLD)], "id string, v bigint, at timestamp")
    warehouse.append(TABLE.name, stored)
    return warehouse


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v bigint")


def stored(house):
    return {(r["id"], r["v"]): r["at"] for r in house.table(TABLE.name).collect()}


def test_table_names():
    assert full_name("t", "raw") == "raw.t" and full_name(" `c.d.t` ") == "c.d.t"
    for bad in ("", "t", "a.b.c.d", "a..b", None):
        with pytest.raises(ValueError):
            full_name(bad)


def test_defaults_fill_absent_columns(spark, house):
    house.append(TABLE.name, source(spark, ("c", 3)))
    assert house.defaults(TABLE.name) == {"at": "current_timestamp()"}
    assert stored(house)[("c", 3)] > OLD


def test_full(spark, house):
    result = run_load(house, TABLE.name, source(spark, ("x", 1), ("y", 2)), "full")
    assert result.inserted == result.affected == 2
    assert set(stored(house)) == {("x", 1), ("y", 2)}


def test_incremental(spark, house):
    result = run_load(house, TABLE.name, source(spark, ("b", 20), ("c", 3)), None, "id")
    assert result.affected == 1
    assert set(stored(house)) == {("a", 1), ("b", 2), ("c", 3)}


def test_upsert_twice_is_once(spark, house):
    rows = source(spark, ("b", 20), ("c", 3))
    first = run_load(house, TABLE.name, rows, "UPSERT", "id")
    once = stored(house)
    second = run_load(house, TABLE.name, rows, "upsert ", "id")
    assert (first.inserted, first.updated, second.inserted, second.updated) == (1, 1, 0, 2)
    assert stored(house) == once and once[("b", 20)] == OLD and once[("c", 3)] > OLD


def test_upsert_refuses_repeated_stored_keys(spark, house):
    with pytest.raises(ValueError, match="more than once"):
        run_load(house, TABLE.name, source(spark, ("b", 1), ("b", 2)), "UPSERT", "id")
    assert set(stored(house)) == {("a", 1), ("b", 2)}


def test_sync(spark, house):
    result = run_load(house, TABLE.name, source(spark, ("b", 20), ("c", 3)), "SYNC", ["id"])
    assert (result.inserted, result.updated, result.deleted) == (1, 1, 1)
    assert set(stored(house)) == {("b", 20), ("c", 3)} and stored(house)[("b", 20)] == OLD


def test_failed_rewrite_leaves_the_table(spark, house):
    with pytest.raises(Exception, match="must not be NULL"):
        run_load(house, TABLE.name, source(spark, ("c", 1), (None, 2)), "FULL", required=["id"])
    assert set(stored(house)) == {("a", 1), ("b", 2)}


def test_wrong_settings(spark, house):
    rows = source(spark, ("a", 1))
    for strategy, keys, match in (("MERGE", "id", "unknown"), ("UPSERT", "", "at least one key"),
                                  ("INCREMENTAL", None, "at least one key"),
                                  ("UPSERT", "nope", "not in"), ("UPSERT", "id, v", "besides")):
        with pytest.raises(ValueError, match=match):
            run_load(house, TABLE.name, rows, strategy, keys)
    with pytest.raises(LookupError):
        run_load(house, "staging.absent", rows, "FULL")
    assert key_list(" id , v,,") == ("id", "v") and set(STRATEGIES) == {
        "FULL", "INCREMENTAL", "UPSERT", "SYNC"}


def test_incremental_keys_are_within_upsert_keys(spark, house, tmp_path):
    rows = source(spark, ("b", 20), ("c", 3))
    run_load(house, TABLE.name, rows, "INCREMENTAL", "id")
    after_incremental = {k for k, _ in stored(house)}
    run_load(house, TABLE.name, rows, "UPSERT", "id")
    assert after_incremental <= {k for k, _ in stored(house)}


def test_partitioned_table_and_truncate(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    spec = TableSpec("staging.days", (("id", "string"), ("day", "date")), partition_by=("day",))
    house.create(spec, replace=True)
    rows = spark.range(50).selectExpr("cast(id as string) id", "date_add(date'2024-01-01', cast(id % 3 as int)) day")
    folder = house.swap(spec.name, rows)
    assert len([f for f in os.listdir(folder) if f.startswith("day=")]) == 3
    assert house.table(spec.name).where("day = date'2024-01-02'").count() == 17
    house.append(spec.name, rows.limit(1))
    assert house.table(spec.name).count() == 51
    house.truncate(spec.name)
    assert house.table(spec.name).count() == 0


def test_upsert_moves_a_row_to_another_partition(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    spec = TableSpec("staging.moved", (("id", "string"), ("day", "date"), ("v", "bigint"),
                                       ("at", "timestamp")), {"at": "current_timestamp()"},
                     partition_by=("day",))
    house.create(spec, replace=True)
    columns = "id string, day date, v bigint"
    day = dt.date(2024, 1, 1).replace
    run_load(house, spec.name, spark.createDataFrame(
        [("a", day(day=1), 1), ("b", day(day=2), 2)], columns), "FULL", sort_by=["v"])
    result = run_load(house, spec.name, spark.createDataFrame(
        [("a", day(day=2), 5), ("c", day(day=3), 3)], columns), "UPSERT", "id", sort_by=["v"])
    assert (result.inserted, result.updated) == (1, 1)
    assert rows_of(house.table(spec.name), "id", "day", "v") == [
        ("a", day(day=2), 5), ("b", day(day=2), 2), ("c", day(day=3), 3)]


def test_every_table_of_the_model(warehouse):
    spec = STAGING_TRANSACTIONS
    assert warehouse.table(spec.name).columns == spec.column_names
    assert spec.data_columns == spec.column_names[:-1]
    assert warehouse.defaults(RAW_AUCTIONS.name) == {"_loaded_at": "current_timestamp()"}


def test_columns_are_added_once(warehouse):
    added = [c for c, _ in INGEST_PARAMETERS_ADDED]
    assert warehouse.add_columns(INGEST_PARAMETERS.name, INGEST_PARAMETERS_ADDED) == added
    assert warehouse.add_columns(INGEST_PARAMETERS.name, INGEST_PARAMETERS_ADDED) == []
    assert warehouse.table(INGEST_PARAMETERS.name).columns[-2:] == added


def test_audit(warehouse):
    start = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    assert record_run(warehouse, "f.csv", "raw", start, "ERROR", 5, 3, -2, "x" * 3000)
    row = warehouse.table(AUDIT.name).first()
    assert (row["filas_leidas"], row["filas_insertadas"], row["filas_rechazadas"]) == (5, 3, 0)
    assert len(row["mensaje_error"]) == 1024 and row["dia"] == dt.date(2024, 5, 1)


def test_audit_failure_is_swallowed(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "none"))
    spark.sql(f"DROP TABLE IF EXISTS {AUDIT.name}")
    assert record_run(house, "f", "raw", dt.datetime.now(dt.timezone.utc), "OK") is False


def test_version_is_read_back_before_it_is_published(spark, house):
    folder = house.write_version(TABLE.name, house.table(TABLE.name).withColumn("v", F.col("v") + 1))
    assert rows_of(house.version(TABLE.name, folder), "v") == [(2,), (3,)]
    assert set(stored(house)) == {("a", 1), ("b", 2)}
    house.publish(TABLE.name, folder)
    assert set(stored(house)) == {("a", 2), ("b", 3)}
