"""Tables with units: partial loads, digests, clustering, replays, old versions."""

import datetime as dt
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastre.operators import merge
from cadastre.schemas import TableSpec
from cadastre.sinks import units
from cadastre.sinks.catalog import Warehouse
from cadastre.sinks.loading import run_load
from conftest import rows_of

OLD = dt.datetime(2001, 1, 1)
KEYED = TableSpec("staging.keyed", (("id", "string"), ("v", "bigint"), ("w", "string"), ("at", "timestamp")),
                  {"at": "current_timestamp()"}, unit="id:64")
MONTHS = TableSpec("consumption.months", (("id", "string"), ("fecha", "date"), ("ciudad", "string"), ("tipo", "string"),
                                          ("v", "bigint"), ("at", "timestamp")),
                   {"at": "current_timestamp()"}, sort_by=("fecha", "ciudad", "tipo"), unit="fecha:0")


def keyed(spark, rows):
    return spark.createDataFrame(rows, "id string, v bigint, w string")


def months(spark, rows):
    return spark.createDataFrame(rows, "id string, fecha date, ciudad string, tipo string, v bigint")


@pytest.fixture
def house(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.create(KEYED, replace=True)
    warehouse.create(MONTHS, replace=True)
    return warehouse


def files_of(house, name):
    return {p: os.path.getmtime(p.removeprefix("file:").replace("///", "/")) for p in house.stored(name).inputFiles()}


def plain(house, name, *columns):
    return rows_of(house.table(name), *columns)


def test_one_key_reads_and_writes_one_bucket(spark, house):
    run_load(house, KEYED.name, keyed(spark, [(f"k{i}", i, "x") for i in range(500)]), "FULL", now=F.lit(OLD))
    before = files_of(house, KEYED.name)
    assert len({p.split("/_bucket=")[1].split("/")[0] for p in before}) == 64
    seen = []
    original = merge.upsert_load

    def spy(source, target, *rest):
        seen.extend(target.inputFiles())
        return original(source, target, *rest)

    merge.upsert_load = spy
    try:
        result = run_load(house, KEYED.name, keyed(spark, [("k7", 700, None)]), "UPSERT", "id")
    finally:
        merge.upsert_load = original
    after = files_of(house, KEYED.name)
    assert (result.inserted, result.updated) == (0, 1)
    assert len({p.split("/_bucket=")[1].split("/")[0] for p in seen}) == 1
    assert len(after.keys() - before.keys()) == 1 and len(before.keys() - after.keys()) == 1
    assert house.table(KEYED.name).columns == KEYED.column_names
    assert plain(house, KEYED.name, "id", "v", "w") == sorted(
        [(f"k{i}", 700 if i == 7 else i, None if i == 7 else "x") for i in range(500)], key=repr)
    assert house.table(KEYED.name).where(F.col("at") != F.lit(OLD)).count() == 0


@pytest.mark.parametrize("strategy", ["UPSERT", "INCREMENTAL", "SYNC", "FULL"])
@pytest.mark.parametrize("spec", [KEYED, MONTHS])
def test_units_load_as_plain_tables_do(spark, house, spec, strategy):
    rng = random.Random(4)
    twin = TableSpec(spec.name + "_plain", spec.columns, spec.defaults)
    house.create(twin, replace=True)

    def rows(seed, count, ids):
        rng = random.Random(seed)
        out = []
        for i in rng.sample(range(ids), count):
            day = dt.date(2024, rng.randint(1, 6), rng.randint(1, 28)) if rng.random() < 0.9 else None
            out.append((f"k{i}", rng.randint(0, 3), rng.choice("xyz")) if spec is KEYED
                       else (f"k{i}", day, rng.choice(["Bogota", "Cali", None]), "casa", rng.randint(0, 3)))
        return (keyed if spec is KEYED else months)(spark, out)

    columns = [c for c, _ in spec.columns]
    for step, now in ((1, OLD), (2, OLD.replace(year=2002)), (3, OLD.replace(year=2003))):
        batch = rows(step, 60, 100)
        results = [run_load(house, name, batch, "FULL" if step == 1 else strategy, "id", now=F.lit(now))
                   for name in (spec.name, twin.name)]
        assert results[0] == results[1]
        assert plain(house, spec.name, *columns) == plain(house, twin.name, *columns)
    assert rng


def test_sync_of_an_unchanged_source_writes_nothing(spark, house):
    rows = [(f"k{i}", dt.date(2024, 1 + i % 4, 3), "Cali", None, i) for i in range(40)]
    run_load(house, MONTHS.name, months(spark, rows), "SYNC", "id")
    before = files_of(house, MONTHS.name)
    result = run_load(house, MONTHS.name, months(spark, rows), "SYNC", "id")
    assert (result.inserted, result.updated, result.deleted) == (0, 40, 0)
    assert files_of(house, MONTHS.name) == before
    # a changed, a new and a vanished row of three months; the fourth stays
    rows[0] = (*rows[0][:4], 99)
    changed = [*(r for r in rows if r[0] != "k1"), ("new", dt.date(2024, 3, 1), None, None, 1)]
    result = run_load(house, MONTHS.name, months(spark, changed), "SYNC", "id")
    assert (result.inserted, result.updated, result.deleted) == (1, 39, 1)
    kept = {p for p in files_of(house, MONTHS.name) if p in before}
    assert {p.split("/_month=")[1].split("/")[0] for p in kept} == {"2024-04"}
    assert plain(house, MONTHS.name, "id", "v") == sorted([(r[0], r[4]) for r in changed], key=repr)


def test_a_null_that_changes_its_column_is_a_change(spark, house):
    run_load(house, MONTHS.name, months(spark, [("a", dt.date(2024, 1, 1), "x", None, 1)]), "SYNC", "id")
    run_load(house, MONTHS.name, months(spark, [("a", dt.date(2024, 1, 1), None, "x", 1)]), "SYNC", "id")
    assert plain(house, MONTHS.name, "ciudad", "tipo") == [(None, "x")]


def test_a_moved_row_leaves_its_old_month(spark, house):
    for strategy in ("SYNC", "UPSERT"):
        run_load(house, MONTHS.name, months(spark, [("a", dt.date(2024, 1, 1), "x", "y", 1)]), "FULL", now=F.lit(OLD))
        run_load(house, MONTHS.name, months(spark, [("a", dt.date(2024, 2, 1), "x", "y", 1)]), strategy, "id")
        assert plain(house, MONTHS.name, "id", "fecha", "at") == [("a", dt.date(2024, 2, 1), OLD)]


def test_repeated_stored_key_is_refused(spark, house):
    run_load(house, KEYED.name, keyed(spark, [("a", 1, "x")]), "FULL")
    for strategy in ("SYNC", "UPSERT"):
        with pytest.raises(ValueError, match="more than once"):
            run_load(house, KEYED.name, keyed(spark, [("a", 2, "x"), ("a", 3, "x")]), strategy, "id")
    assert plain(house, KEYED.name, "id", "v") == [("a", 1)]


def test_stopped_load_resumes_bucket_by_bucket(spark, house, monkeypatch):
    run_load(house, KEYED.name, keyed(spark, [(f"k{i}", i, "x") for i in range(200)]), "FULL", now=F.lit(OLD))
    batch = keyed(spark, [(f"k{i}", -i, "y") for i in range(0, 200, 20)])
    touched = {r[0] for r in batch.select(units.Unit(("id",), 64).value()).distinct().collect()}
    pointed, point = [], Warehouse._point

    def stopping(self, name, unit, value, folder, known):
        if len(pointed) == 3:
            raise RuntimeError("stopped")
        pointed.append(value)
        point(self, name, unit, value, folder, known)

    monkeypatch.setattr(Warehouse, "_point", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        run_load(house, KEYED.name, batch, "UPSERT", "id", token="s-1")
    assert house.units_of(KEYED.name, sorted(touched), "s-1") == set(pointed)
    first, done = list(pointed), files_of(house, KEYED.name)
    monkeypatch.setattr(Warehouse, "_point", lambda *a: (pointed.append(a[3]), point(*a))[1])
    run_load(house, KEYED.name, batch, "UPSERT", "id", token="s-1")
    assert len(first) == 3 and sorted(pointed) == sorted(touched)  # each bucket once
    after = files_of(house, KEYED.name)
    assert all(p in after for p in done if int(p.split("/_bucket=")[1].split("/")[0]) in first)
    assert plain(house, KEYED.name, "id", "v") == sorted(
        [(f"k{i}", -i if i % 20 == 0 else i) for i in range(200)], key=repr)
    # a third time there is nothing left to do
    result = run_load(house, KEYED.name, batch, "UPSERT", "id", token="s-1")
    assert result.affected == 0 and files_of(house, KEYED.name) == after


def test_one_city_opens_few_row_groups(spark, house):
    cities = [f"{a}{b}ville" for a in "abcdefghijklmnopqrstuvwxy" for b in "ao"]
    rows = (spark.range(60_000).select(
        F.col("id").cast("string").alias("id"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.hash("id") % 28 + 28).cast("int") % 28)
        .alias("fecha"), F.element_at(F.array(*map(F.lit, cities)), F.pmod(F.hash("id", F.lit(1)), F.lit(50)) + 1).alias("ciudad"),
        F.element_at(F.array(F.lit("casa"), F.lit("lote"), F.lit("villa")), F.pmod(F.hash("id", F.lit(2)), F.lit(3)) + 1).alias("tipo"),
        F.col("id").alias("v")))
    block = spark.sparkContext._jsc.hadoopConfiguration()
    block.set("parquet.block.size", str(8 << 10))
    try:
        run_load(house, MONTHS.name, rows, "FULL")
    finally:
        block.unset("parquet.block.size")
    groups = {"ciudad": [], "tipo": [], "fecha": []}
    for path in house.stored(MONTHS.name).inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                if column.path_in_schema in groups:
                    groups[column.path_in_schema].append((column.statistics.min, column.statistics.max))
    assert len(groups["ciudad"]) >= 100

    def opened(column, value):
        return sum(a <= value <= z for a, z in groups[column]) / len(groups[column])

    assert opened("ciudad", "moville") < 0.2
    assert opened("fecha", dt.date(2024, 1, 9)) < 0.4 and opened("tipo", "lote") < 0.7


def test_units_are_pruned_by_the_catalog(spark, house):
    run_load(house, MONTHS.name, months(spark, [(str(i), dt.date(2024, 1 + i % 12, 5), "x", "y", i) for i in range(60)]), "FULL")
    assert len(house.stored(MONTHS.name).where("_month = '2024-05'").inputFiles()) == 1


def test_old_versions_are_removed_when_unused(spark, house):
    for v in range(3):
        run_load(house, KEYED.name, keyed(spark, [("a", v, "x"), ("b", v, "x")]), "UPSERT", "id")
    run_load(house, KEYED.name, keyed(spark, [("a", 9, "x")]), "UPSERT", "id")
    expected = plain(house, KEYED.name, "id", "v")
    assert house.remove_old_versions(KEYED.name) == []
    removed = house.remove_old_versions(KEYED.name, keep_hours=0)
    assert removed and plain(house, KEYED.name, "id", "v") == expected == [("a", 9), ("b", 2)]
    run_load(house, KEYED.name, keyed(spark, [("c", 1, "x")]), "UPSERT", "id")
    assert plain(house, KEYED.name, "id") == [("a",), ("b",), ("c",)]


def test_truncate_and_append(spark, house):
    run_load(house, KEYED.name, keyed(spark, [(f"k{i}", i, "x") for i in range(20)]), "FULL")
    house.truncate(KEYED.name)
    assert house.table(KEYED.name).count() == 0
    house.append(KEYED.name, keyed(spark, [("z", 1, "x")]))
    house.append(KEYED.name, keyed(spark, [("z2", 1, "x"), ("z3", None, None)]))
    assert plain(house, KEYED.name, "id") == [("z",), ("z2",), ("z3",)]


def test_interleaved_bits(spark):
    got = spark.createDataFrame([(dt.date(1970, 1, 2), "a", None)], "d date, c string, t string")
    code = got.select(units.interleaved(("d", "c", "t"), got.schema)).first()[0]
    # day 1 -> 8, bit 3; "a" -> 1 * 1024, bit 10; the first column has the highest place
    assert code == (1 << (3 * 3 + 2)) | (1 << (3 * 10 + 1))
