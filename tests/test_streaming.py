"""Streaming jobs: each file once, repeatable batches, routing of bad rows."""

import os

from cadastre.operators.rows import FieldRule
from cadastre.schemas import RAW_TRANSACTIONS, STAGING_TRANSACTIONS, TRANSACTION_TEXT, TableSpec
from cadastre.sinks.catalog import Warehouse
from cadastre.streaming import jobs
from conftest import rows_of

HEADER = ",".join(TRANSACTION_TEXT)


def arrive(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *rows]) + "\n", encoding="utf-8")


def line(id, price, city="Cali"):
    return f"{id},{city}, casa,50,2,1,{price},4.5,-74.1,2024-03-05,Vendida"


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_files_are_ingested_once(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    spec = jobs.batch_table(RAW_TRANSACTIONS, "raw.arriving")
    house.create(spec, replace=True)
    landing, archive = tmp_path / "in", tmp_path / "done"

    def once():
        stream = jobs.arriving_csv(spark, str(landing), TRANSACTION_TEXT, str(archive))
        run(jobs.ingest(stream, house, spec.name, str(tmp_path / "cp")))

    arrive(landing, "a.csv", line("1", "10"), line("2", ""))
    once()
    once()
    assert rows_of(house.table(spec.name), "id", "precio_cop") == [("1", "10"), ("2", "")]
    arrive(landing, "b.csv", line("3", "30"))
    once()
    assert rows_of(house.table(spec.name), "id") == [("1",), ("2",), ("3",)]
    assert house.table(spec.name).where("_loaded_at IS NULL").count() == 0
    assert not os.path.exists(landing / "a.csv")  # archived once a later batch ran


def test_replayed_batch_does_not_repeat_rows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    spec = jobs.batch_table(TableSpec("raw.replay", (("id", "string"),)))
    house.create(spec, replace=True)
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    for batch in (0, 0, 1):
        house.overwrite_partition(spec.name, jobs.BATCH, batch, rows)
    assert rows_of(house.table(spec.name), jobs.BATCH) == [(0,), (0,), (1,), (1,)]


def test_stream_upsert_matches_batch(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    house.create(STAGING_TRANSACTIONS, replace=True)
    landing = tmp_path / "in"

    def once():
        stream = jobs.arriving_csv(spark, str(landing), TRANSACTION_TEXT)
        run(jobs.upsert(stream, house, STAGING_TRANSACTIONS.name, str(tmp_path / "cp")))

    arrive(landing, "a.csv", line("1", "10"), line("1", "10"), line("2", "20"))
    once()
    stamps = dict(rows_of(house.table(STAGING_TRANSACTIONS.name), "id", "_loaded_at"))
    arrive(landing, "b.csv", line("2", "25", "Bogotá"), line("3", "30"), line("4", " "))
    once()
    assert rows_of(house.table(STAGING_TRANSACTIONS.name), "id", "precio_cop", "ciudad") == [
        ("1", 10, "Cali"), ("2", 25, "Bogota"), ("3", 30, "Cali")]
    assert dict(rows_of(house.table(STAGING_TRANSACTIONS.name), "id", "_loaded_at"))["2"] == stamps["2"]


def test_bad_rows_go_to_quarantine(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    text = tuple((c, "string") for c in TRANSACTION_TEXT)
    good = jobs.batch_table(TableSpec("raw.good", text))
    bad = jobs.batch_table(TableSpec("raw.bad", text), extra=[("errors", "array<string>")])
    house.create(good, replace=True)
    house.create(bad, replace=True)
    landing = tmp_path / "in"
    arrive(landing, "a.csv", line("1", "10"), line("", "10"), line("3", "x"))
    stream = jobs.arriving_csv(spark, str(landing), TRANSACTION_TEXT)
    rules = [FieldRule("id"), FieldRule("precio_cop", "decimal", 0, 1e12)]
    run(jobs.check(stream, rules, house, good.name, bad.name, str(tmp_path / "cp")))
    assert rows_of(house.table(good.name), "id") == [("1",)]
    assert rows_of(house.table(bad.name), "id", "errors") == [
        ("", ["id: required"]), ("3", ["precio_cop: not a number"])]
