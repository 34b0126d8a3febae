"""Layer steps end to end, from files to scored requests."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cadastre.contracts import FEATURES_CONTRACT
from cadastre.operators.contracts import Contract
from cadastre.plans import training
from cadastre.plans.steps import Workspace, run_consumption, run_in_order, run_raw, run_staging
from cadastre.schemas import (
    AUDIT, CONSUMPTION_PARAMETERS, FEATURES, INGEST_PARAMETERS, INGEST_PARAMETERS_ADDED,
    MODEL_VERSIONS, RAW_AUCTIONS, RAW_FOREIGN_TRANSACTIONS, RAW_HOUSING_INDEX, RAW_TRANSACTIONS,
    RUNS, STAGING_TRANSACTIONS, TEST, TRAIN, TRANSACTION_TEXT)
from cadastre.sources.control import consumption_tables, source_parameters
from conftest import rows_of

NAME = "transactions.csv"


@pytest.fixture
def workspace(spark, warehouse, tmp_path):
    warehouse.add_columns(INGEST_PARAMETERS.name, INGEST_PARAMETERS_ADDED)
    service = tmp_path / "service"
    service.mkdir()
    for offset, size in ((0, 10), (10, 4)):
        (service / f"offset={offset}.json").write_text(json.dumps(
            [{"property": f"p{offset + i}", "status": "Sold"} for i in range(size)]))
    rows = [
        (NAME, "csv", "transactions", "transactions", "ML", "UPSERT", "id", None, None),
        ("index.xml", "XML", "housing_index", "x", "ML", "FULL", None, None, None),
        ("page_01.json", "JSON", "foreign_transactions", "x", "BI", "FULL", None, None, None),
        ("auctions", "API", "auctions", "x", "BI", "FULL", None, str(service), 10),
        ("odd.bin", "PARQUET", "auctions", "x", "BI", "FULL", None, None, None),
        ("empty", "CSV", None, None, None, None, None, None, None)]
    schema = spark.table(INGEST_PARAMETERS.name).schema
    warehouse.append(INGEST_PARAMETERS.name, spark.createDataFrame(rows, schema))
    warehouse.append(CONSUMPTION_PARAMETERS.name, spark.createDataFrame([
        (NAME, "old_features", "FEATURES", "regresion", "precio_cop", 0, True),
        (NAME, "features", "features", "regresion", "precio_cop", 1, True),
        (NAME, "train", "TRAIN", "regresion", "precio_cop", 2, True),
        (NAME, "test", "TEST", "regresion", "precio_cop", 3, True),
        (NAME, "other", "TEST", "regresion", "precio_cop", 9, False)], CONSUMPTION_PARAMETERS.schema))
    folders = {f: tmp_path / f for f in ("landing", "processing", "processed")}
    for folder in folders.values():
        folder.mkdir()
    return Workspace(warehouse, **{k: str(v) for k, v in folders.items()},
                     rest_options={"fetcher": "fake_service:fetch", "readers": 3},
                     clock=lambda: dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc))


def land(workspace, *lines, name=NAME):
    text = "\n".join([",".join(TRANSACTION_TEXT), *lines]) + "\n"
    with open(f"{workspace.landing}/{name}", "w", encoding="utf-8") as handle:
        handle.write(text)


def line(i, price=None, status="Vendida", rooms=2):
    price = 20_000_000 + 1_000_000 * (i % 50) if price is None else price
    city = ["Bogotá", "CALI", "Medellin"][i % 3]
    return f"p-{i},{city},casa,{40 + i % 50},{rooms},{1 + i % 3},{price},4.{i % 9}1,-74.{i % 7}2," \
           f"2024-0{1 + i % 5}-1{i % 9},{status}"


def audit(workspace):
    return [(r["fuente"], r["estado"], r["filas_leidas"], r["filas_insertadas"], r["filas_rechazadas"])
            for r in workspace.warehouse.table(AUDIT.name).collect()]


def test_csv_to_consumption(workspace):
    land(workspace, *[line(i) for i in range(100)], line(1), line(200, " "), line(201, 5))
    assert run_in_order(lambda: run_raw(workspace, NAME), lambda: run_staging(workspace, NAME),
                        lambda: run_consumption(workspace, NAME)) == 0
    house = workspace.warehouse
    assert house.table(RAW_TRANSACTIONS.name).count() == 103
    assert house.table(STAGING_TRANSACTIONS.name).count() == 101
    features = house.table(FEATURES.name)
    assert features.count() == 100  # the one below the minimum price is left out
    ids = [{r[0] for r in house.table(t.name).select("propiedad_id").collect()} for t in (TRAIN, TEST)]
    assert len(ids[0] | ids[1]) == 100 and not ids[0] & ids[1]
    assert sorted(audit(workspace)) == sorted([
        ("raw", "OK", 103, 103, 0), ("staging", "OK", 103, 101, 1), ("consumption", "OK", 101, 100, 0)])
    import os
    assert os.listdir(workspace.processed) and not os.listdir(workspace.processing)


def test_second_run_updates_and_deletes(workspace):
    workspace.contracts = {"FEATURES": FEATURES_CONTRACT}
    land(workspace, line(1), line(2))
    run_raw(workspace, NAME), run_staging(workspace, NAME), run_consumption(workspace, NAME)
    workspace.clock = lambda: dt.datetime(2024, 6, 2, tzinfo=dt.timezone.utc)
    land(workspace, line(2, 5), line(3))
    assert [f(workspace, NAME) for f in (run_raw, run_staging, run_consumption)] == [0, 0, 0]
    stamps = {r["propiedad_id"]: r["_feature_set_at"].day
              for r in workspace.warehouse.table(FEATURES.name).collect()}
    assert stamps == {"p-1": 1, "p-3": 2}  # p-2 fell below the minimum price


@pytest.mark.parametrize("publish, rows", [("after", 2), ("before", 0)])
def test_broken_contract_fails_the_step(workspace, publish, rows):
    workspace.publish = publish
    land(workspace, line(1), line(2, status="rota"))
    run_raw(workspace, NAME), run_staging(workspace, NAME)
    assert run_consumption(workspace, NAME) == 1
    assert workspace.warehouse.table(FEATURES.name).count() == rows
    row = workspace.warehouse.table(AUDIT.name).where("fuente = 'consumption'").first()
    assert row["estado"] == "ERROR" and "estado: allowed_values" in row["mensaje_error"]


def test_steps_stop_at_the_first_failure(workspace):
    calls = []
    assert run_in_order(lambda: 0, lambda: 1, lambda: calls.append(1) or 0) == 1
    assert calls == []


def test_xml_json_and_service(workspace, tmp_path):
    with open(f"{workspace.landing}/index.xml", "w") as handle:
        handle.write('<i unit="u"><country name="A"><observation><month>2024-01</month>'
                     "<price_index>1</price_index></observation></country></i>")
    for i, following in ((1, "page_02.json"), (2, None)):
        with open(f"{workspace.landing}/page_0{i}.json", "w") as handle:
            json.dump({"meta": {"next": following}, "data": [
                {"transaction_id": f"t{i}", "property": {"state": "NY", "other": 1}}]}, handle)
    house = workspace.warehouse
    for name, table, rows in (("index.xml", RAW_HOUSING_INDEX, 1),
                              ("page_01.json", RAW_FOREIGN_TRANSACTIONS, 2),
                              ("auctions", RAW_AUCTIONS, 14)):
        assert run_raw(workspace, name) == 0
        assert house.table(table.name).count() == rows
    assert rows_of(house.table(RAW_HOUSING_INDEX.name), "unit", "country", "month", "price_index") == [
        ("u", "A", "2024-01", "1")]
    assert rows_of(house.table(RAW_FOREIGN_TRANSACTIONS.name), "transaction_id", "property_state",
                   "sale_price") == [("t1", "NY", None), ("t2", "NY", None)]


@pytest.mark.parametrize("name, reason", [
    ("unknown.csv", "not configured"), ("odd.bin", "not supported"), ("empty", "tabla_raw"),
    (NAME, "no file")])
def test_raw_failures_are_recorded(workspace, name, reason):
    assert run_raw(workspace, name) == 1
    assert reason in workspace.warehouse.table(AUDIT.name).first()["mensaje_error"]


def test_empty_layers_are_no_error(workspace):
    assert run_staging(workspace, NAME) == 0 and run_consumption(workspace, NAME) == 0
    assert {a[2:] for a in audit(workspace)} == {(0, 0, 0)}


def test_parameters(workspace):
    found = source_parameters(workspace.warehouse, NAME)
    assert found["tipo_extraccion"] == "UPSERT" and len(found.consumption) == 4
    assert len(source_parameters(workspace.warehouse, NAME, active_only=False).consumption) == 5
    assert source_parameters(workspace.warehouse, "nope") is None
    assert consumption_tables(workspace.warehouse, NAME) == {
        "FEATURES": "features", "TRAIN": "train", "TEST": "test"}
    with pytest.raises(ValueError):
        consumption_tables(workspace.warehouse, "auctions")


def test_training_registers_promotes_and_scores(workspace, spark, tmp_path):
    workspace.contracts = {"FEATURES": Contract("t", minimum_rows=1)}
    land(workspace, *[line(i, 10_000_000 + 500_000 * (40 + i % 50) + 1_000_000 * (1 + i % 3))
                      for i in range(300)])
    assert [f(workspace, NAME) for f in (run_raw, run_staging, run_consumption)] == [0, 0, 0]
    config = training.TrainingConfig(
        folds=2, model_folder=str(tmp_path / "models"), models={
            "regresion_lineal": {"fit_intercept": True},
            "arbol_decision": {"max_depth": 2, "min_samples_leaf": 5},
            "nonsense": {}})
    result = training.run_training(workspace, config)
    assert set(result.metrics) == {"regresion_lineal", "arbol_decision"}
    assert set(result.failures) == {"nonsense"} and result.best == "regresion_lineal"
    assert result.metrics["regresion_lineal"]["R2"] > 0.99
    house = workspace.warehouse
    stages = rows_of(house.table(MODEL_VERSIONS.name), "version", "stage")
    assert stages == [(1, "Production"), (2, "None")]
    run = house.table(RUNS.name).where("params['modelo'] = 'regresion_lineal'").first()
    assert run["metrics"]["cv_R2_mean"] > 0.99 and run["params"]["train_filas"]
    assert [r["modelo"] for r in training.comparison_table(workspace, result).collect()][0] == result.best
    requests = spark.createDataFrame(
        [("Bogota", "Casa", 60.0, 2, 1, 4.1, -74.1), ("Nowhere", "Casa", 60.0, 0, 1, 4.1, -74.1)],
        "ciudad string, tipo string, area_m2 double, alcobas long, banos long, lat double, lon double")
    scored = training.score_batch(workspace, config, "regresion_lineal", requests)
    assert all(r["precio_estimado"] >= 0 for r in scored.collect())
    with pytest.raises(ValueError):
        training.score_batch(workspace, config, "random_forest", requests)


def test_train_and_test_must_agree(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    with pytest.raises(ValueError):
        training.check_same_shape(a, a.drop("y"))
    training.check_same_shape(a, a.withColumn("x", F.col("x").cast("string")))


def test_default_contracts_cover_all_roles():
    assert set(Workspace(None).contracts) == {"FEATURES", "TRAIN", "TEST"}
    assert FEATURES_CONTRACT.max_age == "7d"
