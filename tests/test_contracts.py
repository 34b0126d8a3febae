"""Contracts: each rule broken alone, report, verdicts, file formats."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cadastre.contracts import FEATURES_CONTRACT, TEST_CONTRACT, TRAIN_CONTRACT
from cadastre.operators import contracts as c
from cadastre.schemas import FEATURES

NOW = "2024-06-01 12:00:00"


def good_row(**changes):
    row = dict(propiedad_id="p-1", ciudad="Cali", tipo="Casa", estado="vendida", area_m2=50.0,
               alcobas=2, banos=1, lat=4.0, lon=-74.0, precio_por_m2=400000.0, log_precio_cop=16.8,
               banos_por_alcoba=0.5, area_por_alcoba=25.0, anio=2024, mes=3, trimestre=1,
               dia_semana=2, fecha=dt.date(2024, 3, 4), precio_cop=20000000, split="train",
               _feature_set_at=dt.datetime(2024, 5, 30))
    row.update(changes)
    return tuple(row[n] for n in FEATURES.column_names)


def features(spark, *rows):
    return spark.createDataFrame(list(rows), FEATURES.schema)


def broken(frame, contract=FEATURES_CONTRACT, now=NOW):
    return {r["check"] for r in c.contract_report(frame, contract, now).where("not passed").collect()}


def test_good_table_passes(spark):
    frame = features(spark, good_row(), good_row(propiedad_id="p-2", area_m2=None, lat=None))
    result = c.validate(frame, FEATURES_CONTRACT, NOW, strict=True)
    assert result["total_rows"] == 2 and result["errors"] == 0
    assert result["checks_ok"] == len(c.compile_checks(FEATURES_CONTRACT)) + 2


@pytest.mark.parametrize("changes, check", [
    ({"ciudad": None}, "ciudad__not_null"),
    ({"estado": "rota"}, "estado__allowed_values"),
    ({"area_m2": 0.5}, "area_m2__min"),
    ({"area_m2": 10000.5}, "area_m2__max"),
    ({"alcobas": 21}, "alcobas__max"),
    ({"lat": 13.5}, "lat__max"),
    ({"lon": -82.0}, "lon__min"),
    ({"mes": 13}, "mes__between"),
    ({"anio": 1999}, "anio__between"),
    ({"precio_cop": 9999999}, "precio_cop__min"),
    ({"split": "valid"}, "split__allowed_values"),
    ({"fecha": None}, "fecha__not_null"),
])
def test_one_broken_rule_shows_alone(spark, changes, check):
    frame = features(spark, good_row(), good_row(propiedad_id="p-2", **changes))
    assert broken(frame) == {check}


def test_unique_counts_copies_and_every_null(spark):
    contract = c.Contract("t", columns=({"name": "v", "constraints": ["unique"]},))
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    row = c.contract_report(frame, contract, NOW).where("check = 'v__unique'").first()
    assert row["observed"] == 3 and not row["passed"]


def test_nan_is_not_above_a_maximum(spark):
    assert broken(features(spark, good_row(area_m2=float("nan")))) == set()


def test_freshness(spark):
    assert broken(features(spark, good_row()), now="2024-06-06 00:59:59") == set()
    assert broken(features(spark, good_row()), now="2024-06-06 01:00:00") == {"freshness"}


def test_empty_table(spark):
    assert broken(features(spark)) == {"row_count", "freshness"}
    assert broken(features(spark), c.Contract("t")) == set()


def test_freshness_needs_both_parts(spark):
    for body in ({"timestamp_column": "_feature_set_at"}, {"max_age": "7d"}):
        contract = c.Contract.from_dict({"dataset": "t", "freshness": body})
        assert c.contract_report(features(spark), contract, NOW).count() == 1


def test_ages():
    assert [c.age_in_hours(a) for a in ("24h", "7d", " 2W ")] == [24, 168, 336]
    for bad in ("5m", "d", "1.5h", ""):
        with pytest.raises(ValueError):
            c.age_in_hours(bad)


def test_unknown_rule(spark):
    contract = c.Contract("t", columns=({"name": "v", "constraints": [">= 0", "not_null"]},))
    assert [x.name for x in c.compile_checks(contract)] == ["v__not_null"]
    with pytest.raises(ValueError):
        c.compile_checks(contract, strict=True)


def test_every_key_of_a_constraint_counts_and_names_stay_apart():
    contract = c.Contract("t", columns=({"name": "v", "constraints": [
        {"min": 1, "max": 5}, {"min": 2}]},))
    assert [x.name for x in c.compile_checks(contract)] == ["v__min", "v__max", "v__min_2"]


def test_verdict_lists_all_rules(spark):
    frame = features(spark, good_row(ciudad=None, mes=0))
    with pytest.raises(c.ContractViolation) as error:
        c.validate(frame, FEATURES_CONTRACT, NOW)
    assert "ciudad: not_null" in str(error.value) and "mes: between" in str(error.value)


def test_all_contracts_are_tried_before_failing(spark):
    bad, good = features(spark, good_row(ciudad=None)), features(spark, good_row())

    def missing():
        raise LookupError("no such table")

    with pytest.raises(c.ContractViolation, match="2 contract") as error:
        c.validate_all([(lambda: bad, TRAIN_CONTRACT), (missing, TEST_CONTRACT),
                        (lambda: good, FEATURES_CONTRACT)], NOW)
    assert "no such table" in str(error.value)
    assert len(c.validate_all([(lambda: good, TRAIN_CONTRACT), (lambda: good, FEATURES_CONTRACT)], NOW)) == 2


def test_strict_types(spark):
    frame = features(spark, good_row()).withColumn("mes", F.col("mes").cast("string")).drop("tipo")
    assert c.type_mismatches(frame, FEATURES_CONTRACT) == [
        "tipo: column is missing", "mes: type string, contract says INT64"]


def test_contract_files(tmp_path):
    body = {"version": "2", "dataset": "t", "freshness": {"timestamp_column": "x", "max_age": "1d"},
            "row_count": {"min": 3}, "schema": [{"name": "a", "constraints": ["not_null"]}]}
    (tmp_path / "c.json").write_text(json.dumps(body))
    loaded = c.load_contract(str(tmp_path / "c.json"))
    assert (loaded.minimum_rows, loaded.max_age, loaded.version) == (3, "1d", "2")
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yml").write_text(yaml.safe_dump(body))
    assert c.load_contract(str(tmp_path / "c.yml")) == loaded


def test_rules_share_one_scan_without_shuffling_rows(spark, tmp_path):
    features(spark, good_row()).write.parquet(str(tmp_path / "f"))
    frame = spark.read.parquet(str(tmp_path / "f"))
    plan = c.contract_report(frame, FEATURES_CONTRACT, NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # one for all rules, one narrow for the unique key
    assert plan.count("hashpartitioning(propiedad_id") == 1 and plan.count("hashpartitioning") == 1
