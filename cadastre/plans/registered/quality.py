"""Contract rules, each alone and all together, and row-level checks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cadastre.contracts import FEATURES_CONTRACT
from cadastre.operators.contracts import Contract, contract_report, hours_old
from cadastre.operators.rows import check_rows
from cadastre.plans.registered import base
from cadastre.plans.registered.base import query, raw_tx, sql_double, sql_integer, staging, table

NOW = "2026-01-01 12:30:00"
SET_AT = "2025-12-26 01:00:00"


def _single(column, constraint):
    return Contract(dataset="t", columns=({"name": column, "constraints": [constraint]},))


def _rule_query(name, view, column, constraint, check, text, violations):
    sql = (f"SELECT 'row_count' AS \"check\", 'row_count >= 0' AS rule, count(*) AS observed, true AS passed "
           f"FROM {view} UNION ALL SELECT '{check}', '{text}', v, v = 0 FROM "
           f"(SELECT CAST({violations} AS BIGINT) AS v FROM {view})")
    source = {"raw_tx": raw_tx, "staging": staging, "features": base.features}[view]
    query(name, sql)(lambda spark, sf: contract_report(
        source(spark, sf), _single(column, constraint), NOW))


_rule_query("dq_not_null", "staging", "fecha", "not_null", "fecha__not_null", "fecha: not_null",
            "count(*) - count(fecha)")
_rule_query("dq_unique", "raw_tx", "id", "unique", "id__unique", "id: unique",
            "count(*) - count(DISTINCT id)")
_rule_query("dq_allowed", "staging", "estado", {"allowed_values": ["vendida", "comprada"]},
            "estado__allowed_values", "estado: allowed_values [''vendida'', ''comprada'']",
            "count(*) FILTER (estado NOT IN ('vendida', 'comprada'))")
_rule_query("dq_min", "staging", "precio_cop", {"min": 10000000}, "precio_cop__min",
            "precio_cop: min 10000000", "count(*) FILTER (precio_cop < 10000000)")
_rule_query("dq_max", "staging", "area_m2", {"max": 150.0}, "area_m2__max", "area_m2: max 150.0",
            "count(*) FILTER (area_m2 > 150)")
_rule_query("dq_between", "features", "anio", {"between": [1998, 2000]}, "anio__between",
            "anio: between [1998, 2000]", "count(*) FILTER (anio NOT BETWEEN 1998 AND 2000)")


@query("dq_row_count", """
SELECT 'row_count' AS "check", 'row_count >= 1000000' AS rule, count(*) AS observed,
 count(*) >= 1000000 AS passed FROM staging""")
def dq_row_count(spark, sf):
    return contract_report(staging(spark, sf), Contract(dataset="t", minimum_rows=1_000_000), NOW)


@query("dq_freshness", f"""
SELECT event_type, CAST(datesub('hour', max(ts), TIMESTAMP '{NOW}') AS BIGINT) AS hours
FROM events GROUP BY event_type""")
def dq_freshness(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        hours_old("ts", NOW).alias("hours"))


def _contract_sql():
    parts = ["SELECT 'row_count' AS \"check\", 'row_count >= 1' AS rule, count(*) AS observed, "
             "count(*) >= 1 AS passed FROM features",
             f"SELECT 'freshness', 'at most 7d old', CAST(datesub('hour', TIMESTAMP '{SET_AT}', "
             f"TIMESTAMP '{NOW}') AS BIGINT), true"]
    for definition in FEATURES_CONTRACT.columns:
        c = definition["name"]
        for constraint in definition["constraints"]:
            rule, argument = (next(iter(constraint.items())) if isinstance(constraint, dict)
                              else (constraint, None))
            text = f"{c}: {rule}" + ("" if argument is None else f" {argument}").replace("'", "''")
            counted = {
                "not_null": lambda: f"count(*) FILTER ({c} IS NULL)",
                "unique": lambda: f"count(*) - count(DISTINCT {c})",
                "allowed_values": lambda: f"count(*) FILTER ({c} NOT IN ("
                + ", ".join(f"'{v}'" for v in argument) + "))",
                "min": lambda: f"count(*) FILTER ({c} < {argument})",
                "max": lambda: f"count(*) FILTER ({c} > {argument})",
                "between": lambda: f"count(*) FILTER ({c} NOT BETWEEN {argument[0]} AND {argument[1]})",
            }[rule]()
            parts.append(f"SELECT '{c}__{rule}', '{text}', v, v = 0 FROM "
                         f"(SELECT CAST({counted} AS BIGINT) AS v FROM features)")
    return "\nUNION ALL ".join(parts)


@query("contract_report", _contract_sql())
def contract_report_query(spark, sf):
    stamped = base.features(spark, sf).withColumn(
        "_feature_set_at", F.lit(SET_AT).cast("timestamp"))
    return contract_report(stamped, replace(FEATURES_CONTRACT, max_age="7d"), NOW)


_ROW_RULES_SQL = f"""
, typed AS (SELECT *, {sql_double('area_m2')} AS a, {sql_integer('alcobas')} AS b,
 {sql_integer('banos')} AS c, {sql_double('lat')} AS d, {sql_double('lon')} AS e FROM raw_tx)
SELECT id, precio_cop, array_to_string(list_filter([
 CASE WHEN trim(coalesce(precio_cop, '')) = '' THEN 'modelo: required' END,
 CASE WHEN trim(coalesce(area_m2, '')) = '' THEN 'area_m2: required' WHEN a IS NULL
  THEN 'area_m2: not a number' WHEN a <= 0 OR a > 10000 THEN 'area_m2: outside (0, 10000]' END,
 CASE WHEN b IS NULL THEN 'alcobas: not a whole number' WHEN b < 0 OR b > 20
  THEN 'alcobas: outside [0, 20]' END,
 CASE WHEN c IS NULL THEN 'banos: not a whole number' WHEN c < 0 OR c > 20
  THEN 'banos: outside [0, 20]' END,
 CASE WHEN d IS NULL THEN 'lat: not a number' WHEN d < -4.3 OR d > 13 THEN 'lat: outside [-4.3, 13.0]' END,
 CASE WHEN e IS NULL THEN 'lon: not a number' WHEN e < -81.8 OR e > -66.8
  THEN 'lon: outside [-81.8, -66.8]' END], lambda x: x IS NOT NULL), '; ') AS problems FROM typed"""


@query("row_rules", _ROW_RULES_SQL)
def row_rules(spark, sf):
    requests = raw_tx(spark, sf).withColumn("modelo", F.col("precio_cop"))
    return check_rows(requests).select(
        "id", "precio_cop", F.array_join("errors", "; ").alias("problems"))
