"""Data contracts compiled to aggregations over the whole table.

All rules but ``unique`` become columns of one aggregate, so a table is
scanned once without shuffling its rows.  Each ``unique`` rule has its own
narrow pass: inside the wide aggregate it would carry every other rule's
buffer through a shuffle once per distinct key.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

HOURS_PER_UNIT = {"h": 1, "d": 24, "w": 168}

# Contract type names and the Spark types they stand for (strict mode only).
TYPE_NAMES = {
    "STRING": T.StringType, "INT64": T.LongType, "FLOAT64": T.DoubleType,
    "DATE": T.DateType, "TIMESTAMP": T.TimestampType, "BOOL": T.BooleanType,
}


class ContractViolation(RuntimeError):
    """One or more rules of one or more contracts do not hold."""


@dataclass(frozen=True)
class Contract:
    dataset: str
    version: str = "?"
    owner: str = ""
    description: str = ""
    timestamp_column: str | None = None
    max_age: str | None = None
    minimum_rows: int = 0
    columns: tuple[dict[str, Any], ...] = field(default_factory=tuple)

    @classmethod
    def from_dict(cls, body: dict[str, Any]) -> Contract:
        freshness = body.get("freshness") or {}
        return cls(
            dataset=body["dataset"], version=str(body.get("version", "?")),
            owner=body.get("owner", ""), description=body.get("description", ""),
            timestamp_column=freshness.get("timestamp_column"),
            max_age=freshness.get("max_age"),
            minimum_rows=(body.get("row_count") or {}).get("min", 0),
            columns=tuple(body.get("schema") or ()))


def load_contract(path: str) -> Contract:
    """Read a contract file, YAML where the parser is installed, else JSON."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return Contract.from_dict(json.loads(text))
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError("YAML contracts need the yaml package; use JSON instead") from exc
    return Contract.from_dict(yaml.safe_load(text))


def age_in_hours(text: str) -> int:
    """``24h``, ``7d`` or ``2w`` as hours."""
    match = re.fullmatch(r"(\d+)([hdw])", str(text).strip().lower())
    if not match:
        raise ValueError(f"age {text!r} is not a number followed by h, d or w")
    return int(match[1]) * HOURS_PER_UNIT[match[2]]


@dataclass(frozen=True)
class Check:
    """A compiled rule: its id, wording and (but for ``unique``) counting column."""

    name: str
    column: str
    rule: str
    text: str
    violations: Column | None


def _not_null(column: str, _: Any) -> Column:
    return F.count_if(F.col(column).isNull())


def _allowed(column: str, values: list) -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def _minimum(column: str, low: Any) -> Column:
    return F.count_if(F.col(column) < F.lit(low))


def _maximum(column: str, high: Any) -> Column:
    # Spark orders NaN above every number; a NaN does not exceed a limit here
    value = F.col(column)
    return F.count_if((value > F.lit(high)) & ~F.isnan(value.cast("double")))


def _between(column: str, limits: list) -> Column:
    low, high = limits
    return F.count_if(~F.col(column).between(F.lit(low), F.lit(high)))


# Rule name -> function of (column name, argument); extend it to add a rule.
RULES: dict[str, Callable[[str, Any], Column]] = {
    "not_null": _not_null,
    "allowed_values": _allowed,
    "min": _minimum,
    "max": _maximum,
    "between": _between,
}


def _wording(column: str, rule: str, argument: Any) -> str:
    return f"{column}: {rule}" if argument is None else f"{column}: {rule} {argument}"


def compile_checks(contract: Contract, strict: bool = False) -> list[Check]:
    """Checks of every rule; an unknown rule is skipped with a warning unless strict."""
    checks: list[Check] = []
    for definition in contract.columns:
        column = definition["name"]
        for constraint in definition.get("constraints") or ():
            pairs = constraint.items() if isinstance(constraint, dict) else [(constraint, None)]
            for rule, argument in pairs:
                if rule != "unique" and rule not in RULES:
                    if strict:
                        raise ValueError(f"unknown rule {rule!r} on column {column!r}")
                    log.warning("rule %r on column %r is unknown and skipped", rule, column)
                    continue
                counter = None if rule == "unique" else RULES[rule](column, argument)
                same = sum(1 for c in checks if c.column == column and c.rule == rule)
                name = f"{column}__{rule}" + (f"_{same + 1}" if same else "")
                checks.append(Check(name, column, rule, _wording(column, rule, argument), counter))
    return checks


def _unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column (``u0``, ``u1``, ..) rows minus distinct values; NULLs are violations.

    Several columns are stacked under a tag, so the rows are computed once whatever their number.
    """
    rows = F.count(F.lit(1)).alias("n")
    if len(columns) == 1:
        return df.groupBy(columns[0]).agg(rows).agg(
            (F.coalesce(F.sum("n"), F.lit(0)) - F.count(columns[0])).alias("u0"))
    stack = F.array(*[F.struct(F.lit(i).alias("rule"), F.col(c).cast("string").alias("value"))
                      for i, c in enumerate(columns)])
    counted = df.select(F.explode(stack).alias("x")).select("x.*").groupBy("rule", "value").agg(rows)
    return counted.agg(*[
        (F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("n"))), F.lit(0))
         - F.count(F.when(F.col("rule") == i, F.col("value")))).alias(f"u{i}") for i in range(len(columns))])


def hours_old(timestamp: str, now: datetime | str) -> Column:
    """Whole hours from the newest timestamp to ``now``; NULL for an empty table."""
    latest = F.max(F.col(timestamp).cast("timestamp"))
    return F.timestamp_diff("HOUR", latest, F.lit(now).cast("timestamp"))


def contract_report(df: DataFrame, contract: Contract, now: datetime | str,
                    strict: bool = False) -> DataFrame:
    """One row per check: ``check, rule, observed, passed``.

    ``observed`` is the number of violating rows, the row count or the age in
    hours.  ``now`` is passed in so that a report can be reproduced.
    """
    checks = compile_checks(contract, strict)
    wide = [c for c in checks if c.violations is not None]
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    aggregates += [c.violations.alias(f"c{i}") for i, c in enumerate(wide)]
    judged_age = bool(contract.timestamp_column and contract.max_age)
    if judged_age:
        aggregates.append(hours_old(contract.timestamp_column, now).alias("__hours"))
    row = df.agg(*aggregates)

    def entry(name: str, rule: str, observed: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), F.lit(rule).alias("rule"),
                        observed.cast("bigint").alias("observed"),
                        F.coalesce(passed, F.lit(False)).alias("passed"))

    entries = [entry("row_count", f"row_count >= {contract.minimum_rows}", F.col("__rows"),
                     F.col("__rows") >= contract.minimum_rows)]
    if judged_age:
        limit = age_in_hours(contract.max_age)
        entries.append(entry("freshness", f"at most {contract.max_age} old", F.col("__hours"),
                             F.col("__hours") <= limit))
    entries += [entry(c.name, c.text, F.col(f"c{i}"), F.col(f"c{i}") == 0)
                for i, c in enumerate(wide)]
    report = row.select(F.inline(F.array(*entries)))
    unique = [c for c in checks if c.violations is None]
    if unique:
        report = report.unionByName(_unique_violations(df, [c.column for c in unique]).select(F.inline(F.array(
            *[entry(c.name, c.text, F.col(f"u{i}"), F.col(f"u{i}") == 0) for i, c in enumerate(unique)]))))
    return report


def type_mismatches(df: DataFrame, contract: Contract) -> list[str]:
    """Columns whose type differs from the contract, for strict validation."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for definition in contract.columns:
        name, wanted = definition["name"], str(definition.get("type", "")).upper()
        if name not in actual:
            problems.append(f"{name}: column is missing")
        elif wanted in TYPE_NAMES and not isinstance(actual[name], TYPE_NAMES[wanted]):
            problems.append(f"{name}: type {actual[name].simpleString()}, contract says {wanted}")
    return problems


def validate(df: DataFrame, contract: Contract, now: datetime | str,
             strict: bool = False) -> dict[str, Any]:
    """Run all checks, raise with every broken rule, else return the totals.

    Only the report is brought to the driver: one short row per rule.
    """
    problems = type_mismatches(df, contract) if strict else []
    rows = contract_report(df, contract, now, strict).collect()
    problems += [f"{r['rule']}: observed {r['observed']}" for r in rows if not r["passed"]]
    if problems:
        raise ContractViolation(
            f"contract {contract.dataset} v{contract.version}: {len(problems)} rule(s) broken\n  - "
            + "\n  - ".join(problems))
    total = next(r["observed"] for r in rows if r["check"] == "row_count")
    return {"table": contract.dataset, "version": contract.version, "total_rows": total,
            "checks_ok": len(rows), "errors": 0}


def validate_all(items: Iterable[tuple[Callable[[], DataFrame], Contract]],
                 now: datetime | str, strict: bool = False) -> list[dict[str, Any]]:
    """Validate every table before raising once with all failures."""
    results, failures = [], []
    for frame, contract in items:
        try:
            results.append(validate(frame(), contract, now, strict))
        except ContractViolation as exc:
            failures.append(str(exc))
        except Exception as exc:  # a missing table or column must not hide other failures
            failures.append(f"contract {contract.dataset}: could not be checked: {exc}")
    if failures:
        raise ContractViolation(f"{len(failures)} contract(s) failed\n\n" + "\n\n".join(failures))
    return results
