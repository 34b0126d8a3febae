"""Row-level input rules: which fields of a row are unusable and why."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions import casts
from cadastre.functions.text import is_blank

ERRORS = "errors"


@dataclass(frozen=True)
class FieldRule:
    """A field's kind (``text``, ``decimal`` or ``integer``) and allowed range."""

    name: str
    kind: str = "text"
    low: float | None = None
    high: float | None = None
    low_open: bool = False


# Limits of a scoring request.
REQUEST_RULES = (
    FieldRule("modelo"),
    FieldRule("ciudad"),
    FieldRule("tipo"),
    FieldRule("area_m2", "decimal", 0, 10000, low_open=True),
    FieldRule("alcobas", "integer", 0, 20),
    FieldRule("banos", "integer", 0, 20),
    FieldRule("lat", "decimal", -4.3, 13.0),
    FieldRule("lon", "decimal", -81.8, -66.8),
)


def _parsed(rule: FieldRule) -> Column | None:
    text = F.col(rule.name).cast("string")
    if rule.kind == "integer":
        return casts.to_integer(text)
    if rule.kind == "decimal":
        return casts.to_double(text)
    return None


def field_error(rule: FieldRule, value: Column | None) -> Column:
    """First problem of the field as text, NULL when there is none.

    ``value`` is the parsed field of a numeric rule.
    """
    error = F.when(is_blank(F.col(rule.name).cast("string")), f"{rule.name}: required")
    if rule.kind == "text":
        return error
    if rule.kind == "integer":
        error = error.when(value.isNull(), f"{rule.name}: not a whole number")
    else:
        error = error.when(value.isNull() | F.isnan(value), f"{rule.name}: not a number")
    low = value <= rule.low if rule.low_open else value < rule.low
    bracket = "(" if rule.low_open else "["
    return error.when(low | (value > rule.high),
                      f"{rule.name}: outside {bracket}{rule.low}, {rule.high}]")


def check_rows(df: DataFrame, rules: Sequence[FieldRule] = REQUEST_RULES) -> DataFrame:
    """Add an array of error texts, empty for a usable row.

    Each numeric field is parsed once, in a projection of its own, and then
    tested several times.
    """
    parsed = {f"__v_{r.name}": _parsed(r) for r in rules if r.kind != "text"}
    errors = [field_error(r, F.col(f"__v_{r.name}") if r.kind != "text" else None) for r in rules]
    return (df.withColumns(parsed).withColumn(ERRORS, F.array_compact(F.array(*errors)))
            .drop(*parsed))


def usable_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(ERRORS) == 0).drop(ERRORS)


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(ERRORS) > 0)
