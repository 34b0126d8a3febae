"""Raw text rows to typed staging rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.functions import casts, text
from cadastre.operators.dedup import keep_one
from cadastre.schemas import LOADED_AT, TRANSACTION_TEXT

CleanRule = Callable[[Column], Column]

# One rule per column that is not passed through; other sources bring their own.
TRANSACTION_RULES: Mapping[str, CleanRule] = {
    "ciudad": text.canonical_city,
    "tipo": text.canonical_type,
    "area_m2": casts.to_double,
    "alcobas": casts.to_integer,
    "banos": casts.to_integer,
    "precio_cop": casts.to_whole_amount,
    "lat": casts.to_double,
    "lon": casts.to_double,
    "fecha": casts.to_date,
    "estado": text.canonical_status,
}

# Ties between copies of one id are broken by every other column, so the kept
# row never depends on file order or on the partitioning.
TRANSACTION_TIE_BREAK = ("precio_cop", "area_m2", "alcobas", "banos", "lat", "lon",
                         "fecha", "tipo", "ciudad", "estado")


def drop_blank(raw: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text is NULL or blank; text that will not parse stays."""
    return raw.where(~text.is_blank(F.col(column)))


def apply_rules(raw: DataFrame, columns: tuple[str, ...],
                rules: Mapping[str, CleanRule]) -> DataFrame:
    return raw.select(*[
        rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in columns])


def dedup_transactions(raw: DataFrame, first: bool = False) -> DataFrame:
    """One raw row per id: the latest load, or with ``first`` the earliest."""
    return keep_one(raw, ["id"], LOADED_AT, TRANSACTION_TIE_BREAK, latest=not first)


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Priced rows, one per id, cleaned and typed.

    The blank-price filter runs before the deduplication, as a later copy
    without a price must not hide an earlier one that has it.
    """
    return apply_rules(dedup_transactions(drop_blank(raw, "precio_cop")),
                       TRANSACTION_TEXT, TRANSACTION_RULES)
