"""Units: the parts of a stored table that a load replaces, and the layout inside them.

A unit is a bucket of keys, a month of a date column or a run that appended rows.  It is the table's only partition column,
and every unit has its own location in the catalog.  A load writes the units it touches to a new
folder and points each of them there; the files of the others are neither read nor written.

A unit is switched at once, the units of one load one after the other.  A key lives in one bucket,
so each of its rows is seen old or new; a load that is stopped in between is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, MONTH, RUN, DIGEST = "_bucket", "_month", "_run", "_digest"
HIDDEN = (BUCKET, MONTH, RUN, DIGEST)
NO_MONTH = "none"


@dataclass(frozen=True)
class Unit:
    """``columns`` are the keys of a bucket, the date column of a month (``count`` 0), or none (a run)."""

    columns: tuple[str, ...]
    count: int = 0

    @property
    def name(self) -> str:
        return BUCKET if self.count else MONTH if self.columns else RUN

    @property
    def ddl(self) -> str:
        return f"{self.name} {'int' if self.count else 'string'}"

    def value(self) -> Column:
        if self.count:
            return F.pmod(F.xxhash64(*self.columns), F.lit(self.count)).cast("int").alias(BUCKET)
        return F.coalesce(F.date_format(self.columns[0], "yyyy-MM"), F.lit(NO_MONTH)).alias(MONTH)

    def fixed_by(self, keys: Sequence[str]) -> bool:
        """Whether rows of equal keys are always of one unit."""
        return bool(self.count) and set(self.columns) <= set(keys)

    @property
    def text(self) -> str:
        return f"{','.join(self.columns)}:{self.count}"

    @staticmethod
    def parse(text: str) -> Unit:
        columns, _, count = text.rpartition(":")
        return Unit(tuple(columns.split(",")) if columns else (), int(count))


def digest(columns: Sequence[str]) -> Column:
    """A 64-bit hash of the columns that tells NULLs apart by their place."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*columns, nulls).alias(DIGEST)


_BITS = 15


def _code(column: str, kind: T.DataType, month: bool) -> Column:
    """15 bits that follow the order of a column: of a date its day (in a month, or in eleven years),
    of a text its first three letters."""
    value = F.col(column)
    if isinstance(kind, T.DateType):
        days = (F.day(value) - 1) * 1024 if month else F.pmod(F.unix_date(value) * 8, F.lit(1 << _BITS))
        return F.coalesce(days, F.lit(0)).cast("bigint")
    if isinstance(kind, T.StringType):
        letters = F.rpad(F.lower(F.coalesce(value, F.lit(""))), 3, " ")
        code = F.lit(0).cast("bigint")
        for at in (1, 2, 3):
            letter = F.greatest(F.lit(0), F.least(F.lit(31), F.ascii(F.substring(letters, at, 1)) - ord("a") + 1))
            code = code * 32 + letter
        return code
    raise ValueError(f"column {column!r} of type {kind.simpleString()} cannot be clustered by")


def interleaved(columns: Sequence[str], schema: T.StructType, month: bool = False) -> Column:
    """One number with the bits of all columns in turn, highest first.

    Rows sorted by it lie close together in every column, so the statistics of a row group are
    narrow in each of them.
    """
    codes = [_code(c, schema[c].dataType, month) for c in columns]
    result = F.lit(0).cast("bigint")
    for bit in reversed(range(_BITS)):
        for code in codes:
            result = F.shiftleft(result, 1).bitwiseOR(F.shiftright(code, bit).bitwiseAND(1))
    return result


def outside(stored: DataFrame, unit: Unit, values: Sequence) -> DataFrame:
    return stored.where(~F.col(unit.name).isin(list(values))) if values else stored


def within(stored: DataFrame, unit: Unit, values: Sequence) -> DataFrame:
    return stored.where(F.col(unit.name).isin(list(values)))
