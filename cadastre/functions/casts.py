"""Casts that turn unusable text into NULL instead of failing the job.

Spark's own try_cast is more liberal than the data model allows (``10d`` is a
double, ``2024`` a date), so a pattern guards each cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastre.functions.text import trim_ws

# Accepted spellings of each type.
DOUBLE_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$|^(?i:nan)$"
INTEGER_PATTERN = r"^[+-]?\d+$"
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
DAY_OR_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


def to_double(text: Column) -> Column:
    value = trim_ws(text)
    return F.when(value.rlike(DOUBLE_PATTERN), value.try_cast("double"))


def to_integer(text: Column) -> Column:
    """Whole numbers only: ``3`` is kept, ``3.0`` is NULL."""
    value = trim_ws(text)
    return F.when(value.rlike(INTEGER_PATTERN), value.try_cast("bigint"))


def to_whole_amount(text: Column) -> Column:
    """Decimal text to a whole amount, halves away from zero; NaN and overflow are NULL."""
    return F.round(to_double(text)).try_cast("bigint")


def to_date(text: Column) -> Column:
    value = trim_ws(text)
    return F.when(value.rlike(DATE_PATTERN), value.try_cast("date"))


def repair_century(text: Column) -> Column:
    """Read ``00YY-MM-DD``, with or without a time of day, as 20YY-MM-DD; other text is NULL."""
    year = F.substring(text, 1, 4).try_cast("int") + F.lit(2000)
    whole = F.concat(year.cast("string"), text.substr(F.lit(5), F.length(text)))
    return F.when(whole.rlike(DAY_OR_TIME_PATTERN), whole.try_cast("timestamp_ntz").cast("date"))
