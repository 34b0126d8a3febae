"""Ratios, calendar parts and stable hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero or NULL denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_error(predicted: Column, actual: Column) -> Column:
    """Signed error in percent of the true value, two decimals."""
    return F.round(F.try_divide(predicted - actual, actual) * 100, 2)


def calendar_parts(day: Column) -> dict[str, Column]:
    """Year, month, quarter and weekday (1 = Sunday) as bigint."""
    return {
        "anio": F.year(day).cast("bigint"),
        "mes": F.month(day).cast("bigint"),
        "trimestre": F.quarter(day).cast("bigint"),
        "dia_semana": F.dayofweek(day).cast("bigint"),
    }


def hash_bucket(key: Column, buckets: int, seed: str = "", method: str = "md5") -> Column:
    """Stable bucket number in ``[0, buckets)``; NULL keys give NULL.

    ``md5`` gives the same number in any engine; ``xxhash64`` is cheaper and
    meant for data that never leaves Spark.  Neither depends on row order or
    on the number of partitions.
    """
    salted = F.concat(key.cast("string"), F.lit(seed)) if seed else key.cast("string")
    if method == "md5":
        number = F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")
    elif method == "xxhash64":
        number = F.when(salted.isNotNull(), F.xxhash64(salted))
    else:
        raise ValueError(f"unknown hash method {method!r}: use md5 or xxhash64")
    return F.pmod(number, F.lit(buckets))


def split_label(key: Column, train_percent: int = 80, method: str = "md5") -> Column:
    """``train`` or ``test``; a NULL key is ``test``."""
    return F.when(hash_bucket(key, 100, method=method) < train_percent, "train").otherwise("test")
