"""Scans of stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.operators.features import minimum_price


def feature_scan(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 target: str, price_minimum: int = 0) -> DataFrame:
    """Model columns only, at or above a minimum target; both reach the file scan."""
    rows = minimum_price(df, price_minimum, target) if price_minimum > 0 else df
    return rows.select(*numeric, *categorical, target)


def parameterised(spark: SparkSession, sql: str, args: dict[str, Any],
                  **frames: DataFrame) -> DataFrame:
    """Run SQL with named ``:parameters``; values are bound, never pasted into the text."""
    return spark.sql(sql, args=args, **frames)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape a frame to a schema: unknown columns dropped, absent ones NULL."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def union_pages(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate pages whose records need not have the same fields."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def role_map(parameters: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Table per role; of several rows of a role the last in load order counts."""
    named = parameters.where(
        (F.coalesce(F.col("rol_tabla"), F.lit("")) != "")
        & (F.coalesce(F.col("tabla_consumption"), F.lit("")) != ""))
    return named.groupBy(*by, F.upper("rol_tabla").alias("rol")).agg(
        F.max_by("tabla_consumption", "orden_carga").alias("tabla"))


def schema_differences(train: DataFrame, test: DataFrame) -> dict[str, list[str]]:
    """Columns only one side has, and shared columns of different type."""
    left = {f.name: f.dataType for f in train.schema.fields}
    right = {f.name: f.dataType for f in test.schema.fields}
    return {
        "missing_in_test": sorted(set(left) - set(right)),
        "missing_in_train": sorted(set(right) - set(left)),
        "types": sorted(c for c in set(left) & set(right) if left[c] != right[c]),
    }
