"""Nested records to one level of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaf(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(kind, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    return value.cast("string")


def _walk(schema: T.StructType, path: str, prefix: str, sep: str) -> list[tuple[str, Column]]:
    leaves: list[tuple[str, Column]] = []
    for field in schema.fields:
        name = f"{prefix}{sep}{field.name}" if prefix else field.name
        here = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            leaves += _walk(field.dataType, here, name, sep)
        else:
            leaves.append((name, _leaf(F.col(here), field.dataType)))
    return leaves


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every scalar leaf as text under its joined name, lists as JSON text.

    When two paths give the same name the later one wins.  Only the schema is
    walked, so the result is a plain projection.
    """
    by_name = dict(_walk(df.schema, "", "", sep))
    return df.select(*[column.alias(name) for name, column in by_name.items()])
