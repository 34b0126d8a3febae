"""JSON pages linked by a ``next`` field to flattened text rows."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.operators.chain import follow_links
from cadastre.sources.flatten import flatten
from cadastre.sources.tables import align


def _page_links(spark: SparkSession, folder: str, meta: str, next_field: str,
                pattern: str) -> DataFrame:
    """``(page, next)`` by file name; only the link is parsed out of each page."""
    schema = T.StructType().add(meta, T.StructType().add(next_field, T.StringType()))
    pages = (spark.read.option("multiLine", True).option("mode", "FAILFAST")
             .option("pathGlobFilter", pattern).schema(schema).json(folder))
    return pages.select(F.col("_metadata.file_name").alias("page"),
                        F.col(f"`{meta}`.`{next_field}`").alias("next"))


def page_order(spark: SparkSession, start: str, meta: str = "meta", next_field: str = "next",
               pattern: str = "*.json") -> DataFrame:
    """``(page, position)``: file names of the pages from ``start`` on; a visited page ends the chain."""
    folder, name = posixpath.split(start)
    links = _page_links(spark, folder, meta, next_field, pattern)
    return follow_links(spark.createDataFrame([(name,)], "start string"), links).select("page", "position")


def _as_text(kind: T.DataType) -> T.DataType:
    """Read leaves and lists as the text they have in the file; keep objects and booleans."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    return kind if isinstance(kind, T.BooleanType) else T.StringType()


def _record_type(kind: T.DataType, data: str, where: str) -> T.StructType:
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
        raise ValueError(f"field {data!r} of the pages {where} holds no records")
    return kind.elementType


def _shape_of(pages: DataFrame, data: str, where: str) -> T.StructType:
    """Type of the records over all given page texts: one schema comes to the driver."""
    part = F.variant_get(F.parse_json("value"), f"$.{data}", "variant")
    shape = pages.where(part.isNotNull()).agg(F.schema_of_variant_agg(part)).first()[0]
    if not shape or shape == "VOID":
        raise ValueError(f"no page {where} has the field {data!r}, or it holds no records")
    return _record_type(T.StructType.fromDDL(f"x {shape.replace('OBJECT<', 'STRUCT<')}")["x"].dataType, data, where)


_BROKEN = "_corrupt_page"


def _texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (spark.read.text(path, wholetext=True, pathGlobFilter=pattern)
            .select(F.col("_metadata.file_name").alias("page"), "value"))


def _parsed(spark: SparkSession, path: str, pattern: str, data: str, record: T.StructType) -> DataFrame:
    """``page``, the records of each and, of a page that is not JSON, its text."""
    schema = T.StructType().add(data, T.ArrayType(_as_text(record))).add(_BROKEN, T.StringType())
    return (spark.read.option("multiLine", True).option("mode", "PERMISSIVE").option("pathGlobFilter", pattern)
            .option("columnNameOfCorruptRecord", _BROKEN).schema(schema).json(path)
            .select(F.col("_metadata.file_name").alias("page"), F.col(data).alias("records"), _BROKEN))


def _records(pages: DataFrame, data: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record; a page that is malformed or lacks the field fails the job."""
    records = (F.when(F.col(_BROKEN).isNotNull(), F.raise_error(F.concat(F.lit("malformed page "), F.col("page"))))
               .when(F.col("records").isNull(), F.raise_error(F.concat(F.lit(f"no field {data} in page "), F.col("page"))))
               .otherwise(F.col("records")))
    return pages.select(*keep, F.explode(records).alias("r")).select(*keep, "r.*")


def read_pages(spark: SparkSession, folder: str, order: DataFrame, data: str = "data",
               record_schema: T.StructType | None = None, pattern: str = "*.json",
               position: str | None = None) -> DataFrame:
    """Records of the pages that ``order`` names, nested as they are, leaves as text.

    The folder is read by a glob and joined with the order on the file name: no list of paths is
    made, and what pages outside the chain hold does not matter.  The schema is that of the chain's
    pages unless given; giving it saves a scan.  ``position`` names a column for the page's place in
    the chain.
    """
    record = record_schema or _shape_of(_texts(spark, folder, pattern).join(order, "page"), data,
                                        f"of the chain in {folder}")
    pages = _parsed(spark, folder, pattern, data, record).join(order, "page")
    return _records(pages.withColumnRenamed("position", position), data, [position]) if position \
        else _records(pages, data)


def read_chained_json(spark: SparkSession, start: str, target: T.StructType | None = None,
                      data: str = "data", meta: str = "meta", next_field: str = "next",
                      sep: str = "_", record_schema: T.StructType | None = None) -> DataFrame:
    """Flattened records of every page reachable from ``start``.

    With ``target`` the result has exactly its columns: fields it lacks are
    dropped, fields no record has are NULL.
    """
    order = page_order(spark, start, meta, next_field)
    rows = flatten(read_pages(spark, posixpath.dirname(start), order, data, record_schema), sep)
    return align(rows, target) if target is not None else rows


def read_all_pages(spark: SparkSession, glob: str, data: str = "data", sep: str = "_") -> DataFrame:
    """Flattened records of every page a glob matches, whatever their links say."""
    record = _shape_of(_texts(spark, glob, "*"), data, f"of {glob}")
    return flatten(_records(_parsed(spark, glob, "*", data, record), data), sep)
