"""CSV files to text rows under a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastre.functions.text import trim_ws

CORRUPT = "__corrupt"


def read_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True,
             delimiter: str = ",", max_bad_records: int = 0,
             quoted_newlines: bool = False) -> DataFrame:
    """Rows of CSV files by column position; every value is text.

    With ``max_bad_records=0`` a short or long row fails the job that reads it.
    Otherwise rows that do not fit are dropped as long as there are no more of
    them than allowed.  An empty field is the empty text, not NULL.  Files are
    split by lines unless ``quoted_newlines`` is set.
    """
    if not columns:
        raise ValueError("the target has no column to load")
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = (spark.read.option("header", header).option("sep", delimiter)
              .option("quote", '"').option("escape", '"').option("multiLine", quoted_newlines)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if max_bad_records == 0:
        rows = reader.option("mode", "FAILFAST").schema(text).csv(path)
    else:
        marked = T.StructType([*text.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                  .schema(marked).csv(path))
        # every column takes part, or the parser would skip fields it need not read
        bad = parsed.agg(F.count(CORRUPT), *[F.count(c) for c in columns]).first()[0]
        if bad > max_bad_records:
            raise ValueError(f"{bad} bad rows in {path}, {max_bad_records} allowed")
        rows = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # the parser reports an empty field as NULL; a missing one was rejected above
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def count_lines(spark: SparkSession, path: str, skip: int = 1) -> DataFrame:
    """Non-blank lines per file less the header lines, never below zero.

    Counts physical lines, so a quoted line break adds to it.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), (trim_ws(F.col("value")) != "").alias("filled"))
    return lines.groupBy("file").agg(
        F.greatest(F.count_if("filled") - skip, F.lit(0)).alias("lines"))
