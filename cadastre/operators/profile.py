"""Column profiling: counts, spreads, frequencies, date ranges, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastre.functions.casts import to_date, to_double
from cadastre.functions.text import is_blank
from cadastre.operators.quantiles import quantiles_of, usable, value_weights


def _rows_of(one_row: DataFrame, names: Sequence[str], label: str,
             fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Turn one wide row (or one per group) into a row per name.

    ``fields`` maps an output column to the prefix of its wide columns.
    """
    items = F.array(*[
        F.struct(F.lit(n).alias(label),
                 *[F.col(f"{prefix}{i}").alias(out) for out, prefix in fields.items()])
        for i, n in enumerate(names)])
    return one_row.select(*keep, F.inline(items))


def raw_counts(raw: DataFrame, column: str = "precio_cop") -> DataFrame:
    """All rows and rows with a blank value, in one pass."""
    return raw.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(is_blank(F.col(column))).alias("blank"))


def split_counts(features: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return features.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "test").alias("n_test"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column from a single scan."""
    names = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    return _rows_of(wide, names, "column", {"nulls": "n"}, keep=["total"])


def describe_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column.

    ``by`` describes each group; rows with a NULL group are left out.
    """
    rows = df
    for b in by:
        rows = rows.where(F.col(b).isNotNull())
    wide = rows.groupBy(*by).agg(*[
        f(usable(c)).alias(f"{prefix}{i}")
        for i, c in enumerate(columns)
        for prefix, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_samp),
                          ("a", F.min), ("z", F.max))])
    basic = _rows_of(wide, columns, "metric",
                     {"n": "n", "mean": "m", "std": "s", "min": "a", "max": "z"}, keep=by)
    quartile = quantiles_of(value_weights(df, columns, by), [0.25, 0.5, 0.75], by)
    wide_quartile = quartile.groupBy(*by, "metric").agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
    return basic.join(wide_quartile, [*by, "metric"], "left")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of each non-NULL value of the columns, one scan for all of them."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def ranked_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return value_counts(df, columns).orderBy("column", F.desc("n"), "value")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns)])
        return _rows_of(wide, columns, "column", {"n_distinct": "n"})
    return value_counts(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"))


def distinct_options(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of one column."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def date_range(df: DataFrame, column: str, parse=to_date) -> DataFrame:
    """First and last parsed day, rows that do not parse, rows without a text."""
    day = parse(F.col(column))
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                  F.count_if(day.isNull() & F.col(column).isNotNull()).alias("unparseable"),
                  F.count_if(day.isNull()).alias("without_day"))


def cast_failures(df: DataFrame, columns: Sequence[str], parse=to_double) -> DataFrame:
    """NULLs a cast adds to each column, blank text counted as missing beforehand."""
    wide = df.agg(*[
        F.count_if(parse(F.col(c)).isNull() & ~is_blank(F.col(c))).alias(f"n{i}")
        for i, c in enumerate(columns)])
    return _rows_of(wide, columns, "column", {"failures": "n"})


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once and how often."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Number of repeated keys, rows they cover and distinct keys overall."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("affected_rows"),
        F.count(F.lit(1)).alias("distinct_keys"))


def head_of(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows in a stated order (a report, planned as a top-n)."""
    return df.orderBy(*order).limit(n)


def blank_share(df: DataFrame, column: str) -> DataFrame:
    blank = is_blank(F.col(column))
    return df.agg(F.count_if(blank).alias("blank"), F.count(F.lit(1)).alias("total"),
                  F.avg(blank.cast("double")).alias("share"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Interquartile fences and the rows outside them."""
    weights = value_weights(df, columns)
    fences = quantiles_of(weights, [0.25, 0.75]).groupBy("metric").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3")).select(
        "metric",
        (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("low"),
        (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("high"))
    # the fences have one row per profiled column, a bound fixed by the caller
    outside = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return weights.join(F.broadcast(fences), "metric").groupBy("metric", "low", "high").agg(
        F.coalesce(F.sum(F.when(outside, F.col("weight"))), F.lit(0)).alias("outliers"),
        F.min("value").alias("min"), F.max("value").alias("max"))


def gap_distribution(df: DataFrame, time_column: str, by: Sequence[str] = ()) -> DataFrame:
    """How many days lie between consecutive days that have rows.

    Rows are reduced to distinct days first, so the ordered window sees at
    most one row per calendar day (and entity), however many rows a day has.
    """
    days = (df.select(*by, F.col(time_column).cast("date").alias("day"))
            .where(F.col("day").isNotNull()).distinct())
    ordered = Window.partitionBy(*by).orderBy("day")
    gaps = days.select(*by, F.date_diff("day", F.lag("day").over(ordered))
                       .cast("bigint").alias("gap_days"))
    return (gaps.where(F.col("gap_days").isNotNull()).groupBy("gap_days")
            .agg(F.count(F.lit(1)).alias("n")))


def source_summary(sources: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """Rows, columns and format of each source."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"), F.lit(fmt).alias("format"), "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"))
        for name, (fmt, df) in sources.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def dataset_summary(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Rows, NULLs over all features and the target's mean, median and range.

    Returned as ``(stat, value)`` rows so that the median, which needs its own
    plan, is stacked under the others instead of being joined to them.
    """
    nulls = F.lit(0)
    for f in features:
        nulls = nulls + F.col(f).isNull().cast("int")
    value = usable(target)
    wide = df.agg(F.count(F.lit(1)).cast("double").alias("v0"),
                  F.coalesce(F.sum(nulls), F.lit(0)).cast("double").alias("v1"),
                  F.round(F.avg(value), 2).alias("v2"),
                  F.min(value).alias("v3"), F.max(value).alias("v4"))
    stats = _rows_of(wide, ["filas", "nulos_total", "target_media", "target_min", "target_max"],
                     "stat", {"value": "v"})
    median = quantiles_of(value_weights(df, [target]), [0.5]).select(
        F.lit("target_mediana").alias("stat"), F.round("value", 2).alias("value"))
    return stats.unionByName(median)


def year_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per leading four characters of a date text."""
    return df.groupBy(F.substring(column, 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def outside_year(df: DataFrame, column: str, year: str) -> DataFrame:
    """Rows whose date text does not start with the expected year; NULL counts as outside."""
    return df.where(~F.substring(column, 1, 4).eqNullSafe(year))


def profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, DataFrame]:
    """The standard set of reports for one source."""
    return {
        "nulls": null_profile(df),
        "numeric": describe_numeric(df, numeric),
        "values": ranked_value_counts(df, categorical),
        "distinct": distinct_counts(df, categorical),
        "outliers": iqr_outliers(df, numeric),
    }
