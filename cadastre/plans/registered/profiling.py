"""Profiles of the sources and of the staging table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastre.functions.casts import to_double
from cadastre.operators import profile
from cadastre.plans.registered import base
from cadastre.plans.registered.base import query, raw_tx, sql_date, sql_double, staging, table
from cadastre.schemas import MODEL_CATEGORICAL, MODEL_NUMERIC, TRANSACTION_TEXT
from cadastre.session import stored

NUMERIC = ["area_m2", "alcobas", "banos", "precio_cop", "lat", "lon"]


def _parsed(spark, sf):
    return raw_tx(spark, sf).select("id", "ciudad", *[to_double(F.col(c)).alias(c) for c in NUMERIC])


_PARSED_SQL = ", parsed AS (SELECT id, ciudad, " + ", ".join(
    f"{sql_double(c)} AS {c}" for c in NUMERIC) + " FROM raw_tx)"


def _stack(columns, template):
    return " UNION ALL ".join(template.format(c=c) for c in columns)


@query("raw_counts", """
SELECT count(*) AS total, count(*) FILTER (trim(coalesce(precio_cop, '')) = '') AS blank FROM raw_tx""")
def raw_counts(spark, sf):
    return profile.raw_counts(raw_tx(spark, sf))


@query("split_counts", """
SELECT ciudad, count(*) AS total, count(*) FILTER (split = 'train') AS n_train,
 count(*) FILTER (split = 'test') AS n_test FROM features GROUP BY ciudad""")
def split_counts(spark, sf):
    return profile.split_counts(base.features(spark, sf), by=["ciudad"])


@query("null_profile", _stack(
    TRANSACTION_TEXT, "SELECT '{c}' AS \"column\", count(*) AS total, "
    "count(*) - count({c}) AS nulls FROM staging"))
def null_profile(spark, sf):
    return profile.null_profile(staging(spark, sf), list(TRANSACTION_TEXT))


_DESCRIBE = ("count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 2) AS std, "
             "min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
             "round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
             "max({c}) AS max")


def _rounded(described):
    return described.withColumns({
        "mean": F.round("mean", 4), "std": F.round("std", 2),
        **{q: F.round(q, 6) for q in ("q25", "q50", "q75")}})


@query("describe_numeric", _PARSED_SQL + _stack(
    NUMERIC, "SELECT '{c}' AS metric, " + _DESCRIBE + " FROM parsed"))
def describe_numeric(spark, sf):
    return _rounded(profile.describe_numeric(stored(_parsed(spark, sf).select(*NUMERIC)), NUMERIC))


@query("describe_by_group", _stack(
    ["area_m2", "precio_cop"],
    "SELECT ciudad, '{c}' AS metric, " + _DESCRIBE.replace("({c}", "(CAST({c} AS DOUBLE)")
    + " FROM staging GROUP BY ciudad"))
def describe_by_group(spark, sf):
    return _rounded(profile.describe_numeric(
        staging(spark, sf), ["area_m2", "precio_cop"], by=["ciudad"]))


_CATEGORIES = ["ciudad", "tipo", "estado"]


@query("value_counts", _stack(
    _CATEGORIES, "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM raw_tx "
    "WHERE {c} IS NOT NULL GROUP BY {c}"))
def value_counts(spark, sf):
    return profile.ranked_value_counts(raw_tx(spark, sf), _CATEGORIES)


@query("distinct_counts", _stack(
    ["id", *_CATEGORIES], "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM raw_tx"))
def distinct_counts(spark, sf):
    return profile.distinct_counts(raw_tx(spark, sf), ["id", *_CATEGORIES])


@query("distinct_options", "SELECT DISTINCT ciudad FROM staging WHERE ciudad IS NOT NULL")
def distinct_options(spark, sf):
    return profile.distinct_options(staging(spark, sf), "ciudad")


@query("date_range", f"""
SELECT min(d) AS first_day, max(d) AS last_day,
 count(*) FILTER (d IS NULL AND fecha IS NOT NULL) AS unparseable,
 count(*) FILTER (d IS NULL) AS without_day FROM (SELECT fecha, {sql_date('fecha')} AS d FROM raw_tx)""")
def date_range(spark, sf):
    return profile.date_range(raw_tx(spark, sf), "fecha")


@query("cast_failures", _stack(NUMERIC, "SELECT '{c}' AS \"column\", count(*) FILTER (" + sql_double(
    "{c}").replace("{1,2}", "{{1,2}}") + " IS NULL AND trim(coalesce({c}, '')) <> '') AS failures FROM raw_tx"))
def cast_failures(spark, sf):
    return profile.cast_failures(raw_tx(spark, sf), NUMERIC)


@query("duplicate_report", """
SELECT count(*) FILTER (n > 1) AS repeated_keys,
 CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS affected_rows, count(*) AS distinct_keys
FROM (SELECT id, count(*) AS n FROM raw_tx GROUP BY id)""")
def duplicate_report(spark, sf):
    return profile.duplicate_report(raw_tx(spark, sf), "id")


@query("duplicate_head", """
SELECT id, count(*) AS n FROM raw_tx GROUP BY id HAVING count(*) > 1 ORDER BY n DESC, id LIMIT 10""")
def duplicate_head(spark, sf):
    repeated = profile.duplicate_keys(raw_tx(spark, sf), "id")
    return profile.head_of(repeated, [F.desc("n"), "id"], 10)


@query("blank_share", """
SELECT count(*) FILTER (b) AS blank, count(*) AS total, avg(CAST(b AS DOUBLE)) AS share
FROM (SELECT trim(coalesce(precio_cop, '')) = '' AS b FROM raw_tx)""")
def blank_share(spark, sf):
    return profile.blank_share(raw_tx(spark, sf), "precio_cop")


@query("iqr_outliers", _PARSED_SQL + _stack(["area_m2", "precio_cop"], """
SELECT '{c}' AS metric, round(low, 4) AS low, round(high, 4) AS high,
 count(*) FILTER ({c} < low OR {c} > high) AS outliers, min({c}) AS min, max({c}) AS max
FROM parsed, (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
 SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM parsed))
WHERE {c} IS NOT NULL GROUP BY low, high"""))
def iqr_outliers(spark, sf):
    return profile.iqr_outliers(_parsed(spark, sf), ["area_m2", "precio_cop"]).withColumns(
        {"low": F.round("low", 4), "high": F.round("high", 4)})


@query("gap_distribution", """
SELECT CAST(gap AS BIGINT) AS gap_days, count(*) AS n FROM (
 SELECT date_diff('day', lag(d) OVER (PARTITION BY user_id ORDER BY d), d) AS gap
 FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)) WHERE gap IS NOT NULL GROUP BY gap""")
def gap_distribution(spark, sf):
    return profile.gap_distribution(table(spark, sf, "events"), "ts", by=["user_id"])


@query("gap_distribution_overall", """
SELECT CAST(gap AS BIGINT) AS gap_days, count(*) AS n FROM (
 SELECT date_diff('day', lag(d) OVER (ORDER BY d), d) AS gap
 FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)) WHERE gap IS NOT NULL GROUP BY gap""")
def gap_distribution_overall(spark, sf):
    return profile.gap_distribution(table(spark, sf, "orders"), "o_orderdate")


_SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
            "embeddings", "pages", "benchmark", "labels", "conversations")


@query("source_summary", " UNION ALL ".join(
    f"SELECT '{t}' AS source, 'parquet' AS format, (SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS column_count" for t in _SOURCES))
def source_summary(spark, sf):
    return profile.source_summary({t: ("parquet", table(spark, sf, t)) for t in _SOURCES})


_FEATURES = (*MODEL_NUMERIC, *MODEL_CATEGORICAL)


@query("dataset_summary", f"""
SELECT unnest(['filas', 'nulos_total', 'target_media', 'target_mediana', 'target_min', 'target_max']) AS stat,
 unnest([CAST(count(*) AS DOUBLE), CAST(sum({' + '.join(f'CAST({c} IS NULL AS INT)' for c in _FEATURES)}) AS DOUBLE),
 round(avg(precio_cop), 2), round(quantile_cont(CAST(precio_cop AS DOUBLE), 0.5), 2),
 CAST(min(precio_cop) AS DOUBLE), CAST(max(precio_cop) AS DOUBLE)]) AS value FROM features""")
def dataset_summary(spark, sf):
    return profile.dataset_summary(
        stored(base.features(spark, sf).select(*_FEATURES, "precio_cop")), _FEATURES, "precio_cop")


@query("year_anomaly", """
SELECT year, count(*) AS n FROM (SELECT substr(CASE WHEN o_orderkey % 97 = 0
 THEN '0' || strftime(o_orderdate, '%y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END, 1, 4) AS year
 FROM orders) WHERE year <> '1998' GROUP BY year""")
def year_anomaly(spark, sf):
    day = F.when(F.col("o_orderkey") % 97 == 0,
                 F.concat(F.lit("0"), F.date_format("o_orderdate", "yy-MM-dd"))).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    dates = table(spark, sf, "orders").select("o_orderkey", day.alias("text_date"))
    return profile.year_counts(profile.outside_year(dates, "text_date", "1998"), "text_date")
