"""Registration of named queries and the views they share.

The test tables are a sales star schema, so queries about property
transactions run on ``raw_tx``: a dirty all-text transaction view computed
from lineitem, orders, customer and part.  The same view is written below as
SQL for the comparison engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.functions.text import CITY_NAMES
from cadastre.operators.clean import clean_transactions
from cadastre.operators.features import build_features

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart over the same tables."""
    def wrap(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = with_views(sql)
        return function
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions: one row per order line, ids repeated as the lines are."""
    lines, orders, customers, parts = (
        table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part"))
    joined = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(customers, F.col("o_custkey") == F.col("c_custkey"))
              .join(parts, F.col("l_partkey") == F.col("p_partkey")))
    spellings = ["BOGOTA", "Bogota", "Bogota D.C.", "Bogotá", "MEDELLIN", "Medellin", "Medellín",
                 "Cali", "Santiago de Cali", "Barranquilla", "B/quilla", " SANTA MARTA "]
    nation, size = F.col("c_nationkey") % 13, F.col("p_size") % 3
    city = F.when(nation == 0, spellings[0])
    for i, spelling in enumerate(spellings[1:], start=1):
        city = city.when(nation == i, spelling)
    city = city.otherwise("valledupar")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")

    def decimals(key):
        return F.lpad((key % 1000).cast("string"), 3, "0")

    whole_price = F.round(F.col("l_extendedprice") * 2000).cast("bigint").cast("string")
    return joined.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        city.alias("ciudad"),
        F.when(size == 0, " apartamento").when(size == 1, "CASA ").otherwise("Lote").alias("tipo"),
        F.when(part % 53 == 0, "").otherwise(
            (F.col("l_quantity") * 4).cast("bigint").cast("string")).alias("area_m2"),
        (F.col("p_size") % 6).cast("string").alias("alcobas"),
        F.concat(F.lit(" "), (F.col("l_linenumber") % 4 + 1).cast("string")).alias("banos"),
        F.when(part % 127 == 0, "  ").when(part % 131 == 0, F.lit(None).cast("string"))
        .when(part % 137 == 0, "n/a").otherwise(F.concat(whole_price, F.lit(".0")))
        .alias("precio_cop"),
        F.concat((part % 12).cast("string"), F.lit("."), decimals(part)).alias("lat"),
        F.concat(F.lit("-"), (supplier % 14 + 67).cast("string"), F.lit("."), decimals(supplier))
        .alias("lon"),
        F.when(part % 149 == 0, "31/12/2024").otherwise(
            F.col("l_shipdate").cast("date").cast("string")).alias("fecha"),
        F.when(F.col("l_returnflag") == "A", "Publicada").when(
            F.col("l_returnflag") == "N", " VENDIDA").otherwise("comprada").alias("estado"),
        F.col("o_orderdate").alias("_loaded_at"))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(raw_tx(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(staging(spark, sf_dir))


# --- the same views as SQL ---------------------------------------------------
_RAW_TX = """
SELECT concat(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING)) AS id,
 CASE c.c_nationkey % 13 WHEN 0 THEN 'BOGOTA' WHEN 1 THEN 'Bogota' WHEN 2 THEN 'Bogota D.C.'
  WHEN 3 THEN 'Bogotá' WHEN 4 THEN 'MEDELLIN' WHEN 5 THEN 'Medellin' WHEN 6 THEN 'Medellín'
  WHEN 7 THEN 'Cali' WHEN 8 THEN 'Santiago de Cali' WHEN 9 THEN 'Barranquilla'
  WHEN 10 THEN 'B/quilla' WHEN 11 THEN ' SANTA MARTA ' ELSE 'valledupar' END AS ciudad,
 CASE p.p_size % 3 WHEN 0 THEN ' apartamento' WHEN 1 THEN 'CASA ' ELSE 'Lote' END AS tipo,
 CASE WHEN l.l_partkey % 53 = 0 THEN ''
  ELSE CAST(CAST(l.l_quantity * 4 AS BIGINT) AS STRING) END AS area_m2,
 CAST(p.p_size % 6 AS STRING) AS alcobas,
 concat(' ', CAST(l.l_linenumber % 4 + 1 AS STRING)) AS banos,
 CASE WHEN l.l_partkey % 127 = 0 THEN '  ' WHEN l.l_partkey % 131 = 0 THEN CAST(NULL AS STRING)
  WHEN l.l_partkey % 137 = 0 THEN 'n/a'
  ELSE concat(CAST(CAST(round(l.l_extendedprice * 2000) AS BIGINT) AS STRING), '.0') END AS precio_cop,
 concat(CAST(l.l_partkey % 12 AS STRING), '.', lpad(CAST(l.l_partkey % 1000 AS STRING), 3, '0')) AS lat,
 concat('-', CAST(67 + l.l_suppkey % 14 AS STRING), '.',
  lpad(CAST(l.l_suppkey % 1000 AS STRING), 3, '0')) AS lon,
 CASE WHEN l.l_partkey % 149 = 0 THEN '31/12/2024'
  ELSE CAST(CAST(l.l_shipdate AS DATE) AS STRING) END AS fecha,
 CASE l.l_returnflag WHEN 'A' THEN 'Publicada' WHEN 'N' THEN ' VENDIDA' ELSE 'comprada' END AS estado,
 o.o_orderdate AS _loaded_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey"""

TIE_BREAK_SQL = ", ".join(
    f"{c} ASC NULLS LAST" for c in ("precio_cop", "area_m2", "alcobas", "banos", "lat", "lon",
                                    "fecha", "tipo", "ciudad", "estado"))


def sql_title(text: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({text}), ' '), "
            f"lambda w: upper(w[1:1]) || w[2:]), ' ')")


def sql_city(text: str = "ciudad") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CITY_NAMES.items())
    return f"CASE {text} {arms} ELSE {sql_title(f'trim({text})')} END"


def sql_double(text: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return (f"CASE WHEN regexp_full_match(trim({text}), '{pattern}') "
            f"THEN TRY_CAST(trim({text}) AS DOUBLE) END")


def sql_integer(text: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') "
            f"THEN TRY_CAST(trim({text}) AS BIGINT) END")


def sql_amount(text: str) -> str:
    return f"TRY_CAST(round({sql_double(text)}) AS BIGINT)"


def sql_date(text: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({text}), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
            f"THEN TRY_CAST(trim({text}) AS DATE) END")


def sql_bucket(key: str, buckets: int, seed: str = "") -> str:
    text = f"concat({key}, '{seed}')" if seed else key
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets}"


def sql_dedup(source: str, direction: str = "DESC") -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "
            f"_loaded_at {direction} NULLS LAST, {TIE_BREAK_SQL}) AS rn FROM {source}) WHERE rn = 1")


def sql_clean(source: str) -> str:
    return f"""SELECT id, {sql_city()} AS ciudad, {sql_title('trim(tipo)')} AS tipo,
 {sql_double('area_m2')} AS area_m2, {sql_integer('alcobas')} AS alcobas,
 {sql_integer('banos')} AS banos, {sql_amount('precio_cop')} AS precio_cop,
 {sql_double('lat')} AS lat, {sql_double('lon')} AS lon, {sql_date('fecha')} AS fecha,
 lower(trim(estado)) AS estado FROM {source}"""


def sql_features(source: str) -> str:
    return f"""SELECT id AS propiedad_id, ciudad, tipo, estado, area_m2, alcobas, banos, lat, lon,
 precio_cop / nullif(area_m2, 0) AS precio_por_m2, ln(CAST(precio_cop AS DOUBLE)) AS log_precio_cop,
 CAST(banos AS DOUBLE) / nullif(alcobas, 0) AS banos_por_alcoba,
 area_m2 / nullif(alcobas, 0) AS area_por_alcoba,
 CAST(year(fecha) AS BIGINT) AS anio, CAST(month(fecha) AS BIGINT) AS mes,
 CAST(quarter(fecha) AS BIGINT) AS trimestre, CAST(dayofweek(fecha) + 1 AS BIGINT) AS dia_semana,
 fecha, precio_cop,
 CASE WHEN {sql_bucket('id', 100)} < 80 THEN 'train' ELSE 'test' END AS split
FROM {source} WHERE precio_cop >= 10000000"""


_VIEWS = f"""WITH raw_tx AS ({_RAW_TX}
), priced AS (SELECT * FROM raw_tx WHERE trim(coalesce(precio_cop, '')) <> ''
), latest AS ({sql_dedup('priced')}
), staging AS ({sql_clean('latest')}
), features AS ({sql_features('staging')}
)"""


def with_views(body: str) -> str:
    """Put the shared views in front of a query body.

    A body that starts with ``,`` continues the list of views.
    """
    return f"{_VIEWS}\n{body.strip()}"
