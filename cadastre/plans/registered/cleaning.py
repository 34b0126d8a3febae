"""Cleaning, deduplication, features and joins on names."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastre.functions import casts, numeric, text
from cadastre.operators import clean, features as feature_ops, match
from cadastre.operators.chain import follow_links
from cadastre.plans.registered import base
from cadastre.plans.registered.base import (
    query, raw_tx, sql_amount, sql_bucket, sql_city, sql_date, sql_dedup, sql_double,
    sql_integer, sql_title, staging, table)
from cadastre.schemas import MODEL_CATEGORICAL, MODEL_NUMERIC, TARGET
from cadastre.session import stored
from cadastre.sources.flatten import flatten
from cadastre.sources.tables import align, feature_scan, parameterised, role_map, union_pages


def _one_column(column, function, alias="result"):
    return lambda spark, sf: raw_tx(spark, sf).select(
        "id", column, function(F.col(column)).alias(alias))


def _register_column(name, column, function, sql):
    query(name, f"SELECT id, {column}, {sql} AS result FROM raw_tx")(_one_column(column, function))


_register_column("normalize_city", "ciudad", text.canonical_city, sql_city())
_register_column("normalize_city_trim", "ciudad",
                 lambda c: text.canonical_city(c, trim_first=True), sql_city("trim(ciudad)"))
_register_column("normalize_type", "tipo", text.canonical_type, sql_title("trim(tipo)"))
_register_column("normalize_status", "estado", text.canonical_status, "lower(trim(estado))")
_register_column("safe_cast_double", "lat", casts.to_double, sql_double("lat"))
_register_column("safe_cast_int", "banos", casts.to_integer, sql_integer("banos"))
_register_column("safe_cast_price", "precio_cop", casts.to_whole_amount, sql_amount("precio_cop"))
_register_column("safe_cast_date", "fecha", casts.to_date, sql_date("fecha"))


@query("drop_blank_price", "SELECT id, precio_cop FROM priced")
def drop_blank_price(spark, sf):
    return clean.drop_blank(raw_tx(spark, sf), "precio_cop").select("id", "precio_cop")


@query("dedup_latest", "SELECT * FROM latest")
def dedup_latest(spark, sf):
    return clean.dedup_transactions(clean.drop_blank(raw_tx(spark, sf), "precio_cop"))


@query("dedup_first", sql_dedup("priced", "ASC"))
def dedup_first(spark, sf):
    return clean.dedup_transactions(
        clean.drop_blank(raw_tx(spark, sf), "precio_cop"), first=True)


@query("staging_select", "SELECT * FROM staging")
def staging_select(spark, sf):
    return staging(spark, sf)


@query("min_price_filter", "SELECT id, precio_cop FROM staging WHERE precio_cop >= 10000000")
def min_price_filter(spark, sf):
    return feature_ops.minimum_price(staging(spark, sf)).select("id", "precio_cop")


_ROUNDED = {"log_precio_cop": 9}


@query("features_select",
       "SELECT * REPLACE (round(log_precio_cop, 9) AS log_precio_cop) FROM features")
def features_select(spark, sf):
    frame = base.features(spark, sf)
    return frame.withColumns({c: F.round(c, n) for c, n in _ROUNDED.items()})


@query("ratio_features",
       "SELECT propiedad_id, precio_por_m2, banos_por_alcoba, area_por_alcoba FROM features")
def ratio_features(spark, sf):
    return base.features(spark, sf).select(
        "propiedad_id", "precio_por_m2", "banos_por_alcoba", "area_por_alcoba")


@query("log_price", "SELECT propiedad_id, round(log_precio_cop, 9) AS log_precio_cop FROM features")
def log_price(spark, sf):
    return base.features(spark, sf).select(
        "propiedad_id", F.round("log_precio_cop", 9).alias("log_precio_cop"))


@query("calendar_features", """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS anio, CAST(month(o_orderdate) AS BIGINT) AS mes,
 CAST(quarter(o_orderdate) AS BIGINT) AS trimestre,
 CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS dia_semana FROM orders""")
def calendar_features(spark, sf):
    parts = numeric.calendar_parts(F.col("o_orderdate").cast("date"))
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query("hash_split", f"""
SELECT DISTINCT id, CASE WHEN {sql_bucket('id', 100)} < 80 THEN 'train' ELSE 'test' END AS split
FROM raw_tx""")
def hash_split(spark, sf):
    return raw_tx(spark, sf).select("id").distinct().select(
        "id", numeric.split_label(F.col("id")).alias("split"))


@query("random_split")
def random_split(spark, sf):
    return (feature_ops.random_split(staging(spark, sf)).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n")))


@query("century_fix", """
SELECT event_id, CAST(TRY_CAST(CAST(CAST(substr(d, 1, 4) AS INT) + 2000 AS STRING) || substr(d, 5)
 AS TIMESTAMP) AS DATE) AS fixed
FROM (SELECT event_id, '00' || strftime(ts, '%y-%m-%d') || CASE event_id % 3 WHEN 1 THEN ' 10:11:12'
 WHEN 2 THEN 'junk' ELSE '' END AS d FROM events)""")
def century_fix(spark, sf):
    rest = F.col("event_id") % 3
    text_date = F.concat(F.lit("00"), F.date_format("ts", "yy-MM-dd"), F.when(rest == 1, " 10:11:12").when(
        rest == 2, "junk").otherwise(""))
    return table(spark, sf, "events").select(
        "event_id", casts.repair_century(text_date).alias("fixed"))


@query("fold_text", """
SELECT id, ciudad, trim(strip_accents(lower(ciudad))) AS folded FROM raw_tx""")
def fold_text(spark, sf):
    return raw_tx(spark, sf).select("id", "ciudad", text.fold(F.col("ciudad")).alias("folded"))


@query("display_name", f"""
SELECT p_partkey, {sql_title("replace(lower(p_type) || '_' || p_name, '_', ' ')")} AS shown FROM part""")
def display_name(spark, sf):
    name = F.concat(F.lower("p_type"), F.lit("_"), F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", text.display_name(name).alias("shown"))


@query("pct_error", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
 round((1500 * l_quantity - l_extendedprice) / nullif(l_extendedprice, 0) * 100, 2) AS error_pct
FROM lineitem""")
def pct_error(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
        numeric.percent_error(1500 * F.col("l_quantity"), F.col("l_extendedprice"))
        .alias("error_pct"))


# --- sources ---------------------------------------------------------------
@query("flatten_struct", """
SELECT CAST(event_id AS STRING) AS event_id, event_type AS event_type,
 CAST(user_id AS STRING) AS event_user_id,
 CAST(json_extract(props, '$.k') AS STRING) AS props_k,
 '["' || event_type || '","' || CAST(user_id AS STRING) || '"]' AS tags FROM events""")
def flatten_struct(spark, sf):
    nested = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.col("event_type").alias("type"), F.col("user_id")).alias("event"),
        F.from_json("props", "k bigint").alias("props"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"))
    return flatten(nested)


@query("feature_scan", """
SELECT area_m2, alcobas, banos, lat, lon, banos_por_alcoba, area_por_alcoba, anio, mes, trimestre,
 dia_semana, ciudad, tipo, estado, precio_cop FROM features WHERE precio_cop >= 20000000""")
def feature_scan_query(spark, sf):
    return feature_scan(base.features(spark, sf), MODEL_NUMERIC, MODEL_CATEGORICAL, TARGET,
                        20_000_000)


@query("param_query", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 100000""")
def param_query(spark, sf):
    return parameterised(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} "
        "WHERE o_orderpriority = :priority AND o_totalprice >= :minimum",
        {"priority": "1-URGENT", "minimum": 100000.0}, orders=table(spark, sf, "orders"))


@query("role_map", """
SELECT p_brand, upper(p_type) AS rol, arg_max(p_name, p_partkey) AS tabla FROM part
WHERE coalesce(p_type, '') <> '' AND coalesce(p_name, '') <> '' GROUP BY ALL""")
def role_map_query(spark, sf):
    parameters = table(spark, sf, "part").select(
        "p_brand", F.lower("p_type").alias("rol_tabla"), F.col("p_name").alias("tabla_consumption"),
        F.col("p_partkey").alias("orden_carga"))
    return role_map(parameters, by=["p_brand"])


@query("schema_align", """
SELECT CAST(event_id AS STRING) AS event_id, event_type, CAST(NULL AS STRING) AS channel,
 CAST(user_id AS STRING) AS user_id FROM events""")
def schema_align(spark, sf):
    from pyspark.sql.types import StructType
    wanted = StructType.fromDDL("event_id string, event_type string, channel string, user_id string")
    return align(table(spark, sf, "events"), wanted)


@query("union_pages", """
SELECT conv_id, turn, text AS question, CAST(NULL AS STRING) AS answer FROM conversations
WHERE role = 'user'
UNION ALL SELECT conv_id, turn, NULL, text FROM conversations WHERE role <> 'user'""")
def union_pages_query(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    given = turns.where("role <> 'user'").select("conv_id", "turn", F.col("text").alias("answer"))
    return union_pages([asked, given])


@query("page_chain", """
, ends AS (SELECT conv_id, min(turn) AS first, max(turn) AS last FROM conversations GROUP BY conv_id
), RECURSIVE_LINKS AS (
 SELECT DISTINCT c.conv_id, c.turn, CASE WHEN c.turn < e.last THEN c.turn + 1 END AS next
 FROM conversations c JOIN ends e ON c.conv_id = e.conv_id)
SELECT concat(CAST(l.conv_id AS STRING), '/', CAST(e.first AS STRING)) AS start,
 CAST(l.turn - e.first AS BIGINT) AS position,
 concat(CAST(l.conv_id AS STRING), '/', CAST(l.turn AS STRING)) AS page
FROM RECURSIVE_LINKS l JOIN ends e ON l.conv_id = e.conv_id""")
def page_chain(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn").distinct()
    ends = turns.groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))

    def page(number):
        return F.concat(F.col("conv_id").cast("string"), F.lit("/"), number.cast("string"))

    links = turns.join(ends, "conv_id").select(
        page(F.col("turn")).alias("page"),
        F.when(F.col("turn") < F.col("last"), page(F.col("turn") + 1)).alias("next"))
    return follow_links(ends.select(page(F.col("first")).alias("start")), links)


# --- name matching and distinct options ------------------------------------
_PLACES_SQL = """
, cities AS (SELECT DISTINCT ciudad AS city FROM staging WHERE ciudad IS NOT NULL
), places AS (
 SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Municipio de SANTIAGO DE CALI'
   WHEN 'MACHINERY' THEN 'medellÍN ' WHEN 'HOUSEHOLD' THEN NULL ELSE n_name END AS town,
  CASE c_nationkey % 5 WHEN 0 THEN 'Área de Bogotá' WHEN 1 THEN 'marta' WHEN 2 THEN 'Valledupar (Cesar)'
   ELSE c_name END AS county
 FROM customer JOIN nation ON c_nationkey = n_nationkey
), names AS (SELECT c_custkey, 0 AS rank, town AS name FROM places
 UNION ALL SELECT c_custkey, 1, county FROM places
), folded AS (SELECT *, trim(strip_accents(lower(name))) AS f FROM names WHERE name <> ''
), known AS (SELECT city, trim(strip_accents(lower(city))) AS g FROM cities
), hits AS (SELECT c_custkey, rank, min(city) AS city FROM folded JOIN known
  ON contains(f, g) OR contains(g, f) GROUP BY c_custkey, rank)
SELECT p.c_custkey, (SELECT arg_min(h.city, h.rank) FROM hits h WHERE h.c_custkey = p.c_custkey) AS city
FROM places p"""


@query("place_match", _PLACES_SQL)
def place_match(spark, sf):
    nations = table(spark, sf, "nation")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey") % 5
    town = (F.when(segment == "BUILDING", "Municipio de SANTIAGO DE CALI")
            .when(segment == "MACHINERY", "medellÍN ")
            .when(segment == "HOUSEHOLD", F.lit(None).cast("string")).otherwise(F.col("n_name")))
    county = (F.when(nation == 0, "Área de Bogotá").when(nation == 1, "marta")
              .when(nation == 2, "Valledupar (Cesar)").otherwise(F.col("c_name")))
    places = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", town.alias("town"), county.alias("county"))
    # the few names are looked up many times
    cities = stored(staging(spark, sf).select(F.col("ciudad").alias("city")).distinct())
    return match.match_places(places, "c_custkey", ["town", "county"], cities)
