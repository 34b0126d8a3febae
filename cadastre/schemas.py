"""Table shapes of every layer.

Fixed values: column names, their order and their types are the shared data
model; a table written here must be readable by existing consumers of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LOADED_AT = "_loaded_at"
FEATURE_SET_AT = "_feature_set_at"
NOW_DEFAULT = "current_timestamp()"


@dataclass(frozen=True)
class TableSpec:
    """Name, columns (``(name, ddl type)``) and physical layout of one table."""

    name: str
    columns: tuple[tuple[str, str], ...]
    defaults: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    comment: str = ""
    # ``key,key:count`` for buckets of keys, ``column:0`` for months, ``:0`` for runs; see sinks.units
    unit: str = ""

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def data_columns(self) -> list[str]:
        """Columns a load supplies, i.e. those without a default."""
        return [name for name in self.column_names if name not in self.defaults]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))

    @property
    def data_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema.fields if f.name not in self.defaults])


def _text(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((name, "string") for name in names) + ((LOADED_AT, "timestamp"),)


# --- fixed values: the layers' column lists --------------------------------
TRANSACTION_TEXT = (
    "id", "ciudad", "tipo", "area_m2", "alcobas", "banos",
    "precio_cop", "lat", "lon", "fecha", "estado",
)

STAGING_COLUMNS = (
    ("id", "string"), ("ciudad", "string"), ("tipo", "string"),
    ("area_m2", "double"), ("alcobas", "bigint"), ("banos", "bigint"),
    ("precio_cop", "bigint"), ("lat", "double"), ("lon", "double"),
    ("fecha", "date"), ("estado", "string"),
)

SPLIT_COLUMNS = (
    ("propiedad_id", "string"), ("ciudad", "string"), ("tipo", "string"),
    ("estado", "string"), ("area_m2", "double"), ("alcobas", "bigint"),
    ("banos", "bigint"), ("lat", "double"), ("lon", "double"),
    ("precio_por_m2", "double"), ("log_precio_cop", "double"),
    ("banos_por_alcoba", "double"), ("area_por_alcoba", "double"),
    ("anio", "bigint"), ("mes", "bigint"), ("trimestre", "bigint"),
    ("dia_semana", "bigint"), ("fecha", "date"), ("precio_cop", "bigint"),
)

FEATURE_COLUMNS = SPLIT_COLUMNS + (("split", "string"),)

MODEL_NUMERIC = (
    "area_m2", "alcobas", "banos", "lat", "lon", "banos_por_alcoba",
    "area_por_alcoba", "anio", "mes", "trimestre", "dia_semana",
)
MODEL_CATEGORICAL = ("ciudad", "tipo", "estado")
TARGET = "precio_cop"
# ---------------------------------------------------------------------------

RAW_TRANSACTIONS = TableSpec(
    "raw.transactions", _text(*TRANSACTION_TEXT), {LOADED_AT: NOW_DEFAULT},
    comment="transactions as received, every business column text", unit=":0")
RAW_HOUSING_INDEX = TableSpec(
    "raw.housing_index", _text("unit", "country", "month", "price_index"),
    {LOADED_AT: NOW_DEFAULT}, comment="monthly price index per country", unit=":0")
RAW_FOREIGN_TRANSACTIONS = TableSpec(
    "raw.foreign_transactions",
    _text("transaction_id", "authority_name", "property_state",
          "property_fair_market_value", "property_type", "transaction_type",
          "transaction_date", "lease_rate", "sale_price"),
    {LOADED_AT: NOW_DEFAULT}, comment="flattened records of chained JSON pages", unit=":0")
RAW_AUCTIONS = TableSpec(
    "raw.auctions",
    _text("property", "auction_date", "minimum_bid", "final_bid", "status"),
    {LOADED_AT: NOW_DEFAULT}, comment="auction records of a paged REST service", unit=":0")

STAGING_TRANSACTIONS = TableSpec(
    "staging.transactions", STAGING_COLUMNS + ((LOADED_AT, "timestamp"),),
    {LOADED_AT: NOW_DEFAULT}, required=("id",), sort_by=("fecha", "ciudad", "tipo"), unit="id:64")

FEATURES = TableSpec(
    "consumption.features", FEATURE_COLUMNS + ((FEATURE_SET_AT, "timestamp"),),
    {FEATURE_SET_AT: NOW_DEFAULT}, required=("propiedad_id",),
    sort_by=("fecha", "ciudad", "tipo"), unit="fecha:0")
TRAIN = TableSpec("consumption.train", SPLIT_COLUMNS, required=("propiedad_id",),
                  sort_by=("fecha", "ciudad", "tipo"), unit="fecha:0")
TEST = TableSpec("consumption.test", SPLIT_COLUMNS, required=("propiedad_id",),
                 sort_by=("fecha", "ciudad", "tipo"), unit="fecha:0")

INGEST_PARAMETERS = TableSpec(
    "config.ingest_parameters",
    (("nombre_archivo", "string"), ("tipo_archivo", "string"),
     ("tabla_raw", "string"), ("tabla_staging", "string"),
     ("tipo_analisis", "string"), ("tipo_extraccion", "string"),
     ("columnas_llave", "string")),
    required=("nombre_archivo",))
# columns added to the ingest parameters after its first release
INGEST_PARAMETERS_ADDED = (("url_api", "string"), ("limit_pagina", "bigint"))

CONSUMPTION_PARAMETERS = TableSpec(
    "config.consumption_parameters",
    (("nombre_archivo", "string"), ("tabla_consumption", "string"),
     ("rol_tabla", "string"), ("estrategia", "string"), ("clave", "string"),
     ("orden_carga", "bigint"), ("activo", "boolean")),
    required=("nombre_archivo", "tabla_consumption"))

AUDIT = TableSpec(
    "metadata.ingestion_log",
    (("nombre_archivo", "string"), ("fuente", "string"),
     ("fecha_hora_inicio", "timestamp"), ("fecha_hora_fin", "timestamp"),
     ("estado", "string"), ("filas_leidas", "bigint"),
     ("filas_insertadas", "bigint"), ("filas_rechazadas", "bigint"),
     ("mensaje_error", "string"), ("dia", "date")),
    required=("nombre_archivo",), partition_by=("dia",))

RAW_MANIFEST = TableSpec(
    "metadata.raw_manifest",
    (("nombre_archivo", "string"), ("run", "string"), ("posicion", "bigint"),
     ("archivo", "string"), ("longitud", "bigint"), ("modificado", "timestamp"),
     ("evento", "string"), ("registrado", "timestamp")),
    required=("nombre_archivo", "run"),
    comment="files of each raw run, written before they are moved, and the end of the run")

MODEL_VERSIONS = TableSpec(
    "metadata.model_versions",
    (("version", "bigint"), ("run_id", "string"), ("registry", "string"),
     ("stage", "string")))
RUNS = TableSpec(
    "metadata.runs",
    (("run_id", "string"), ("experiment", "string"), ("started_at", "timestamp"),
     ("params", "map<string,string>"), ("metrics", "map<string,double>")))

ALL_TABLES = (
    RAW_TRANSACTIONS, RAW_HOUSING_INDEX, RAW_FOREIGN_TRANSACTIONS, RAW_AUCTIONS,
    STAGING_TRANSACTIONS, FEATURES, TRAIN, TEST, INGEST_PARAMETERS,
    CONSUMPTION_PARAMETERS, AUDIT, RAW_MANIFEST, MODEL_VERSIONS, RUNS,
)
