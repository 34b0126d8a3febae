"""The contracts of the consumption tables.

Fixed values: rule limits agreed with the consumers of these tables.
"""

from __future__ import annotations

from cadastre.operators.contracts import Contract

_COLUMNS = (
    {"name": "propiedad_id", "type": "STRING", "constraints": ["not_null", "unique"]},
    {"name": "ciudad", "type": "STRING", "constraints": ["not_null"]},
    {"name": "tipo", "type": "STRING", "constraints": ["not_null"]},
    {"name": "estado", "type": "STRING", "constraints": [
        "not_null", {"allowed_values": ["publicada", "vendida", "comprada", "remodelacion"]}]},
    {"name": "area_m2", "type": "FLOAT64", "constraints": [{"min": 1.0}, {"max": 10000.0}]},
    {"name": "alcobas", "type": "INT64", "constraints": ["not_null", {"min": 0}, {"max": 20}]},
    {"name": "banos", "type": "INT64", "constraints": ["not_null", {"min": 0}, {"max": 20}]},
    {"name": "lat", "type": "FLOAT64", "constraints": [{"min": -4.3}, {"max": 13.0}]},
    {"name": "lon", "type": "FLOAT64", "constraints": [{"min": -81.8}, {"max": -66.8}]},
    {"name": "precio_por_m2", "type": "FLOAT64", "constraints": [{"min": 0.0}]},
    {"name": "log_precio_cop", "type": "FLOAT64", "constraints": ["not_null", {"min": 0.0}]},
    {"name": "banos_por_alcoba", "type": "FLOAT64", "constraints": [{"min": 0.0}]},
    {"name": "area_por_alcoba", "type": "FLOAT64", "constraints": [{"min": 0.0}]},
    {"name": "anio", "type": "INT64", "constraints": ["not_null", {"between": [2000, 2030]}]},
    {"name": "mes", "type": "INT64", "constraints": ["not_null", {"between": [1, 12]}]},
    {"name": "trimestre", "type": "INT64", "constraints": ["not_null", {"between": [1, 4]}]},
    {"name": "dia_semana", "type": "INT64", "constraints": ["not_null", {"between": [1, 7]}]},
    {"name": "fecha", "type": "DATE", "constraints": ["not_null"]},
    {"name": "precio_cop", "type": "INT64", "constraints": ["not_null", {"min": 10000000}]},
)

_SPLIT = (
    {"name": "split", "type": "STRING",
     "constraints": ["not_null", {"allowed_values": ["train", "test"]}]},
)

FEATURES_CONTRACT = Contract(
    dataset="consumption.features", version="1.0.0",
    timestamp_column="_feature_set_at", max_age="7d", minimum_rows=1,
    columns=_COLUMNS + _SPLIT)
TRAIN_CONTRACT = Contract(
    dataset="consumption.train", version="1.0.0", minimum_rows=1, columns=_COLUMNS)
TEST_CONTRACT = Contract(
    dataset="consumption.test", version="1.0.0", minimum_rows=1, columns=_COLUMNS)
