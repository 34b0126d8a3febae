"""Model features and the reproducible train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.functions.numeric import calendar_parts, safe_ratio, split_label
from cadastre.schemas import FEATURE_COLUMNS, SPLIT_COLUMNS

# Defaults of the training set.
TRAIN_PERCENT = 80
MINIMUM_PRICE = 10_000_000


def minimum_price(df: DataFrame, minimum: int = MINIMUM_PRICE,
                  column: str = "precio_cop") -> DataFrame:
    """Rows at or above the minimum; a NULL price never passes."""
    return df.where(F.col(column) >= F.lit(minimum))


def build_features(staging: DataFrame, train_percent: int = TRAIN_PERCENT,
                   price_minimum: int = MINIMUM_PRICE, hash_method: str = "md5") -> DataFrame:
    """Derive the feature set of every staging row at or above the minimum price."""
    price = F.col("precio_cop")
    derived = {
        "propiedad_id": F.col("id"),
        "precio_por_m2": safe_ratio(price, F.col("area_m2")),
        "log_precio_cop": F.ln(price.cast("double")),
        "banos_por_alcoba": safe_ratio(F.col("banos"), F.col("alcobas")),
        "area_por_alcoba": safe_ratio(F.col("area_m2"), F.col("alcobas")),
        "split": split_label(F.col("id"), train_percent, hash_method),
        **calendar_parts(F.col("fecha")),
    }
    priced = minimum_price(staging, price_minimum)
    return priced.select(*[
        derived[name].alias(name) if name in derived else F.col(name)
        for name, _ in FEATURE_COLUMNS])


def split_rows(features: DataFrame, label: str) -> DataFrame:
    """Rows of one split in the shape of its table."""
    return features.where(F.col("split") == label).select(*[n for n, _ in SPLIT_COLUMNS])


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """Label rows at random; depends on row order, so the hash split is preferred."""
    return df.withColumn("split", F.when(F.rand(seed) < train_share, "train").otherwise("test"))
