"""A third of all rows under one key: results stay whole and right."""

import pytest
from pyspark.sql import functions as F

from cadastre.operators import dedup, match, merge, profile, quantiles
from conftest import rows_of

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Ids 0..19999 once each and one id on a third of the rows."""
    frame = spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 1000).alias("v"), F.col("id").alias("t"))
    return frame.repartition(8).persist()


def test_dedup(skewed):
    kept = dedup.keep_one(skewed, ["k"], "t", ["v"])
    assert kept.count() == ROWS - ROWS // 3 + 1
    assert kept.where("k = -1").first()["t"] == ROWS - 3


def test_duplicates_and_classification(skewed):
    assert tuple(profile.duplicate_report(skewed, "k").first()) == (1, ROWS // 3, ROWS - ROWS // 3 + 1)
    other = skewed.where("k < 0 OR k > 20000").select("k")
    counted = merge.classify_keys(skewed.select("k"), other, ["k"]).where("k = -1").first()
    assert (counted["source_rows"], counted["target_rows"], counted["action"]) == (
        ROWS // 3, ROWS // 3, "update")


def test_loads(spark, skewed):
    target = spark.range(-1, 5).select(F.col("id").alias("k"), F.lit(0).alias("v"), F.lit(0).alias("at"))
    source = skewed.select("k", "v")
    added = merge.incremental_load(source, target, ["k"], {"at": F.lit(1)})
    assert added.count() == source.where("k > 4").count()
    new_only = merge.incremental_load(source, target.where("k >= 0"), ["k"], {"at": F.lit(1)})
    assert new_only.where("k = -1").count() == ROWS // 3
    # a hot key in the stored table, one row for it in the batch
    stored = skewed.select("k", "v", F.lit(0).alias("at"))
    batch = spark.createDataFrame([(-1, 7), (-2, 8)], "k long, v long")
    result = merge.upsert_load(batch, stored, ["k"], {"at": F.lit(1)})
    assert result.where("k = -1 AND v = 7 AND _action = 'update'").count() == ROWS // 3
    assert result.count() == ROWS + 1


def test_quantiles_of_a_hot_group(skewed):
    grouped = skewed.withColumn("g", F.when(F.col("k") < 0, "hot").otherwise("rest"))
    got = {r["g"]: r["value"] for r in quantiles.quantiles(grouped, ["t"], [0.5], by=["g"]).collect()}
    want = {r["g"]: r["m"] for r in grouped.groupBy("g").agg(F.percentile("t", 0.5).alias("m")).collect()}
    assert got == want


def test_hot_name(spark, skewed):
    places = skewed.select("t", F.when(F.col("k") < 0, "Cali centro").otherwise("Quito").alias("town"))
    cities = spark.createDataFrame([("Cali",), ("Bogota",)], "city string")
    matched = match.match_places(places, "t", ["town"], cities)
    assert rows_of(matched.groupBy("city").count()) == [("Cali", ROWS // 3), (None, ROWS - ROWS // 3)]
