"""Model registry as tables: versions joined to the runs that produced them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastre.functions.text import is_blank


def versions_with_runs(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Name, artefact path and test R² of every registered version.

    Versions without a run, a name or an artefact cannot be served and are
    left out; a missing R² counts as 0.
    """
    joined = versions.join(runs, "run_id").select(
        F.col("params")["modelo"].alias("modelo"), "version", "run_id",
        F.coalesce(F.col("metrics")["test_R2"], F.lit(0.0)).alias("r2"),
        F.col("params")["uri"].alias("uri"), "stage")
    return joined.where(~is_blank(F.col("modelo")) & ~is_blank(F.col("uri")))


def best_versions(candidates: DataFrame) -> DataFrame:
    """Best version per model name, the earliest on ties."""
    order = Window.partitionBy("modelo").orderBy(F.col("r2").desc(), F.col("version").asc())
    return (candidates.withColumn("__rank", F.row_number().over(order))
            .where("__rank = 1").drop("__rank"))


def top_models(candidates: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` best models by R², rounded to four decimals for listing."""
    best = best_versions(candidates).orderBy(F.col("r2").desc(), "modelo").limit(n)
    return best.withColumn("r2", F.round("r2", 4))


def promoted_stages(versions: DataFrame, runs: DataFrame, modelo: str,
                    registry: str) -> DataFrame:
    """Stage of every version after the newest version of ``modelo`` goes to production.

    Other versions in production are archived.  When the name has no version
    the newest of the registry is promoted.
    """
    named = versions.where(F.col("registry") == registry).join(
        runs.select("run_id", F.col("params")["modelo"].alias("modelo")), "run_id", "left")
    chosen = named.agg(F.coalesce(
        F.max(F.when(F.col("modelo") == modelo, F.col("version"))),
        F.max("version")).alias("version"))
    # one row: the number of the promoted version
    promoted = chosen.withColumn("__promoted", F.lit(True))
    mine = F.col("registry") == registry
    return versions.join(F.broadcast(promoted), "version", "left").select(
        "version", "run_id", "registry",
        F.when(mine & F.col("__promoted"), "Production")
        .when(mine & (F.col("stage") == "Production"), "Archived")
        .otherwise(F.col("stage")).alias("stage"))
