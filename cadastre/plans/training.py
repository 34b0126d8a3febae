"""Train, compare, register and promote models; score with the best of them.

    python -m cadastre.plans.training --config models.yaml [--root hdfs:///lake]

trains what the file lists, see :func:`config_from`, and ends with 1 if no model could be trained.
"""

from __future__ import annotations

import argparse
import json
import logging
import posixpath
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.operators import learning, registry
from cadastre.operators.metrics import METRICS, model_comparison
from cadastre.operators.profile import dataset_summary
from cadastre.plans.steps import Workspace
from cadastre.schemas import (
    MODEL_CATEGORICAL, MODEL_NUMERIC, MODEL_VERSIONS, RUNS, TARGET)
from cadastre.session import build_session
from cadastre.sinks.catalog import Warehouse
from cadastre.sources.tables import feature_scan, schema_differences

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainingConfig:
    train: str = "consumption.train"
    test: str = "consumption.test"
    key: str = "propiedad_id"
    target: str = TARGET
    numeric: tuple[str, ...] = MODEL_NUMERIC
    categorical: tuple[str, ...] = MODEL_CATEGORICAL
    models: Mapping[str, Mapping[str, Any]] = field(
        default_factory=lambda: dict(learning.STANDARD_PARAMETERS))
    folds: int = 5
    seed: int = 42
    price_minimum: int = 10_000_000
    experiment: str = "precios"
    registry: str = "precios"
    model_folder: str = "models"
    served_models: int = 2
    parallel_folds: int = 1


@dataclass
class TrainingResult:
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)
    run_ids: dict[str, str] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)
    best: str | None = None


def _scan(workspace: Workspace, table: str, config: TrainingConfig) -> DataFrame:
    return feature_scan(workspace.warehouse.table(table), [config.key, *config.numeric],
                        config.categorical, config.target, config.price_minimum)


def check_same_shape(train: DataFrame, test: DataFrame) -> None:
    """Train and test must have the same columns; differing types only warn."""
    differences = schema_differences(train, test)
    if differences["missing_in_test"] or differences["missing_in_train"]:
        raise ValueError(f"train and test differ in their columns: {differences}")
    if differences["types"]:
        log.warning("train and test differ in the type of %s", differences["types"])


def _summary(df: DataFrame, config: TrainingConfig, prefix: str) -> dict[str, str]:
    features = [*config.numeric, *config.categorical]
    rows = dataset_summary(df, features, config.target).collect()  # six rows
    return {f"{prefix}_{r['stat']}": repr(r["value"]) for r in rows}


def _train_one(workspace: Workspace, config: TrainingConfig, name: str,
               params: Mapping[str, Any], train: DataFrame, test: DataFrame,
               common: dict[str, str]) -> tuple[str, dict[str, float]]:
    columns = (list(config.numeric), list(config.categorical), config.target)
    per_fold = learning.cross_validate(
        train, config.key, name, dict(params), *columns, folds=config.folds, seed=config.seed,
        minimum=config.price_minimum, parallelism=config.parallel_folds)
    logged = learning.cross_validation_summary(per_fold)
    model = learning.fit(train, name, dict(params), *columns)
    row = learning.evaluate(model, test, config.target, minimum=config.price_minimum).first()
    metrics = {m: float(row[m]) for m in METRICS if row[m] is not None}
    logged.update({f"test_{m}": v for m, v in metrics.items()})

    run_id = uuid.uuid4().hex
    started = workspace.clock()
    values = {"modelo": name, "cv_folds": str(config.folds),
              "features_numericas": ",".join(config.numeric),
              "features_categoricas": ",".join(config.categorical),
              **{k: str(v) for k, v in params.items()}, **common}
    path = posixpath.join(config.model_folder, f"{name}_{started:%Y%m%d_%H%M%S}_{run_id[:8]}")
    try:
        model.write().save(path)
        values["uri"] = path
    except Exception as exc:  # an unsaved model is still compared, but cannot be served
        log.warning("model %s could not be saved: %s", name, exc)
    spark, warehouse = workspace.spark, workspace.warehouse
    clean = {k: float(v) for k, v in logged.items() if v is not None}
    warehouse.append(RUNS.name, spark.createDataFrame(
        [(run_id, config.experiment, started, values, clean)], RUNS.schema).coalesce(1))
    versions = warehouse.table(MODEL_VERSIONS.name)
    last = versions.where(F.col("registry") == config.registry).agg(F.max("version")).first()[0] or 0
    warehouse.append(MODEL_VERSIONS.name, spark.createDataFrame(
        [(last + 1, run_id, config.registry, "None")], MODEL_VERSIONS.schema).coalesce(1))
    return run_id, metrics


def promote(workspace: Workspace, config: TrainingConfig, name: str) -> bool:
    """Put the newest version of a model into production; a failure only warns."""
    try:
        warehouse = workspace.warehouse
        stages = registry.promoted_stages(
            warehouse.table(MODEL_VERSIONS.name), warehouse.table(RUNS.name), name, config.registry)
        warehouse.swap(MODEL_VERSIONS.name, stages.coalesce(1))
        return True
    except Exception as exc:
        log.warning("model %s could not be promoted: %s", name, exc)
        return False


def run_training(workspace: Workspace, config: TrainingConfig) -> TrainingResult:
    """Train every configured model; one that fails is skipped, the best is promoted."""
    train = _scan(workspace, config.train, config).persist(StorageLevel.MEMORY_AND_DISK)
    test = _scan(workspace, config.test, config).persist(StorageLevel.MEMORY_AND_DISK)
    result = TrainingResult()
    try:
        check_same_shape(train, test)
        common = {**_summary(train, config, "train"), **_summary(test, config, "test")}
        for name, params in config.models.items():
            try:
                result.run_ids[name], result.metrics[name] = _train_one(
                    workspace, config, name, params, train, test, common)
            except Exception as exc:
                log.error("training %s failed: %s", name, exc)
                result.failures[name] = str(exc)
    finally:
        train.unpersist()
        test.unpersist()
    if result.metrics:
        result.best = max(result.metrics, key=lambda n: result.metrics[n].get("R2", -1.0))
        promote(workspace, config, result.best)
    return result


def comparison_table(workspace: Workspace, result: TrainingResult) -> DataFrame:
    rows = [(n, *[m.get(k) for k in METRICS]) for n, m in result.metrics.items()]
    schema = "modelo string, " + ", ".join(f"{m} double" for m in METRICS)
    return model_comparison(workspace.spark.createDataFrame(rows, schema))


def served_models(workspace: Workspace, config: TrainingConfig) -> DataFrame:
    """The best version of each model, the best ``served_models`` of them."""
    warehouse = workspace.warehouse
    versions = warehouse.table(MODEL_VERSIONS.name).where(F.col("registry") == config.registry)
    candidates = registry.versions_with_runs(versions, warehouse.table(RUNS.name))
    return registry.top_models(candidates, config.served_models)


def load_served_model(workspace: Workspace, config: TrainingConfig, name: str) -> PipelineModel:
    rows = served_models(workspace, config).where(F.col("modelo") == name).collect()
    if not rows:
        raise ValueError(f"model {name!r} is not among the served models")
    return PipelineModel.load(rows[0]["uri"])


def score_batch(workspace: Workspace, config: TrainingConfig, name: str,
                requests: DataFrame) -> DataFrame:
    """Estimated price of each request, with the model that made it."""
    model = load_served_model(workspace, config, name)
    return learning.score(model, requests).withColumn("modelo_usado", F.lit(name))


def config_from(values: Mapping[str, Any]) -> TrainingConfig:
    """Configuration of a mapping with the fields of :class:`TrainingConfig` by their names.

    ``models`` is a list of ``{name, params, enabled}``, or a mapping of names to parameters; without
    parameters a model has its standard ones.  Unknown fields and models are errors, so a misspelt
    setting does not pass unnoticed.
    """
    known = {f.name for f in fields(TrainingConfig)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings {unknown}; known: {sorted(known)}")
    settings = {k: tuple(v) if isinstance(v, list) and k != "models" else v for k, v in values.items()}
    if "models" in values:
        listed = values["models"]
        if isinstance(listed, Mapping):
            listed = [{"name": name, "params": params} for name, params in listed.items()]
        models = {}
        for entry in listed:
            name = entry["name"]
            if name not in learning.MODELS:
                raise ValueError(f"unknown model {name!r}; known: {sorted(learning.MODELS)}")
            if name in models:
                raise ValueError(f"model {name!r} is listed twice")
            if entry.get("enabled", True):
                models[name] = dict(entry.get("params") or learning.STANDARD_PARAMETERS.get(name, {}))
        if not models:
            raise ValueError("no model is enabled")
        settings["models"] = models
    return TrainingConfig(**settings)


def read_config(spark: SparkSession, path: str) -> TrainingConfig:
    """Configuration from a JSON or YAML file in any store that Spark reads."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    if path.endswith((".yaml", ".yml")):
        import yaml
        values = yaml.safe_load(text)
    else:
        values = json.loads(text)
    if not isinstance(values, Mapping):
        raise ValueError(f"{path} holds no settings")
    return config_from(values)


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Train the models of a configuration file.")
    parser.add_argument("--config", required=True)
    parser.add_argument("--root", default="warehouse", help="root folder of the tables")
    given = parser.parse_args(arguments)
    spark = build_session()
    config = read_config(spark, given.config)
    result = run_training(Workspace(Warehouse(spark, given.root)), config)
    print(json.dumps({"best": result.best, "metrics": result.metrics, "failures": result.failures}, sort_keys=True))
    return 0 if result.best else 1


if __name__ == "__main__":
    raise SystemExit(main())
