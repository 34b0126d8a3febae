"""Metrics, folds, model registry, fitting and scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cadastre.functions.casts import to_double, to_integer
from cadastre.functions.text import canonical_city, canonical_type
from cadastre.operators import learning, metrics, registry
from cadastre.operators.rows import ERRORS, check_rows
from cadastre.plans.registered import base
from cadastre.plans.registered.base import query, raw_tx, sql_bucket, table
from cadastre.schemas import MODEL_CATEGORICAL, MODEL_NUMERIC, TARGET
from cadastre.session import stored


def _predicted(spark, sf):
    """Order lines with a simple formula in place of a model."""
    return table(spark, sf, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"), "l_returnflag", "l_linestatus",
        F.col("l_extendedprice").alias("y"), (1500 * F.col("l_quantity")).alias("p"))


_PREDICTED_SQL = """
, predicted AS (SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
 l_returnflag, l_linestatus, l_extendedprice AS y, 1500 * l_quantity AS p FROM lineitem)"""


def _metrics_sql(source, by, minimum=0):
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}avg(abs(y - p)) AS MAE, sqrt(avg((y - p) * (y - p))) AS RMSE,
 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS R2,
 avg(CASE WHEN y >= {minimum} THEN abs(y - p) / abs(y) END) * 100 AS MAPE
FROM {source}""" + (f" GROUP BY {by}" if by else "")


def _rounded_sql(inner, keys=""):
    return (f"SELECT {keys}round(MAE, 4) AS MAE, round(RMSE, 4) AS RMSE, round(R2, 6) AS R2, "
            f"round(MAPE, 4) AS MAPE FROM ({inner})")


def _rounded(df):
    return df.withColumns({"MAE": F.round("MAE", 4), "RMSE": F.round("RMSE", 4),
                           "R2": F.round("R2", 6), "MAPE": F.round("MAPE", 4)})


@query("regression_metrics",
       _PREDICTED_SQL + _rounded_sql(_metrics_sql("predicted", "", 20000)))
def regression_metrics(spark, sf):
    return _rounded(metrics.regression_metrics(_predicted(spark, sf), "y", "p", minimum=20000))


@query("metrics_by_split", _PREDICTED_SQL + f"""
, labelled AS (SELECT *, CASE WHEN {sql_bucket('id', 100)} < 80 THEN 'train' ELSE 'test' END AS split
 FROM predicted)""" + _rounded_sql(_metrics_sql("labelled", "split"), "split, "))
def metrics_by_split(spark, sf):
    from cadastre.functions.numeric import split_label
    labelled = _predicted(spark, sf).withColumn("split", split_label(F.col("id")))
    return _rounded(metrics.regression_metrics(labelled, "y", "p", by=["split"]))


_FOLDED_SQL = f"""{_PREDICTED_SQL}
, folded AS (SELECT *, {sql_bucket('id', 5, '#42')} AS fold FROM predicted)"""


@query("kfold_assign", f"{_FOLDED_SQL} SELECT id, y, fold FROM folded")
def kfold_assign(spark, sf):
    return metrics.assign_fold(_predicted(spark, sf), "id").select("id", "y", "fold")


_CV_COLUMNS = [(m, s) for m in metrics.METRICS for s in ("mean", "std")]


@query("cv_summary", f"{_FOLDED_SQL} SELECT " + ", ".join(
    f"round({'avg' if s == 'mean' else 'stddev_pop'}({m}), 4) AS cv_{m}_{s}" for m, s in _CV_COLUMNS)
    + f" FROM ({_metrics_sql('folded', 'fold')})")
def cv_summary(spark, sf):
    folded = metrics.assign_fold(_predicted(spark, sf), "id")
    summary = metrics.fold_summary(metrics.regression_metrics(folded, "y", "p", by=["fold"]))
    return summary.select(*[F.round(c, 4).alias(c) for c in summary.columns])


@query("hash_sample", f"{_PREDICTED_SQL} SELECT id, y, p FROM predicted ORDER BY md5(id || '#42'), id LIMIT 10")
def hash_sample(spark, sf):
    return metrics.hash_sample(_predicted(spark, sf), "id", 10).select("id", "y", "p")


@query("model_comparison", _PREDICTED_SQL + _rounded_sql(
    "SELECT l_returnflag || l_linestatus AS modelo, * EXCLUDE (l_returnflag, l_linestatus) FROM ("
    + _metrics_sql("predicted", "l_returnflag, l_linestatus") + ")", "modelo, "))
def model_comparison(spark, sf):
    named = _predicted(spark, sf).withColumn("modelo", F.concat("l_returnflag", "l_linestatus"))
    results = metrics.regression_metrics(named, "y", "p", by=["modelo"])
    return metrics.model_comparison(_rounded(results))


# --- registry ---------------------------------------------------------------
def _registry(spark, sf):
    """Every part is a registered version; its type is the model name."""
    parts = table(spark, sf, "part")
    run_id = F.concat(F.lit("run-"), F.col("p_partkey").cast("string"))
    versions = parts.select(
        F.col("p_partkey").alias("version"), run_id.alias("run_id"), F.lit("precios").alias("registry"),
        F.when(F.col("p_size") > 45, "Production").otherwise("None").alias("stage"))
    runs = parts.select(
        run_id.alias("run_id"),
        F.create_map(F.lit("modelo"), F.col("p_type"), F.lit("uri"),
                     F.when(F.col("p_size") != 1, F.concat(F.lit("models/"), F.col("p_name"))))
        .alias("params"),
        F.create_map(F.lit("test_R2"), F.when(
            F.col("p_size") != 2, F.round(F.col("p_retailprice") / 2500, 2))).alias("metrics"))
    return versions, runs


_CANDIDATES_SQL = """
, candidates AS (SELECT p_type AS modelo, p_partkey AS version,
 'run-' || CAST(p_partkey AS STRING) AS run_id,
 CASE WHEN p_size <> 2 THEN round(p_retailprice / 2500, 2) ELSE 0.0 END AS r2,
 'models/' || p_name AS uri, CASE WHEN p_size > 45 THEN 'Production' ELSE 'None' END AS stage
 FROM part WHERE p_size <> 1 AND trim(p_type) <> ''
), best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY modelo ORDER BY r2 DESC, version) AS rn FROM candidates) WHERE rn = 1)"""


@query("registry_join", f"{_CANDIDATES_SQL} SELECT * FROM candidates")
def registry_join(spark, sf):
    return registry.versions_with_runs(*_registry(spark, sf))


@query("best_per_group", f"{_CANDIDATES_SQL} SELECT * FROM best")
def best_per_group(spark, sf):
    return registry.best_versions(registry.versions_with_runs(*_registry(spark, sf)))


@query("top_n_models", f"""{_CANDIDATES_SQL}
SELECT * REPLACE (round(r2, 4) AS r2) FROM best ORDER BY r2 DESC, modelo LIMIT 2""")
def top_n_models(spark, sf):
    return registry.top_models(registry.versions_with_runs(*_registry(spark, sf)), 2)


@query("promote_best", """
, promoted AS (SELECT max(p_partkey) AS v FROM part WHERE p_type = 'ECONOMY')
SELECT p_partkey AS version, 'run-' || CAST(p_partkey AS STRING) AS run_id, 'precios' AS registry,
 CASE WHEN p_partkey = v THEN 'Production' WHEN p_size > 45 THEN 'Archived' ELSE 'None' END AS stage
FROM part, promoted""")
def promote_best(spark, sf):
    return registry.promoted_stages(*_registry(spark, sf), "ECONOMY", "precios")


# --- fitting and scoring ----------------------------------------------------
def _training_rows(spark, sf):
    return base.features(spark, sf).select(
        "propiedad_id", *MODEL_NUMERIC, *MODEL_CATEGORICAL, TARGET, "split")


def _training_frame(spark, sf):
    """Features of all rows, stored: each fit and evaluation makes several passes over them."""
    return stored(_training_rows(spark, sf))


def _fitted(frame, name):
    """Fit on the train rows."""
    return learning.fit(frame.where("split = 'train'"), name, learning.STANDARD_PARAMETERS[name],
                        MODEL_NUMERIC, MODEL_CATEGORICAL, TARGET)


def _scaled_sql(column):
    value = f"CAST({column} AS DOUBLE)"
    filled = f"coalesce({value}, (SELECT quantile_cont({value}, 0.5) FROM train), 0)"
    spread = f"(SELECT stddev_pop({filled}) FROM train)"
    return (f"round(({filled} - (SELECT avg({filled}) FROM train))"
            f" / CASE WHEN {spread} > 0 THEN {spread} ELSE 1 END, 6) AS n_{column}")


def _index_sql(column):
    """Place of the category among those of the train rows; an unknown one comes after them."""
    value = f"coalesce({column}, '{learning.UNKNOWN}')"
    known = f"SELECT list(DISTINCT {value} ORDER BY {value}) FROM train"
    return f"CAST(coalesce(list_position(({known}), {value}) - 1, len(({known}))) AS DOUBLE) AS i_{column}"


@query("ml_preprocess", """
, train AS (SELECT * FROM features WHERE split = 'train')
SELECT propiedad_id, """ + ", ".join(
    [*map(_scaled_sql, MODEL_NUMERIC), *map(_index_sql, MODEL_CATEGORICAL)])
    + " FROM features WHERE split = 'test'")
def ml_preprocess(spark, sf):
    frame = _training_frame(spark, sf)
    train, test = frame.where("split = 'train'"), frame.where("split = 'test'")
    stages = learning.preprocessing_stages(train, MODEL_NUMERIC, MODEL_CATEGORICAL)
    prepared = Pipeline(stages=stages).fit(train).transform(test)
    return prepared.select(
        "propiedad_id", *[F.round(f"__n_{c}", 6).alias(f"n_{c}") for c in MODEL_NUMERIC],
        *[F.col(f"__i_{c}").alias(f"i_{c}") for c in MODEL_CATEGORICAL])


def _model_query(key, name):
    @query(key)
    def evaluate(spark, sf):
        frame = _training_frame(spark, sf)
        return learning.evaluate(_fitted(frame, name), frame, TARGET, by=["split"]).withColumn(
            "modelo", F.lit(name))
    return evaluate


_model_query("ml_linear", "regresion_lineal")
_model_query("ml_tree", "arbol_decision")
_model_query("ml_forest", "random_forest")
_model_query("ml_gbt", "xgboost")


@query("cv_metrics")
def cv_metrics(spark, sf):
    train = _training_rows(spark, sf).where("split = 'train'")
    return learning.cross_validate(
        train, "propiedad_id", "regresion_lineal", {}, MODEL_NUMERIC, MODEL_CATEGORICAL, TARGET)


# a regression on one number has a closed form, so SQL can check fit, evaluation and folds
def _order_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"),
        F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))


_LINES_SQL = f"""
, lines AS (SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS id,
 CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)
, folded AS (SELECT *, {sql_bucket('id', 5, '#42')} AS fold FROM lines)"""


@query("linear_one_feature", f"""{_LINES_SQL}
, fitted AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM lines)
, predicted AS (SELECT y, i + s * x AS p FROM lines, fitted)""" + _rounded_sql(_metrics_sql("predicted", "")))
def linear_one_feature(spark, sf):
    lines = _order_lines(spark, sf)
    model = learning.fit(lines, "regresion_lineal", {}, ["x"], [], "y")
    return _rounded(learning.evaluate(model, lines, "y"))


@query("cv_one_feature", f"""{_LINES_SQL}
, fitted AS (SELECT f.fold, regr_slope(y, x) AS s, regr_intercept(y, x) AS i
 FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold GROUP BY f.fold)
, predicted AS (SELECT CAST(fold AS INT) AS fold, y, i + s * x AS p FROM folded JOIN fitted USING (fold))"""
       + _rounded_sql(_metrics_sql("predicted", "fold"), "fold, "))
def cv_one_feature(spark, sf):
    return _rounded(learning.cross_validate(
        _order_lines(spark, sf), "id", "regresion_lineal", {}, ["x"], [], "y"))


@query("batch_score")
def batch_score(spark, sf):
    """Every request: usable ones with a price as of a fixed day, the others with their errors."""
    model = _fitted(stored(_training_rows(spark, sf).where("split = 'train'")), "regresion_lineal")
    checked = check_rows(raw_tx(spark, sf).withColumn("modelo", F.lit("regresion_lineal")))
    typed = checked.select(
        "id", "modelo", canonical_city(F.col("ciudad")).alias("ciudad"),
        canonical_type(F.col("tipo")).alias("tipo"), to_double(F.col("area_m2")).alias("area_m2"),
        to_integer(F.col("alcobas")).alias("alcobas"), to_integer(F.col("banos")).alias("banos"),
        to_double(F.col("lat")).alias("lat"), to_double(F.col("lon")).alias("lon"), ERRORS)
    scored = learning.score(model, typed, F.lit("2026-01-01").cast("timestamp"))
    usable = F.size(ERRORS) == 0
    return scored.withColumns({
        "precio_estimado": F.when(usable, F.col("precio_estimado")),
        ERRORS: F.array_join(ERRORS, "; ")})
