"""Training from a configuration file."""

import json

import pytest

from cadastre.operators import learning
from cadastre.plans import training
from cadastre.plans.steps import run_consumption, run_raw, run_staging
from cadastre.schemas import RUNS
from test_steps import NAME, land, line, workspace  # noqa: F401


def test_file_decides_what_is_trained(workspace, tmp_path, capsys, spark):
    workspace.contracts = {}
    land(workspace, *[line(i) for i in range(120)])
    assert [f(workspace, NAME) for f in (run_raw, run_staging, run_consumption)] == [0, 0, 0]
    path = tmp_path / "models.yaml"
    path.write_text(f"""
folds: 2
numeric: [area_m2, alcobas]
categorical: [tipo]
model_folder: {tmp_path}/models
models:
  - name: regresion_lineal
  - name: arbol_decision
    params: {{max_depth: 2, random_state: 1}}
  - name: xgboost
    enabled: false
""", encoding="utf-8")
    assert training.main(["--config", str(path), "--root", workspace.warehouse.root]) == 0
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(told["metrics"]) == {"regresion_lineal", "arbol_decision"} and told["best"] in told["metrics"]
    runs = {r["params"]["modelo"]: r["params"] for r in workspace.warehouse.table(RUNS.name).collect()}
    assert runs["arbol_decision"]["max_depth"] == "2" and runs["arbol_decision"]["cv_folds"] == "2"


def test_settings_are_checked(spark, tmp_path):
    config = training.config_from({"models": {"arbol_decision": None}, "numeric": ["a"]})
    assert config.models == {"arbol_decision": learning.STANDARD_PARAMETERS["arbol_decision"]} and config.numeric == ("a",)
    for values, match in (({"fold": 3}, "unknown settings"), ({"models": ["x"] and [{"name": "nope"}]}, "unknown model"),
                          ({"models": [{"name": "xgboost", "enabled": False}]}, "no model"),
                          ({"models": [{"name": "xgboost"}, {"name": "xgboost"}]}, "twice")):
        with pytest.raises(ValueError, match=match):
            training.config_from(values)
    path = tmp_path / "c.json"
    path.write_text('{"folds": 3}')
    assert training.read_config(spark, str(path)).folds == 3
    path.write_text("[]")
    with pytest.raises(ValueError, match="no settings"):
        training.read_config(spark, str(path))
