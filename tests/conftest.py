import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))
# Python workers import the package and the test helpers too
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")])

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from cadastre.session import build_session
    session = build_session("local[8]", shuffle_partitions=4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-warehouse-")})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data at {SF_DIR}")
    return SF_DIR


@pytest.fixture
def warehouse(spark, tmp_path):
    """Empty warehouse with every table of the model."""
    from cadastre.schemas import ALL_TABLES
    from cadastre.sinks.catalog import Warehouse
    house = Warehouse(spark, str(tmp_path / "warehouse"))
    for spec in ALL_TABLES:
        house.create(spec, replace=True)
    return house


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
