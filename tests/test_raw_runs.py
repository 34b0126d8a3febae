"""The raw step, stopped at each place and run again."""

import json
import os
import time

import pytest

from cadastre.plans.steps import run_raw
from cadastre.schemas import RAW_AUCTIONS, RAW_FOREIGN_TRANSACTIONS, RAW_MANIFEST, RAW_TRANSACTIONS
from cadastre.sinks.catalog import Warehouse
from cadastre.sinks.manifest import Run, open_run
from cadastre.sources import files
from test_steps import NAME, land, line, workspace  # noqa: F401

PAGES = [f"page_0{k}.json" for k in range(1, 5)]


def land_pages(workspace):
    for k, name in enumerate(PAGES):
        following = PAGES[k + 1] if k + 1 < len(PAGES) else None
        with open(f"{workspace.landing}/{name}", "w", encoding="utf-8") as handle:
            json.dump({"meta": {"next": following}, "data": [{"transaction_id": k, "property": {"state": "NY"}}]}, handle)


def count(workspace, spec):
    return workspace.warehouse.table(spec.name).count()


def stop_after(monkeypatch, owner, name, calls):
    """Let a function run so many times, then fail; it works again once it has failed."""
    original, made = getattr(owner, name), []

    def stopping(*args, **kwargs):
        if len(made) == calls:
            monkeypatch.setattr(owner, name, original)
            raise RuntimeError("stopped")
        made.append(1)
        return original(*args, **kwargs)

    monkeypatch.setattr(owner, name, stopping)


@pytest.mark.parametrize("owner, name, calls", [
    (files, "move", 0), (files, "move", 1), (Warehouse, "write_run", 0), (Warehouse, "publish", 0),
    (Run, "close", 0)])
def test_csv_stopped_and_run_again(workspace, monkeypatch, owner, name, calls):
    land(workspace, *[line(i) for i in range(10)])
    stop_after(monkeypatch, owner, name, calls)
    assert run_raw(workspace, NAME) == 1
    assert run_raw(workspace, NAME) == 0
    assert count(workspace, RAW_TRANSACTIONS) == 10
    assert os.listdir(workspace.processed) == [NAME] or NAME in os.listdir(workspace.processed)
    assert not os.path.exists(f"{workspace.processing}/{NAME}") and not os.path.exists(f"{workspace.landing}/{NAME}")
    assert open_run(workspace.warehouse, NAME) is None


@pytest.mark.parametrize("moved", [1, 3, 4, 6])
def test_pages_stopped_between_moves(workspace, monkeypatch, moved):
    land_pages(workspace)
    stop_after(monkeypatch, files, "move", moved)
    assert run_raw(workspace, PAGES[0]) == 1
    assert run_raw(workspace, PAGES[0]) == 0
    assert count(workspace, RAW_FOREIGN_TRANSACTIONS) == 4
    assert {f for f in os.listdir(workspace.processed) if f.endswith("json") and not f.startswith(".")} == set(PAGES)


def test_service_stopped_after_the_append(workspace, monkeypatch):
    stop_after(monkeypatch, Run, "close", 0)
    assert [run_raw(workspace, "auctions") for _ in range(2)] == [1, 0]
    assert count(workspace, RAW_AUCTIONS) == 14
    # the next run is another one
    assert run_raw(workspace, "auctions") == 0 and count(workspace, RAW_AUCTIONS) == 28


def test_another_file_takes_the_place_of_a_broken_one(workspace, monkeypatch):
    land(workspace, line(1))
    stop_after(monkeypatch, Warehouse, "write_run", 0)
    assert run_raw(workspace, NAME) == 1
    time.sleep(0.01)
    land(workspace, line(2), line(3))
    assert run_raw(workspace, NAME) == 0
    assert sorted(r["id"] for r in workspace.warehouse.table(RAW_TRANSACTIONS.name).collect()) == ["p-2", "p-3"]


def test_manifest_names_the_files(workspace):
    land_pages(workspace)
    assert run_raw(workspace, PAGES[0]) == 0
    rows = workspace.warehouse.table(RAW_MANIFEST.name).where("evento = 'found'").orderBy("posicion").collect()
    assert [(r["posicion"], r["archivo"]) for r in rows] == list(enumerate(PAGES))
    assert all(r["longitud"] > 0 and r["modificado"] for r in rows) and len({r["run"] for r in rows}) == 1
