"""Costly views are computed once in queries that read them several times."""

import time

import pytest
from pyspark.sql import functions as F

from cadastre import session
from cadastre.plans.registered import QUERIES, loading


def _leaves(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().collectLeaves().toString()


@pytest.mark.parametrize("name", [
    "load_upsert", "load_incremental", "merge_counts", "dataset_summary", "describe_numeric", "place_match"])
def test_result_reads_stored_rows(spark, sf_dir, name):
    """The joins of the transaction view are behind the stored rows, not in every branch of the result."""
    assert "l_orderkey" not in _leaves(spark, sf_dir, name)


def test_stored_copies_come_from_one_pass(spark, sf_dir):
    """load_sync reads lines once for its source and once for the stored side."""
    assert _leaves(spark, sf_dir, "load_sync").count("l_linenumber") == 2


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_storing_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = session.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20  # files are removed in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert rows.count() == 7


def test_key_slices_hold_every_row_once(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4)] + [
        (f"k{i}", i) for i in range(100)], "id string, n int")
    slices = session.key_slices(rows, ["id"], 4)
    found = [[tuple(r) for r in s.collect()] for s in slices]
    assert sorted(sum(found, []), key=repr) == sorted((tuple(r) for r in rows.collect()), key=repr)
    keys = [{k for k, _ in rows} for rows in found]
    assert sum(map(len, keys)) == len(set.union(*keys)) and all(keys)


@pytest.mark.parametrize("name", ["load_upsert", "load_incremental"])
def test_loads_in_slices(spark, sf_dir, name, monkeypatch):
    """Slices of the keys, one stored after the other, give the rows of one load."""
    whole = sorted(map(repr, QUERIES[name](spark, sf_dir).collect()))
    monkeypatch.setattr(session, "SLICE_BYTES", 50_000)
    counts, write = [], loading.stored
    monkeypatch.setattr(loading, "stored", lambda *parts: (counts.append(len(parts)), write(*parts))[1])
    cut = QUERIES[name](spark, sf_dir)
    assert counts == [session.MOST_SLICES] * 3
    assert sorted(map(repr, cut.collect())) == whole
