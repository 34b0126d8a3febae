"""Operators on small frames against brute force or stated results."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cadastre.operators import chain, clean, dedup, features, match, merge, metrics, profile
from cadastre.operators import quantiles as q
from cadastre.operators import registry, rows
from cadastre.sources.flatten import flatten
from cadastre.sources.tables import align, role_map, schema_differences, union_pages
from conftest import rows_of

RAW = ("id string, ciudad string, tipo string, area_m2 string, alcobas string, banos string, "
       "precio_cop string, lat string, lon string, fecha string, estado string, _loaded_at timestamp")


def raw_row(id="p-1", ciudad="Bogotá", tipo=" casa", area="72.5", alcobas="3", banos=" 2 ",
            precio="250000000.0", lat="4.65", lon="-74.05", fecha="2024-03-05", estado=" VENDIDA",
            day=1):
    return (id, ciudad, tipo, area, alcobas, banos, precio, lat, lon, fecha, estado,
            dt.datetime(2024, 1, day))


# --- cleaning ---------------------------------------------------------------
def test_clean_row(spark):
    row = clean.clean_transactions(spark.createDataFrame([raw_row()], RAW)).first()
    assert tuple(row) == ("p-1", "Bogota", "Casa", 72.5, 3, 2, 250000000, 4.65, -74.05,
                          dt.date(2024, 3, 5), "vendida")


def test_latest_priced_row_is_kept(spark):
    frame = spark.createDataFrame([
        raw_row(precio="1", day=1), raw_row(precio="2", day=3), raw_row(precio=" ", day=9),
        raw_row(id="p-2", precio="n/a"), raw_row(id="p-3", precio=None)], RAW)
    assert rows_of(clean.clean_transactions(frame), "id", "precio_cop") == [
        ("p-1", 2), ("p-2", None)]


def test_dedup_does_not_depend_on_order(spark):
    data = [raw_row(id=f"p-{i % 5}", precio=str(random.Random(i).randint(1, 9)), day=1 + i % 3)
            for i in range(60)]
    shuffled = data[:]
    random.Random(7).shuffle(shuffled)
    first = rows_of(clean.dedup_transactions(spark.createDataFrame(data, RAW).repartition(1)))
    second = rows_of(clean.dedup_transactions(spark.createDataFrame(shuffled, RAW).repartition(6)))
    assert first == second and len(first) == 5


def test_dedup_first_and_null_order(spark):
    frame = spark.createDataFrame([(1, 2, None), (1, 1, None), (1, 1, 5), (2, None, 1)],
                                  "k int, t int, v int")
    assert rows_of(dedup.keep_one(frame, ["k"], "t", ["v"], latest=False)) == [
        (1, 1, 5), (2, None, 1)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS id", "id AS t")
    plan = dedup.keep_one(frame, ["id"], "t", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_clean_is_idempotent_on_clean_text(spark):
    once = clean.clean_transactions(spark.createDataFrame([raw_row(), raw_row(id="x")], RAW))
    again = clean.clean_transactions(once.select(
        *[F.col(c).cast("string") for c in once.columns], F.current_timestamp().alias("_loaded_at")))
    assert rows_of(once) == rows_of(again)


# --- features ---------------------------------------------------------------
def test_features(spark):
    staging = clean.clean_transactions(spark.createDataFrame([
        raw_row(), raw_row(id="cheap", precio="9999999"), raw_row(id="none", precio="x"),
        raw_row(id="studio", alcobas="0", area="")], RAW))
    got = {r["propiedad_id"]: r for r in features.build_features(staging).collect()}
    assert set(got) == {"p-1", "studio"}
    assert got["p-1"]["precio_por_m2"] == 250000000 / 72.5
    assert (got["p-1"]["anio"], got["p-1"]["dia_semana"]) == (2024, 3)
    assert got["studio"]["banos_por_alcoba"] is None and got["studio"]["precio_por_m2"] is None


def test_splits_partition_the_features(spark):
    staging = clean.clean_transactions(spark.createDataFrame(
        [raw_row(id=f"p-{i}") for i in range(200)], RAW))
    built = features.build_features(staging)
    train, test = (features.split_rows(built, s) for s in ("train", "test"))
    ids = [{r[0] for r in f.select("propiedad_id").collect()} for f in (train, test)]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 200
    assert "split" not in train.columns


# --- merge ------------------------------------------------------------------
SCHEMA = "id string, v int, at int"


def frames(spark, target, source):
    return (spark.createDataFrame(source, "id string, v int"),
            spark.createDataFrame(target, SCHEMA), {"at": F.lit(9)})


def test_upsert_keeps_stored_defaults(spark):
    source, target, stamp = frames(spark, [("a", 1, 1), ("b", 2, 1), (None, 7, 1)],
                                   [("b", 20), ("c", 30), (None, 40)])
    got = merge.upsert_load(source, target, ["id"], stamp)
    assert rows_of(got, "id", "v", "at", "_action") == sorted([
        ("a", 1, 1, "keep"), ("b", 20, 1, "update"), ("c", 30, 9, "insert"),
        (None, 7, 1, "keep"), (None, 40, 9, "insert")], key=repr)


def test_upsert_can_set_null(spark):
    source, target, stamp = frames(spark, [("a", 1, 1)], [("a", None)])
    assert rows_of(merge.upsert_load(source, target, ["id"], stamp), "id", "v", "at") == [
        ("a", None, 1)]


def test_incremental_inserts_every_copy_of_a_new_key(spark):
    source, target, stamp = frames(spark, [("a", 1, 1)], [("a", 5), ("n", 1), ("n", 1)])
    assert rows_of(merge.incremental_load(source, target, ["id"], stamp), "id", "v", "at") == [
        ("n", 1, 9), ("n", 1, 9)]


def test_sync_deletes_and_keeps_first_stamp(spark):
    source, target, stamp = frames(spark, [("a", 1, 1), ("b", 2, 2)], [("b", 20), ("c", 30)])
    assert rows_of(merge.sync_load(source, target, ["id"], stamp), "id", "v", "at", "_action") == [
        ("b", 20, 2, "update"), ("c", 30, 9, "insert")]
    touched = merge.sync_load(source, target, ["id"], stamp, touch=True)
    assert rows_of(touched, "id", "at") == [("b", 9), ("c", 9)]
    assert rows_of(merge.missing_rows(source, target, ["id"]), "id") == [("a",)]


def test_classification_counts_both_sides(spark):
    source, target, _ = frames(spark, [("a", 1, 1), ("b", 2, 2), ("b", 3, 2), (None, 1, 1)],
                               [("b", 20), ("c", 30), (None, 1)])
    assert rows_of(merge.classify_keys(source, target, ["id"])) == sorted([
        ("a", 0, 1, "delete"), ("b", 1, 2, "update"), ("c", 1, 0, "insert"),
        (None, 0, 1, "delete"), (None, 1, 0, "insert")], key=repr)


def test_repeated_source_key_is_found_only_when_stored(spark):
    source, target, _ = frames(spark, [("a", 1, 1)], [("a", 1), ("a", 2), ("n", 1), ("n", 2)])
    assert rows_of(merge.repeated_source_keys(source, target, ["id"]), "id") == [("a",)]


def test_small_batch_leaves_the_stored_table_unshuffled(spark, tmp_path):
    target = spark.range(1000).selectExpr("cast(id as string) id", "1 v", "1 at")
    spark.createDataFrame([("1", 2)], "id string, v int").write.parquet(str(tmp_path / "batch"))
    source = spark.read.parquet(str(tmp_path / "batch"))
    got = merge.upsert_load(source, target, ["id"], {"at": F.lit(1)})
    plan = got._jdf.queryExecution().executedPlan().toString()
    kept, added = plan.split("Union")[1].split("LeftAnti")
    assert "BroadcastHashJoin" in kept and "Exchange hashpartitioning" not in kept
    # of the stored keys only those that the batch has are shuffled
    assert "LeftSemi" in added.split("Exchange hashpartitioning")[1]


# --- quantiles and profiles -------------------------------------------------
def linear(values, p):
    values = sorted(values)
    position = p * (len(values) - 1)
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


@pytest.mark.parametrize("shape", ["uniform", "tail", "narrow", "few", "one", "signed"])
def test_quantiles_are_exact(spark, shape):
    rng = random.Random(3)
    values = {
        "uniform": [rng.uniform(0, 1) for _ in range(997)],
        "tail": [rng.paretovariate(0.6) for _ in range(1000)],
        "narrow": [4.6 + rng.random() * 1e-6 for _ in range(500)],
        "few": [float(rng.choice([1, 2, 2, 2, 50])) for _ in range(400)],
        "one": [7.0],
        "signed": [rng.gauss(0, 1) * 10 ** rng.randint(-8, 8) for _ in range(800)],
    }[shape]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r["p"]: r["value"] for r in q.quantiles(frame, ["x"], points).collect()}
    assert set(got) == set(points)
    for p in points:
        assert got[p] == pytest.approx(linear(values, p), rel=1e-12, abs=1e-300)


def test_quantiles_by_group_and_column(spark):
    rng = random.Random(5)
    data = [(rng.choice("ab"), rng.random(), rng.randint(0, 9)) for _ in range(500)] + [(None, 1., 1)]
    frame = spark.createDataFrame(data, "g string, x double, y int")
    got = {(r["g"], r["metric"]): r["value"]
           for r in q.quantiles(frame, ["x", "y"], [0.5], by=["g"]).collect()}
    assert set(got) == {(g, m) for g in "ab" for m in "xy"}
    for g in "ab":
        for i, m in ((1, "x"), (2, "y")):
            assert got[g, m] == pytest.approx(statistics.median(r[i] for r in data if r[0] == g))


def test_describe(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = profile.describe_numeric(frame, ["x"]).first()
    assert (row["n"], row["mean"], row["min"], row["q50"], row["max"]) == (4, 4.0, 1.0, 2.5, 10.0)
    assert row["std"] == pytest.approx(statistics.stdev([1, 2, 3, 10]))


def test_describe_of_an_empty_column(spark):
    frame = spark.createDataFrame([(None,)], "x double")
    row = profile.describe_numeric(frame, ["x"]).first()
    assert row["n"] == 0 and row["q50"] is None


def test_outliers(spark):
    values = [float(v) for v in list(range(20)) + [1000, -1000, 1000]]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    row = profile.iqr_outliers(frame, ["x"]).first()
    low = linear(values, .25) - 1.5 * (linear(values, .75) - linear(values, .25))
    assert row["low"] == pytest.approx(low)
    assert (row["outliers"], row["min"], row["max"]) == (3, -1000.0, 1000.0)


def test_gaps(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, h),) for d, h in ((1, 1), (1, 5), (2, 1), (5, 1))], "t timestamp")
    assert rows_of(profile.gap_distribution(frame, "t")) == [(1, 1), (3, 1)]


def test_cast_failures_ignore_blanks(spark):
    frame = spark.createDataFrame([("1",), ("x",), ("",), (None,)], "v string")
    assert rows_of(profile.cast_failures(frame, ["v"])) == [("v", 1)]


def test_year_outside(spark):
    frame = spark.createDataFrame([("2024-01-01",), ("0204-01-01",), (None,)], "d string")
    assert rows_of(profile.outside_year(frame, "d", "2024")) == [("0204-01-01",), (None,)]


def test_profile_reports(spark):
    frame = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", None)], "c string, x double")
    reports = profile.profile(frame, ["x"], ["c"])
    assert rows_of(reports["nulls"], "column", "nulls") == [("c", 0), ("x", 1)]
    assert rows_of(reports["values"], "value", "n") == [("a", 2), ("b", 1)]


# --- chains and names -------------------------------------------------------
def walk(start, links):
    seen, page = [], start
    while page and page not in seen:
        seen.append(page)
        page = links.get(page)
    return seen


@pytest.mark.parametrize("links", [
    {"a": "b", "b": "c", "c": None},
    {"a": "b", "b": "a"},
    {"a": "b", "b": "c", "c": "d", "d": "b"},
    {"a": "a"},
    {f"p{i}": f"p{i + 1}" for i in range(150)} | {"p150": None, "a": "p0"},
])
def test_chain_follows_links_once(spark, links):
    starts = spark.createDataFrame([("a",)], "start string")
    edges = spark.createDataFrame(list(links.items()), "page string, next string")
    rows_ = chain.follow_links(starts, edges).orderBy("position").collect()
    assert [r["page"] for r in rows_] == walk("a", links)
    assert [r["position"] for r in rows_] == list(range(len(rows_)))


def test_names_match_like_a_nested_loop(spark):
    from unicodedata import normalize

    def fold(s):
        return "".join(c for c in normalize("NFD", s.lower()) if not "̀" <= c <= "ͯ").strip()

    cities = ["Bogota", "Cali", "Medellin", "Santa Marta", "Santiago", "X"]
    names = ["Santiago de CALÍ", "marta", "bogotá d.c.", "Quito", "MEDELLÍN", "xx", " ", "a", None, ""]
    want = {}
    for n in names:
        if n:
            hit = next((c for c in sorted(cities) if fold(c) in fold(n) or fold(n) in fold(c)), None)
            if hit:
                want[n] = hit
    got = match.match_names(spark.createDataFrame([(n,) for n in names], "name string"),
                            spark.createDataFrame([(c,) for c in cities], "city string"))
    assert {r["name"]: r["city"] for r in got.collect()} == want


def test_first_candidate_wins(spark):
    places = spark.createDataFrame([(1, None, "Cali"), (2, "Bogotá", "Cali"), (3, "Quito", "Lima")],
                                   "k int, town string, county string")
    cities = spark.createDataFrame([("Bogota",), ("Cali",)], "city string")
    assert rows_of(match.match_places(places, "k", ["town", "county"], cities)) == [
        (1, "Cali"), (2, "Bogota"), (3, None)]


# --- metrics, folds, registry -----------------------------------------------
def test_metrics_match_their_definitions(spark):
    pairs = [(100.0, 90.0), (200.0, 230.0), (400.0, 380.0), (10.0, 40.0)]
    row = metrics.regression_metrics(
        spark.createDataFrame(pairs, "y double, p double"), "y", "p", minimum=100).first()
    errors = [y - p for y, p in pairs]
    mean = sum(y for y, _ in pairs) / 4
    assert row["MAE"] == pytest.approx(sum(map(abs, errors)) / 4)
    assert row["RMSE"] == pytest.approx((sum(e * e for e in errors) / 4) ** 0.5)
    assert row["R2"] == pytest.approx(
        1 - sum(e * e for e in errors) / sum((y - mean) ** 2 for y, _ in pairs))
    assert row["MAPE"] == pytest.approx(100 * (0.1 + 0.15 + 0.05) / 3)


@pytest.mark.parametrize("pairs, r2", [([(5.0, 5.0)] * 3, 1.0), ([(5.0, 6.0)] * 3, 0.0)])
def test_constant_truth(spark, pairs, r2):
    row = metrics.regression_metrics(
        spark.createDataFrame(pairs, "y double, p double"), "y", "p", minimum=99).first()
    assert row["R2"] == r2 and row["MAPE"] != row["MAPE"]


def test_folds_are_stable_and_cover_all(spark):
    frame = spark.range(1000).selectExpr("concat('p', id) AS id")
    one = rows_of(metrics.assign_fold(frame.repartition(1), "id"))
    assert one == rows_of(metrics.assign_fold(frame.repartition(5), "id"))
    assert {f for _, f in one} == set(range(5))


def test_hash_sample_is_reproducible(spark):
    frame = spark.range(500).selectExpr("cast(id as string) id")
    first = rows_of(metrics.hash_sample(frame.repartition(1), "id", 10))
    assert first == rows_of(metrics.hash_sample(frame.repartition(7), "id", 10)) and len(first) == 10


VERSIONS = "version long, run_id string, registry string, stage string"
RUNS = "run_id string, params map<string,string>, metrics map<string,double>"


def registry_frames(spark):
    versions = spark.createDataFrame([
        (1, "r1", "g", "None"), (2, "r2", "g", "Production"), (3, "r3", "g", "None"),
        (4, "r4", "g", "None"), (5, "gone", "g", "None")], VERSIONS)
    runs = spark.createDataFrame([
        ("r1", {"modelo": "a", "uri": "u1"}, {"test_R2": 0.7}),
        ("r2", {"modelo": "a", "uri": "u2"}, {"test_R2": 0.7}),
        ("r3", {"modelo": "b", "uri": "u3"}, {}),
        ("r4", {"modelo": "c"}, {"test_R2": 0.99})], RUNS)
    return versions, runs


def test_served_models(spark):
    joined = registry.versions_with_runs(*registry_frames(spark))
    assert rows_of(registry.best_versions(joined), "modelo", "version", "r2") == [
        ("a", 1, 0.7), ("b", 3, 0.0)]
    assert rows_of(registry.top_models(joined, 1), "modelo") == [("a",)]


def test_promotion_archives_the_old_version(spark):
    versions, runs = registry_frames(spark)
    got = registry.promoted_stages(versions, runs, "b", "g")
    assert dict(rows_of(got, "version", "stage")) == {
        1: "None", 2: "Archived", 3: "Production", 4: "None", 5: "None"}
    unknown = registry.promoted_stages(versions, runs, "zzz", "g")
    assert dict(rows_of(unknown, "version", "stage"))[5] == "Production"


# --- rows, shapes -----------------------------------------------------------
def test_row_rules(spark):
    frame = spark.createDataFrame([
        ("m", "c", "t", "50", "2", "1", "4.6", "-74"),
        ("m", "", "t", "0", "2.5", "21", "99", "x"),
        ("m", "c", None, "", "0", "0", "-4.3", "-66.8")],
        "modelo string, ciudad string, tipo string, area_m2 string, alcobas string, banos string, "
        "lat string, lon string")
    checked = rows.check_rows(frame)
    got = [r["errors"] for r in checked.orderBy(F.size("errors")).collect()]
    assert got[0] == []
    assert got[1] == ["tipo: required", "area_m2: required"]
    assert got[2] == ["ciudad: required", "area_m2: outside (0, 10000]",
                      "alcobas: not a whole number", "banos: outside [0, 20]",
                      "lat: outside [-4.3, 13.0]", "lon: not a number"]
    assert rows.usable_rows(checked).count() == 1 and rows.quarantined_rows(checked).count() == 2


def test_flatten(spark):
    frame = spark.sql("""SELECT named_struct('b', 1, 'c', named_struct('d', true)) AS a,
        array(1, 2) AS l, 'late' AS a_b, CAST(NULL AS INT) AS n""")
    assert flatten(frame).first().asDict() == {
        "a_b": "late", "a_c_d": "True", "l": "[1,2]", "n": None}


def test_align_and_union(spark):
    from pyspark.sql.types import StructType
    frame = spark.createDataFrame([(1, "x")], "a int, extra string")
    got = align(frame, StructType.fromDDL("a string, missing double"))
    assert got.dtypes == [("a", "string"), ("missing", "double")] and got.first()[0] == "1"
    other = spark.createDataFrame([("y",)], "extra string")
    assert rows_of(union_pages([frame, other])) == [(1, "x"), (None, "y")]


def test_role_map_takes_the_last(spark):
    frame = spark.createDataFrame(
        [("features", "old", 1), ("FEATURES", "new", 2), ("train", "t", 3), ("", "x", 4), (None, "y", 5)],
        "rol_tabla string, tabla_consumption string, orden_carga int")
    assert rows_of(role_map(frame)) == [("FEATURES", "new"), ("TRAIN", "t")]


def test_schema_differences(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1.0, 2)], "x double, z int")
    assert schema_differences(a, b) == {
        "missing_in_test": ["y"], "missing_in_train": ["z"], "types": ["x"]}
