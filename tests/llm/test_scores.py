"""Scores written out by hand, words of scripts without spaces, and repeated rows of one document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastre.llm import (bm25_packing, crf_language, decision_list, direct_codes, factorization, license_digest,
                          rule_ensemble, shared, text_stats, two_tier_bpe, vertical_join)
from test_llm_operators import RANKS, WORDS, all_texts, prose

TWICE = [(1, prose(60, 1)), (1, prose(60, 1)), (1, prose(60, 2)), (2, None), (2, None), (None, prose(60, 1)), (None, ""), (None, "")]


@pytest.fixture(scope="module")
def twice(spark):
    shared.work_folder(spark)
    rows = [(k, t, "en", "s", n) for n, (k, t) in enumerate(TWICE)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score long").repartition(3)


def places_of(spark, text, bits=20):
    import pyarrow as pa
    return set(factorization._places(pa.RecordBatch.from_arrays([pa.array([text])], names=["text"]), bits)[0].tolist())


def test_pair_sum_written_out(spark):
    rng = np.random.default_rng(1)
    texts = [t or "" for _, t in all_texts()] + ["Beta alpha beta", "alpha", "gamma Alpha BETA gamma delta"]
    terms = np.array(sorted(set().union(*(places_of(spark, t) for t in texts[-3:]))))
    model = factorization.Machine(terms, -0.4, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 3)), 20)
    shared.work_folder(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in factorization.score_texts(docs, model).collect()}
    for k, text in enumerate(texts):
        there = [i for i, t in enumerate(terms.tolist()) if t in places_of(spark, text)]
        total = -0.4 + sum(model.weights[i] for i in there) + sum(
            model.factors[i] @ model.factors[j] for i in there for j in there if i < j)
        assert got[k] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)


def test_terms_of_scripts_without_spaces(spark):
    insult, text = places_of(spark, "白痴"), places_of(spark, "你真是白痴，滚开。大家好")
    assert len(insult) == 3 and insult <= text  # two letters and their pair
    assert not places_of(spark, "，。…")
    assert places_of(spark, "ÄRGER Naïve") == places_of(spark, "ärger naïve") and len(places_of(spark, "Ärger naïve")) == 2
    assert len(places_of(spark, "toxic words here")) == 3


def test_insult_in_chinese_is_learned(spark):
    shared.work_folder(spark)
    plain, bad = "今天天气很好我们去公园走走看看花", "你真是白痴"
    rows = [(k, plain[k % 7:k % 7 + 6] + (bad if k % 4 == 0 else plain[k % 5:k % 5 + 4]) + "。") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(600)], "doc_id long, toxic int")
    model = factorization.learn_from(docs, labels)
    out = factorization.score_texts(docs, model).where("held_out").collect()
    assert len(out) > 50 and all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in out)


def test_rules_in_numpy(spark, sf_dir):
    shared.work_folder(spark)
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = rule_ensemble.learn_from(docs, labels)
    rows = text_stats.add_features(docs.select("doc_id", "text")).withColumn("score", model.score()).collect()
    x = np.array([[r[f] for f in text_stats.FEATURES] for r in rows], float)
    total = np.full(len(x), model.intercept)
    for path, weight in zip(model.rules, model.weights):
        for i, row in enumerate(x):
            total[i] += weight * all((row[f] > edge) if above else (row[f] <= edge) for f, above, edge in path)
    assert model.rules and np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-total)), atol=1e-12)


def test_repeated_rows_of_one_document(spark, twice, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    by_text = [decision_list.judge(twice, decision_list.learn_from(docs, labels)),
               rule_ensemble.score_texts(twice, rule_ensemble.learn_from(docs, labels)),
               factorization.score_texts(twice, factorization.learn_from(docs, labels)),
               crf_language.label_texts(twice, crf_language.learn_from(docs)), license_digest.scan(twice),
               two_tier_bpe.digests(twice, RANKS, __import__("public_tokenizers").PATTERN)]
    for result in by_text:
        rows = [tuple(r) for r in result.collect()]
        assert sorted(repr(r[0]) for r in rows) == sorted(repr(k) for k, _ in TWICE)
        # equal rows have equal results
        assert len({repr(r) for r in rows if r[0] == 2}) == 1
    files = direct_codes.write_token_files(twice, WORDS, shared.new_folder(spark, "t"))
    assert direct_codes.read_token_files(files).count() == len(TWICE)
    pieces = bm25_packing.pack(twice, WORDS, 49408)
    assert pieces.where("start = 0").count() == len(TWICE)
    joined = vertical_join.similar_texts(twice).collect()
    assert len(joined) == len(TWICE) and {r["component_id"] for r in joined if r["doc_id"] == 1} == {1}


def test_languages_of_nothing(spark, sf_dir):
    field = crf_language.learn_from(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert crf_language.label_texts(empty, field).count() == 0
    assert crf_language.label_texts(empty, crf_language.learn_from(empty)).count() == 0
