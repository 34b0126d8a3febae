"""The pipeline's stages on repeated and null ids, and against brute force."""

import itertools
import random

from pyspark.sql import functions as F

import corpus_pipeline
from cadastre.llm import factorization, rule_ensemble, shared, text_stats


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeghilnorst", k=rng.randint(2, 7))) for _ in range(n))


A, B, C = prose(60, 1), prose(60, 2), prose(60, 3)


def copies_of(spark, rows):
    df = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(rows)],
                               "doc_id long, text string, component_id int, _document_row string").repartition(3)
    kept = corpus_pipeline.keep_one_of_copies(spark, df, "")
    assert kept.columns == df.columns
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())


def test_copies_with_repeated_and_null_ids(spark):
    got = copies_of(spark, [(1, A), (1, A), (2, A), (2, B), (None, A), (None, A), (None, C), (None, C), (5, None), (5, ""),
                            (None, ""), (3, B + " more")])
    assert got == sorted([(False, 1, A), (False, 2, B), (True, 0, C), (False, 5, ""), (False, 5, ""), (True, 0, "")])


def test_copies_equal_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for g in range(12):
        words = prose(40 + 5 * g, 100 + g).split()
        for k in range(rng.randint(1, 6)):
            own = list(words)
            for at in rng.sample(range(len(own)), k):
                own[at] = f"x{g}{k}"
            rows.append((len(rows), " ".join(own)))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    expected = [(False, *rows[i]) for i in range(len(rows)) if find(i) == i]
    assert copies_of(spark, rows) == expected


def test_filters_keep_what_their_scores_say(spark, sf_dir):
    shared.work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.union(docs.limit(3)).union(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def texts(df):
        return sorted((repr(r["doc_id"]), r["text"] or "") for r in df.collect())

    toxic = factorization.score_texts(docs, factorization.learn_from(docs, labels)).where("predicted = 1")
    bad = {r["doc_id"] for r in toxic.where("doc_id is not null").select("doc_id").distinct().collect()}
    kept = shared.stored(corpus_pipeline.drop_toxic(spark, docs, sf_dir), "t")
    assert texts(kept.where("doc_id is not null")) == texts(docs.where(~F.col("doc_id").isin(sorted(bad)) if bad else F.lit(True))
                                                            .where("doc_id is not null"))
    model = rule_ensemble.learn_from(kept, labels)
    good = text_stats.add_features(kept).withColumn("s", model.score()).where("s >= 0.7")
    assert texts(corpus_pipeline.keep_good(spark, kept, sf_dir)) == texts(good)


def test_whole_pipeline_packs_every_kept_document_once(spark, sf_dir):
    shared.work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), "stage")
    pieces = corpus_pipeline.pack(spark, docs, sf_dir)
    counts = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r["n"] == r["all"] for r in counts)
    assert sorted(r["doc_id"] for r in counts) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_pipeline_of_nothing(spark, sf_dir):
    shared.work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), "stage")
        assert docs.count() == 0
