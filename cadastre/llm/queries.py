"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadastre.llm import (bm25_packing, crf_language, decision_list, direct_codes, factorization,
                          license_digest, role_repair, rule_ensemble, shared, target_draw, tree_forest,
                          two_tier_bpe, url_filter, vertical_join)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WORD_VOCABULARY = "word_bpe_49k.json"
WORD_VOCABULARY_SIZE = 49408
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return wrap


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shared.work_folder(spark)  # hands the package to the executors
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_direct_codes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    files = direct_codes.write_token_files(docs, public_tokenizers.path(WORD_VOCABULARY),
                                           shared.new_folder(spark, "op3"))
    return direct_codes.read_token_files(files)


@query("op6_two_tier_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_tier_bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS),
                                public_tokenizers.PATTERN)


@query("op2_bm25_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY),
                             WORD_VOCABULARY_SIZE)


@query("op8_vertical_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertical_join.similar_texts(read(spark, sf_dir, "documents"))


@query("op7_tree_forest")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_forest.near_vectors(read(spark, sf_dir, "embeddings"))


@query("op4_decision_list")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return decision_list.judge(docs, decision_list.learn_from(docs, read(spark, sf_dir, "labels")))


@query("op9_rule_ensemble")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return rule_ensemble.score_texts(docs, rule_ensemble.learn_from(docs, read(spark, sf_dir, "labels")))


@query("op10_factorization")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return factorization.score_texts(docs, factorization.learn_from(docs, read(spark, sf_dir, "labels")))


@query("op1_crf_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return crf_language.label_texts(docs, crf_language.learn_from(docs))


@query("op5_license_digest", license_digest.oracle_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(read(spark, sf_dir, "documents"))


@query("op11_target_draw")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_draw.draw(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_role_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.damage_and_mend(read(spark, sf_dir, "conversations"))


@query("op13_url_filter", url_filter.oracle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
