"""From raw documents to packed training sequences.

Toxic documents go, then those of low quality, then all but one of each group of near copies;
what is left is packed.  Each stage is written as Parquet in the shared folder and read again.

Edge cases: null and empty texts are scored like any other text (as the operators state), link
with nothing and are packed as an end id; rows of one doc_id, or of none, are each judged by their
own text, and of a group of copies the row of smallest doc_id stays (null ids last; of several rows of
that id the first in the table), so of equal rows one stays unless their text has no word; empty
tables give no row; columns that documents has beyond doc_id and text are carried along whatever their
names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm import bm25_packing, factorization, rule_ensemble, shared, text_stats, vertical_join
from cadastre.llm.queries import WORD_VOCABULARY, WORD_VOCABULARY_SIZE, read

ROW, SCORE, NUMBER = "_document_row", "_score", "_document_number"


def _rows_where(scored: DataFrame, condition: Column) -> DataFrame:
    """The documents for which the condition holds.

    A filter would be pushed below the statistics, which repeats each of them at every mention.
    """
    return scored.select(F.inline(F.when(condition, F.array(ROW))))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose toxicity is below 0.3."""
    model = factorization.learn_from(docs, read(spark, sf_dir, "labels"))
    scored = docs.select(F.struct("*").alias(ROW),
                         factorization.score_column(spark, model, F.col("text")).alias(SCORE))
    return _rows_where(scored, F.col(SCORE) < 0.3)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality is at least 0.7."""
    model = rule_ensemble.learn_from(docs, read(spark, sf_dir, "labels"))
    scored = text_stats.add_features(docs.select(F.struct("*").alias(ROW), F.col("text").cast("string")))
    return _rows_where(scored, model.score() >= 0.7)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group linked by five-word shingles, Jaccard 0.8 or more.

    Ids may repeat or be null, so links run between numbers of rows, which are stored with them: a task
    that is run again cannot give others.  Who stays is found on narrow rows; groups are combined before
    they are shuffled.
    """
    shared.work_folder(spark)
    rows = shared.stored(docs.select(F.monotonically_increasing_id().alias(NUMBER), F.struct("*").alias(ROW)), "numbered")
    found = shared.stored(vertical_join.similar_texts(
        rows.select(NUMBER, F.col(f"{ROW}.text").alias("text")), key=NUMBER, size=5, percent=80)
        .select(NUMBER, "component_id"), "components")
    ids = rows.select(NUMBER, F.col(f"{ROW}.doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", NUMBER))[NUMBER]
    groups = (found.join(ids, NUMBER).groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n"))
              .where("n > 1"))
    dropped = found.join(groups, "component_id").where(F.col(NUMBER) != F.col("first")).select(NUMBER)
    return rows.join(shared.small_if_counted(dropped, "dropped"), NUMBER, "left_anti").select(f"{ROW}.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    shared.work_folder(spark)
    return bm25_packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY), WORD_VOCABULARY_SIZE)


STAGES = [("toxicity", drop_toxic), ("quality_classifier", keep_good),
          ("ngram_jaccard_join", keep_one_of_copies), ("packing", pack)]

#: trained scores and packing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name)
    return docs
