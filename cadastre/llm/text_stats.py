"""Statistics of whole texts as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACES = " \t\n\x0b\f\r"

#: shares and counts that learned rules put thresholds on
FEATURES = ("n_words", "mean_word", "symbol_share", "repeat_share", "dup_line_share", "upper_share",
            "mark_share", "digit_share")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def count_of(text: Column, symbols: str) -> Column:
    """Characters of a regular-expression class in the text."""
    return (F.length(text) - F.length(F.regexp_replace(text, symbols, ""))).cast("long")


def repeated_words(words: Column, window: int = 5) -> Column:
    """Words inside windows that occur twice or more, the first occurrence included."""
    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= window, F.transform(
            F.sequence(F.lit(0), F.size(w) - window),
            lambda i: F.xxhash64(*(w[i + k] for k in range(window))))).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, k: F.when(
            k + 1 < F.size(places), F.least(F.lit(window), places[k + 1] - p)).otherwise(window)),
            F.lit(0).cast("long"), lambda a, x: a + x)

    def repeats(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: let(
            F.sort_array(F.transform(
                F.filter(s, lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"]))
                         | ((k + 1 < F.size(s)) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == x["h"]))),
                lambda x: x["i"])), covered))

    return let(windows(words), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(repeats(h)))


def add_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and n_lines."""
    whole = F.coalesce(F.col(text), F.lit(""))
    with_words = docs.withColumn("_words", words_of(F.col(text))).withColumn(
        "_lines", F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_SPACES)) != ""))
    return with_words.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": count_of(whole, "[#*$%&|<>]"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }).drop("_words", "_lines")


def add_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The counts and the shares of FEATURES; 0 for a text without words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return add_counts(docs, text).withColumns({
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "repeat_share": F.col("n_repeat_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper_share": count_of(whole, "\\p{Lu}") / chars,
        "mark_share": count_of(whole, "[!?;:]") / chars,
        "digit_share": count_of(whole, "[0-9]") / chars,
    })


def held_out(key: Column) -> Column:
    """Rows that no label is learned from: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled, not held-out documents, picked by a hash of their key.

    Returns the documents' columns and ``label``; contradicting labels of one key leave it out.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
             .groupBy(key).agg(F.min(label).cast("int").alias("label"), F.max(label).alias("_other"))
             .where("label = _other").drop("_other")
             .orderBy(F.xxhash64(F.col(key).cast("long")), key).limit(rows))
    return docs.join(F.broadcast(known), key)  # at most `rows` small rows
