"""Draw of documents by their likeness to a target text collection.

1. Features of a text are its words and pairs of neighbouring words, each known by its CRC-32 modulo
   ``BUCKETS``.  One pass over the texts stores every document's buckets (two bytes a feature) and
   sums the buckets per task; only sums of ``BUCKETS`` places come to the driver.
2. A bucket's gain is the logarithm of its share in the target over its share in the documents.  The
   gains are one array of ``BUCKETS`` numbers, and a document's weight is their mean at its buckets.
3. The score is the weight plus Gumbel noise from a hash of the key, so the highest scores are a
   weighted draw without replacement.
4. The cutoff: a quantile sketch of the scores brackets it, the rows above and inside the bracket are
   counted exactly, the bracket is widened until the count proves that it holds the cutoff, and only
   the scores inside are sorted.  Ranks are the number of higher scores and the place among equal
   ones, so no task orders all drawn rows.

Edge cases: a null or word-free text has no feature and weight 0, and too few words to be drawn; a
null key takes part with the empty text as key and goes last among equal scores; repeated rows are
documents of their own (rows equal in everything share one place order, whichever comes first);
an empty target gives every bucket the same count of 0; an empty table gives no row; other columns
are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastre.llm import shared, words

BUCKETS = 10_000

#: ASCII letters and digits, and every byte of a character beyond ASCII
_INSIDE = words.LETTERS.copy()
_INSIDE[ord("0"):ord("9") + 1] = True
#: longer words are left to zlib one by one
_SHORT = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc_on(register: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC[(register ^ byte) & np.uint32(255)] ^ (register >> np.uint32(8))


def crc_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes, going on from the CRC-32 of what stands before it."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    ordered, at = sizes[order], starts[order]
    register = ~before[order].astype(np.uint32)
    long = int(np.searchsorted(-ordered, -_SHORT, "left"))  # runs of more than _SHORT bytes
    for k in range(min(int(ordered[0]) if len(ordered) else 0, _SHORT)):
        some = slice(long, int(np.searchsorted(-ordered, -k, "left")))
        register[some] = _crc_on(register[some], data[at[some] + k])
    out = np.empty(len(sizes), np.uint32)
    out[order] = ~register
    for i in order[:long].tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]], int(before[i]))
    return out


def features_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, buckets of all features, and where each text's begin (one entry more)."""
    data, offsets = words.text_bytes(column)
    data = words.LOWER[data]
    starts, ends, firsts = words.find_words(data, offsets, _INSIDE)
    count = np.diff(firsts)
    one = crc_of(data, starts, ends, np.zeros(len(starts), np.uint32))
    # pairs: every word but the last of its text, and the next one
    left = np.ones(len(starts), bool)
    left[firsts[1:][count > 0] - 1] = False
    left = np.flatnonzero(left)
    blank = ~_crc_on(~one[left], np.full(len(left), 32, np.uint8))
    two = crc_of(data, starts[left + 1], ends[left + 1], blank)
    bounds = np.concatenate([[0], np.cumsum(count + np.maximum(count - 1, 0))])
    out = np.empty(bounds[-1], np.uint16)
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(starts)) - firsts[:-1][owner]
    out[bounds[:-1][owner] + inside] = one % BUCKETS
    out[(bounds[:-1] + count)[owner[left]] + inside[left]] = two % BUCKETS
    return count, out, bounds


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text with its buckets; at the end of a task one row per bucket with its count."""
    total = np.zeros(BUCKETS, np.int64)
    names = ["key", "n_words", "n_features", "buckets", "bucket", "n"]
    for block in shared.blocks(batches, "text"):
        count, found, bounds = features_of(block.column("text"))
        total += np.bincount(found, minlength=BUCKETS)
        raw = [found[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        none = pa.nulls(len(raw), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [block.column("key"), pa.array(count, pa.int64()), pa.array(np.diff(bounds), pa.int64()),
             pa.array(raw, pa.binary()), none, none], names=names)
    used = np.flatnonzero(total)
    if len(used):
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.nulls(len(used), pa.binary()), pa.array(used, pa.int64()),
             pa.array(total[used], pa.int64())], names=names)


def measure(texts: DataFrame) -> DataFrame:
    """Features of ``key, text``: rows of texts (bucket is null) and rows of counts."""
    return texts.mapInArrow(
        _measure, "key long, n_words long, n_features long, buckets binary, bucket long, n long")


def counts_of(measured: DataFrame) -> np.ndarray:
    """Features in each bucket: at most ``BUCKETS`` rows come to the driver."""
    total = np.zeros(BUCKETS, np.int64)
    for row in measured.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains_of(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, floored."""
    all_docs, all_target = float(docs.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(
        (t + 1.0) * (all_docs + BUCKETS) / ((s + 1.0) * (all_target + BUCKETS))))
        for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def weigh(measured: DataFrame, gains: np.ndarray) -> DataFrame:
    """key, n_words, n_features and weight of every text."""
    table = measured.sparkSession.sparkContext.broadcast(gains)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_features").to_numpy(zero_copy_only=False)
            raw = batch.column("buckets").to_pylist()
            sums = np.array([int(table.value[np.frombuffer(b, np.uint16)].sum()) for b in raw], np.int64)
            weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_words"), batch.column("n_features"),
                 pa.array(weight, pa.int64())], names=["key", "n_words", "n_features", "weight"])

    return (measured.where("bucket is null").select("key", "n_words", "n_features", "buckets")
            .mapInArrow(run, "key long, n_words long, n_features long, weight long"))


def add_score(weighed: DataFrame, seed: int) -> DataFrame:
    """Weight plus Gumbel noise in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


def cutoff(scores: DataFrame, rows: int, percent: int, accuracy: int) -> int | None:
    """The least score among the ``rows`` highest; None where no row is drawn.

    ``percent`` says where the sketch looks first; the counts decide.
    """
    if not rows:
        return None
    wide, middle = 2 / accuracy, 1 - percent / 100
    while True:
        low, high = max(0.0, middle - wide), min(1.0, middle + wide)
        a, z = scores.agg(F.percentile_approx("score", [low, high], accuracy)).first()[0]
        if low == 0.0:
            a = None  # a sketch's least value need not be the least
        if high == 1.0:
            z = None
        below = F.lit(True) if z is None else F.col("score") <= z
        inside = below if a is None else below & (F.col("score") >= a)
        above, held = scores.agg(F.count_if(~below), F.count_if(inside)).first()
        if above < rows <= above + held:
            break
        wide *= 8
    # scores are whole thousandths, so the bracket holds few different ones
    up_to = F.sum("n").over(Window.orderBy(F.desc("score")))
    return (scores.where(inside).groupBy("score").agg(F.count("*").alias("n"))
            .withColumn("up_to", up_to + above).where(F.col("up_to") >= rows)
            .agg(F.max("score")).first()[0])


def draw(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text",
         target_text: str = "text", least_words: int = 20, percent: int = 25, seed: int = 7,
         accuracy: int = 10_000) -> DataFrame:
    """Per row: key, n_features, weight, score, rank (1, 2, .. among the drawn, else null).

    ``accuracy`` is that of the sketch; the result does not depend on it.
    """
    def texts(df: DataFrame, name: str, column: str | None) -> DataFrame:
        own = F.col(column).cast("long") if column else F.lit(None).cast("long")
        return df.select(own.alias("key"), F.col(name).cast("string").alias("text"))

    measured = shared.stored(measure(texts(docs, text, key)), "features")
    gains = gains_of(counts_of(measured), counts_of(measure(texts(target, target_text, None))))
    scored = shared.stored(add_score(weigh(measured, gains), seed), "scored")
    fit = F.col("n_words") >= least_words
    eligible = scored.where(fit)
    rows = percent * eligible.count() // 100
    least = cutoff(eligible.select("score"), rows, percent, accuracy)
    out = [F.col("key").alias(key), "n_features", "weight", "score"]
    if least is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    high = fit & (F.col("score") >= least)
    # one row per score, and scores are whole thousandths of logarithms: tens of thousands at most
    higher = (scored.where(high).groupBy("score").agg(F.count("*").alias("n"))
              .select(F.col("score").alias("_score"), (F.sum("n").over(
                  Window.orderBy(F.desc("score"))) - F.col("n")).alias("_higher")))
    among = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("key"))).cast("long")
    place = F.col("_higher") + F.col("_among")
    drawn = (scored.where(high).withColumn("_among", among).join(higher, F.col("score") == F.col("_score"))
             .select(*out, F.when(place <= rows, place).alias("rank")))
    return drawn.union(scored.where(~high).select(*out, F.lit(None).cast("long").alias("rank")))
