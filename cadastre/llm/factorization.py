"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of w_i + half of (|sum of v_i|^2 - sum of |v_i|^2)) over the distinct
terms of a text.  The factors give each pair of terms a weight of its own, so an insult beside the
mention of a group counts for more than the sum of both.  Terms are lower-cased letter runs, and in
scripts without spaces letters and pairs of neighbouring letters, hashed to 2^bits places.  Those in at least ``least`` labelled texts whose presence tells the classes apart
(G statistic of at least ``least_gain``) are learned, by AdaGrad on the driver over at most
``sample_rows`` texts.

Edge cases: a null, empty or letter-free text has the bias as its score; without labelled texts
of both classes the score is the share of label 1 (0 without labels); repeated rows score alike;
a null key is kept; an empty table gives no row; other columns of the table do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm import shared, words
from cadastre.llm.crf_language import find_units
from cadastre.llm.text_stats import held_out, labelled_sample

#: text cut into terms at a time: arrays of several numbers a byte are made of it
_BLOCK_BYTES = 1 << 20


@dataclass
class Machine:
    terms: np.ndarray      # learned places, ascending
    bias: float
    weights: np.ndarray    # one a term
    factors: np.ndarray    # terms x k
    bits: int

    def score(self, places: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts from (place, text) of each of their words."""
        total = np.full(n, self.bias)
        if len(self.terms) and len(places):
            at = np.minimum(np.searchsorted(self.terms, places), len(self.terms) - 1)
            known = self.terms[at] == places
            pairs = np.unique(owner[known].astype(np.int64) << 32 | at[known])
            text, term = pairs >> 32, pairs & 0xFFFFFFFF
            total += np.bincount(text, self.weights[term], n)
            for f in range(self.factors.shape[1]):
                v = self.factors[term, f]
                total += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _places(block: pa.RecordBatch, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed place of every word of the block and the number of its text."""
    data, offsets = words.text_bytes(pc.utf8_lower(block.column("text")))
    starts, ends, firsts = find_units(data, offsets)
    hashes = words.hash_words(data, starts, ends)
    owner = np.repeat(np.arange(block.num_rows), np.diff(firsts))
    # only where a script has no spaces does one unit begin where another ends
    left = np.flatnonzero((ends[:-1] == starts[1:]) & (owner[:-1] == owner[1:]))
    pairs = words.mix(hashes[left] * np.uint64(0x9E3779B97F4A7C15) + hashes[left + 1])
    places = (np.concatenate([hashes, pairs]) >> np.uint64(64 - bits)).astype(np.int64)
    return places, np.concatenate([owner, owner[left]])


def _terms_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in shared.blocks(batches, "text", _BLOCK_BYTES):
            places, owner = _places(block, bits)
            pairs = np.unique(owner << 32 | places)
            bounds = np.searchsorted(pairs >> 32, np.arange(block.num_rows + 1)).astype(np.int32)
            terms = pa.ListArray.from_arrays(bounds, pa.array((pairs & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("label"), terms],
                                             names=["doc_id", "label", "terms"])
    return run


def _gain(inside: np.ndarray, often: np.ndarray, positive: float, n: int) -> np.ndarray:
    """G statistic of each term's presence against the label: often texts, inside of label 1."""
    total = np.zeros(len(often))
    for seen, texts, share in ((inside, often, positive / n), (often - inside, often, 1 - positive / n),
                               (positive - inside, n - often, positive / n),
                               (n - positive - often + inside, n - often, 1 - positive / n)):
        expected = texts * share
        total += 2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))
    return total


def fit(texts: list[np.ndarray], labels: np.ndarray, *, bits: int, factors: int = 4, least: int = 3,
        least_gain: float = 12.0, passes: int = 40, rate: float = 0.1, decay: float = 1e-4,
        batch: int = 256, seed: int = 5) -> Machine:
    """Learn from the distinct places of each text."""
    share = float(labels.mean()) if len(labels) else 0.0
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate(texts) if len(texts) else np.zeros(0, np.int64)
    terms, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    inside = np.bincount(column, np.repeat(labels, sizes), len(terms))
    chosen = (often >= least) & (_gain(inside, often, labels.sum(), max(len(labels), 1)) >= least_gain)
    new = np.cumsum(chosen) - 1
    rng = np.random.default_rng(seed)
    k = int(chosen.sum())
    model = Machine(terms[chosen].astype(np.int64), 0.0, np.zeros(k), rng.normal(0, 0.05, (k, factors)), bits)
    if share in (0.0, 1.0) or not k:
        share = min(max(share, 1e-6), 1 - 1e-6)
        model.bias = float(np.log(share / (1 - share)))
        return Machine(model.terms[:0], model.bias, model.weights[:0], model.factors[:0], bits)
    owner = np.repeat(np.arange(len(texts)), sizes)
    learned = chosen[column]
    owner, column = owner[learned], new[column[learned]]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    square_w, square_v, square_b = np.full(k, 1e-6), np.full((k, factors), 1e-6), 1e-6
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for s in range(0, len(order), batch):
            rows = order[s:s + batch]
            n = np.diff(bounds)[rows]
            text = np.repeat(np.arange(len(rows)), n)
            term = column[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[rows], n)]
            v = model.factors[term]
            sums = np.stack([np.bincount(text, v[:, f], len(rows)) for f in range(factors)], axis=1)
            total = model.bias + np.bincount(text, model.weights[term], len(rows)) \
                + 0.5 * ((sums ** 2).sum(1) - np.bincount(text, (v * v).sum(1), len(rows)))
            error = 1 / (1 + np.exp(-np.clip(total, -500, 500))) - labels[rows]
            e = error[text]
            touched, at = np.unique(term, return_inverse=True)
            grad = np.bincount(at, e, len(touched)) / len(rows) + decay * model.weights[touched]
            square_w[touched] += grad ** 2
            model.weights[touched] -= rate * grad / np.sqrt(square_w[touched])
            pull = e[:, None] * (sums[text] - v)
            grad_v = np.stack([np.bincount(at, pull[:, f], len(touched)) for f in range(factors)], axis=1) \
                / len(rows) + decay * model.factors[touched]
            square_v[touched] += grad_v ** 2
            model.factors[touched] -= rate * grad_v / np.sqrt(square_v[touched])
            grad_b = error.mean()
            square_b += grad_b ** 2
            model.bias -= rate * grad_b / np.sqrt(square_b)
    return model


def learn_from(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 12_000, bits: int = 20,
               **options) -> Machine:
    """Fit on at most ``sample_rows`` labelled, not held-out documents, whole texts."""
    sample = labelled_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                             labels, "toxic", sample_rows)
    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label").mapInArrow(
        _terms_of(bits), "doc_id long, label int, terms array<int>").orderBy("doc_id").toArrow()
    terms = rows.column("terms").combine_chunks()
    flat, ends = terms.flatten().to_numpy(), terms.offsets.to_numpy()
    return fit([flat[a:z] for a, z in zip(ends[:-1] - ends[0], ends[1:] - ends[0])] if len(rows) else [],
               rows.column("label").to_numpy().astype(np.float64), bits=bits, **options)


def score_column(spark: SparkSession, model: Machine, text: Column) -> Column:
    """Score of each text, as a column for any table."""
    shipped = spark.sparkContext.broadcast(model)  # at most the terms of the sample

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        machine = shipped.value
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [machine.score(*_places(block, machine.bits), block.num_rows)
                 for block in shared.blocks([batch], "text", _BLOCK_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text.cast("string"))


def score_texts(docs: DataFrame, model: Machine, *, key: str = "doc_id", text: str = "text",
                threshold: float = 0.3) -> DataFrame:
    """Per row: key, held_out, score (0 to 1), predicted (1 if score >= threshold)."""
    scored = docs.select(F.col(key).alias("key"),
                         score_column(docs.sparkSession, model, F.col(text)).alias("score"))
    return scored.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
