"""Packing by lexical retrieval: each seed's window is filled with its BM25 neighbours.

1. Every text is encoded once.  Its full windows are sequences already; the ids left over (its
   tail) are stored with a min-hash of their distinct ids.
2. Document frequencies of all tails are summed over the corpus: one count an id, so their size
   is bounded by the vocabulary.
3. Tails are ordered by min-hash, which puts texts that share words side by side, and each
   partition is cut into shards of at most ``shard_docs`` tails.  A shard holds an inverted index
   of BM25 weights.
4. In a shard the first unused tail is a seed.  Its unused neighbours by BM25 fill the window as
   long as they fit; then the best one left is cut to fill it, and its rest stays in the pool.
   Without neighbours the next unused tail follows.  What the last window of a shard holds is cut
   at powers of two, so it needs no padding.

Edge cases: a null or empty text has the end id alone; a null key stays null; repeated rows are
packed each on its own; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared, words
from cadastre.llm.word_ids import forget, word_ids

_STORED = ("kind int, key long, doc_tokens long, tail_start long, tail_tokens long, lexical long, "
           "first_sequence long, crcs binary, blob binary")
_PIECES = "key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split()[0] for f in _PIECES.split(", ")]
#: sequence ids: whole windows below, windows of tails above
_TAILS = 1 << 62


def pack(docs: DataFrame, vocabulary: str, vocabulary_size: int, *, key: str = "doc_id",
         text: str = "text", window: int = 2048, end_id: int = 1, shard_docs: int = 1024,
         query_terms: int = 32, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``query_terms``: how many of a seed's ids, those of highest weight, look for neighbours.
    """
    encoded = shared.stored(
        docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
        .mapInArrow(_encoder(vocabulary, vocabulary_size, window, end_id), _STORED), "packing-ids")
    tails = encoded.where("kind = 0")
    corpus = tails.agg(F.count("*").alias("n"), F.avg("tail_tokens").alias("mean")).first()
    frequency = np.zeros(vocabulary_size, np.int64)
    counts = encoded.where("kind = 1").select("blob").mapInArrow(_frequencies, "id int, n long") \
        .groupBy("id").agg(F.sum("n").alias("n"))
    for row in counts.toLocalIterator():  # at most one row an id
        frequency[row["id"]] = row["n"]
    n = corpus["n"]
    idf = np.log1p((n - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    weights = docs.sparkSession.sparkContext.broadcast(idf)  # bounded by the vocabulary

    ordered = (tails.where("tail_tokens > 0")
               .select("key", "doc_tokens", "tail_start", "lexical", "blob")
               .repartitionByRange("lexical", F.xxhash64("key", "tail_start"))
               .sortWithinPartitions("lexical", "key", "blob"))
    filled = ordered.mapInArrow(
        _filler(weights, float(corpus["mean"] or 1), window, shard_docs, query_terms, k1, b), _PIECES)
    whole = encoded.where("kind = 0 and tail_start > 0").select(
        "key", "doc_tokens", "first_sequence", "crcs").mapInArrow(_windows(window), _PIECES)
    return whole.unionByName(filled).withColumnRenamed("key", key)


def _encoder(vocabulary: str, size: int, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary, "<u2" if size <= 1 << 16 else "<u4")
        codes = words.mix(np.arange(1, size + 1, dtype=np.uint64)) >> np.uint64(1)
        seen = np.zeros(size, np.int32)
        sequence = TaskContext.get().partitionId() << 36
        for block in shared.blocks(batches, "text"):
            rows = []
            found, bounds = encoder.encode(block.column("text"))
            places = bounds.tolist()
            for key, a, z in zip(block.column("key").to_pylist(), places[:-1], places[1:]):
                ids = np.append(found[a:z], encoder.code.type(end_id))
                cut = len(ids) // window * window
                whole = ids[:cut].astype("<u4").tobytes()
                crcs = [zlib.crc32(whole[i:i + 4 * window]) for i in range(0, 4 * cut, 4 * window)]
                tail = ids[cut:]
                ordered = np.sort(tail)
                distinct = ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(tail) else ordered
                seen[distinct] += 1
                rows.append((0, key, len(ids), cut, len(tail),
                             int(codes[distinct].min()) if len(tail) else 0, sequence,
                             np.array(crcs, "<u4").tobytes(), tail.tobytes()))
                sequence += len(crcs)
            yield _rows(rows)
            shared.give_back()
        if seen.any():
            there = np.flatnonzero(seen).astype("<i4")
            yield _rows([(1, None, 0, 0, 0, 0, 0, b"",
                          there.tobytes() + seen[there].astype("<i4").tobytes())])
    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] + [pa.int64()] * 6 + [pa.binary()] * 2
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
        names=[f.split()[0] for f in _STORED.split(", ")])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            both = np.frombuffer(blob, "<i4")
            half = len(both) // 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:half]), pa.array(both[half:].astype(np.int64))], names=["id", "n"])


def _windows(window: int):
    """Rows of the full windows of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in shared.blocks(batches, "crcs", 1 << 16):
            out = []
            for row in block.to_pylist():
                for i, crc in enumerate(np.frombuffer(row["crcs"], "<u4").tolist()):
                    out.append((row["key"], i * window, window, crc, row["doc_tokens"],
                                row["first_sequence"] + i, 0))
            yield _pieces(out)
    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_NAMES))], names=_NAMES)


class Shard:
    """Inverted index of the BM25 weights of some tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float, k1: float, b: float):
        sizes = np.array([len(t) for t in tails], np.int64)
        shift = max(1, len(idf) - 1).bit_length()
        kind = np.uint32 if len(tails) << shift < 1 << 32 else np.uint64
        pairs = np.repeat(np.arange(len(tails), dtype=kind) << kind(shift), sizes) \
            | np.concatenate(tails).astype(kind)
        pairs.sort()
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        times = np.diff(np.append(first, len(pairs)))
        pairs = pairs[first]
        owner = (pairs >> kind(shift)).astype(np.int64)
        term = (pairs & kind((1 << shift) - 1)).astype(np.uint16 if shift <= 16 else np.uint32)
        long = k1 * (1 - b + b * sizes[owner] / mean)
        weight = (idf[term] * times * (k1 + 1) / (times + long)).astype(np.float32)
        self.n = len(tails)
        self.bounds = np.searchsorted(owner, np.arange(self.n + 1))
        self.rank = idf[term] * times
        by_term = np.argsort(term, kind="stable")
        self.owners, self.weights = owner[by_term], weight[by_term]
        place = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(idf)))])
        self.starts, self.ends = place[term], place[1:][term]

    def neighbours(self, seed: int, terms: int) -> np.ndarray:
        """Tails that share one of the seed's heaviest ids, best first."""
        a, z = self.bounds[seed], self.bounds[seed + 1]
        at = np.arange(a, z)[self.ends[a:z] - self.starts[a:z] > 1]
        if len(at) > terms:
            at = at[np.argpartition(-self.rank[at], terms)[:terms]]
        if not len(at):
            return at
        lists = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in at])
        scores = np.bincount(self.owners[lists], self.weights[lists], self.n)
        scores[seed] = 0
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def fill(tails: list[np.ndarray], shard: Shard, window: int, terms: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, from, to), each id of each tail in exactly one."""
    used = [0] * len(tails)
    size = [len(t) for t in tails]
    out, first = [], 0
    while True:
        while first < len(tails) and used[first] == size[first]:
            first += 1
        if first == len(tails):
            return out
        row: list[tuple[int, int, int]] = []
        free = window

        def take(i: int, most: int) -> int:
            n = min(most, size[i] - used[i])
            row.append((i, used[i], used[i] + n))
            used[i] += n
            return n

        free -= take(first, free)
        if free:
            near = shard.neighbours(first, terms).tolist()
            spare = []
            for i in near:
                left = size[i] - used[i]
                if 0 < left <= free:
                    free -= take(i, free)
                    if not free:
                        break
                elif left:
                    spare.append(i)
            if free and spare:
                free -= take(spare[0], free)
            i = first
            while free and i < len(tails):
                if used[i] < size[i]:
                    free -= take(i, free)
                i += 1
        out.append(row)


def cut_to_powers(row: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """A window that is not full as sequences whose sizes are powers of two."""
    out = []
    left = list(row)
    while total:
        goal = 1 << (total.bit_length() - 1)
        total -= goal
        part = []
        while goal:
            i, a, z = left.pop(0)
            n = min(goal, z - a)
            part.append((i, a, a + n))
            goal -= n
            if a + n < z:
                left.insert(0, (i, a + n, z))
        out.append(part)
    return out


def _filler(weights, mean: float, window: int, shard_docs: int, terms: int, k1: float, b: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        idf = weights.value
        code = "<u2" if len(idf) <= 1 << 16 else "<u4"
        sequence = _TAILS | TaskContext.get().partitionId() << 36
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            nonlocal sequence
            tails = [np.frombuffer(r["blob"], code) for r in held]
            rows = []
            for row in fill(tails, Shard(tails, idf, mean, k1, b), window, terms):
                total = sum(z - a for _, a, z in row)
                for part in [row] if total == window else cut_to_powers(row, total):
                    offset = 0
                    for i, a, z in part:
                        raw = tails[i][a:z].astype("<u4").tobytes()
                        rows.append((held[i]["key"], held[i]["tail_start"] + a, z - a, zlib.crc32(raw),
                                     held[i]["doc_tokens"], sequence, offset))
                        offset += z - a
                    sequence += 1
            held.clear()
            return _pieces(rows)

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == shard_docs:
                    yield close()
        if held:
            yield close()
    return run
