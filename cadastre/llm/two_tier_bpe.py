"""Byte-level BPE by two tiers: a minimal perfect hash, then merges by a heap over linked bytes.

A pre-token that is a vocabulary entry is found by the minimal perfect hash: one displacement and
one compare of bytes.  Any other is merged: its bytes are a linked list, adjacent pairs wait in a
heap by (rank, place), and the lowest live one merges until none is left.

Edge cases: a null or empty text has no ids; equal rows stay separate rows; a pre-token of any
length is merged in O(n log n); other columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared

_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys in n places.

    Keys fall into buckets; the largest buckets first look for a displacement that puts all
    their keys on free places; buckets of one key take what is left and store the place itself.
    """

    def __init__(self, keys: list[bytes], values: list[int], load: int = 4, tries: int = 256):
        n = self.n = len(keys)
        self.buckets = max(1, n // load)
        codes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        bucket = (codes % np.uint64(self.buckets)).astype(np.int64)
        members = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[members], np.arange(self.buckets + 1))
        sizes = np.diff(bounds)
        at = np.full(n, -1, np.int64)
        shifts = np.zeros(self.buckets, np.int64)
        order = np.argsort(-sizes, kind="stable").tolist()
        for b in order:
            if sizes[b] < 2:
                break
            own = members[bounds[b]:bounds[b + 1]]
            start = 1
            while True:
                places = self._places(codes[own][:, None], np.arange(start, start + tries, dtype=np.uint64))
                good = (at[places] < 0).all(axis=0)
                for k in np.flatnonzero(good).tolist():
                    if len(set(places[:, k].tolist())) == len(own):
                        break
                else:
                    start += tries
                    continue
                break
            at[places[:, k]] = own
            shifts[b] = start + k
        alone = np.array([b for b in order if sizes[b] == 1], np.int64)
        free = np.flatnonzero(at < 0)
        at[free] = members[bounds[alone]]
        shifts[alone] = -free
        self.shifts = shifts.tolist()
        self.keys = [keys[i] for i in at.tolist()]
        self.values = [values[i] for i in at.tolist()]

    def _places(self, codes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        x = codes ^ (shifts * np.uint64(0x9E3779B97F4A7C15))
        return ((x * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64)

    def _place(self, code: int, shift: int) -> int:
        x = (code ^ (shift * 0x9E3779B97F4A7C15)) & _MASK
        return ((x * 0xD6E8FEB86659FD93 & _MASK) >> 32) % self.n

    def find(self, key: bytes) -> int:
        """The key's value, or -1 if it is not one of the keys."""
        if not self.n:
            return -1
        code = xxhash.xxh3_64_intdigest(key)
        shift = self.shifts[code % self.buckets]
        place = self._place(code, shift) if shift > 0 else -shift
        return self.values[place] if self.keys[place] == key else -1


class TwoTierBpe:
    """Encode and decode by a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str, keep: int = 250_000):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = ranks
        self.hash = PerfectHash(list(ranks), list(ranks.values()))
        self.longest = max(map(len, ranks), default=0)
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.pattern = regex.compile(pattern)
        # white space where cutting at single spaces and line ends could change a match
        self.odd = re.compile(r"\s\s|^\s|\s$|[^\S \n]")
        self.keep = keep
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids.

        Cut before single spaces and around single line ends, pre-tokens stay whole (a space
        begins the next pre-token, a lone line end is one), so the pieces are encoded apart
        and kept.  Texts with other white space are matched as a whole.
        """
        if not text:
            return b""
        if self.odd.search(text):
            return self._match(text)
        cut = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0") \
            if "\0" not in text else [text]
        known = self.young
        new = set(cut).difference(known)
        if new:
            if len(known) + len(new) > self.keep:
                self.old, self.young = known, {w: known[w] for w in set(cut) & known.keys()}
                known = self.young
            for piece in new:
                ids = self.old.get(piece)
                known[piece] = self._match(piece) if ids is None else ids
        return b"".join([known[w] for w in cut])

    def _match(self, text: str) -> bytes:
        out, parts = [], self.parts
        for part in self.pattern.findall(text):
            ids = parts.get(part)
            if ids is None:
                raw = part.encode()
                rank = self.hash.find(raw)
                ids = rank.to_bytes(4, "little") if rank >= 0 else self.merge(raw)
                if len(raw) < 64:
                    if len(parts) >= self.keep:
                        parts.clear()
                    parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def merge(self, raw: bytes) -> bytes:
        """Ids of a pre-token that is not in the vocabulary."""
        n, get, longest = len(raw), self.ranks.get, self.longest
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1)
                if (rank := get(raw[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            j = after[i]
            if j < 0 or j >= n or after[j] != end:
                continue  # one of the two has merged meanwhile
            after[i], after[j] = end, -1
            if end < n:
                before[end] = i
                to = after[end]
                if to - i <= longest and (rank := get(raw[i:to])) is not None:
                    heappush(heap, (rank, i, to))
            first = before[i]
            if first >= 0 and end - first <= longest and (rank := get(raw[first:end])) is not None:
                heappush(heap, (rank, first, end))
        ids, i = [], 0
        while i < n:
            ids.append(get(raw[i:after[i]]))
            i = after[i]
        return np.array(ids, "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_OPEN: dict[tuple[str, str], TwoTierBpe] = {}


def codec(path: str, pattern: str) -> TwoTierBpe:
    """The worker's codec for a rank file; it lives as long as the worker."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = TwoTierBpe(path, pattern)
    return _OPEN[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, *, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: key and ids (binary, little-endian 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for block in shared.blocks(batches, "text"):
            ids = [bpe.encode(t) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("key"), pa.array(ids, pa.binary())],
                                             names=["key", "ids"])

    return _two(docs, key, text, "string").mapInArrow(run, "key long, ids binary") \
        .withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, path: str, pattern: str, *, key: str = "doc_id",
               ids: str = "ids") -> DataFrame:
    """Per row: key, n_tokens, ids and their decoded bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for block in shared.blocks(batches, "text"):
            made = [x or b"" for x in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([len(x) // 4 for x in made], pa.int64()),
                 pa.array(made, pa.binary()), pa.array([bpe.decode(x) for x in made], pa.binary())],
                names=["key", "n_tokens", "ids", "decoded"])

    return _two(encoded, key, ids, "binary") \
        .mapInArrow(run, "key long, n_tokens long, ids binary, decoded binary") \
        .withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, pattern: str, *, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: key, n_tokens, ids_sha256, decoded_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for block in shared.blocks(batches, "text"):
            ids = [bpe.encode(t) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids])],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _two(docs, key, text, "string").mapInArrow(run, schema).withColumnRenamed("key", key)


def _two(df: DataFrame, key: str, text: str, kind: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("key"), F.col(text).cast(kind).alias("text"))
