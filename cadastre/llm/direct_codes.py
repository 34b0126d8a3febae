"""Token-id files with access to any token: directly addressable codes.

An id is split into chunks of ``BITS`` bits.  Level 0 holds the low chunk of every id with a
bitmap that tells which ids go on; level 1 holds the next chunk of those only, and so on.  A rank
directory (set bits before each word of the bitmap) turns the place of an id on one level into its
place on the next, so reading token i touches one chunk and one directory entry a level.

File, little-endian: magic, header (count of ids and texts, levels, texts' and ids' start within
the writing partition), text keys, null marks and sizes, then per level: chunk count, chunks,
bitmap words, ranks.  Files hold at most ``file_tokens`` ids unless one text alone has more.

Edge cases: a null or empty text is the end id alone; a null key sorts first and comes back null;
equal keys stay separate rows, in order of their text; an empty table gives no file and no row;
other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastre.llm import shared
from cadastre.llm.word_ids import word_ids

MAGIC = b"DACIDS01"
BITS = 8
_HEADER = struct.Struct("<8sqqqqq")
_FILES = ("partition int, part_no int, path string, n_texts long, n_tokens long")


# ---------------------------------------------------------------- codes

class Level:
    """Chunks of one level, the bitmap of ids that go on, and the rank directory."""

    def __init__(self, chunks: np.ndarray, bitmap: np.ndarray, ranks: np.ndarray):
        self.chunks, self.bitmap, self.ranks = chunks, bitmap, ranks

    @classmethod
    def of(cls, chunks: np.ndarray, more: np.ndarray) -> Level:
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view("<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])
        return cls(chunks, bits, ranks.astype("<u4"))

    def goes_on(self, i: int) -> bool:
        return bool(int(self.bitmap[i >> 6]) >> (i & 63) & 1)

    def rank(self, i: int) -> int:
        """Ids before place ``i`` that go on."""
        below = int(self.bitmap[i >> 6]) & ((1 << (i & 63)) - 1) if i & 63 else 0
        return int(self.ranks[i >> 6]) + below.bit_count()


class DirectCodes:
    """A sequence of ids with access to any of them."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def of(cls, ids: np.ndarray) -> DirectCodes:
        levels, rest = [], ids.astype(np.uint64)
        while True:
            more = rest >> np.uint64(BITS)
            on = more > 0
            levels.append(Level.of((rest & np.uint64((1 << BITS) - 1)).astype(np.uint8), on))
            if not on.any():
                return cls(levels)
            rest = more[on]

    def __len__(self) -> int:
        return len(self.levels[0].chunks)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, level in enumerate(self.levels):
            value |= int(level.chunks[i]) << (BITS * k)
            if not level.goes_on(i):
                break
            i = level.rank(i)
        return value

    def ids(self) -> np.ndarray:
        """All ids: each level's values are put where the level before goes on."""
        values = np.zeros(0, np.uint64)
        for level in reversed(self.levels):
            n = len(level.chunks)
            own = level.chunks.astype(np.uint64)
            if len(values):
                on = np.unpackbits(level.bitmap.view(np.uint8), bitorder="little")[:n].astype(bool)
                own[on] |= values << np.uint64(BITS)
            values = own
        return values

    def to_bytes(self) -> bytes:
        out = []
        for level in self.levels:
            out += [struct.pack("<q", len(level.chunks)), level.chunks.tobytes(),
                    level.bitmap.tobytes(), level.ranks.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes, at: int, count: int) -> DirectCodes:
        levels = []
        for _ in range(count):
            n = struct.unpack_from("<q", data, at)[0]
            words = (n + 63) // 64
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, "<u8", words, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", words + 1, at + 8 + n + 8 * words)
            levels.append(Level(chunks, bitmap, ranks))
            at += 8 + n + 8 * words + 4 * (words + 1)
        return cls(levels)


class TokenFile:
    """One file: the texts' keys and sizes, and their ids one after another."""

    def __init__(self, keys: np.ndarray, nulls: np.ndarray, sizes: np.ndarray,
                 codes: DirectCodes, start: int):
        self.keys, self.nulls, self.sizes, self.codes, self.start = keys, nulls, sizes, codes, start

    @classmethod
    def of(cls, keys: list[int | None], ids: list[bytes], start: int) -> TokenFile:
        return cls(np.array([k or 0 for k in keys], "<i8"),
                   np.array([k is None for k in keys], np.uint8),
                   np.array([len(x) // 4 for x in ids], "<i8"),
                   DirectCodes.of(np.frombuffer(b"".join(ids), "<u4")), start)

    def to_bytes(self) -> bytes:
        return b"".join([
            _HEADER.pack(MAGIC, len(self.codes), len(self.keys), len(self.codes.levels), self.start, 0),
            self.keys.tobytes(), self.sizes.tobytes(), self.codes.to_bytes(), self.nulls.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> TokenFile:
        magic, _, texts, levels, start, _ = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        at = _HEADER.size
        return cls(np.frombuffer(data, "<i8", texts, at),
                   np.frombuffer(data, np.uint8, texts, len(data) - texts),
                   np.frombuffer(data, "<i8", texts, at + 8 * texts),
                   DirectCodes.from_bytes(data, at + 16 * texts, levels), start)

    def __getitem__(self, i: int) -> int:
        return self.codes[i]


# ---------------------------------------------------------------- Spark

def write_token_files(docs: DataFrame, vocabulary: str, folder: str, *, key: str = "doc_id",
                      text: str = "text", end_id: int = 2, file_tokens: int = 1 << 20) -> DataFrame:
    """Encode each text, append ``end_id``, and write files in ascending order of the key.

    Returns the stored list of files: ``partition, part_no, path, n_texts, n_tokens``.  A file's
    name follows from its partition and number, so a repeated task writes the same file again.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(vocabulary), struct.pack("<I", end_id)
        partition, number, start = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal keys, ids, held, number, start
            path = f"{folder}/ids-{partition:06d}-{number:06d}.dac"
            shared.write_file(path, TokenFile.of(keys, ids, start).to_bytes())
            row = [[partition], [number], [path], [len(keys)], [held]]
            start, number = start + held, number + 1
            keys, ids, held = [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(),
                                                      pa.int64(), pa.int64()))],
                names=["partition", "part_no", "path", "n_texts", "n_tokens"])

        for block in shared.blocks(batches, "text"):
            found, bounds = encoder.encode(block.column("text"))
            places = bounds.tolist()
            for k, a, z in zip(block.column("key").to_pylist(), places[:-1], places[1:]):
                made = found[a:z].tobytes() + end
                if ids and held + len(made) // 4 > file_tokens:
                    yield close()
                keys.append(k)
                ids.append(made)
                held += len(made) // 4
        if ids:
            yield close()

    ordered = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
               .repartitionByRange(F.col("key").asc_nulls_first())
               .sortWithinPartitions(F.col("key").asc_nulls_first(), "text"))
    return shared.stored(ordered.mapInArrow(write, _FILES), "token-files")


def read_token_files(files: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Per text: key, start (ids of all texts before it), n_tokens, ids_crc32 and its file.

    Starts come from the files' own starts and the totals of the partitions before (a table of
    one row a partition).
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                file = TokenFile.from_bytes(shared.read_file(path))
                raw = file.codes.ids().astype("<u4").tobytes()
                ends = np.cumsum(file.sizes)
                first = ends - file.sizes
                crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.keys, mask=file.nulls.astype(bool)),
                     pa.array(first + (before + file.start)), pa.array(file.sizes),
                     pa.array(crcs, pa.int64()), pa.array([path] * len(crcs))],
                    names=["key", "start", "n_tokens", "ids_crc32", "path"])

    totals = files.groupBy("partition").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("partition", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    placed = files.join(before, "partition").select("path", "before") \
        .repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return placed.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long, path string") \
        .withColumnRenamed("key", key)
