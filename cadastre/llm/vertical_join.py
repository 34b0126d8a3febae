"""N-gram Jaccard self-join by vertical partitioning.

1. Every text becomes its set of distinct ``size``-word shingles (63-bit hashes); texts of equal
   sets are one class, found by count and a 128-bit sum of the set.
2. A global order of shingles, the rare ones first: by the number of all shingles of all texts that
   fall on the same one of ``PLACES`` places of a table, in half powers of two, then by hash.  Every
   shingle is counted; the table has one size however long the corpus is.
3. Sets above the threshold share ``least`` of the first shingles of both (a prefix as much longer;
   small sets share what they must); buckets of equal prefix shingles give candidate pairs, filtered
   by sizes, by the places of the shingles and by their number, then by parity bitmaps: one bit per shingle or so; sets differ in at least as many shingles as their
   bitmaps in bits, so no link is lost and whole sets travel for few other pairs.
4. The order is cut into ``fragments``.  Each fragment of each candidate pair is intersected on
   its own, and the partial counts are summed per pair.
5. Linked pairs are joined to components.

Edge cases: a null, empty or word-free text has no shingle and links with nothing; keys are
expected to be unique, rows of an equal key keep their own sets and may share a component; a row with a null key links with nothing and is its own component (null);
an empty table gives no row; other columns are not read.
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
from cadastre.llm.components import components

#: places of the table of counts, and the parts it travels in
PLACES, _PARTS = 1 << 22, 1 << 10
#: an order key holds the class of the count above so many bits of the hash
_HASH_BITS = 56
#: from this class on a bucket may hold more than 65,536 sets
_CROWDED = 32
#: text cut into shingles at a time: arrays of several numbers a byte are made of it
_BLOCK_BYTES = 1 << 20
_PAIR = ["x_doc", "x_f1", "x_n", "y_doc", "y_f1", "y_n"]
_PAIR_TYPE = ", ".join(f"{c} long" for c in _PAIR)


def _sets(block: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes (62 bits) of each text, ascending."""
    data, offsets = words.text_bytes(block.column("text"))
    starts, ends, firsts = words.find_words(data, offsets)
    hashes = words.hash_words(data, starts, ends)
    shingles, bounds = words.hash_shingles(hashes, firsts, size)
    shingles >>= np.uint64(1)
    places = bounds.tolist()
    for a, b in zip(places[:-1], places[1:]):
        own = shingles[a:b]
        own.sort()
        if b - a > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        yield own


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _prefix_length(n: int, percent: int, least: int) -> int:
    """Shingles of which a partner must share at least ``least``, or ceil(t n) if that is less."""
    must = -(-percent * n // 100)
    return n - must + min(least, must)


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(PLACES - 1)).astype(np.int64)


def _bitmap(own: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per place; as many places as shingles, rounded up to a power of two."""
    places = max(256, 1 << (len(own) - 1).bit_length())
    counts = np.bincount((own & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8))


def _measure(size: int):
    """A text's set (key, n, two sums, bitmap); at the end of a task the counts of all places, a part a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, total = "key n f1 f2 bits part counts", np.zeros(PLACES, np.uint32)
        for block in shared.blocks(batches, "text", _BLOCK_BYTES):
            sets = list(_sets(block, size))
            n = np.array([len(s) for s in sets], np.int64)
            one = [int(words.mix(s).sum()) if len(s) else 0 for s in sets]
            two = [int(words.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()) if len(s) else 0 for s in sets]
            yield _batch(names, block.column("key"), n, _signed(np.array(one, np.uint64)),
                         _signed(np.array(two, np.uint64)),
                         pa.array([_bitmap(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                         pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.binary()))
            if n.any():
                total += np.bincount(_places(np.concatenate(sets)), minlength=PLACES).astype(np.uint32)
        parts = total.reshape(_PARTS, -1)
        used = np.flatnonzero(parts.any(axis=1))
        if len(used):
            none = pa.nulls(len(used), pa.int64())
            yield _batch(names, none, none, none, none, pa.nulls(len(used), pa.binary()), used,
                         pa.array([zlib.compress(parts[k].tobytes(), 1) for k in used], pa.binary()))
        del total, parts
        shared.give_back()
    return run


def _add_counts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of the counts of one part, which are summed as they stream in."""
    total = np.zeros(PLACES // _PARTS, np.uint64)
    for batch in batches:
        for counts in batch.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(counts), np.uint32)
    classes = np.minimum(2 * np.log2(np.maximum(total, 1)), 62).astype(np.uint8)
    yield _batch("part classes mass", [key[0].as_py()], pa.array([classes.tobytes()], pa.binary()),
                 pa.array([np.bincount(classes, total.astype(np.float64), 64).tolist()], pa.list_(pa.float64())))


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _ordered(own: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Order keys of a set's shingles, ascending: the class of its count, then its hash."""
    keys = (classes[_places(own)].astype(np.uint64) << np.uint64(_HASH_BITS)) | (own >> np.uint64(62 - _HASH_BITS))
    keys.sort()
    return keys


def _prefixes(size: int, percent: int, least: int, order):
    """The prefix shingles of each set: order key, half the set's sum, n and place, text key.

    Copies within a block are one set already.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, _ = order.value
        for block in shared.blocks(batches, "text", _BLOCK_BYTES):
            seen: dict[tuple, tuple] = {}
            for key, own in zip(block.column("key").to_pylist(), _sets(block, size)):
                if not len(own) or key is None:
                    continue
                f1 = int(words.mix(own).sum().view(np.int64))
                if (f1, len(own)) in seen:
                    front, doc = seen[f1, len(own)]
                    seen[f1, len(own)] = front, min(doc, key)
                    continue
                m = _prefix_length(len(own), percent, least)
                seen[f1, len(own)] = _ordered(own, classes)[:m].copy(), key
            if seen:
                sizes = [len(front) for front, _ in seen.values()]
                yield _batch(
                    "shingle f1 place doc",
                    _signed(np.concatenate([front for front, _ in seen.values()])),
                    np.repeat(np.array([f for f, _ in seen], np.int64), sizes),
                    np.concatenate([(n << 32) | np.arange(m) for (_, n), m in zip(seen, sizes)]),
                    np.repeat(np.array([doc for _, doc in seen.values()], np.int64), sizes))
        shared.give_back()
    return run


def order_of(measured: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class of each place (one byte each, ``PLACES`` in all), and how many shingles each class has."""
    rows = (measured.where("part is not null").groupBy("part")
            .applyInArrow(_add_counts, "part long, classes binary, mass array<double>").collect())
    classes, mass = np.zeros((_PARTS, PLACES // _PARTS), np.uint8), np.zeros(64)
    for row in rows:
        classes[row["part"]] = np.frombuffer(row["classes"], np.uint8)
        mass += row["mass"]
    return classes.reshape(-1), mass


def cuts_of(mass: np.ndarray, fragments: int) -> np.ndarray:
    """Order keys that cut the global order into fragments of about as many shingles."""
    above = np.concatenate([[0.0], np.cumsum(mass)])
    out = []
    for k in range(1, fragments):
        wanted = above[-1] * k / fragments
        at = min(max(int(np.searchsorted(above, wanted, "right")) - 1, 0), 62)
        share = (wanted - above[at]) / mass[at] if mass[at] else 0.0
        out.append((at << _HASH_BITS) + int(share * (1 << _HASH_BITS)))
    return np.array(out, np.uint64)


def buckets(prefixes: DataFrame) -> DataFrame:
    """Sets that share a prefix shingle: shingle, doc, f1, n, at (its place), sharing (sets there).

    A shingle of a low class is counted where its bucket is made, which is small.  The others may hold
    any number of sets: those are combined before the shuffle, and counted apart from their rows.
    """
    crowded = F.shiftright("shingle", _HASH_BITS) >= _CROWDED
    one = [F.min("doc").alias("doc"), F.first("place").alias("place")]
    small = (prefixes.where(~crowded).repartition("shingle").groupBy("shingle", "f1").agg(*one)
             .withColumn("sharing", F.count("*").over(Window.partitionBy("shingle"))).where("sharing > 1"))
    large = prefixes.where(crowded).groupBy("shingle", "f1").agg(*one)
    counts = large.groupBy("shingle").agg(F.count("*").alias("sharing")).where("sharing > 1")
    return (small.union(large.join(counts, "shingle"))
            .select("shingle", "doc", "f1", F.shiftright("place", 32).alias("n"),
                    F.col("place").bitwiseAND((1 << 32) - 1).alias("at"), "sharing"))


#: sets that may be broadcast (16 bytes each)
_BROADCAST_SETS = 500_000


def small_pairs(found: DataFrame, percent: int, most: int, least: int) -> DataFrame:
    """Candidate pairs of the buckets of at most ``most`` sets.

    Shingles that a pair shares in larger buckets are not counted here, so pairs of sets that are both in
    such buckets need no more than one.
    """
    crowd = shared.stored(found.where(F.col("sharing") > most).select("doc", "f1").distinct(), "crowd")
    if crowd.count() <= _BROADCAST_SETS:
        crowd = F.broadcast(crowd)
    few = found.where(F.col("sharing") <= most).drop("sharing")
    x = few.select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("doc", "f1", "n", "at")))
    y = few.select("shingle", *(F.col(c).alias(f"y_{c}") for c in ("doc", "f1", "n", "at")))
    pairs = (x.join(y, "shingle")
             .where("(x_doc, x_f1) < (y_doc, y_f1)")
             .where(f"100 * least(x_n, y_n) >= {percent} * greatest(x_n, y_n)")
             # before the first ``least`` common shingles a pair shares fewer than so many
             .where(f"{100 + percent} * (least(x_n - x_at, y_n - y_at) + {least - 1}) >= {percent} * (x_n + y_n)")
             .groupBy(*_PAIR).agg(F.count("*").alias("common")))
    for side in "xy":
        pairs = pairs.join(crowd.select(F.col("doc").alias(f"{side}_doc"), F.col("f1").alias(f"{side}_f1"),
                                        F.lit(True).alias(f"{side}_crowd")), [f"{side}_doc", f"{side}_f1"], "left")
    return pairs.where(f"common >= least({least}, ceil({percent} * least(x_n, y_n) / 100.0D)) "
                       "or (x_crowd and y_crowd)").select(*_PAIR)


def blocks_of(found: DataFrame, most: int, block_sets: int, percent: int) -> DataFrame:
    """Members of the larger buckets in blocks: block, band, doc, f1, n, shingle.

    A set lives in the block of its smallest shared shingle and its band of sizes; sets that link are
    of one band or of neighbouring ones.  Such sets are spread over as many blocks as they need, so a
    block holds about ``block_sets`` sets however many share a shingle.
    """
    # a little wider than the threshold asks, for the rounding of logarithms
    width = 1.000001 * math.log(100 / percent) if percent < 100 else 1e-9
    many = found.where(F.col("sharing") > most).select(
        "shingle", "doc", "f1", "n", F.floor(F.log("n") / width).cast("long").alias("band"))
    home = many.groupBy("doc", "f1", "band").agg(F.min("shingle").alias("home"))
    counts = home.groupBy("home", "band").agg(F.ceil(F.count("*") / block_sets).alias("parts"))
    placed = home.join(counts, ["home", "band"]).select(
        "doc", "f1", F.xxhash64("home", "band", F.pmod(F.xxhash64("doc", "f1"), "parts")).alias("block"))
    return many.join(placed, ["doc", "f1"])


def _folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """The bitmap of the same set over fewer places."""
    while bitmap.shape[-1] > size:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] ^ bitmap[..., half:]
    return bitmap


def _may_link(n_x, n_y, differing, percent: int):
    """Whether sets of these sizes that differ in so many shingles, or more, may link."""
    return (100 + percent) * (n_x + n_y - differing) >= 2 * percent * (n_x + n_y)


def near_pairs(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps do not rule a link out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differing = []
            for x, y in zip(batch.column("x_bits").to_pylist(), batch.column("y_bits").to_pylist()):
                size = min(len(x), len(y))
                differing.append(int(np.bitwise_count(
                    _folded(np.frombuffer(x, np.uint8), size) ^ _folded(np.frombuffer(y, np.uint8), size)).sum()))
            n_x, n_y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x_n", "y_n"))
            yield batch.filter(pa.array(_may_link(n_x, n_y, np.array(differing, np.int64), percent))).select(_PAIR)

    for side in "xy":
        pairs = pairs.join(maps.select(F.col("doc").alias(f"{side}_doc"), F.col("f1").alias(f"{side}_f1"),
                                       F.col("bits").alias(f"{side}_bits")), [f"{side}_doc", f"{side}_f1"])
    return pairs.select(*_PAIR, "x_bits", "y_bits").mapInArrow(run, _PAIR_TYPE)


def contents(texts: DataFrame, size: int, fragments: int, order) -> DataFrame:
    """Order keys of each text's set by fragment of the global order: doc, f1, fragment, n, keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, mass = order.value
        cuts = cuts_of(mass, fragments)
        for block in shared.blocks(batches, "text", _BLOCK_BYTES):
            out: list[tuple] = []
            for doc, f1, own in zip(block.column("key").to_pylist(), block.column("f1").to_pylist(),
                                    _sets(block, size)):
                if len(own) and int(words.mix(own).sum().view(np.int64)) == f1:
                    parts = np.split(ordered := _ordered(own, classes),
                                     np.searchsorted(ordered, cuts))
                    out += [(doc, f1, k, len(own), part.tobytes()) for k, part in enumerate(parts)]
            if out:
                *columns, keys = zip(*out)
                yield _batch("doc f1 fragment n keys", *columns, pa.array(keys, pa.binary()))
        shared.give_back()

    return (texts.select("key", "text", "f1")
            .mapInArrow(run, "doc long, f1 long, fragment long, n long, keys binary"))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that the two parts of a fragment share."""
    for batch in batches:
        shared_keys = []
        for x, y in zip(batch.column("x_keys").to_pylist(), batch.column("y_keys").to_pylist()):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if not len(a) or not len(b):
                shared_keys.append(0)
                continue
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            shared_keys.append(int((b[at] == a).sum()))
        names = [*_PAIR, "fragment"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(shared_keys, pa.int64())],
                                         names=[*names, "common"])


def pair_links(pairs: DataFrame, texts: DataFrame, percent: int, size: int, fragments: int, order) -> DataFrame:
    """Pairs at or above the threshold, by the sum of their fragments' counts."""
    def side(name: str) -> DataFrame:
        one = pairs.select(F.col(f"{name}_doc").alias("key"), F.col(f"{name}_f1").alias("f1")).distinct()
        return contents(texts.join(one, "key"), size, fragments, order).select(
            F.col("doc").alias(f"{name}_doc"), F.col("f1").alias(f"{name}_f1"), "fragment",
            F.col("keys").alias(f"{name}_keys"))

    return (pairs.join(side("x"), ["x_doc", "x_f1"]).join(side("y"), ["y_doc", "y_f1", "fragment"])
            .mapInArrow(_overlaps, f"{_PAIR_TYPE}, fragment long, common long")
            # repeated rows of a text count once
            .groupBy(*_PAIR, "fragment").agg(F.max("common").alias("common"))
            .groupBy(*_PAIR).agg(F.sum("common").alias("common"))
            .where(f"100 * common >= {percent} * (x_n + y_n - common)")
            .select(F.col("x_doc").alias("a"), F.col("y_doc").alias("b")))


def _block_near(percent: int, dense: int):
    def run(key: tuple, group):
        """Pairs of two blocks that may link; one row without a pair where they are too many to list."""
        import pandas as pd
        group = group.drop_duplicates(["side", "doc", "f1"]).sort_values(["n", "doc", "f1"], kind="stable")
        doc, f1, n, side = (group[c].to_numpy(np.int64) for c in ("doc", "f1", "n", "side"))
        bits = [np.frombuffer(b, np.uint8) for b in group["bits"]]
        sizes = np.array([len(b) for b in bits])
        # row i of level s: the bitmap of set i over s bytes, for sets that have so many
        levels = {s: np.stack([_folded(b, s) if len(b) >= s else np.zeros(s, np.uint8) for b in bits])
                  for s in set(sizes.tolist())}
        found = []
        for i in range(len(bits)):
            # partners are no smaller, and no larger than the threshold allows
            j = np.arange(i + 1, np.searchsorted(n, 100 * n[i] // percent, "right"))
            if key[0] != key[1]:
                j = j[side[j] != side[i]]
            if len(j):
                level = levels[int(sizes[i])]
                differing = np.bitwise_count(level[j] ^ level[i]).sum(axis=1, dtype=np.int64)
                found += [(i, k) for k in j[_may_link(n[i], n[j], differing, percent)].tolist()]
        if len(found) > dense * len(bits):
            return pd.DataFrame([(*key, True, 0, 0, 0, 0, 0, 0)], columns=["one", "two", "dense", *_PAIR])
        order = [(i, k) if (doc[i], f1[i]) < (doc[k], f1[k]) else (k, i) for i, k in found]
        x, y = (np.array([o[at] for o in order], np.int64) for at in (0, 1))
        return pd.DataFrame({"one": np.full(len(x), key[0]), "two": np.full(len(x), key[1]),
                             "dense": np.zeros(len(x), bool), "x_doc": doc[x], "x_f1": f1[x], "x_n": n[x],
                             "y_doc": doc[y], "y_f1": f1[y], "y_n": n[y]})
    return run


def meetings(members: DataFrame) -> DataFrame:
    """Pairs of blocks that share a shingle and are of one band or neighbouring ones."""
    at = members.select("shingle", "band", "block").distinct()
    around = at.select("shingle", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"),
                       F.col("block").alias("two"))
    pairs = at.withColumnRenamed("block", "one").join(around, ["shingle", "band"])
    return pairs.select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct()


def near_blocks(members: DataFrame, maps: DataFrame, percent: int, dense: int) -> DataFrame:
    """Pairs of members of larger buckets that may link, and pairs of blocks with very many of them."""
    meet = meetings(members)
    sets = members.select("block", "doc", "f1", "n").distinct().join(maps, ["doc", "f1"])
    return (sets.join(_sides(meet), "block").groupBy("one", "two")
            .applyInPandas(_block_near(percent, dense), f"one long, two long, dense boolean, {_PAIR_TYPE}"))


def _sides(meet: DataFrame) -> DataFrame:
    """The blocks of each pair of blocks."""
    return (meet.select(F.col("one").alias("block"), "one", "two", F.lit(0).alias("side"))
            .union(meet.where("one < two").select("two", "one", "two", F.lit(1))))


def _block_counts(key: tuple, group):
    """Common shingles of every pair of one fragment of two blocks, as one matrix."""
    import pandas as pd
    # repeated rows of a text count once
    group = group.drop_duplicates(["side", "doc", "f1"]).sort_values(["side", "doc", "f1"], kind="stable")
    left, right = (group["side"] == 0).to_numpy(), (group["side"] == group["side"].max()).to_numpy()
    parts = [np.frombuffer(k, np.uint64) for k in group["keys"]]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    values, column = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.zeros((int(left.sum()), int(right.sum())), np.uint32)
    step = 4096
    by_column = np.argsort(column, kind="stable")
    column, owner = column[by_column], owner[by_column]
    for start in range(0, len(values), step):
        a, z = np.searchsorted(column, [start, start + step])
        has = np.zeros((len(parts), step), np.float32)
        has[owner[a:z], column[a:z] - start] = 1
        total += (has[left] @ has[right].T).astype(np.uint32)
    return pd.DataFrame({
        "one": [key[0]], "two": [key[1]], "counts": [zlib.compress(total.tobytes(), 1)],
        "docs": [group["doc"].to_numpy(np.int64).tobytes()],
        "sizes": [group["n"].to_numpy(np.int64).tobytes()], "sides": [group["side"].to_numpy(np.int64).tobytes()]})


def _block_links(percent: int):
    def run(key: tuple, group):
        """Sum the fragments; return a spanning forest of the links between the two blocks."""
        import pandas as pd
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64) for c in group["counts"])
        docs, n, side = (np.frombuffer(group[c].iloc[0], np.int64) for c in ("docs", "sizes", "sides"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
        common = total.reshape(len(left), len(right))
        union = n[left][:, None] + n[right][None, :] - common
        rows, columns = np.nonzero(100 * common >= percent * union)
        root = list(range(len(docs)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = []
        for i, j in zip(left[rows].tolist(), right[columns].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                links.append((docs[i], docs[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def block_links(meet: DataFrame, members: DataFrame, texts: DataFrame, percent: int, size: int,
                fragments: int, order) -> DataFrame:
    """Links between pairs of blocks, as a spanning forest of each."""
    homes = members.join(_sides(meet).select("block").distinct(), "block", "left_semi") \
        .select("doc", "f1", "block").distinct()
    sets = contents(texts.join(homes.select(F.col("doc").alias("key"), "f1"), "key"), size, fragments, order)
    return (sets.join(homes, ["doc", "f1"]).join(_sides(meet), "block")
            .select("one", "two", "fragment", "side", "doc", "f1", "n", "keys")
            .groupBy("one", "two", "fragment")
            .applyInPandas(lambda key, group: _block_counts(key, group),
                           "one long, two long, counts binary, docs binary, sizes binary, sides binary")
            .groupBy("one", "two").applyInPandas(_block_links(percent), "a long, b long"))


def _keys(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x_doc").alias("key")).union(pairs.select("y_doc"))


def similar_texts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3,
                  percent: int = 90, fragments: int = 4, least: int = 4, most: int = 32,
                  block_sets: int = 256, dense: int = 8) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links).

    ``percent``: two sets link when 100 * common >= percent * union.  ``least``: shingles that candidates
    must share in their prefixes.  ``most``: buckets of more
    sets are compared block against block rather than as rows of pairs.  ``dense``: blocks with more
    possible links a set than this count all their pairs together.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    measured = shared.stored(
        texts.mapInArrow(_measure(size), "key long, n long, f1 long, f2 long, bits binary, part long, counts binary"), "sets")
    order = spark.sparkContext.broadcast(order_of(measured))  # PLACES bytes
    prefixes = shared.stored(texts.mapInArrow(
        _prefixes(size, percent, least, order), "shingle long, f1 long, place long, doc long"), "prefixes")
    found = shared.stored(buckets(prefixes), "buckets")
    pairs = shared.stored(small_pairs(found, percent, most, least), "pairs")
    members = shared.stored(blocks_of(found, most, block_sets, percent), "blocks")
    maps = (measured.where("part is null and n > 0 and key is not null")
            .select(F.col("key").alias("doc"), "f1", "bits").dropDuplicates(["doc", "f1"]))
    in_blocks = shared.stored(near_blocks(members, maps, percent, dense), "near_in_blocks")
    near = shared.stored(near_pairs(pairs, maps, percent).union(
        in_blocks.where("not dense").select(*_PAIR)).distinct(), "near")
    meet = in_blocks.where("dense").select("one", "two")
    crowded = members.join(_sides(meet).select("block").distinct(), "block", "left_semi").select("doc")
    # texts are smaller than their sets, so these travel and are stored in place of the sets
    needed = shared.small_if_counted(_keys(near).union(crowded).distinct(), "needed")
    wanted = shared.stored(texts.join(needed, "key", "left_semi").distinct(), "texts")
    cut = (percent, size, fragments, order)
    links = pair_links(near, wanted, *cut).union(block_links(meet, members, wanted, *cut))
    reached = components(links)

    sets = measured.where("part is null").drop("bits", "part", "counts")
    classes = (sets.where("n > 0 and key is not null").groupBy("n", "f1", "f2").agg(F.min("key").alias("first"))
               .join(reached, F.col("first") == F.col("node"), "left")
               .select("n", "f1", "f2", F.coalesce("component", "first").alias("component")))
    return (sets.join(classes, ["n", "f1", "f2"], "left")
            .select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("key").isNotNull(), F.coalesce("component", "key")).alias("component_id")))
