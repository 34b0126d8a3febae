"""Near-duplicate vectors by a forest of random-projection trees with spill.

1. Equal vectors of one label are one class with a weight.
2. Trees are fitted on a bounded sample: each node has a random direction and a place among the
   sample's projections, near the median; vectors in a band around it (``spill`` of the sample) go
   both ways.  Depth grows with the logarithm of the table.  A node in which every split would part
   too many links, such as a group of near copies, is left whole whatever its size.
3. Every class is routed down every tree.  Classes that share a leaf are compared in double
   precision; a leaf of more than ``block_rows`` classes is compared block against block.
   A pair that meets in several leaves counts in the smallest one only, so no list of pairs is made.
4. Links are joined to components.

Edge cases: a vector that is null, zero, of null label, or with a null or non-finite component
links with nothing, and neither do vectors of different length or a row without id; repeated rows
are vectors of their own and link; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared
from cadastre.llm.components import components


#: share of links at the threshold that one split may lose; without such a split a node stays a leaf
_MOST_LOST = 0.06
#: directions tried at a node, and the shares of its sample below the split, the even one first
_TRIES = 8
_PLACES = (0.5, 0.44, 0.56, 0.38, 0.62, 0.31, 0.69, 0.25, 0.75)


class Tree:
    """A binary tree of random splits that do not run through groups of near copies.

    A split that would part too many links (of all sample rows, of those with links among the
    sample, or of these by their number of links) is not made.  ``depth`` gives the size of the
    leaves, that of a tree of even splits; a leaf that no split fits is larger.
    """

    def __init__(self, sample: np.ndarray, degree: np.ndarray, depth: int, spill: float, threshold: float,
                 rng: np.random.Generator):
        goal = len(sample) * ((1 + spill) / 2) ** depth
        # projections of two vectors at the threshold differ by a normal deviate of this size
        apart = math.sqrt(max(2 - 2 * threshold, 1e-12))
        self.split, normals, low, high, children = [-1], [], [], [], []
        open_nodes = [(0, np.arange(len(sample)))] if depth else []
        while open_nodes:
            node, rows = open_nodes.pop()
            found = _best_split(sample[rows], degree[rows], spill, apart, rng) if len(rows) > goal else None
            if found is None:
                continue
            normal, below, middle, above, at = found
            self.split[node] = len(normals)
            normals.append(normal)
            low.append(below)
            high.append(above)
            children.append((len(self.split), len(self.split) + 1))
            self.split += [-1, -1]
            open_nodes += [(children[-1][0], rows[at < middle]), (children[-1][1], rows[at >= middle])]
        self.split = np.array(self.split)
        self.normals = np.array(normals, np.float32).reshape(-1, sample.shape[1])
        self.low, self.high = np.array(low), np.array(high)
        self.children = np.array(children, np.int64).reshape(-1, 2)

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each vector reaches."""
        rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        out_rows, out_leaves = [], []
        while len(rows):
            split = self.split[nodes]
            ended = split < 0
            out_rows.append(rows[ended])
            out_leaves.append(nodes[ended])
            rows, split = rows[~ended], split[~ended]
            at = np.einsum("ij,ij->i", vectors[rows], self.normals[split])
            left, right = at <= self.high[split], at >= self.low[split]
            rows = np.concatenate([rows[left], rows[right]])
            nodes = np.concatenate([self.children[split[left], 0], self.children[split[right], 1]])
        if not out_rows:
            return rows, nodes
        return np.concatenate(out_rows), np.concatenate(out_leaves)


def _best_split(sample: np.ndarray, degree: np.ndarray, spill: float, apart: float, rng: np.random.Generator):
    """The evenest split that loses few links: normal, low, middle, high, projections; or None."""
    normals = rng.standard_normal((_TRIES, sample.shape[1])).astype(np.float32)
    projected = sample @ normals.T
    some = slice(None, None, max(1, len(sample) // 512))
    linked = degree[some]
    for place in _PLACES:
        bands = np.quantile(projected, [place - spill / 2, place, place + spill / 2], axis=0)
        x = projected[some]
        # chance that a partner at the threshold lies beyond the band, by a logistic curve
        beyond = np.where(x < bands[0], bands[2] - x, np.where(x > bands[2], x - bands[0], np.inf))
        lost = 1 / (1 + np.exp(np.minimum(1.702 * beyond / apart, 60)))
        lost[np.isinf(beyond)] = 0
        worst = lost.mean(axis=0)
        if linked.any():
            worst = np.maximum(worst, lost[linked > 0].mean(axis=0))
            worst = np.maximum(worst, linked @ lost / linked.sum())
        k = int(worst.argmin())
        if worst[k] <= _MOST_LOST and (projected[:, k] < bands[1, k]).any():
            return normals[k], bands[0, k], bands[1, k], bands[2, k], projected[:, k]
    return None


def fit(sample: np.ndarray, trees: int, depth: int, spill: float, threshold: float, seed: int) -> list[Tree]:
    rng = np.random.default_rng(seed)
    sample = sample.astype(np.float32)
    degree = np.zeros(len(sample), np.int64)
    if depth:
        for a in range(0, len(sample), 1024):
            degree[a:a + 1024] = (sample[a:a + 1024] @ sample.T >= threshold).sum(axis=1) - 1
        degree = np.maximum(degree, 0)
    return [Tree(sample, degree, depth, spill, threshold, rng) for _ in range(trees)]


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(lists), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _router(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for block in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
            unit = _matrix(block.column("vector")).astype(np.float32)
            rows, leaves = [], []
            for t, tree in enumerate(trees):
                r, leaf = tree.route(unit)
                rows.append(r)
                leaves.append(leaf | t << 32)
            row, leaf = np.concatenate(rows), np.concatenate(leaves)
            order = np.lexsort([leaf, row])
            row, leaf = row[order], leaf[order]
            bounds = np.searchsorted(row, np.arange(block.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.ListArray.from_arrays(bounds, pa.array(leaf))],
                names=[*block.schema.names, "leaves"])
    return run


def _compare(threshold: float):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Weights linked to each class of a leaf, and a spanning forest of the links."""
        leaf, one, two = (k.as_py() for k in key)
        ids = group.column("class").to_numpy()
        label, weight = group.column("label").to_numpy(), group.column("weight").to_numpy()
        part = group.column("part").to_numpy()
        unit = _matrix(group.column("vector").combine_chunks())
        own = group.column("leaves").combine_chunks()
        flat, bounds = own.flatten().to_numpy(), own.offsets.to_numpy()
        bounds = bounds - bounds[0]
        width = int(np.diff(bounds).max())
        table = np.full((len(ids), width), -1, np.int64)
        table[np.repeat(np.arange(len(ids)), np.diff(bounds)),
              np.arange(len(flat)) - np.repeat(bounds[:-1], np.diff(bounds))] = flat
        gained = np.zeros(len(ids), np.int64)
        root = list(range(len(ids)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        links = []
        for value in np.unique(label):
            rows = np.flatnonzero(label == value)
            for a in range(0, len(rows), 512):
                left = rows[a:a + 512]
                i, j = np.nonzero(unit[left] @ unit[rows[a:]].T >= threshold)
                i, j = left[i], rows[a:][j]
                keep = i < j
                if one != two:
                    keep &= part[i] != part[j]
                i, j = i[keep], j[keep]
                for s in range(0, len(i), 20_000):
                    p, q = i[s:s + 20_000], j[s:s + 20_000]
                    earlier = (table[p] >= 0) & (table[p] < leaf)
                    met = ((table[p][:, :, None] == table[q][:, None, :]) & earlier[:, :, None]).any(axis=(1, 2))
                    p, q = p[~met], q[~met]
                    np.add.at(gained, p, weight[q])
                    np.add.at(gained, q, weight[p])
                    at = np.array([find(x) for x in range(len(ids))])
                    new = at[p] != at[q]  # pairs already connected need no step
                    for x, y in zip(p[new].tolist(), q[new].tolist()):
                        u, v = find(x), find(y)
                        if u != v:
                            root[u] = v
                            links.append((x, y))
        linked = np.flatnonzero(gained)
        x = np.array([a for a, _ in links], np.int64)
        y = np.array([b for _, b in links], np.int64)
        return pa.table({
            "a": np.concatenate([ids[linked], ids[x]]), "gained": np.concatenate([gained[linked], np.zeros_like(x)]),
            "b": pa.array(np.concatenate([ids[linked], ids[y]]))})
    return run


def near_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label", threshold: float = 0.93, trees: int = 8, spill: float = 0.12,
                 leaf_rows: int = 512, deepest: int = 12, sample_rows: int = 8192,
                 block_rows: int = 1024, seed: int = 7) -> DataFrame:
    """Per row: key, n_links, component_id, kept (the row is its component's smallest).

    ``sample_rows``: trees are fitted on so many classes at most; every class is indexed.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"),
                          F.col(vector).cast("array<double>").alias("vector"),
                          F.col(label).cast("long").alias("label"))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = shared.stored(
        good.groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight")),
        "vector-classes")
    sizes = [r[0] for r in classes.select(F.size("vector")).distinct().toLocalIterator()]
    found = None
    for size in sizes:  # as a rule one
        own = classes.where(F.size("vector") == size)
        compared = _leaves(own, trees, spill, threshold, leaf_rows, deepest, sample_rows, block_rows, seed) \
            .groupBy("leaf", "one", "two").applyInArrow(_compare(threshold), "a long, gained long, b long")
        found = compared if found is None else found.union(compared)
    if found is None:
        found = spark.createDataFrame([], "a long, gained long, b long")
    found = shared.stored(found, "vector-links")
    gained = found.where("gained > 0").groupBy(F.col("a").alias("first")).agg(F.sum("gained").alias("gained"))
    reached = components(found.where("gained = 0").select("a", "b"))
    linked = (classes.join(gained, F.col("vec_id") == F.col("first"), "left")
              .join(reached, F.col("vec_id") == F.col("node"), "left")
              .select("label", "vector",
                      (F.col("weight") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id")))
    placed = good.join(linked, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                       F.col("vec_id").alias("component_id"))
    return placed.union(alone).select(
        F.col("vec_id").alias(key), "n_links", "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _leaves(classes: DataFrame, trees: int, spill: float, threshold: float, leaf_rows: int, deepest: int,
            sample_rows: int, block_rows: int, seed: int) -> DataFrame:
    """Every class in each leaf it reaches, with the blocks of that leaf it is compared in."""
    n = classes.count()
    sample = classes.select("vector").orderBy(F.xxhash64("vec_id")).limit(sample_rows).toArrow()
    unit = _matrix(sample.column("vector").combine_chunks())
    depth = min(deepest, max(0, math.ceil(math.log2(max(1, n) / leaf_rows))))
    forest = classes.sparkSession.sparkContext.broadcast(fit(unit, trees, depth, spill, threshold, seed))
    routed = shared.stored(
        classes.select("vec_id", "label", "weight", "vector").mapInArrow(
            _router(forest), "vec_id long, label long, weight long, vector array<double>, leaves array<long>"),
        "vector-leaves")
    at = routed.select(F.col("vec_id").alias("class"), "label", "weight", "vector", "leaves",
                       F.explode("leaves").alias("leaf"))
    counts = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    split = at.join(counts, "leaf").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    return split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "leaf", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"),
        "class", "label", "weight", "part", "vector", "leaves")
