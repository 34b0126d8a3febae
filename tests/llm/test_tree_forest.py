"""Links inside a large group of distinct near copies, with trees that are deep for the table."""

import numpy as np

from cadastre.llm import shared, tree_forest


def test_deep_trees_keep_the_links_of_a_large_group(spark):
    rng = np.random.default_rng(8)
    unit = rng.standard_normal((3000, 32))
    centre = rng.standard_normal(32)
    unit[:1000] = centre / np.linalg.norm(centre) + rng.standard_normal((1000, 32)) * (1 / 0.95 - 1) ** 0.5 / 32 ** 0.5
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    shared.work_folder(spark)
    vectors = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(unit)],
                                    "vec_id long, embedding array<double>, label int")
    depth = 9  # ceil(log2(3000 / 8))
    got = {r["vec_id"]: r["n_links"] for r in tree_forest.near_vectors(vectors, leaf_rows=8).collect()}
    assert 2 ** (depth - 1) < 3000 / 8 <= 2 ** depth
    hot = sum(got[i] for i in range(1000))
    assert all(got[i] <= want[i] for i in got)
    assert hot >= 0.99 * want[:1000].sum()


def test_a_group_stays_whole_but_scattered_vectors_are_split():
    rng = np.random.default_rng(9)
    unit = rng.standard_normal((4096, 32))
    unit[:1400] = rng.standard_normal(32) + 0.2 * rng.standard_normal((1400, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for tree in tree_forest.fit(unit, 4, 8, 0.12, 0.93, 3):
        rows, leaves = tree.route(unit.astype(np.float32))
        assert np.bincount(leaves[rows < 1400]).max() >= 1300
        assert np.median(np.bincount(leaves)[np.unique(leaves)]) < 400
