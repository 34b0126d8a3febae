"""Quality classifier: a sparse ensemble of rules taken from trees.

Shallow trees are grown on random parts of the labelled statistics; every path from a root is a
rule (a conjunction of thresholds).  A lasso logistic regression weighs the rules, most get weight
zero, and the rest is compiled to one Spark expression.  Trees and weights are fitted on the driver
over at most ``sample_rows`` rows of a few numbers; scoring is Spark columns only.

Edge cases: a null or empty text has all statistics 0 and is scored like any other; without
labelled rows of both classes the score is the share of label 1 (0.5 without labels); repeated rows score alike; a null key is
kept; an empty table gives no row; other columns of the table do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.llm import text_stats
from cadastre.llm.text_stats import FEATURES

#: (feature number, above, edge) of each condition
Path = tuple[tuple[int, bool, float], ...]


@dataclass
class RuleModel:
    rules: list[Path]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            holds = F.lit(True)
            for f, above, edge in rule:
                value = F.col(FEATURES[f]).cast("double")
                holds = holds & (value > edge if above else value <= edge)
            total = total + F.when(holds, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{FEATURES[f]} {'>' if a else '<='} {e:g}" for f, a, e in r)
                for w, r in sorted(zip(self.weights, self.rules), key=lambda x: -abs(x[0]))]


def _paths(x: np.ndarray, y: np.ndarray, depth: int, leaf: int, rng: np.random.Generator,
           head: Path = ()) -> list[Path]:
    """All paths of a tree grown by Gini impurity on a random half of the features."""
    out = [head] if head else []
    if depth == 0 or len(y) < 2 * leaf or y.min() == y.max():
        return out
    best, at = 1e-9, None
    whole = y.mean() * (1 - y.mean())
    for f in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, s = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(v))
        left, right = s[:-1] / n, (s[-1] - s[:-1]) / (len(v) - n)
        gain = whole - (n * left * (1 - left) + (len(v) - n) * right * (1 - right)) / len(v)
        gain[(v[1:] == v[:-1]) | (n < leaf) | (len(v) - n < leaf)] = 0
        k = int(np.argmax(gain)) if len(gain) else 0
        if len(gain) and gain[k] > best:
            best, at = gain[k], (int(f), float((v[k] + v[k + 1]) / 2))
    if at is None:
        return out
    f, edge = at
    low = x[:, f] <= edge
    return (out + _paths(x[low], y[low], depth - 1, leaf, rng, head + ((f, False, edge),))
            + _paths(x[~low], y[~low], depth - 1, leaf, rng, head + ((f, True, edge),)))


def _holds(rule: Path, x: np.ndarray) -> np.ndarray:
    result = np.ones(len(x), bool)
    for f, above, edge in rule:
        result &= x[:, f] > edge if above else x[:, f] <= edge
    return result


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, leaf: int = 10,
        penalty: float = 0.002, steps: int = 400, seed: int = 11) -> RuleModel:
    """Rules of random trees, weighed by lasso logistic regression (accelerated proximal steps)."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel([], [], float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    rules: dict[bytes, Path] = {}
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        for path in _paths(x[rows], y[rows], depth, leaf, rng):
            held = _holds(path, x)
            if held.any() and not held.all():
                rules.setdefault(np.packbits(held).tobytes(), path)
    paths = list(rules.values())
    a = np.stack([_holds(p, x) for p in paths], axis=1).astype(np.float64)
    # both classes weigh the same while weights are learned; the intercept returns to their shares
    each = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    w, b = np.zeros(a.shape[1]), 0.0
    z, zb, t = w, b, 1.0
    step = 4.0 / (np.einsum("ij,ij,i->", a, a, each) + 1)
    for _ in range(steps):
        error = each * (1 / (1 + np.exp(-(a @ z + zb))) - y)
        new = z - step * (a.T @ error)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = zb - step * error.sum()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, zb = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new, new_b
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleModel([paths[k] for k in kept], [float(w[k]) for k in kept], float(b))


def learn_from(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, **options) -> RuleModel:
    """Fit on at most ``sample_rows`` labelled, not held-out documents."""
    sample = text_stats.labelled_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                                        labels, "quality", sample_rows)
    rows = text_stats.add_features(sample).select("doc_id", "label", *FEATURES).toPandas() \
        .sort_values("doc_id")
    return fit(rows[list(FEATURES)].to_numpy(np.float64), rows["label"].to_numpy(np.float64), **options)


def score_texts(docs: DataFrame, model: RuleModel, *, key: str = "doc_id", text: str = "text",
                threshold: float = 0.7) -> DataFrame:
    """Per row: key, held_out, score (0 to 1), predicted (1 if score >= threshold)."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return (text_stats.add_features(picked).withColumn("score", model.score())
            .select(F.col("doc_id").alias(key), text_stats.held_out(F.col("doc_id")).alias("held_out"),
                    "score", (F.col("score") >= threshold).cast("int").alias("predicted")))
