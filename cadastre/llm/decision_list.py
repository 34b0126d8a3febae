"""Quality rules: an ordered list of threshold conjunctions learned by sequential covering.

Statistics of labelled texts are cut into bins.  A rule grows by the condition (statistic above or
not above a bin's edge) of highest gain over the growing part of the labelled rows, until it covers
no good text or has ``conditions`` of them; its tail is pruned while that helps on the other part.
Rows that it covers go, and the next rule is learned from the rest.  Every step is one grouped
count; the result is an ordered list of Spark conditions.

Edge cases: a null or word-free text has all counts 0 and fails the base rule; without labelled
rows the list is empty and the base rule alone decides; repeated rows are judged alike; a null key
is kept; other columns of the table do not matter; an empty table gives no row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared, text_stats
from cadastre.llm.text_stats import FEATURES


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    edge: float
    bin: int

    def on(self, binned: bool = False) -> Column:
        value, edge = (F.col(f"bin_{self.feature}"), self.bin) if binned else (F.col(self.feature), self.edge)
        return value > edge if self.above else value <= edge

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.edge:g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, binned: bool = False) -> Column:
    result = F.lit(True)
    for condition in rule:
        result = result & condition.on(binned)
    return result


def _gain(p: int, n: int, p_all: int, n_all: int) -> float:
    """Information gained on the bad texts kept (FOIL)."""
    if not p:
        return -1.0
    return p * (math.log2((p + 1e-9) / (p + n + 1e-9)) - math.log2((p_all + 1e-9) / (p_all + n_all + 1e-9)))


def learn(sample: DataFrame, *, features: tuple[str, ...] = FEATURES, bins: int = 32, rules: int = 8,
          conditions: int = 3, least: int = 5, precision: float = 0.9) -> list[Rule]:
    """Rules for label 0, best first.  ``sample``: the features and ``label``."""
    edges = dict(zip(features, sample.agg(*(
        F.percentile_approx(f, [k / bins for k in range(1, bins)], 1000).alias(f) for f in features)).first()))
    if any(e is None for e in edges.values()):
        return []
    edges = {f: sorted(set(e)) for f, e in edges.items()}
    binned = shared.stored(sample.select(
        "label", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("growing"),
        *(sum((F.when(F.col(f) > e, 1).otherwise(0) for e in edges[f]), F.lit(0)).alias(f"bin_{f}")
          for f in features)), "rule-bins")
    found: list[Rule] = []
    while len(found) < rules:
        rest = binned
        for rule in found:
            rest = rest.where(~_all(rule, True))
        rule = _grow(rest.where("growing"), features, edges, conditions, least)
        if rule:
            rule = _prune(rest.where("not growing"), rule, precision)
        if not rule:
            break
        found.append(rule)
    return found


def _grow(rows: DataFrame, features: tuple[str, ...], edges: dict[str, list[float]], most: int,
          least: int) -> Rule:
    rule: Rule = ()
    while len(rule) < most:
        pairs = rows.where(_all(rule, True)).select(
            "label", F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"bin_{f}").alias("b"))
                                         for f in features))).alias("x"))
        counts: dict[str, dict[int, list[int]]] = {f: {} for f in features}
        for r in pairs.groupBy("x.f", "x.b", "label").count().toLocalIterator():  # features x bins
            counts[r["f"]].setdefault(r["b"], [0, 0])[r["label"]] += r["count"]
        p_all, n_all = (sum(c[k] for c in counts[features[0]].values()) for k in (0, 1))
        if not n_all and rule or not p_all:
            break
        best, gain = None, 1e-6
        for f in features:
            p = n = 0
            for b, edge in enumerate(edges[f]):
                own = counts[f].get(b, [0, 0])
                p, n = p + own[0], n + own[1]
                for above, p_, n_ in ((False, p, n), (True, p_all - p, n_all - n)):
                    if p_ >= least and (g := _gain(p_, n_, p_all, n_all)) > gain:
                        best, gain = Condition(f, above, float(edge), b), g
        if best is None:
            break
        rule += (best,)
    return rule


def _prune(rows: DataFrame, rule: Rule, precision: float) -> Rule:
    """The prefix of the rule of highest worth on rows it did not grow from; none if it errs too often."""
    counts = rows.agg(*(F.count_if(_all(rule[:k], True) & (F.col("label") == v)).alias(f"c{k}_{v}")
                        for k in range(1, len(rule) + 1) for v in (0, 1))).first()
    best, worth = (), -1.0
    for k in range(1, len(rule) + 1):
        p, n = counts[f"c{k}_0"], counts[f"c{k}_1"]
        if p and p / (p + n) >= precision and (p - n) / (p + n) + 1e-4 * p / (p + 1) > worth:
            best, worth = rule[:k], (p - n) / (p + n) + 1e-4 * p / (p + 1)
    return best


def first_match(rules: list[Rule]) -> Column:
    """1-based number of the first rule that holds, or 0."""
    result = None
    for k, rule in enumerate(rules, 1):
        result = F.when(_all(rule), k) if result is None else result.when(_all(rule), k)
    return F.lit(0) if result is None else result.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule], *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the counts, base_failed, kept, and the number of the rule that rejects it."""
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (text_stats.add_features(picked)
            .withColumn("base_failed", base).withColumn("rule", first_match(rules))
            .select(F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule"))


def learn_from(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 20_000, **options) -> list[Rule]:
    """Learn from at most ``sample_rows`` labelled, not held-out documents."""
    sample = text_stats.labelled_sample(docs.select("doc_id", F.col("text").cast("string").alias("text")),
                                        labels, "quality", sample_rows)
    stats = text_stats.add_features(sample).select("doc_id", "label", *FEATURES)
    return learn(shared.stored(stats, "rule-sample"), **options)
