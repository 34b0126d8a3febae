"""Result frames of the load strategies.

Each function returns the rows the target should hold (or receive) with an
``_action`` column, so that one write yields both the table and its counts.

Shape of the joins: the stored table is always the streamed (left) side and
the incoming batch the side looked up, or only the *keys* of the stored table
are looked up.  A batch small enough to broadcast therefore never shuffles the
stored table, and when both are large adaptive execution may split a skewed
left side, which a full outer join would not allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "_action"


def _distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # grouped, hence combined before the shuffle: a hot key costs one row per task
    return df.where(_all_present(keys)).select(*keys).distinct()


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows without a match in the target; NULL keys never match.

    Of the stored keys only those that the source has are made distinct and looked up, so a batch that
    can be broadcast leaves the stored table unshuffled.  The source is read twice: store it first
    where it is costly to compute, as the loads do.
    """
    wanted = source.where(_all_present(keys)).select(*keys)
    known = target.select(*keys).join(wanted, list(keys), "left_semi")
    return source.join(_distinct_keys(known, keys), list(keys), "left_anti")


def missing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows the source no longer has: the delete set of a synchronising load."""
    return target.join(_distinct_keys(source, keys), list(keys), "left_anti")


def full_load(source: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    return source.withColumns({**defaults, ACTION: F.lit("insert")})


def incremental_load(source: DataFrame, target: DataFrame, keys: Sequence[str],
                     defaults: dict[str, Column]) -> DataFrame:
    """Only the rows to append; rows already stored are left alone."""
    return full_load(new_rows(source, target, keys), defaults)


def upsert_load(source: DataFrame, target: DataFrame, keys: Sequence[str],
                defaults: dict[str, Column]) -> DataFrame:
    """Stored rows, updated where the source has their key, plus the new rows.

    Columns with a default keep their stored value on update.  The source must
    hold each matched key once, see :func:`repeated_source_keys`.
    """
    data = [c for c in source.columns if c not in keys]
    incoming = source.where(_all_present(keys)).select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in data], F.lit(True).alias("__found"))
    hit = F.coalesce(F.col("__found"), F.lit(False))
    stored = target.join(incoming, list(keys), "left").select(
        *[F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in data else F.col(c)
          for c in target.columns],
        F.when(hit, "update").otherwise("keep").alias(ACTION))
    added = incremental_load(source, target, keys, defaults)
    return stored.unionByName(added)


def sync_load(source: DataFrame, target: DataFrame, keys: Sequence[str],
              defaults: dict[str, Column], touch: bool = False) -> DataFrame:
    """Make the target equal to the source; rows missing from it disappear.

    Columns with a default keep the stored value for known keys unless
    ``touch`` renews them.  The stored side is reduced to one row per key
    before the join.
    """
    kept = list(defaults)
    stored = target.where(_all_present(keys)).groupBy(*keys).agg(
        *[F.min(c).alias(f"__old_{c}") for c in kept], F.lit(True).alias("__found"))
    joined = source.join(stored, list(keys), "left")
    values = {
        c: defaults[c] if touch else F.coalesce(F.col(f"__old_{c}"), defaults[c]) for c in kept}
    return joined.select(
        *[F.col(c) for c in source.columns],
        *[v.alias(c) for c, v in values.items()],
        F.when(F.col("__found"), "update").otherwise("insert").alias(ACTION))


def repeated_source_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys the source holds more than once and the target holds at all."""
    repeated = (source.where(_all_present(keys)).groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return repeated.join(_distinct_keys(target, keys), list(keys), "left_semi")


def classify_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides and the resulting action.

    Both sides are tagged, stacked and grouped: one shuffle of pre-aggregated
    keys and no join, whatever the key distribution.  NULL keys match nothing,
    so they are counted on their own side only.
    """
    tagged = (source.select(*keys, F.lit(1).alias("s"), F.lit(0).alias("t"))
              .unionByName(target.select(*keys, F.lit(0).alias("s"), F.lit(1).alias("t"))))
    matchable = _all_present(keys)
    side = F.when(matchable, F.lit(0)).otherwise(F.col("s"))
    counted = tagged.groupBy(*keys, side.alias("__side")).agg(
        F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows"))
    action = (F.when((F.col("source_rows") > 0) & (F.col("target_rows") > 0), "update")
              .when(F.col("source_rows") > 0, "insert").otherwise("delete"))
    return counted.select(*keys, "source_rows", "target_rows", action.alias("action"))


def compare_digests(source: DataFrame, target: DataFrame, keys: Sequence[str], unit: str,
                    digest: str) -> DataFrame:
    """Per unit: rows inserted, updated (changed or not) and deleted, whether it must be rewritten, and
    whether the source repeats a stored key.

    Only keys and digests are read.  Both sides are stacked and grouped by key: one shuffle of
    pre-aggregated rows.  A row that moved touches both units, but counts once, as updated.  NULL keys
    match nothing.
    """
    def side(rows: DataFrame, s: int) -> DataFrame:
        return rows.select(*keys, unit, digest, F.lit(s).alias("s"), F.lit(1 - s).alias("t"))

    tagged = side(source, 1).unionByName(side(target, 0))
    matchable = _all_present(keys)
    grouped = tagged.groupBy(*keys, F.when(matchable, F.lit(0)).otherwise(F.col("s")).alias("__side")).agg(
        F.sum("s").alias("s"), F.sum("t").alias("t"),
        *[F.collect_set(F.when(F.col(c) == 1, F.col(unit))).alias(f"__{c}_unit") for c in ("s", "t")],
        F.min(digest).alias("__low"), F.max(digest).alias("__high"), F.count(digest).alias("__n"))
    both = (F.col("s") > 0) & (F.col("t") > 0)
    same = (both & (F.col("s") == 1) & (F.col("t") == 1) & (F.col("__n") == 2)
            & (F.col("__low") == F.col("__high")) & (F.col("__s_unit") == F.col("__t_unit")))
    named = grouped.select(
        F.explode(F.array_union("__s_unit", "__t_unit")).alias("unit"), "s", "t", "__s_unit", "__t_unit",
        both.alias("both"), same.alias("same"), (both & (F.col("s") > 1)).alias("repeated"))
    # a key counts in one of the units it is in
    counted = F.col("unit") == F.coalesce(F.array_min("__s_unit"), F.array_min("__t_unit"))
    return named.groupBy("unit").agg(
        F.sum(F.when(counted & ~F.col("both"), F.col("s")).otherwise(0)).alias("inserted"),
        F.sum(F.when(counted & F.col("both"), F.col("s")).otherwise(0)).alias("updated"),
        F.sum(F.when(counted, F.col("t") - F.when(F.col("both"), F.col("s")).otherwise(0)).otherwise(0))
        .alias("deleted"),
        F.max(~F.col("same")).alias("touched"), F.max("repeated").alias("repeated"))


def action_counts(result: DataFrame) -> DataFrame:
    """Inserted, updated and affected rows of a load result in one row."""
    inserted = F.count_if(F.col(ACTION) == "insert")
    updated = F.count_if(F.col(ACTION) == "update")
    return result.agg(inserted.alias("inserted"), updated.alias("updated"),
                      (inserted + updated).alias("affected"))
