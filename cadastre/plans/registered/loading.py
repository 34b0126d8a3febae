"""Load strategies on a stored table and a newer source.

The stored table is what an earlier load would have left: the transactions
loaded before 1998 with an older price, plus some that were withdrawn since.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastre.operators import clean, features as feature_ops, merge
from cadastre.plans.registered import base
from cadastre.plans.registered.base import query, raw_tx, sql_clean, sql_dedup, sql_features, staging
from cadastre.session import key_slices, slice_count, stored

KEYS = ["id"]
NOW, EARLIER = "2026-01-01 00:00:00", "2001-01-01 00:00:00"

_STORED_SQL = f"""
, early AS (SELECT * FROM priced WHERE _loaded_at < TIMESTAMP '1998-01-01 00:00:00'
), early_latest AS ({sql_dedup('early')}
), early_clean AS ({sql_clean('early_latest')}
), stored AS (
 SELECT * REPLACE (precio_cop - 1 AS precio_cop), TIMESTAMP '{EARLIER}' AS _loaded_at FROM early_clean
 UNION ALL
 SELECT * REPLACE (concat('w-', id) AS id), TIMESTAMP '{EARLIER}' FROM early_clean
 WHERE estado = 'publicada')"""


def _stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def _early(spark, sf):
    return clean.clean_transactions(
        raw_tx(spark, sf).where(F.col("_loaded_at") < _stamp("1998-01-01 00:00:00")))


def stored_staging(spark, sf):
    return _stored_copies(_early(spark, sf))


def _stored_copies(early):
    # both copies of a row come from one pass; a union would clean and deduplicate twice
    older = F.struct("id", (F.col("precio_cop") - 1).alias("precio_cop"))
    withdrawn = F.struct(F.concat(F.lit("w-"), F.col("id")).alias("id"), "precio_cop")
    copies = F.when(F.col("estado") == "publicada", F.array(older, withdrawn)).otherwise(F.array(older))
    rest = [c for c in early.columns if c not in ("id", "precio_cop")]
    return early.select(*rest, F.inline(copies)).select(*early.columns, _stamp(EARLIER).alias("_loaded_at"))


def _defaults(column="_loaded_at"):
    return {column: _stamp(NOW)}


def _in_slices(spark, sf, load):
    """``load`` of source and stored table, both stored, slice by slice of the keys and stored.

    No two slices share a key, so the shuffles on disk at one time are those of one slice.
    """
    source = staging(spark, sf)
    count = slice_count(source)
    source = stored(*key_slices(source, KEYS, count))
    target = stored(*map(_stored_copies, key_slices(_early(spark, sf), KEYS, count)))
    loaded = [load(s, t) for s, t in zip(key_slices(source, KEYS, count), key_slices(target, KEYS, count))]
    return stored(*loaded) if count > 1 else loaded[0]


@query("load_full", f"SELECT *, TIMESTAMP '{NOW}' AS _loaded_at FROM staging")
def load_full(spark, sf):
    return merge.full_load(staging(spark, sf), _defaults()).drop(merge.ACTION)


@query("load_incremental", f"""{_STORED_SQL}
SELECT * FROM stored UNION ALL SELECT s.*, TIMESTAMP '{NOW}' AS _loaded_at FROM staging s
WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.id = s.id)""")
def load_incremental(spark, sf):
    def load(source, target):
        added = merge.incremental_load(source, target, KEYS, _defaults())
        return target.unionByName(added.drop(merge.ACTION))

    return _in_slices(spark, sf, load)


_UPSERT_SQL = f"""{_STORED_SQL}
, upserted AS (
 SELECT s.*, t._loaded_at, 'update' AS _action FROM staging s JOIN stored t ON s.id = t.id
 UNION ALL SELECT t.*, 'keep' FROM stored t WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.id = t.id)
 UNION ALL SELECT s.*, TIMESTAMP '{NOW}', 'insert' FROM staging s
 WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.id = s.id))"""


@query("load_upsert", f"{_UPSERT_SQL} SELECT * EXCLUDE (_action) FROM upserted")
def load_upsert(spark, sf):
    return _in_slices(spark, sf, lambda source, target: merge.upsert_load(
        source, target, KEYS, _defaults()).drop(merge.ACTION))


@query("merge_counts", f"""{_UPSERT_SQL}
SELECT count(*) FILTER (_action = 'insert') AS inserted, count(*) FILTER (_action = 'update') AS updated,
 count(*) FILTER (_action IN ('insert', 'update')) AS affected FROM upserted""")
def merge_counts(spark, sf):
    # actions depend on the keys alone
    return merge.action_counts(merge.upsert_load(
        stored(staging(spark, sf).select(*KEYS)),
        stored(stored_staging(spark, sf).select(*KEYS, "_loaded_at")), KEYS, _defaults()))


@query("merge_classify", f"""{_STORED_SQL}
SELECT coalesce(s.id, t.id) AS id, CAST(count(DISTINCT s.id) AS BIGINT) AS source_rows,
 CAST(count(DISTINCT t.id) AS BIGINT) AS target_rows,
 CASE WHEN any_value(s.id) IS NOT NULL AND any_value(t.id) IS NOT NULL THEN 'update'
  WHEN any_value(s.id) IS NOT NULL THEN 'insert' ELSE 'delete' END AS action
FROM staging s FULL JOIN stored t ON s.id = t.id GROUP BY 1""")
def merge_classify(spark, sf):
    return merge.classify_keys(staging(spark, sf), stored_staging(spark, sf), KEYS)


@query("merge_delete_set", f"""{_STORED_SQL}
SELECT id, precio_cop FROM stored t WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.id = t.id)""")
def merge_delete_set(spark, sf):
    return merge.missing_rows(staging(spark, sf), stored_staging(spark, sf), KEYS).select(
        "id", "precio_cop")


_FEATURES_SQL = f"""{_STORED_SQL}
, stored_features AS (SELECT *, TIMESTAMP '{EARLIER}' AS _feature_set_at FROM ({sql_features('stored')})
), synced AS (SELECT s.* REPLACE (round(s.log_precio_cop, 9) AS log_precio_cop),
 coalesce(t._feature_set_at, TIMESTAMP '{NOW}') AS _feature_set_at
 FROM features s LEFT JOIN stored_features t ON s.propiedad_id = t.propiedad_id)"""


def _synced(spark, sf):
    stored = feature_ops.build_features(stored_staging(spark, sf)).withColumn(
        "_feature_set_at", _stamp(EARLIER))
    synced = merge.sync_load(base.features(spark, sf), stored, ["propiedad_id"],
                             _defaults("_feature_set_at"))
    return synced.withColumn("log_precio_cop", F.round("log_precio_cop", 9))


@query("load_sync", f"{_FEATURES_SQL} SELECT * FROM synced")
def load_sync(spark, sf):
    return _synced(spark, sf).drop(merge.ACTION)


@query("materialize_split", f"""{_FEATURES_SQL}
SELECT * EXCLUDE (split, _feature_set_at) FROM synced WHERE split = 'train'""")
def materialize_split(spark, sf):
    return feature_ops.split_rows(_synced(spark, sf), "train")
