"""Merge upsert by key (J2), last write per key (W3), upsert totals (A6),
delete / lookup by ids (J6, V7).

The target is a DataFrame snapshot; the result is the new snapshot with an
``_action`` column. Committing it is a separate write (see tables.py).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys_not_null(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def dedup_latest(df: DataFrame, keys, order_col: str) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per key.

    A max over a struct led by the order column: Spark aggregates it partially
    before the shuffle, so a key holding a third of the rows still reaches the
    reducer as one row per map task. Ties fall to the remaining columns, so the
    choice is deterministic.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys and c != order_col]
    agg = df.groupBy(*keys).agg(F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_w"))
    return agg.select(*keys, *[F.col("_w")[c].alias(c) for c in [order_col] + others]).select(*df.columns)


def dedup_any(df: DataFrame, keys) -> DataFrame:
    """One row per key where no column orders them: the greatest by the other columns, so always the same one."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    agg = df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_w"))
    return agg.select(*keys, *[F.col("_w")[c].alias(c) for c in others]).select(*df.columns)


def null_key_rows(df: DataFrame, keys) -> DataFrame:
    """Rows that cannot be upserted: a key field is null (quarantine)."""
    return df.where(~_keys_not_null(keys)).withColumn("reason", F.lit("null_key"))


# Above this many batch keys the merge falls back to one full outer join.
MAX_BROADCAST_KEYS = 2_000_000


def merge_upsert(target: DataFrame, updates: DataFrame, keys, order_col: str | None = None,
                 max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """``$set``-style upsert of ``updates`` into ``target`` on ``keys``.

    Columns present in ``updates`` overwrite (an explicit null overwrites);
    other target columns are kept; unmatched updates are inserted. Duplicate
    keys inside the batch keep the greatest ``order_col`` (W3), without one the
    greatest row, so a replayed batch changes nothing; rows with a
    null key are left out (see :func:`null_key_rows`). ``_action`` is
    'upserted' (new key), 'modified' (some provided value changed), 'same'
    (matched, nothing changed) or 'kept' (target row not in the batch).

    Plan: the de-duplicated batch is written once and its rows counted. A batch
    of at most ``max_broadcast_keys`` keys (the usual incremental case) is
    broadcast: the target streams through one left join without a shuffle, and
    a scan of its key columns alone finds the keys it already has, so that the
    rest of the batch is inserted. A larger batch is one full outer join.
    """
    keys = list(keys)
    upd = updates.where(_keys_not_null(keys))
    if order_col:
        upd = dedup_latest(upd, keys, order_col).drop(order_col)
    else:
        upd = dedup_any(upd, keys)
    from ..session import checkpoint_dir
    checkpoint_dir(target.sparkSession)
    upd = upd.checkpoint(eager=True)
    if upd.count() > max_broadcast_keys:
        return _merge_join(target, upd, keys, "full_outer")
    merged = _merge_join(target, upd, keys, "left")
    there = target.select(*keys).join(F.broadcast(upd.select(*keys)), keys, "left_semi").distinct()
    new = upd.join(there, keys, "left_anti").withColumn("_action", F.lit("upserted"))
    return merged.unionByName(new, allowMissingColumns=True)


def _merge_join(target: DataFrame, upd: DataFrame, keys, how: str) -> DataFrame:
    upd_cols = [c for c in upd.columns if c not in keys]
    tgt_only = [c for c in target.columns if c not in keys and c not in upd_cols]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys],
                      F.lit(True).alias("_in_t"))
    u = upd.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in upd_cols], F.lit(True).alias("_in_u"))
    if how == "left":
        u = F.broadcast(u)
    j = t.join(u, keys, how)
    in_t = F.coalesce(F.col("_in_t"), F.lit(False))
    in_u = F.coalesce(F.col("_in_u"), F.lit(False))
    out = [F.col(k) for k in keys]
    for c in upd_cols:
        tc = F.col(f"_t_{c}") if c in target.columns else F.lit(None)
        out.append(F.when(in_u, F.col(f"_u_{c}")).otherwise(tc).alias(c))
    for c in tgt_only:
        out.append(F.col(f"_t_{c}").alias(c))
    changed = reduce(lambda a, b: a | b,
                     [~F.col(f"_u_{c}").eqNullSafe(F.col(f"_t_{c}")) if c in target.columns else F.lit(True)
                      for c in upd_cols], F.lit(False))
    action = F.when(in_u & ~in_t, "upserted").when(in_u & changed, "modified") \
        .when(in_u, "same").otherwise("kept")
    cols = keys + [c for c in target.columns if c not in keys] + [c for c in upd_cols if c not in target.columns]
    return j.select(*out, action.alias("_action")).select(*cols, "_action")


def merge_counts(merged: DataFrame, by=()) -> DataFrame:
    """Upsert totals (A6): upserted, modified, same, and their written sum."""
    return merged.groupBy(*by).agg(
        F.count_if(F.col("_action") == "upserted").alias("upserted"),
        F.count_if(F.col("_action") == "modified").alias("modified"),
        F.count_if(F.col("_action") == "same").alias("same"),
        F.count_if(F.col("_action").isin("upserted", "modified")).alias("written"))


def delete_by_ids(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Target without the given ids (J6/V7): a left anti join."""
    return target.join(ids.select(key).distinct(), key, "left_anti")


def lookup_by_ids(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Target rows with the given ids: a left semi join."""
    return target.join(ids.select(key), key, "left_semi")
