"""Upserts without a row-level table format (S11-S14, U3, A21/A22 folds).

Parquet tables cannot ``MERGE``; the operators here compute the merged table
as a DataFrame (a full outer join on the key for MERGE, an anti-join on the
key for INSERT-IF-ABSENT: each side is shuffled once) and the caller commits
it to a *new* directory
(``sources.tables_io.commit``), never overwriting the path being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_list
from .ordered import dense_id


def first_n_by_key(source: DataFrame, keys: Sequence[str] | str, n: int) -> DataFrame:
    """The batch cap. The reference's LIMIT has no ORDER BY; here the pick
    is the n smallest keys (NULLs last), a per-task top-n then a merge."""
    keys = as_list(keys)
    return source.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)


def dedupe_batch(source: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """One row per key inside an incoming batch: the lowest ``tie`` wins.
    ``min_by`` is a partial aggregate, safe for a hot key."""
    keys, tie = as_list(keys), as_list(tie)
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    return (source.groupBy(*keys)
                  .agg(F.min_by(F.struct(*rest), F.struct(*[F.col(t) for t in tie])).alias("_r"))
                  .select(*keys, "_r.*"))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str] | str,
                     tie: Sequence[str] | str | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``.

    The batch is deduplicated on the key first (lowest tie wins; without ``tie``,
    the lowest of all other columns); rows whose key already exists are dropped;
    NULL keys never conflict (appended)."""
    keys = as_list(keys)
    src = source.select(*target.columns)
    if tie is None:
        tie = [c for c in target.columns if c not in keys] or keys
    nulls = src.where(_any_null(keys))
    src = dedupe_batch(src.where(~_any_null(keys)), keys, tie).select(*target.columns).unionByName(nulls)
    new = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def _any_null(keys) -> Column:
    c = None
    for k in keys:
        t = F.col(k).isNull()
        c = t if c is None else c | t
    return c


def assert_unique(df: DataFrame, keys: Sequence[str] | str, what: str = "merge source") -> DataFrame:
    """Fail the job if ``keys`` repeat (a merge must not touch a target row
    twice). The check is a scalar subquery over a partial count, evaluated
    once, and sits in a filter so it cannot be pruned away."""
    keys = as_list(keys)
    # NULL keys never match a target row, so repeated NULL keys are harmless
    worst = (df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.coalesce(F.max("_n"), F.lit(0)).alias("_m"))).scalar()
    guard = F.when(worst > 1, F.raise_error(F.lit(f"duplicate key in {what}: {keys}"))) \
        .otherwise(F.lit(True))
    return df.where(guard.cast("boolean"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] | str,
                 update_cols: Sequence[str] | None = None, stamp: str | None = None,
                 check_unique: bool = True) -> DataFrame:
    """``MERGE ... WHEN MATCHED UPDATE SET update_cols WHEN NOT MATCHED
    INSERT``. Unmatched target rows pass through; ``stamp`` (S14) gets the
    statement time on every updated or inserted row.

    NULL keys never match: such source rows are inserted. A ``stamp`` column that
    the target lacks is added (NULL on rows that pass through)."""
    keys = as_list(keys)
    unknown = [c for c in update_cols or () if c not in target.columns or c not in source.columns]
    if unknown:
        raise ValueError(f"update_cols not in both target and source: {unknown}")
    if stamp is not None and stamp not in target.columns:
        target = target.withColumn(stamp, F.lit(None).cast("timestamp"))
    cols = list(target.columns)
    upd = list(update_cols) if update_cols is not None else \
        [c for c in source.columns if c not in keys and c in cols]
    src = source
    if stamp is not None:
        src = src.withColumn(stamp, F.current_timestamp())
        if stamp not in upd:
            upd.append(stamp)
    if check_unique:
        src = assert_unique(src, keys)
    # one full outer join on the key: each side is shuffled once
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t_in"))
    sr = src.withColumn("_s_in", F.lit(True))
    cond = None
    for k in keys:
        e = F.col(k) == F.col(f"_t_{k}")  # NULL keys never match
        cond = e if cond is None else cond & e
    j = sr.join(t, cond, "full_outer")
    in_s, in_t = F.col("_s_in").isNotNull(), F.col("_t_in").isNotNull()
    out = []
    for c in cols:
        dt = target.schema[c].dataType
        if c in keys:
            out.append(F.when(in_s, F.col(c).cast(dt)).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in upd and c in src.columns:
            out.append(F.when(in_s, F.col(c).cast(dt)).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in src.columns:
            # not updated: matched rows keep the target value, inserts take the source
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(c).cast(dt)).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


def extend_key_map(key_map: DataFrame, batch: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """P8 across loads: ``key_map`` (``key``, ``id_col``) with the new keys of ``batch``,
    numbered on from the highest id in key order, like a serial column: known keys keep
    their id, and each new key gets one however often it comes. NULL keys get none."""
    known = key_map.select(F.col(key).alias("_k"))
    new = batch.select(key).where(F.col(key).isNotNull()).distinct().join(known, F.col(key) == F.col("_k"), "left_anti")
    last = key_map.agg(F.max(id_col)).first()[0] or 0
    added = dense_id(new, key, id_col, start=last + 1)
    return key_map.select(key, id_col).unionByName(added.withColumn(id_col, F.col(id_col).cast(key_map.schema[id_col].dataType)))


def with_serial_id(df: DataFrame, key_map: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """``df`` with the ids of an extended key map (NULL for NULL keys). Map keys are
    unique, so a hot key on the side of ``df`` can be split."""
    ids = key_map.select(F.col(key).alias("_k"), id_col)
    return df.join(ids, F.col(key) == F.col("_k"), "left").drop("_k")


def with_audit_stamp(df: DataFrame, col: str = "_etl_updated_dttm") -> DataFrame:
    """The write time on each written row."""
    return df.withColumn(col, F.current_timestamp())
