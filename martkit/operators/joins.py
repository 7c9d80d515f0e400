"""Join operators (J*, P1).

Plain equi-joins are left to Catalyst/AQE: the planner broadcasts a side only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sort-merges; AQE splits skewed partitions at runtime. The custom
operators here (OR-join, as-of, cutoff) are rewritten into equi-joins, unions
and partitioned windows so they never fall back to a nested-loop join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions, stored
from .common import as_list, exact_number, split_hot

UNB = Window.unboundedPreceding


def prefix(df: DataFrame, p: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Every column (or ``cols``) renamed with a prefix."""
    cols = list(cols) if cols is not None else df.columns
    return df.select(*[F.col(c).alias(p + c) for c in cols])


def role_playing(fact: DataFrame, dim: DataFrame, dim_key: str,
                 roles: dict[str, str], how: str = "left") -> DataFrame:
    """Join the same dimension once per role.

    ``roles`` maps a prefix to the fact column holding that role's key, e.g.
    ``{"cust_": "c_nationkey", "supp_": "s_nationkey"}``.
    """
    out = fact
    for p, fk in roles.items():
        d = prefix(dim, p)
        out = out.join(d, out[fk] == d[p + dim_key], how)
    return out


PART_ROWS = 1_000_000  # rows in a partition of a parent_left_join
HOT_ROWS = 250_000     # children of one key that are not gathered there
KEY_BUCKETS = 1 << 16
NEST_ROWS = 1000       # children in an array of nest_children


def _hot_keys(child: DataFrame, key: str, hot_rows: int) -> tuple[int, DataFrame | None]:
    """The count of rows whose key is not NULL, and the keys of more than ``hot_rows``
    rows (stored, ``_hot``; None without one). Rows are counted by a bucket of the key's
    hash first, which needs no table of all keys; keys only in buckets that are large."""
    rows = child.select(F.col(key).alias("_hot")).where(F.col("_hot").isNotNull())
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_hot"), F.lit(KEY_BUCKETS)))
    buckets = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    total, most = buckets.agg(F.sum("_n"), F.max("_n")).first()
    if (most or 0) <= hot_rows:
        return total or 0, None
    large = buckets.where(F.col("_n") > hot_rows).select("_bucket")
    keys = rows.join(F.broadcast(large), "_bucket", "left_semi").groupBy("_hot").agg(F.count(F.lit(1)).alias("_n"))
    hot = stored(keys.where(F.col("_n") > hot_rows).select("_hot"), "hot-keys")
    return total, None if hot.isEmpty() else hot


def parent_left_join(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                     part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``parent LEFT JOIN child ON parent_key = child_key`` for a parent that is
    unique on its key (a dimension or header table) and a child that may be
    heavily skewed (one key holding a third of the child rows).

    Both sides are dealt by key over a count of partitions that follows from their rows.
    The session's count stays the same when the tables grow, and AQE only merges
    partitions, so tasks would sort ever more rows. A partition count given by the query
    keeps AQE from splitting skewed partitions, and of an outer join it could only split
    the preserved side; so keys with more than ``hot_rows`` children are left out of it
    and their children, wherever they are, meet the few parents by a broadcast. A NULL
    parent key matches nothing; these parents pass the join by. The limits only decide
    where rows are worked on, never a result."""
    return _dealt_left_join(parent, child, parent_key, child_key, part_rows, hot_rows)


def nest_children(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, element: Column, out: str,
                  nest_rows: int = NEST_ROWS, part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each parent row with ``out``, the sorted array of its children's ``element``s, which
    are never NULL (empty without children). ``child`` has the key and orderable columns.

    No array holds more than ``nest_rows`` children, so that no row grows with a hot key: a
    parent with more comes once for each run of them. The children are gathered where
    ``parent_left_join`` has dealt them, without another shuffle. Those of a hot key are
    numbered where they lie, and runs of one partition's rows are gathered."""
    values = [c for c in child.columns if c != child_key]

    def run(position: Column) -> Column:
        return position - position % nest_rows

    def gathered(runs: DataFrame) -> DataFrame:
        return runs.groupBy(child_key, "_run").agg(F.sort_array(F.collect_list(element)).alias(out)).drop("_run")

    def nest(rows: DataFrame) -> DataFrame:
        position = F.row_number().over(Window.partitionBy(child_key).orderBy(*values)) - 1
        return gathered(rows.withColumn("_run", run(position)))

    def nest_hot(rows: DataFrame, parts: int) -> DataFrame:
        # the partition is in the position's high bits: no run holds rows of two partitions
        rows = rows.sortWithinPartitions(child_key, *values).withColumn("_position", F.monotonically_increasing_id())
        rows = rows.withColumn("_run", run(F.col("_position"))).drop("_position")
        return gathered(rows.repartition(parts, child_key, "_run"))

    j = _dealt_left_join(parent, child, parent_key, child_key, part_rows, hot_rows, nest, nest_hot)
    return j.select(*parent.columns, F.coalesce(out, F.array().cast(j.schema[out].dataType)).alias(out))


def _dealt_left_join(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, part_rows: int,
                     hot_rows: int, nest: Callable | None = None, nest_hot: Callable | None = None) -> DataFrame:
    """``parent_left_join``; ``nest`` and ``nest_hot`` gather the children, once dealt by
    their key, and those of hot keys before the join."""
    n_rows, hot = _hot_keys(child, child_key, hot_rows)
    n_rows += parent.count()
    parts = max(shuffle_partitions(parent.sparkSession), -(-n_rows // part_rows))
    valid = F.col(parent_key).isNotNull()
    keyed, children = parent.where(valid), child.where(F.col(child_key).isNotNull())
    few = many = None
    if hot is not None:
        keys = F.broadcast(hot)
        few = keyed.join(keys, keyed[parent_key] == keys["_hot"], "left_semi")
        many = children.join(keys, children[child_key] == keys["_hot"], "left_semi")
        keyed = keyed.join(keys, keyed[parent_key] == keys["_hot"], "left_anti")
        children = children.join(keys, children[child_key] == keys["_hot"], "left_anti")
    left, right = keyed.repartition(parts, parent_key), children.repartition(parts, child_key)
    if nest is not None:
        right, many = nest(right), None if many is None else nest_hot(many, parts)
    rest = parent.where(~valid).select(*parent.columns, *[F.lit(None).cast(f.dataType).alias(f.name)
                                                          for f in right.schema.fields])
    if many is not None:
        rest = many.join(F.broadcast(few), few[parent_key] == many[child_key]).select(
            *[few[c] for c in parent.columns], *[many[c] for c in right.columns]).union(rest)
    return left.join(right, left[parent_key] == right[child_key], "left").union(rest)


def valid_key_left_join(left: DataFrame, right: DataFrame, left_key: str,
                        right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` where many left keys may be NULL
    (text that is no key, say). A NULL matches nothing, and the shuffle of a join would
    send all of them to one task; those rows pass the join by."""
    valid = F.col(left_key).isNotNull()
    keyed = left.where(valid)
    joined = keyed.join(right, keyed[left_key] == right[right_key], "left")
    rest = left.where(~valid).select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name)
                                                      for f in right.schema.fields])
    return joined.union(rest)


def not_in(left: DataFrame, col: str, right: DataFrame, right_col: str) -> DataFrame:
    """``left WHERE col NOT IN (SELECT right_col FROM right)`` with SQL's
    three-valued logic, as a plain equi anti-join.

    Spark plans NOT IN as a null-aware anti join only when the subquery side
    can be broadcast; otherwise it falls back to a nested-loop join, which a
    large subquery cannot afford. Here: an anti-join on equality (hash or
    sort-merge, as AQE decides), plus two scalar facts about the subquery --
    a NULL in it rejects every row, and when it is non-empty a NULL probe is
    rejected too."""
    r = right.select(F.col(right_col).alias("_v"))
    has_null = r.where(F.col("_v").isNull()).select(F.count(F.lit(1)) > 0).scalar()
    non_empty = r.select(F.count(F.lit(1)) > 0).scalar()
    kept = left.join(r, left[col] == r["_v"], "left_anti")
    return kept.where(~has_null & (F.col(col).isNotNull() | ~non_empty))


def or_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
            keep: Sequence[str]) -> DataFrame:
    """``left JOIN right ON l1 = r1 OR l2 = r2 ...`` followed by DISTINCT on
    ``keep``, without a nested-loop join.

    When every alternative compares with the same right column, the left keys
    are exploded into one column and a single equi-join runs (the left side is
    scanned and shuffled once); otherwise the result is a union of equi-joins.
    """
    rcols = {rc for _, rc in pairs}
    if len(rcols) == 1:
        rc = rcols.pop()
        lkeep = [c for c in keep if c in left.columns and c not in right.columns]
        ex = left.select(*lkeep, F.explode(F.array(*[F.col(lc) for lc, _ in pairs])).alias("_ok"))
        return (ex.join(right, ex["_ok"] == right[rc], "inner").select(*keep).distinct())
    out = None
    for lc, rc in pairs:
        part = left.join(right, left[lc] == right[rc], "inner").select(*keep)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def cutoff_left(left: DataFrame, cutoff: DataFrame, key: str, ts: str,
                cutoff_ts: str) -> DataFrame:
    """Keep left rows strictly before the key's cutoff (the earliest one
    when there are several); keys without a cutoff keep every row. Distinct."""
    first = cutoff.groupBy(F.col(key).alias("_ck")).agg(F.min(cutoff_ts).alias("_cut"))
    j = left.join(first, left[key] == first["_ck"], "left")
    return (j.where(F.col("_cut").isNull() | (F.col(ts) < F.col("_cut")))
             .drop("_ck", "_cut").distinct())


def asof_left(left: DataFrame, right: DataFrame, by: Sequence[str] | str,
              left_ts: str, right_ts: str, right_cols: Sequence[str],
              tie: Sequence[str] | str | None = None, prefix_: str = "",
              shift=None, rows_per_bucket: int | None = None,
              direction: str = "backward") -> DataFrame:
    """For each left row, the right row with the same ``by`` key nearest
    in time in the given ``direction``:

    * ``backward`` (default): the latest with ``right_ts <= left_ts (+ shift)``;
    * ``forward``: the earliest with ``right_ts >= left_ts (+ shift)``;
    * ``nearest``: whichever of the two is closer (backward on a tie).

    Left rows always survive; unmatched get NULL right columns; NULL keys or
    timestamps never match. Among right rows with equal ts the highest ``tie``
    wins (without ``tie``, the highest of all ``right_cols``).

    Plan: both sides are unioned into one (key, ts)-ordered stream in which a
    right row sorts before a left row at the same instant; ``last(right,
    ignorenulls)`` carries the nearest right row along the stream (forward: along
    the reversed stream, a second sort on the same partitioning). Hot keys are cut
    into ranges of the stream (``split_hot``), and each range's boundary right row
    is carried on through a summary of one row per (key, chunk).
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(direction)
    back, fwd = direction in ("backward", "nearest"), direction in ("forward", "nearest")
    by = as_list(by)
    tie = as_list(tie) or list(right_cols)
    keys = [f"_k{i}" for i in range(len(by))]
    probe = F.col(left_ts) if shift is None else F.col(left_ts) + shift
    lcols = left.columns
    ts_type = left.select(probe.alias("_ts")).schema["_ts"].dataType
    rvalid = right
    for b in by:
        rvalid = rvalid.where(F.col(b).isNotNull())
    rvalid = rvalid.where(F.col(right_ts).isNotNull())
    r0 = rvalid.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)],
                       F.col(right_ts).cast(ts_type).alias("_ts"),
                       *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)],
                       *[F.col(c).alias(f"_rc{i}") for i, c in enumerate(right_cols)])
    rstruct = F.struct(*[F.col(f"_rc{i}").alias(c) for i, c in enumerate(right_cols)],
                       F.col("_ts").alias("__ts"))
    rside = r0.select(*keys, "_ts", F.lit(0).alias("_tag"),
                      *[f"_t{i}" for i in range(len(tie))],
                      F.lit(None).cast(left.select(F.struct(*lcols)).schema[0].dataType).alias("_l"),
                      rstruct.alias("_r"))
    lside = left.select(
        *[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)],
        probe.alias("_ts"), F.lit(1).alias("_tag"),
        *[F.lit(None).cast(rside.schema[f"_t{i}"].dataType).alias(f"_t{i}")
          for i in range(len(tie))],
        F.struct(*[F.col(c) for c in lcols]).alias("_l"),
        F.lit(None).cast(rside.schema["_r"].dataType).alias("_r"))
    u = lside.unionByName(rside).withColumn("_key", F.struct(*keys))
    ties = [F.col(f"_t{i}") for i in range(len(tie))]
    seq = [F.col("_ts"), F.col("_tag")] + ties
    # left rows of one instant may lie in any order: a hash spreads them
    cold, hot = split_hot(u, [*seq, F.xxhash64("_l")], rows_per_bucket)

    def carried(d: DataFrame, *by_cols: str) -> DataFrame:
        part = Window.partitionBy(*by_cols)
        if back:
            wb = part.orderBy(*seq).rowsBetween(UNB, Window.currentRow)
            d = d.withColumn("_mb", F.last("_r", ignorenulls=True).over(wb))
        if fwd:
            wf = part.orderBy(F.col("_ts").desc(), F.col("_tag"), *ties).rowsBetween(UNB, Window.currentRow)
            d = d.withColumn("_mf", F.last("_r", ignorenulls=True).over(wf))
        return d.where(F.col("_tag") == 1)

    cols = ["_l", "_ts", *keys, *(["_mb"] if back else []), *(["_mf"] if fwd else [])]
    j = carried(cold, "_key").select(*cols)
    if hot is not None:
        # of the right rows of an instant only the best matters; it is in the last of
        # their chunks, before all left rows of the instant
        is_r = F.col("_tag") == 0
        tcols = [f"_t{i}" for i in range(len(tie))]  # as in ``ties``
        best = (hot.where(is_r).groupBy("_key", "_ts", "_tag", *keys)
                .agg(F.max_by(F.struct("_r", "_chunk", *tcols), F.struct(*ties, "_chunk")).alias("_x"))
                .select("_key", "_ts", "_tag", *keys, "_x.*", F.lit(None).cast(hot.schema["_l"].dataType).alias("_l")))
        hot = stored(hot.where(~is_r).unionByName(best.select(*hot.columns)), "asof-hot")
        ends = hot.groupBy("_key", "_chunk").agg(
            F.max_by(F.when(is_r, F.col("_r")), F.when(is_r, F.col("_ts"))).alias("_lr"),
            F.min_by(F.when(is_r, F.col("_r")), F.when(is_r, F.col("_ts"))).alias("_fr"))
        wk = Window.partitionBy("_key").orderBy("_chunk")
        carry = ends.select(
            "_key", "_chunk", F.last("_lr", ignorenulls=True).over(wk.rowsBetween(UNB, -1)).alias("_cb"),
            F.first("_fr", ignorenulls=True).over(wk.rowsBetween(1, Window.unboundedFollowing)).alias("_cf"))
        h = carried(hot, "_key", "_chunk").join(stored(carry, "asof-carry"), ["_key", "_chunk"])
        if back:
            h = h.withColumn("_mb", F.coalesce("_mb", "_cb"))
        if fwd:
            # a right row of the very instant may be in a chunk before the left row's
            same = hot.where(is_r).select(F.col("_key").alias("_sk"), F.col("_ts").alias("_st"), F.col("_r").alias("_sr"))
            h = h.join(same, (F.col("_key") == F.col("_sk")) & (F.col("_ts") == F.col("_st")), "left")
            h = h.withColumn("_mf", F.coalesce("_sr", "_mf", "_cf"))
        j = j.unionByName(h.select(*cols))
    mb, mf = F.col("_mb"), F.col("_mf")
    if direction == "backward":
        m = mb
    elif direction == "forward":
        m = mf
    else:
        j = j.withColumns({"_bts": F.col("_mb.__ts"), "_fts": F.col("_mf.__ts")})
        at, before, after_ = exact_number(j, "_ts"), exact_number(j, "_bts"), exact_number(j, "_fts")
        closer_back = (at - before) <= (after_ - at)
        m = F.when(mf.isNull(), mb).when(mb.isNull(), mf).when(closer_back, mb).otherwise(mf)
    valid = F.col("_ts").isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    m = F.when(valid, m)
    return j.select("_l.*", *[m.getField(c).alias(prefix_ + c) for c in right_cols])


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    size = F.lit(16)
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        size = size + (F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 16
                       if kind == "string" or not kind.isidentifier() else F.lit(8))
    return size.cast("long")


PER_SLOT = 32  # points of a slot, about


@dataclass(frozen=True)
class Series:
    """A ``small_series``. ``slots``: per key (``_k0``, ...) and time slot, ``_ats`` and
    ``_values`` (its points by time), ``_past`` (the last point of the slots before)
    and ``_next`` (the first of those after). Slots are ``n`` equal parts of the time
    from ``lo`` on, ``width`` long; the first and the last have no end. No slot has more
    than ``most`` points."""
    slots: DataFrame
    lo: float
    width: float
    n: int
    most: int = 0

    def slot(self, number: Column) -> Column:
        at = F.floor((number.cast("double") - F.lit(self.lo)) / F.lit(self.width))
        return F.least(F.greatest(at, F.lit(0)), F.lit(self.n - 1)).cast("int")


def small_series(right: DataFrame, by: Sequence[str] | str, ts: str, cols: Sequence[str],
                 tie: Sequence[str] | str | None = None, max_bytes: int | None = None) -> Series | None:
    """A series cut into (key, time slot) rows of a few points each (of the points of one
    instant the highest ``tie`` wins; without ``tie``, by all columns), or None if it
    takes more than ``max_bytes`` (default: the session's broadcast threshold). The
    points are stored and measured before any is gathered, so the bound holds for every
    array and for all of them together."""
    spark, by, tie = right.sparkSession, as_list(by), as_list(tie) or list(cols)
    if max_bytes is None:
        max_bytes = _threshold(spark)
    keys = [f"_k{i}" for i in range(len(by))]
    valid = right.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, ts]]))
    points = stored(valid.groupBy(*[F.col(b).alias(k) for k, b in zip(keys, by, strict=True)], F.col(ts).alias("_at")).agg(
        F.max_by(F.struct(*cols), F.struct(*tie)).alias("_v")), "series")
    flat = points.select(*keys, "_at", *[F.col("_v").getField(c).alias(f"_c{i}") for i, c in enumerate(cols)])
    number = exact_number(points, "_at").cast("double")
    per_key = flat.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(_row_bytes(flat)).alias("_b"),
                                      F.min(number).alias("_lo"), F.max(number).alias("_hi"))
    n_keys, most, size, lo, hi = per_key.agg(F.count("*"), F.max("_n"), F.sum("_b"), F.min("_lo"), F.max("_hi")).first()
    if size is not None and size > max_bytes:
        return None
    n = max(1, min((most or 0) // PER_SLOT, max_bytes // (256 * max(1, n_keys))))
    series = Series(points, lo or 0.0, max(((hi or 0.0) - (lo or 0.0)) / n, 1e-9), n)
    placed = points.withColumn("_slot", series.slot(number))
    most = placed.groupBy(*keys, "_slot").count().agg(F.max("count")).first()[0] or 0
    found = placed.groupBy(*keys, "_slot").agg(
        F.sort_array(F.collect_list(F.struct("_at", "_v"))).alias("_p"))
    every = points.select(*keys).distinct().withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    filled = every.join(found, [*keys, "_slot"], "left")
    w = Window.partitionBy(*keys).orderBy("_slot")
    slots = filled.select(
        *keys, "_slot", F.col("_p._at").alias("_ats"), F.col("_p._v").alias("_values"),
        F.last(F.element_at("_p", -1), ignorenulls=True).over(w.rowsBetween(UNB, -1)).alias("_past"),
        F.first(F.element_at("_p", 1), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("_next"))
    return replace(series, slots=slots, most=most)


def _threshold(spark) -> int:
    return max(0, int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))


def asof_series(left: DataFrame, series: Series, by: Sequence[str] | str, left_ts: str,
                right_cols: Sequence[str], prefix_: str = "", shift=None, direction: str = "backward") -> DataFrame:
    """J12 against a ``small_series``: the same rows as ``asof_left``. The series is
    broadcast (its size is measured); a left row meets the slot of its key and time and
    finds its place there by binary search, and the left side is neither shuffled nor
    sorted. The left column's time must compare with the series' as it is."""
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(direction)
    by, lcols = as_list(by), left.columns
    probe = F.col(left_ts) if shift is None else F.col(left_ts) + shift
    slots = series.slots
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, series.most.bit_length())))])
    # the columns of the left side stay apart, whatever their names
    rows = left.select(F.struct(*lcols).alias("_l"), probe.cast(slots.schema["_ats"].dataType.elementType).alias("_probe"))
    rows = rows.withColumn("_in", series.slot(exact_number(rows, "_probe")))
    cond = reduce(Column.__and__, [F.col(f"_l.{b}") == F.col(f"_k{i}") for i, b in enumerate(by)])
    j = rows.join(F.broadcast(slots), cond & (F.col("_in") == F.col("_slot")), "left")

    def before(inclusive: bool) -> Column:
        """How many points of the slot are before the probe (or at it)."""
        def step(n: Column, s: Column) -> Column:
            at = F.get("_ats", n + s - 1)
            return F.when((at <= F.col("_probe")) if inclusive else (at < F.col("_probe")), n + s).otherwise(n)
        return F.aggregate(steps, F.lit(0), step)

    def point(n: Column) -> Column:
        return F.struct(F.get("_ats", n).alias("_at"), F.get("_values", n).alias("_v"))

    if direction != "forward":
        j = j.withColumn("_n", before(True)).withColumn(
            "_b", F.when(F.col("_n") > 0, point(F.col("_n") - 1)).otherwise(F.col("_past")))
    if direction != "backward":
        j = j.withColumn("_n", before(False)).withColumn(
            "_f", F.when(F.col("_n") < F.coalesce(F.size("_ats"), F.lit(0)), point(F.col("_n"))).otherwise(F.col("_next")))
    if direction == "nearest":
        j = j.withColumns({"_bts": F.col("_b._at"), "_fts": F.col("_f._at")})
        at, past, next_ = exact_number(j, "_probe"), exact_number(j, "_bts"), exact_number(j, "_fts")
        m = F.when(F.col("_bts").isNull(), F.col("_f._v")).when(
            F.col("_fts").isNull() | ((at - past) <= (next_ - at)), F.col("_b._v")).otherwise(F.col("_f._v"))
    else:
        m = F.col("_b._v" if direction == "backward" else "_f._v")
    j = j.withColumn("_m", F.when(F.col("_probe").isNotNull(), m))
    return j.select("_l.*", *[F.col("_m").getField(c).alias(prefix_ + c) for c in right_cols])


def asof_probes(left: DataFrame, right: DataFrame, probes: dict, right_by: Sequence[str] | str,
                right_ts: str, tie: Sequence[str] | str | None = None,
                rows_per_bucket: int | None = None, direction: str = "backward",
                max_bytes: int | None = None) -> DataFrame:
    """Several as-of probes of one right side. ``probes`` maps an output prefix
    to ``(left key columns, left time column, shift or None, right columns)``, so
    every probe has its own key and time (weather at departure, weather at
    arrival). One as-of after the other: left rows need no unique key, and
    duplicates and NULLs pass through each of them.

    A right side of at most ``max_bytes`` (``small_series``) is probed in place, and the
    left side runs once. A larger one goes through ``asof_left``, which counts the left
    rows of every key; the left side is stored first, so that it too runs once."""
    out, right_by = left, as_list(right_by)
    cols = list(dict.fromkeys(c for *_, right_cols in probes.values() for c in right_cols))
    series = small_series(right, right_by, right_ts, cols, tie, max_bytes)
    if series is not None:
        for name, (by, ts, shift, right_cols) in probes.items():
            out = asof_series(out, series, by, ts, right_cols, prefix_=name, shift=shift, direction=direction)
        return out
    out = stored(out, "asof-left")
    for name, (by, ts, shift, right_cols) in probes.items():
        side = right
        keys = as_list(by)
        if keys != right_by:
            side = right.withColumnsRenamed(dict(zip(right_by, keys, strict=True)))
        out = asof_left(out, side, keys, ts, right_ts, right_cols, tie=tie, prefix_=name, shift=shift,
                        rows_per_bucket=rows_per_bucket, direction=direction)
    return out
