"""Ordered-series operators (W*, P8, P12).

None of these uses a window over all rows without PARTITION BY, and none relies
on one key fitting in one task: ordinary keys get a plain window; hot keys are cut
into ranges of their order (``split_hot``), each (key, chunk) is processed
independently, and the edges are stitched through a summary of one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import as_list, col, range_chunks, split_hot

UNB = Window.unboundedPreceding


# --------------------------------------------------------------------------
# Dense ids over a total order, no single-task window
# --------------------------------------------------------------------------
def dense_id(df: DataFrame, order_by, out: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids following ``order_by`` (must be a total order).

    One range shuffle: rows are range-partitioned and sorted inside each
    partition; the position inside a partition comes from
    ``monotonically_increasing_id`` (partition id in the high bits, running
    index in the low bits). Per-partition counts (one row per partition, so
    bounded by the partition count) give the offsets.
    """
    order = [col(c) for c in as_list(order_by)]
    c = (range_chunks(df, order)
         .sortWithinPartitions(*order)
         .withColumn("_pos", F.monotonically_increasing_id()
                     - F.shiftleft(F.col("_chunk").cast("long"), 33)))
    # Range bounds and positions are only stable for one execution: keep one
    # copy (shared checkpoint folder) that both branches below read.
    c = stored(c, "dense-id")
    counts = c.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select(
        "_chunk",
        F.coalesce(F.sum("_n").over(Window.orderBy("_chunk").rowsBetween(UNB, -1)),
                   F.lit(0)).alias("_off"))
    # offsets has one row per partition: a proven bound, so broadcast it.
    return (c.join(F.broadcast(offs), "_chunk")
            .withColumn(out, (F.col("_pos") + F.col("_off") + F.lit(start)).cast("long"))
            .drop("_chunk", "_pos", "_off"))


def positional_join(left: DataFrame, left_order, right: DataFrame, right_order,
                    pos: str = "_position") -> DataFrame:
    """Attach ``right``'s values to ``left`` by row position (both totally ordered)."""
    lft = dense_id(left, left_order, pos)
    rgt = dense_id(right, right_order, pos)
    return lft.join(rgt, pos, "left").drop(pos)


# --------------------------------------------------------------------------
# Dense rank of all values, without a global window
# --------------------------------------------------------------------------
def dense_rank_global(df: DataFrame, value: str, out: str = "rank",
                      descending: bool = True) -> DataFrame:
    """Rank distinct values (``dense_id`` over the distinct set), join back.

    NULL values rank last.
    """
    v = F.col(value)
    o = v.desc_nulls_last() if descending else v.asc_nulls_last()
    ranks = dense_id(df.select(value).distinct(), [o], out)
    ranks = ranks.select(F.struct(value).alias("_key"), out)
    return df.withColumn("_key", F.struct(value)).join(ranks, "_key").drop("_key")


# --------------------------------------------------------------------------
# Top-n per group by rank or dense rank
# --------------------------------------------------------------------------
def top_n_by_group(df: DataFrame, by, value: str, n: int = 1, method: str = "rank",
                   out: str = "rnk", descending: bool = True) -> DataFrame:
    """Rows whose ``rank``/``dense_rank`` of ``value`` within ``by`` is <= n.

    Skew-safe: distinct (group, value, count) is a partial aggregate; the
    ranking filter lets Spark put a partial ``WindowGroupLimit`` in front of the
    shuffle on the group, so even a hot group reaches its final task as at most
    n distinct values per input task; the result joins back on (group, value).
    Ties are kept; NULL values rank last.
    """
    by = as_list(by)
    v = F.col(value)
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    dist = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*by).orderBy(order)
    top = dist.withColumn("_d", F.dense_rank().over(w)).where(F.col("_d") <= n)
    if method == "dense_rank":
        top = top.withColumn(out, F.col("_d"))
    elif method == "rank":
        # rank = 1 + rows with a strictly better value; only the n best distinct
        # values can reach rank n
        top = top.withColumn(
            out, F.coalesce(F.sum("_cnt").over(w.rowsBetween(UNB, -1)), F.lit(0)) + 1)
    else:
        raise ValueError(method)
    top = top.where(F.col(out) <= n).select(F.struct(*by, value).alias("_key"),
                                            F.col(out).cast("int").alias(out))
    # one struct key: NULL-safe equality (struct fields compare NULL = NULL)
    # with a plain equi-join
    return df.withColumn("_key", F.struct(*by, value)).join(top, "_key").drop("_key")


# --------------------------------------------------------------------------
# neighbours: lag/lead per key, chunked
# --------------------------------------------------------------------------
def neighbours(df: DataFrame, by, order, value: str, prev: str = "_prev",
               nxt: str = "_next", rows_per_bucket: int | None = None) -> DataFrame:
    """Add previous/next ``value`` within each key along ``order`` (total).

    Missing neighbours are NULL; ``{prev}_exists``/``{nxt}_exists`` tell a
    missing neighbour from a NULL value.

    Ordinary keys: lag and lead of one window. Hot keys: the same per (key, chunk),
    with the edge rows completed from the neighbouring chunk of the key.
    """
    by, order = as_list(by), as_list(order)
    ocols = [col(o) for o in order]
    cold, hot = split_hot(df.withColumn("_key", F.struct(*by)), order, rows_per_bucket)
    new = [prev, f"{prev}_exists", nxt, f"{nxt}_exists"]

    def adjacent(d: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*ocols)
        return (d.withColumn(prev, F.lag(value).over(w))
                 .withColumn(f"{prev}_exists", F.lag(F.lit(True), 1, False).over(w))
                 .withColumn(nxt, F.lead(value).over(w))
                 .withColumn(f"{nxt}_exists", F.lead(F.lit(True), 1, False).over(w)))

    out = adjacent(cold, "_key").select(*df.columns, *new)
    if hot is None:
        return out
    okey = F.struct(*ocols)
    edges = hot.groupBy("_key", "_chunk").agg(
        F.min_by(F.struct(F.col(value).alias("v")), okey).alias("_first"),
        F.max_by(F.struct(F.col(value).alias("v")), okey).alias("_last"))
    wc = Window.partitionBy("_key").orderBy("_chunk")
    edges = stored(edges.select("_key", "_chunk", F.lag("_last").over(wc).alias("_pl"),
                                F.lead("_first").over(wc).alias("_nf")), "chunk-edges")
    j = adjacent(hot, "_key", "_chunk").join(edges, ["_key", "_chunk"])
    j = (j.withColumn(prev, F.when(F.col(f"{prev}_exists"), F.col(prev)).otherwise(F.col("_pl.v")))
          .withColumn(f"{prev}_exists", F.col(f"{prev}_exists") | F.col("_pl").isNotNull())
          .withColumn(nxt, F.when(F.col(f"{nxt}_exists"), F.col(nxt)).otherwise(F.col("_nf.v")))
          .withColumn(f"{nxt}_exists", F.col(f"{nxt}_exists") | F.col("_nf").isNotNull()))
    return out.unionByName(j.select(*df.columns, *new))


def runs(df: DataFrame, by, order, value: str, length: int = 3,
         rows_per_bucket: int | None = None) -> DataFrame:
    """Distinct (key, value) with a run of at least ``length`` consecutive
    equal values along ``order`` (total). NULL breaks a run.

    length 3 is "equal to both neighbours" (one ``neighbours`` pass). Longer
    runs are islands: a row starts a run when it differs from its predecessor,
    a running count of starts numbers the runs (``running_sum``, hot-key
    safe), and a partial count per (key, run) keeps the long ones.
    """
    by = as_list(by)
    nb = neighbours(df, by, order, value, rows_per_bucket=rows_per_bucket)
    v = F.col(value)
    if length <= 3:
        if length <= 1:
            hit = v.isNotNull()
        elif length == 2:
            hit = (v == F.col("_prev")) | (v == F.col("_next"))
        else:
            hit = (v == F.col("_prev")) & (v == F.col("_next"))
        return nb.where(hit).select(*by, value).distinct()
    start = (~F.coalesce(v == F.col("_prev"), F.lit(False))).cast("long")
    numbered = running_sum(nb.withColumn("_start", start), by, order, "_start", "_run",
                           rows_per_bucket=rows_per_bucket)
    return (numbered.where(v.isNotNull())
                    .groupBy(*by, "_run", value).agg(F.count(F.lit(1)).alias("_len"))
                    .where(F.col("_len") >= length)
                    .select(*by, value).distinct())


def local_minima(df: DataFrame, by, order, value: str, first: bool = True,
                 rows_per_bucket: int | None = None) -> DataFrame:
    """Rows strictly below both neighbours; a missing neighbour counts as
    +infinity. ``first`` keeps only the earliest hit per key."""
    by, order = as_list(by), as_list(order)
    nb = neighbours(df, by, order, value, rows_per_bucket=rows_per_bucket)
    v = F.col(value)
    hit = (v.isNotNull()
           & (~F.col("_prev_exists") | (v < F.col("_prev")))
           & (~F.col("_next_exists") | (v < F.col("_next"))))
    hits = nb.where(hit).drop("_prev", "_next", "_prev_exists", "_next_exists")
    if not first:
        return hits
    okey = F.struct(*[col(o) for o in order])
    keep = [c for c in hits.columns if c not in by]
    return (hits.groupBy(*by)
            .agg(F.min_by(F.struct(*keep), okey).alias("_h"))
            .select(*by, "_h.*"))


# --------------------------------------------------------------------------
# Partition minimum and running sums
# --------------------------------------------------------------------------
def window_min(df: DataFrame, by, value: str, out: str = "min_value") -> DataFrame:
    """The key's minimum on every row. Map-side partial aggregate + join,
    rather than a window that holds a whole key in one task."""
    by = as_list(by)
    k = df.withColumn("_key", F.struct(*by))
    m = k.groupBy("_key").agg(F.min(value).alias(out))
    return k.join(m, "_key").drop("_key")


def running_sum(df: DataFrame, by, order, value: str, out: str = "running",
                rows_per_bucket: int | None = None) -> DataFrame:
    """Prefix sums of ``value`` per key along ``order`` (total). NULL values
    add nothing; the sum is NULL until the first value that is not. Sums of
    integers and decimals are exact; those of doubles depend in their last digits
    on the order in which Spark adds."""
    by, order = as_list(by), as_list(order)
    ocols = [col(o) for o in order]
    cold, hot = split_hot(df.withColumn("_key", F.struct(*by)), order, rows_per_bucket)

    def prefix(*keys: str):
        return F.sum(value).over(Window.partitionBy(*keys).orderBy(*ocols)
                                 .rowsBetween(UNB, Window.currentRow))

    done = cold.withColumn(out, prefix("_key")).select(*df.columns, out)
    if hot is None:
        return done
    tot = hot.groupBy("_key", "_chunk").agg(F.sum(value).alias("_tot"))
    wc = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(UNB, -1)
    offs = stored(tot.select("_key", "_chunk", F.sum("_tot").over(wc).alias("_off")), "chunk-offsets")
    j = hot.withColumn("_local", prefix("_key", "_chunk")).join(offs, ["_key", "_chunk"])
    both = F.when(F.col("_off").isNull(), F.col("_local")).when(F.col("_local").isNull(), F.col("_off")) \
        .otherwise(F.col("_local") + F.col("_off"))
    return done.unionByName(j.withColumn(out, both.cast(done.schema[out].dataType)).select(*df.columns, out))


# --------------------------------------------------------------------------
# gaps
# --------------------------------------------------------------------------
def gaps(df: DataFrame, by, id_col: str, lo=None, hi=None, out: str = "missing",
         rows_per_bucket: int | None = None) -> DataFrame:
    """Ids missing from each key's range [lo, hi] (default: the key's own
    min..max). Work is O(present + missing): consecutive present ids inside the
    range are paired with ``neighbours`` and only the holes are expanded; a key
    without an id inside misses the whole range, if both ends are given."""
    by = as_list(by)
    known = df.where(F.col(id_col).isNotNull())
    inside = known
    if lo is not None:
        inside = inside.where(F.col(id_col) >= lo)
    if hi is not None:
        inside = inside.where(F.col(id_col) <= hi)
    ids = inside.select(*by, id_col).distinct()
    t = ids.schema[id_col].dataType
    nb = neighbours(ids, by, [id_col], id_col, rows_per_bucket=rows_per_bucket)
    x, nxt = F.col(id_col), F.col("_next")

    def seg(cond, a, b):
        return F.when(cond, F.struct(a.cast(t).alias("a"), b.cast(t).alias("b")))
    # every hole hangs off one present id: the gap to its successor, and for
    # the key's first/last id the gap to lo/hi -- one pass over the pairs
    segs = [seg(F.col("_next_exists") & (nxt > x + 1), x + 1, nxt - 1)]
    if lo is not None:
        segs.append(seg(~F.col("_prev_exists") & (x > F.lit(lo)), F.lit(lo), x - 1))
    if hi is not None:
        segs.append(seg(~F.col("_next_exists") & (x < F.lit(hi)), x + 1, F.lit(hi)))
    holes = (nb.select(*by, F.explode(F.array(*segs)).alias("_h")).where(F.col("_h").isNotNull())
               .select(*by, F.col("_h.a").alias("_a"), F.col("_h.b").alias("_b")))
    if lo is not None and hi is not None and lo <= hi:
        in_range = F.col(id_col).between(lo, hi)
        none = known.groupBy(*by).agg(F.max(in_range).alias("_any")).where(~F.col("_any"))
        holes = holes.unionByName(none.select(*by, F.lit(lo).cast(t).alias("_a"), F.lit(hi).cast(t).alias("_b")))
    # expand in two levels so a huge hole is spread over many tasks
    step = 1 << 20
    blocks = holes.select(*by, "_b", F.explode(F.sequence(
        F.col("_a"), F.col("_b"), F.lit(step).cast(holes.schema["_a"].dataType))).alias("_s"))
    return blocks.select(
        *by, F.explode(F.sequence(F.col("_s"), F.least(F.col("_b"), F.col("_s") + step - 1)))
        .alias(out))


# --------------------------------------------------------------------------
# Pair sum
# --------------------------------------------------------------------------
def pair_sum(df: DataFrame, by, value: str, idx, target) -> DataFrame:
    """First pair (i < j, lexicographic on index) per key with
    value_i + value_j = target. NULLs never match.

    No pair enumeration: for every (key, value) the smallest index is kept;
    each row j looks up its complement's smallest index, and the best valid
    (i, j) per key is a min aggregate. (If the complement's smallest index is
    not below j, no smaller i exists for that j.)
    """
    by = as_list(by)
    idx_cols = as_list(idx)
    ikey = F.struct(*[F.col(c) for c in idx_cols])
    base = df.where(F.col(value).isNotNull()).select(*by, value, ikey.alias("_i"))
    first = base.groupBy(*by, value).agg(F.min("_i").alias("_mi"))
    probe = base.select(*by, (F.lit(target) - F.col(value)).alias(value), F.col("_i").alias("_j"))
    m = probe.join(first, [*by, value]).where(F.col("_mi") < F.col("_j"))
    best = m.groupBy(*by).agg(F.min(F.struct("_mi", "_j")).alias("_p"))
    return best.select(*by, F.col("_p._mi").alias("i"), F.col("_p._j").alias("j"))


# --------------------------------------------------------------------------
# Pointer composition
# --------------------------------------------------------------------------
def pointer_compose(df: DataFrame, idx: str, val: str, out: str = "composed") -> DataFrame:
    """nums[nums[i]]: equi-join value -> index; out-of-range pointers give NULL."""
    look = df.select(F.col(idx).alias("_k"), F.col(val).alias(out))
    return df.join(look, df[val] == look["_k"], "left").drop("_k")
