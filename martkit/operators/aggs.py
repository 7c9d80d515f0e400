"""Aggregation operators (A*).

All of them are hash aggregates with map-side partial aggregation, so a hot
group is combined inside each input task before the shuffle. Nothing here
collects a group into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import money, ratio_half_up
from .common import as_list


def money_sum(c) -> Column:
    """Exact sum of a 2-decimal money column: a decimal sum, which does not depend on
    the order of adding, given back as the nearest double."""
    return F.sum(money(c)).cast("double")


def cube_report(df: DataFrame, dims: Sequence[str], sums: dict[str, Column | str],
                count: str = "row_count", gid: str = "gid",
                distinct: dict[str, str] | None = None) -> DataFrame:
    """CUBE over ``dims`` with sums, a row count and, on request, counts of
    distinct values (``distinct``: output name -> column).

    Columns are summed as they are: money is passed as a decimal
    (``functions.scalar.money``), which sums exactly in any order. ``gid``
    (grouping id, first dim = highest bit) tells a subtotal row from a group whose
    key really is NULL.

    Rows are added up at the finest grain first, and only these sums are cubed. A
    distinct value is in a cell if any of its rows is: each value's set of finest groups
    (a partial aggregate, so a value with a third of all rows is as small as any) gives
    its cells, which are counted. No raw row is copied per grouping set.
    """
    names = list(sums)
    fine = df.groupBy(*dims).agg(
        *[F.sum(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in sums.items()], F.count(F.lit(1)).alias(count))
    out = fine.cube(*dims).agg(
        *[F.sum(c).cast(fine.schema[c].dataType).alias(c) for c in names], F.sum(count).alias(count),
        F.grouping_id(*dims).cast("int").alias(gid))
    out = out.select(*dims, *names, count, gid)
    for i, (name, value) in enumerate((distinct or {}).items()):
        cells = _cells_of_values(df, dims, value).groupBy(*[f"_d{j}" for j in range(len(dims))], "_gid").agg(
            F.count(F.lit(1)).alias(f"_n{i}"))
        same = F.col(gid) == F.col("_gid")
        for j, c in enumerate(dims):
            same = same & F.col(c).eqNullSafe(F.col(f"_d{j}"))
        out = out.join(cells, same, "left").withColumn(name, F.coalesce(f"_n{i}", F.lit(0).cast("long"))) \
            .drop("_gid", f"_n{i}", *[f"_d{j}" for j in range(len(dims))])
    return out.select(*dims, *names, count, *(distinct or {}), gid)


def _cells_of_values(df: DataFrame, dims: Sequence[str], value: str) -> DataFrame:
    """The cube cells (``_gid``, ``_d0``, ``_d1``, ...) of every distinct value."""
    own = df.where(F.col(value).isNotNull()).groupBy(value).agg(
        F.collect_set(F.struct(*[F.col(c).alias(f"_d{j}") for j, c in enumerate(dims)])).alias("_groups"))
    n = len(dims)

    def masked(group: Column) -> Column:
        return F.array(*[F.struct(F.lit(mask).alias("_gid"), *[
            (F.lit(None).cast(df.schema[c].dataType) if mask >> (n - 1 - j) & 1 else group[f"_d{j}"]).alias(f"_d{j}")
            for j, c in enumerate(dims)]) for mask in range(2 ** n)])

    return own.select(F.explode(F.array_distinct(F.flatten(F.transform("_groups", masked)))).alias("_c")).select("_c.*")


# ---------------------------------------------------------------- A2: mergeable distinct counts
def distinct_bitmaps(df: DataFrame, by: Sequence[str] | str, value: str) -> DataFrame:
    """A2: the distinct values of an integer column per group, as bitmaps: ``by``,
    ``bucket`` and ``bitmap`` (4 KB for 32,768 neighbouring values). They can be stored,
    merged with those of later rows (``merge_bitmaps``), rolled up to coarser groups and
    counted (``count_bitmaps``) without the rows, and the counts stay exact. For ids that
    are dense in their range; few values spread over many buckets are better kept as they are."""
    found = df.where(F.col(value).isNotNull()).select(
        *as_list(by), F.col(value).cast("long").alias("_v"))
    return found.groupBy(*as_list(by), F.bitmap_bucket_number("_v").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] | str) -> DataFrame:
    """Bitmaps of the coarser groups ``by``: the union, bucket by bucket."""
    return bitmaps.groupBy(*as_list(by), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, by: Sequence[str] | str, out: str = "n_distinct") -> DataFrame:
    """Distinct values per group of bitmaps that are merged to the groups ``by``."""
    return bitmaps.groupBy(*as_list(by)).agg(F.sum(F.bitmap_count("bitmap")).alias(out))


def cube_bitmaps(bitmaps: DataFrame, dims: Sequence[str], out: str = "n_distinct", gid: str = "gid") -> DataFrame:
    """Distinct values in every cell of the cube over ``dims``, from bitmaps of the finest
    groups: the cube copies bitmaps, not rows."""
    cells = bitmaps.cube(*dims, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"),
                                              F.grouping_id(*dims, "bucket").alias("_gid"))
    cells = cells.where(F.col("_gid").bitwiseAND(1) == 0).withColumn(gid, F.shiftright("_gid", 1).cast("int"))
    return cells.groupBy(*dims, gid).agg(F.sum(F.bitmap_count("bitmap")).alias(out))


def next_day_retention(df: DataFrame, user: str, date: str, out: str = "fraction") -> DataFrame:
    """Share of users active on the day after their first day
    (rounded to 2 decimals). NULL dates are ignored."""
    # distinct (user, day) first: a partial aggregate that shrinks even a hot
    # user to one row per active day before anything joins on the user
    d = df.where(F.col(date).isNotNull()).select(user, F.to_date(date).alias("_d")).distinct()
    first = d.groupBy(user).agg(F.min("_d").alias("_f"))
    back = (d.join(first, user)
             .where(F.col("_d") == F.date_add("_f", 1))
             .select(user).distinct())
    n_back = back.select(F.count(F.lit(1))).scalar()  # scalar subquery, runs once
    return first.agg(F.count(F.lit(1)).alias("_n")).select(ratio_half_up(n_back, "_n").alias(out))


def common_prefix(df: DataFrame, by, text: str, out: str = "prefix") -> DataFrame:
    """Longest prefix shared by all non-NULL strings of each group.

    The shared prefix of a set equals the shared prefix of its byte-wise
    min and max, so two partial aggregates suffice."""
    by = as_list(by)
    mm = df.groupBy(*by).agg(F.min(text).alias("_a"), F.max(text).alias("_b"))
    return mm.select(*by, prefix_of(F.col("_a"), F.col("_b")).alias(out))


def prefix_of(a: Column, b: Column) -> Column:
    """Longest common prefix of two strings ('' if either is NULL)."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""),
                      lambda x, y: F.coalesce(x == y, F.lit(False)))
    pos = F.array_position(same, False)
    n = F.when(pos == 0, F.least(F.length(a), F.length(b))).otherwise(pos - 1)
    return F.coalesce(a.substr(F.lit(1), n.cast("int")), F.lit(""))


def summing_fold(state: DataFrame, delta: DataFrame, keys: Sequence[str],
                 counters: Sequence[str]) -> DataFrame:
    """Rows with equal keys add their counters (NULL counts as 0)."""
    u = state.select(*keys, *counters).unionByName(delta.select(*keys, *counters))
    return u.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c)
                                  for c in counters])


def latest_by_key(df: DataFrame, keys: Sequence[str], version: Sequence[str] | str,
                  tie: Sequence[str] | str | None = None) -> DataFrame:
    """The row with the highest (version, tie) per key survives.

    ``max_by`` is a partial aggregate (a hot key is reduced inside every input
    task before the shuffle) unlike ``row_number() = 1`` over a window.
    """
    keys = as_list(keys)
    ver = as_list(version) + as_list(tie)
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
                .agg(F.max_by(F.struct(*rest), F.struct(*ver)).alias("_row")))
    return picked.select(*keys, "_row.*")


def best_by_sum(df: DataFrame, by: Sequence[str] | str, item: str, amount: str,
                out: str = "best") -> DataFrame:
    """Per group, the ``item`` with the highest summed ``amount``; ties go to the
    smallest item. Two partial aggregates (group, item) -> group."""
    by = as_list(by)
    s = df.groupBy(*by, item).agg(F.sum(money(amount)).alias("_s"))
    return s.groupBy(*by).agg(
        F.max_by(F.col(item), F.struct(F.col("_s"), -F.col(item))).alias(out))


def user_price_report(df: DataFrame, user: str, product: str, price: str) -> DataFrame:
    """Per user min/max/avg price (2 decimals) and the best product; lines
    without a price are no part of the average."""
    stats = df.groupBy(user).agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.sum(money(price)).alias("_sum"), F.count(price).alias("_n"))
    # round(avg, 2) half-up, exact: from the decimal sum and the count of prices
    stats = stats.select(user, "min_price", "max_price",
                         ratio_half_up(F.col("_sum") * 100, F.col("_n") * 100).alias("avg_price"))
    best = best_by_sum(df, user, product, price, "best_product")
    return stats.join(best, user)


def divisible_difference(df: DataFrame, value: str, m: int, by=None,
                         out: str = "difference") -> DataFrame:
    """Sum of values not divisible by m minus sum of those divisible."""
    v = F.col(value)
    term = F.when(v % m != 0, v).otherwise(-v)
    by = as_list(by)
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.sum(term).alias(out))


def entity_rollup(parent: DataFrame, parent_key: str, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per parent with a count per child table (0 when none).

    Each child is pre-aggregated to one row per key before the join."""
    out = parent
    for name, (child, fk) in children.items():
        cnt = child.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias(name))
        out = (out.join(cnt, out[parent_key] == cnt["_fk"], "left").drop("_fk")
                  .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long"))))
    return out
