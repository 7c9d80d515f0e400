"""Layouts for lookups on several keys, and the lookups.

A table sorted on one key answers point lookups on that key alone. Along a
space-filling curve over several keys, every file and row group covers a small range
of each of them, so Parquet's own statistics skip most of the table for a lookup on any
key or pair. One copy of the table serves the lookups that would need an index each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from ..session import scratch_path
from .tables_io import read_as, write_table


def _cell(c: str, bounds: Sequence) -> Column:
    """How many of the sorted ``bounds`` (2^bits - 1) are at most the value: a binary
    search. NULL is below all."""
    steps = F.array(*[F.lit((len(bounds) + 1) >> i) for i in range(1, (len(bounds) + 1).bit_length())])
    table = F.array(*[F.lit(b) for b in bounds])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.col(c) >= F.element_at(table, at + step), at + step).otherwise(at))


def curve_position(df: DataFrame, cols: Sequence[str], bits: int = 8) -> Column:
    """Place of a row on a Z-order curve over ``cols`` (numbers, dates or times): the bits
    of each column's quantile cell, taken in turn, high bits first. Quantiles make equal
    shares whatever the scale, outliers and skew; they are 2^bits - 1 numbers a column."""
    for c in cols:
        if not isinstance(df.schema[c].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
            raise TypeError(f"{c}: a curve needs numbers, dates or times")
    if len(cols) * bits > 62:
        raise ValueError("more bits than a curve position holds")
    shares = F.array(*[F.lit(i / 2 ** bits) for i in range(1, 2 ** bits)])
    quantiles = df.agg(*[F.percentile_approx(c, shares, 100 * 2 ** bits).alias(f"q{i}")
                         for i, c in enumerate(cols)]).first()
    place = F.lit(0).cast("long")
    for i, (c, bounds) in enumerate(zip(cols, quantiles, strict=True)):
        if bounds is None:
            continue  # no value at all
        cell = _cell(c, bounds).cast("long")
        for bit in range(bits):
            place = place + F.shiftleft(F.shiftright(cell, bit).bitwiseAND(1), bit * len(cols) + len(cols) - 1 - i)
    return place


def curve_layout(spark: SparkSession, df: DataFrame, cols: Sequence[str], bits: int = 8,
                 bloom_cols: Sequence[str] = (), name: str = "curved", n_files: int | None = None,
                 row_group_bytes: int | None = None) -> DataFrame:
    """``df`` rewritten along a Z-order curve over ``cols``: ranges of the curve per
    file (without ``n_files``, as many as the session's advisory size asks for), and
    inside a file sorted by it; rows of one curve cell are spread by a hash of the row."""
    opts = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom_cols}
    if row_group_bytes:
        opts["parquet.block.size"] = str(row_group_bytes)
    placed = df.withColumn("_z", curve_position(df, cols, bits)).withColumn("_tie", F.xxhash64(*df.columns))
    order = ["_z", "_tie"]
    ranged = placed.repartitionByRange(n_files, *order) if n_files else placed.repartitionByRange(*order)
    path = write_table(ranged.sortWithinPartitions(*order).drop(*order), scratch_path(spark, name), options=opts)
    return read_as(spark, path, df.schema)


def lookup(table: DataFrame, keys: DataFrame, max_keys: int = 256) -> DataFrame:
    """The rows of ``table`` whose values in the columns of ``keys`` are one of its rows
    (NULL matches nothing). Up to ``max_keys`` keys become literals of the filter, which
    Parquet's statistics and bloom filters see; with more, it is a semi join."""
    cols = keys.columns
    known = keys.dropna().distinct()
    few = known.limit(max_keys + 1).collect()
    if len(few) > max_keys:
        return table.join(known, list(cols), "left_semi")
    if not few:
        return table.limit(0)
    rows = [reduce(Column.__and__, [F.col(c) == F.lit(v) for c, v in zip(cols, r, strict=True)]) for r in few]
    return table.where(reduce(Column.__or__, rows))
