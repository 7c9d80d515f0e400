"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_number(df: DataFrame, name: str) -> Column:
    """A number for differences of ``name`` (numeric, date or timestamp): exact for
    all but floating point, and free of time zones."""
    x, dtype = F.col(name), df.schema[name].dataType.simpleString()
    if dtype == "timestamp_ntz":
        # wall-clock micros from field arithmetic: no cast to an instant, so no
        # session time zone (and no DST gap) can reorder values
        return (F.unix_date(x.cast("date")).cast("long") * 86_400_000_000
                + F.hour(x).cast("long") * 3_600_000_000 + F.minute(x).cast("long") * 60_000_000
                + (F.date_part(F.lit("SECOND"), x) * 1_000_000).cast("long"))
    if dtype == "timestamp":
        return F.unix_micros(x)
    if dtype == "date":
        return F.unix_date(x).cast("long")
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return x.cast("decimal(20,0)")
    if dtype in ("float", "double") or dtype.startswith("decimal"):
        return x
    raise TypeError(f"nearest needs a numeric, date or timestamp column, got {dtype}")


ROWS_PER_BUCKET = 2_000_000


def split_hot(df: DataFrame, order: Iterable, rows_per_bucket: int | None = None
              ) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with a ``_chunk``), by ``_key``.

    Keys with more than ``rows_per_bucket`` rows are found once, by a partial count,
    and stored, so that joins with them are broadcast only if that table is measured
    to be small. Ordinary keys need one plain window. The hot ones are
    range-partitioned on (key, full order tuple) - equal-depth whatever the values:
    outliers, one shared instant, strings - and stored with the number of their
    range, which is monotone in the order within a key; operators work per (key,
    chunk) and stitch the edges. The limit only decides where rows are worked on,
    never a result. Without a hot key the second frame is None.
    """
    rpb = int(rows_per_bucket or ROWS_PER_BUCKET)
    hot = stored(df.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rpb), "hot-keys")
    rows = hot.agg(F.sum("_n")).first()[0]
    if not rows:
        return df, None
    keys = hot.select("_key")
    chunks = (df.join(keys, "_key", "left_semi")
              .repartitionByRange(-(-rows // rpb), F.col("_key"), *[col(o) for o in order])
              .withColumn("_chunk", F.spark_partition_id()))
    return df.join(keys, "_key", "left_anti"), stored(chunks, "hot-chunks")


def range_chunks(df: DataFrame, order: Iterable, n: int | None = None,
                 out: str = "_chunk") -> DataFrame:
    """Range-partition on ``order`` and tag each row with its partition index.

    The bounds come from a sample, which depends on the order in which rows
    arrive; callers that read the result twice must materialise it first
    (``dense_id`` checkpoints it). Without ``n`` the partition count is the
    session's and AQE may merge small neighbouring ranges (still contiguous and
    in order, so the partition index stays monotone in ``order``).
    """
    cols = [col(c) for c in order]
    r = df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)
    return r.withColumn(out, F.spark_partition_id())
