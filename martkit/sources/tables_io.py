"""Table writes and maintenance.

Tables are parquet directories under the shared checkpoint root
(``session.scratch_path``). Rewrites always go to a new directory: Spark
cannot overwrite a path it is reading in the same plan, and a reader of the
old version is never disturbed (the "swap" is returning the new path).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.scalar import readable_size
from ..session import scratch_path, stored


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Sequence[str] = (), compression: str | None = None,
                options: dict | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.parquet(path)
    return path


def read_as(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table folder with its known columns (also where no file is written yet: an
    empty partitioned table has none to infer them from)."""
    return spark.read.schema(schema).parquet(path)


def ctas(spark: SparkSession, df: DataFrame, name: str, **kw) -> DataFrame:
    """CREATE TABLE AS SELECT (also a backup copy); returns the new table."""
    path = write_table(df, scratch_path(spark, name), **kw)
    return read_as(spark, path, df.schema)


def insert_select(df: DataFrame, path: str) -> None:
    """INSERT INTO ... SELECT (by name: columns reordered to the table's)."""
    spark = df.sparkSession
    try:
        table = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        table = None  # the first insert creates the table
    if table is not None:
        if set(table.columns) != set(df.columns):
            raise ValueError(f"columns {df.columns} do not match the table's {table.columns}")
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    df.write.mode("append").parquet(path)


def commit(df: DataFrame, name: str) -> DataFrame:
    """Materialise a new version of a table (staged write to a new
    directory) and return it. Safe when ``df`` reads the old version."""
    spark = df.sparkSession
    return read_as(spark, write_table(df, scratch_path(spark, name)), df.schema)


def truncate_reload(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Empty, then load: the load is written once, to a new version of the table
    beside the old one, and returned. ``df`` may read the table being replaced, and
    whoever reads the old version never sees an empty one."""
    return read_as(spark, write_table(df, f"{path.rstrip('/')}-v{uuid.uuid4().hex[:12]}"), df.schema)


# ---------------------------------------------------------------- S15 / L4
def with_month(df: DataFrame, ts: str, out: str = "ym") -> DataFrame:
    """Month partition value (yyyyMM int); NULL ts lands in the default partition."""
    return df.withColumn(out, (F.year(ts) * 100 + F.month(ts)).cast("int"))


def month_range(df: DataFrame, ts: str, lo: str, hi: str, ym: str = "ym") -> DataFrame:
    """L4: half-open [lo, hi) on ``ts`` plus the implied ``ym`` bounds, which
    Spark will not derive itself, so partition pruning happens."""
    lo_c, hi_c = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    last = datetime.fromisoformat(hi) - timedelta(microseconds=1)
    lo_ym = int(lo[:4]) * 100 + int(lo[5:7])
    hi_ym = last.year * 100 + last.month
    return df.where((F.col(ym) >= lo_ym) & (F.col(ym) <= hi_ym)
                    & (F.col(ts) >= lo_c) & (F.col(ts) < hi_c))


def _by_month(df: DataFrame, ts: str, sort_by: Sequence[str]) -> DataFrame:
    # REBALANCE on the partition column: rows of a month go to the same tasks
    # (few files per month), and AQE splits a hot month over several tasks
    # instead of one task writing a third of the data
    d = with_month(df, ts).hint("rebalance", "ym")
    return d.sortWithinPartitions("ym", *sort_by) if sort_by else d


def write_month_partitioned(df: DataFrame, ts: str, path: str, sort_by: Sequence[str] = ()) -> str:
    """Partition by month; inside each month cluster rows on
    ``sort_by`` so parquet min/max statistics skip row groups."""
    return write_table(_by_month(df, ts, sort_by), path, partition_by=["ym"])


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A month-partitioned table of ``schema``'s columns, with ``ym``."""
    return read_as(spark, path, StructType([*schema.fields, StructField("ym", IntegerType())]))


def reload_months(df: DataFrame, ts: str, path: str, sort_by: Sequence[str] = ()) -> DataFrame:
    """The months that ``df`` has rows of are replaced by these rows, by dynamic
    partition overwrite; the files of all other months stay as they are. ``df`` is staged
    first, so it may read the table itself. Returns the table."""
    spark = df.sparkSession
    staged = stored(df, "month-reload")
    _by_month(staged, ts, sort_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("ym").parquet(path)
    return read_months(spark, path, df.schema)


# ---------------------------------------------------------------- S17 / A1
_V1 = "spark.sql.sources.useV1SourceList"


def footer_scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet table through Spark's V2 source with aggregates pushed down: counts, and
    the least and greatest numbers or dates, whole or by partition column, come from the
    files' footers, and no data page is read. (Only the read is switched to V2; the
    pushdown setting has no effect on other reads.)"""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    sources = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(x for x in sources.split(",") if x.strip() != "parquet"))
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    finally:
        spark.conf.set(_V1, sources)


def footer_stats(table: DataFrame, columns: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """``n_rows`` and, per column, ``min_<c>`` and ``max_<c>`` of a ``footer_scan``;
    ``by``: partition columns. A table without files has 0 rows."""
    named = [(f(c), f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    counted = table.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *[x.alias(c) for x, c in named])
    if by:
        return counted
    # pushed down, the count of no footer is NULL, against its type: added up once more, it is 0
    return counted.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"),
                       *[F.max(c).alias(c) for _, c in named])


def partition_row_counts(table: DataFrame, part_col: str = "ym") -> DataFrame:
    """Rows per partition of a ``footer_scan`` (sums rows, not parts)."""
    return footer_stats(table, by=[part_col])


def table_size_report(df: DataFrame, name: str) -> DataFrame:
    """Bytes on disk (distinct files from the hidden metadata column),
    readable size and rows."""
    files = df.select(F.col("_metadata.file_path").alias("f"),
                      F.col("_metadata.file_size").alias("s"))
    per_file = files.groupBy("f").agg(F.max("s").alias("s"), F.count(F.lit(1)).alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")  # noqa: E731 - no file: 0
    tot = per_file.agg(total("s").alias("bytes"), total("n").alias("n_rows"))
    return tot.select(F.lit(name).alias("table_name"), "bytes",
                      readable_size("bytes").alias("readable"), "n_rows")


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-NULL count (and total rows)."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(f.name)).alias(f"_c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"_c{i}").alias("non_null")) for i, f in enumerate(fields)])
    return counts.select(F.explode(rows).alias("_f"), F.col("_rows").alias("n_rows")).select("_f.*", "n_rows")


# ---------------------------------------------------------------- S20 / S21
def typed_compact_rewrite(spark: SparkSession, raw: DataFrame, types: dict[str, str],
                          sort_by: Sequence[str], domains: dict[str, Sequence[str]] | None = None,
                          json_fields: dict[str, tuple[str, str]] | None = None,
                          month_of: str | None = None, name: str = "compact") -> DataFrame:
    """Text mart -> typed, narrow mart: casts to narrower types (a value that does
    not fit is an error), fields lifted out of JSON text (``json_fields``: new column
    -> (text column, JSON path); the text itself goes), domain checks (fail fast),
    month partitions, zstd, rows clustered by ``sort_by`` inside each file."""
    cols = []
    for c, t in types.items():
        e = F.col(c).cast(t)
        if domains and c in domains:
            vals = list(domains[c])
            e = F.when(e.isNull() | e.isin(*vals), e).otherwise(
                F.raise_error(F.concat(F.lit(f"{c} outside domain: "), e.cast("string"))))
        cols.append(e.alias(c))
    cols += [F.get_json_object(src, path).alias(c) for c, (src, path) in (json_fields or {}).items()]
    typed, parts = raw.select(*cols), []
    if month_of is not None:
        typed, parts = with_month(typed, month_of).hint("rebalance", "ym"), ["ym"]
    typed = typed.sortWithinPartitions(*parts, *sort_by)
    path = write_table(typed, scratch_path(spark, name), partition_by=parts, compression="zstd")
    return read_as(spark, path, typed.schema)


def clustered_layout(spark: SparkSession, df: DataFrame, cluster_by: Sequence[str],
                     bloom_cols: Sequence[str] = (), name: str = "clustered",
                     n_files: int | None = None) -> DataFrame:
    """Range-cluster on the lookup key and sort inside files (min/max
    skipping), plus parquet bloom filters for point lookups. Without ``n_files``,
    Spark merges ranges to its advisory partition size, so files follow the data."""
    opts = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom_cols}
    # a hash of the other columns breaks ties: one hot key value still spans many files
    rest = [c for c in df.columns if c not in cluster_by]
    order = [F.col(c) for c in cluster_by] + ([F.xxhash64(*rest)] if rest else [])
    d = df.repartitionByRange(n_files, *order) if n_files else df.repartitionByRange(*order)
    path = write_table(d.sortWithinPartitions(*order), scratch_path(spark, name), options=opts)
    return read_as(spark, path, df.schema)
