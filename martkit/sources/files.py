"""File and JDBC sources/sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import stored

CSV = {"header": True, "quote": '"', "escape": '"'}


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: CSV with a header row and no index column; quotes inside fields are
    doubled, and fields with line ends are quoted."""
    df.write.mode(mode).options(**CSV).csv(path)


def csv_scan(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header. A declared schema is the default and must have the
    header's names in the header's order (an error otherwise); inference (an extra
    full pass over the files) only when none is given. Malformed rows are errors.

    Files are split, so one large file is many tasks. ``multi_line``: quoted fields may
    hold line ends, and then a file is one task (without it, such a row is malformed)."""
    r = spark.read.options(**CSV, multiLine=multi_line, mode="FAILFAST")
    if schema is not None:
        return r.schema(schema).option("enforceSchema", False).csv(path)
    return r.option("inferSchema", True).csv(path)


CORRUPT = "_corrupt_record"


def split_rejects(parsed: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of rows read with a corrupt-record column."""
    kept = stored(parsed.select(*columns, CORRUPT, F.col("_metadata.file_path").alias("_file")), "parsed")
    good = kept.where(F.col(CORRUPT).isNull()).select(*columns)
    return good, kept.where(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("raw"))


def csv_scan_rejects(spark: SparkSession, path: str, schema: StructType,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV as ``(good, rejected)``, instead of an error at the first malformed row:
    the rows of ``schema``, and ``file, raw`` of each row with another number of fields or
    a value that is not of its column's type. The files are parsed once and kept, so that
    the two always add up to the rows."""
    parsed = spark.read.options(**CSV, multiLine=multi_line, mode="PERMISSIVE", enforceSchema=False,
                                columnNameOfCorruptRecord=CORRUPT).schema(
        StructType([*schema.fields, StructField(CORRUPT, StringType())])).csv(path)
    return split_rejects(parsed, schema.fieldNames())


def jdbc_scan(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10_000,
              properties: dict | None = None) -> DataFrame:
    """Read a remote relational table in parallel.

    With ``partition_column`` the range [lower, upper] is split into
    ``num_partitions`` strides, one query (and one task) each; filters and
    the projection are pushed into the remote query by the JDBC source.
    Credentials come from ``properties`` (never from code).
    """
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", fetch_size))
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC read needs lower_bound, upper_bound, num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
