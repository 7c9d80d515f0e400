"""Incremental marts with Structured Streaming.

A target is a folder of parquet parts. ``foreachBatch`` folds each micro-batch on its
own (only the inserted block, like a materialized view firing on insert) and
overwrites the part ``stream=<id>/batch=<n>``: the path is the record of what was
applied, so a replayed batch rewrites its own part, several streams feed one target,
and nothing is listed on the driver. Readers fold the parts: sums add up, latest rows
win by version, running totals win by batch.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.aggs import count_bitmaps, distinct_bitmaps, latest_by_key, merge_bitmaps
from ..operators.common import as_list
from ..session import scratch_path
from ..sources.tables_io import ctas

Fold = Callable[[DataFrame], DataFrame]


def sum_fold(keys: Sequence[str] | str, counters: Sequence[str]) -> Fold:
    """Rows add up per key (NULL counts as 0)."""
    keys, counters = as_list(keys), list(counters)
    return lambda df: df.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in counters])


def latest_fold(keys: Sequence[str] | str, version: Sequence[str] | str,
                tie: Sequence[str] | str | None = None) -> Fold:
    """The row with the highest (version, tie) per key survives."""
    return lambda df: latest_by_key(df, as_list(keys), version, tie)


def read_target(spark: SparkSession, target: str, fold: Fold) -> DataFrame:
    """The folded content of a target."""
    out = fold(spark.read.parquet(target))
    return out.drop("stream", "batch")


def land_stream_files(df: DataFrame, path: str, order: str, rows_per_file: int = 1_000_000) -> str:
    """Write ``df`` as time-ordered parquet files (an insert log) of bounded size; how
    many follows from the data."""
    df.repartitionByRange(order).sortWithinPartitions(order) \
        .write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema: StructType,
                bytes_per_trigger: int = 10 << 30) -> DataFrame:
    """Parquet files as a stream; a micro-batch takes about ``bytes_per_trigger``."""
    return (spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_trigger)
            .option("pathGlobFilter", "*.parquet").parquet(path))


def stream_id(checkpoint: str) -> str:
    """Names a stream by its checkpoint, which is what makes its batch ids unique."""
    return "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def fold_stream(stream: DataFrame, target: str, checkpoint: str, fold: Fold,
                output_mode: str = "append", query_name: str | None = None) -> None:
    """Run ``stream`` to the end of its available input, writing the fold of each
    micro-batch as the part of that (stream, batch)."""
    fold_stream_into(stream, {target: fold}, checkpoint, output_mode, query_name)


def fold_stream_into(stream: DataFrame, targets: dict[str, Fold], checkpoint: str,
                     output_mode: str = "append", query_name: str | None = None) -> None:
    """``fold_stream`` with several targets that one pass over the stream keeps."""
    own = stream_id(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        for target, fold in targets.items():
            fold(batch).write.mode("overwrite").parquet(f"{target}/stream={own}/batch={batch_id}")

    writer = (stream.writeStream.outputMode(output_mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    q = (writer.queryName(query_name) if query_name else writer).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def streaming_totals(stream: DataFrame, target: str, keys: Sequence[str] | str,
                     aggs: dict[str, object], checkpoint: str) -> None:
    """M2 with the state store: running totals per key live in Spark's state; each
    trigger writes only the keys that changed (update mode). Read with ``totals_fold``."""
    totals = stream.groupBy(*as_list(keys)).agg(*[c.alias(n) for n, c in aggs.items()])
    fold_stream(totals, target, checkpoint, lambda batch: batch, "update")


def totals_fold(keys: Sequence[str] | str, counters: Sequence[str]) -> Fold:
    """Running totals of ``streaming_totals``: of each stream the latest of a key, which
    several streams into one target add up (batch numbers count within a stream only)."""
    keys = as_list(keys)
    return lambda df: sum_fold(keys, counters)(latest_by_key(df, ["stream", *keys], "batch"))


# ---------------------------------------------------------------- distinct counters
def sketch_fold(keys: Sequence[str] | str, value: str, lg_k: int = 12) -> Fold:
    """M2: a HyperLogLog sketch of the distinct values per key, 2^``lg_k`` registers
    whatever the number of values; sketches of parts merge."""
    return lambda df: df.groupBy(*as_list(keys)).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def read_sketches(spark: SparkSession, target: str, keys: Sequence[str] | str, out: str = "estimate") -> DataFrame:
    """Estimated distinct values per key of a target of sketches."""
    parts = spark.read.parquet(target)
    return parts.groupBy(*as_list(keys)).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def bitmap_fold(keys: Sequence[str] | str, value: str) -> Fold:
    """M2: the distinct values of an integer column per key, exactly, as bitmaps."""
    return lambda df: distinct_bitmaps(df, keys, value)


def read_bitmaps(spark: SparkSession, target: str, keys: Sequence[str] | str, out: str = "n_distinct") -> DataFrame:
    """Distinct values per key of a target of bitmaps."""
    return count_bitmaps(merge_bitmaps(spark.read.parquet(target), keys), keys, out)


def sketch_error(lg_k: int = 12, sigmas: float = 3.0) -> float:
    """Relative error of an estimate that ``sigmas`` standard errors allow."""
    return sigmas * 1.04 / math.sqrt(2 ** lg_k)


def backfill(spark: SparkSession, target: str, fold: Fold,
             run: Callable[[str, str], None]) -> tuple[DataFrame, str]:
    """Back up the folded target, then replay the whole insert log into an empty
    one from a fresh checkpoint (``run(new_target, checkpoint)``)."""
    backup = ctas(spark, read_target(spark, target, fold), "backup")
    fresh = scratch_path(spark, "replayed")
    run(fresh, scratch_path(spark, "ckpt"))
    return backup, fresh
