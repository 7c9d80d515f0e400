"""Incremental (Structured Streaming) queries.

The events table is landed as a time-ordered insert log whose files and
micro-batches are bounded by size; the final target must equal the batch answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import cents
from ..session import scratch_path
from ..sources.tables import Tables
from ..streaming.incremental import (backfill, bitmap_fold, file_stream, fold_stream, fold_stream_into,
                                     land_stream_files, latest_fold, read_bitmaps, read_sketches,
                                     read_target, sketch_error, sketch_fold, streaming_totals, sum_fold,
                                     totals_fold)
from .registry import query

LATEST_SQL = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
"""
TOTALS_SQL = """
SELECT event_type, count(*) AS n_events,
       sum(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)) :: BIGINT AS value_cents
FROM events GROUP BY 1
"""
LATEST = latest_fold("user_id", ["ts"], ["event_id"])


def _landed_events(spark: SparkSession, d: str):
    ev = Tables(spark, d).events.select("event_id", "user_id", "ts", "event_type", "value")
    return land_stream_files(ev, scratch_path(spark, "events_log"), "ts"), ev.schema


@query("incremental_mv", LATEST_SQL, "M1")
def incremental_mv(spark: SparkSession, d: str) -> DataFrame:
    """Latest event per user kept by a stream over the insert log; the same
    stream restarted on its checkpoint adds nothing (replay-safe)."""
    path, schema = _landed_events(spark, d)
    target, ckpt = scratch_path(spark, "latest_by_user"), scratch_path(spark, "ckpt")
    for _ in range(2):  # the restart finds no new input
        fold_stream(file_stream(spark, path, schema), target, ckpt, LATEST)
    return read_target(spark, target, LATEST)


@query("incremental_summing", TOTALS_SQL, "M2")
def incremental_summing(spark: SparkSession, d: str) -> DataFrame:
    """Counters folded by adding each micro-batch's partial sums."""
    path, schema = _landed_events(spark, d)
    target = scratch_path(spark, "totals_by_type")
    fold_stream(file_stream(spark, path, schema), target, scratch_path(spark, "ckpt"),
                lambda batch: batch.groupBy("event_type").agg(
                    F.count(F.lit(1)).alias("n_events"), F.sum(cents("value")).alias("value_cents")))
    return read_target(spark, target, sum_fold("event_type", ["n_events", "value_cents"]))


@query("streaming_state_totals", TOTALS_SQL, "M2")
def streaming_state_totals(spark: SparkSession, d: str) -> DataFrame:
    """The same counters kept in the streaming state store (update mode)."""
    path, schema = _landed_events(spark, d)
    target = scratch_path(spark, "totals_state")
    streaming_totals(file_stream(spark, path, schema), target, "event_type",
                     {"n_events": F.count(F.lit(1)), "value_cents": F.sum(cents("value"))},
                     scratch_path(spark, "ckpt"))
    return read_target(spark, target, totals_fold("event_type", ["n_events", "value_cents"]))


@query("streaming_distinct", """
SELECT event_type, count(DISTINCT user_id) AS n_users, TRUE AS estimate_in_bound FROM events GROUP BY event_type
""", "M2")
def streaming_distinct(spark: SparkSession, d: str) -> DataFrame:
    """Distinct users per event type kept by a stream, exactly as bitmaps and estimated
    by sketches, in one pass; restarting the stream on its checkpoint adds nothing."""
    path, schema = _landed_events(spark, d)
    sketches, bitmaps, ckpt = (scratch_path(spark, n) for n in ("user_sketches", "user_bitmaps", "ckpt"))
    for _ in range(2):
        fold_stream_into(file_stream(spark, path, schema), {
            sketches: sketch_fold("event_type", "user_id"), bitmaps: bitmap_fold("event_type", "user_id")}, ckpt)
    exact = read_bitmaps(spark, bitmaps, "event_type", "n_users")
    near = read_sketches(spark, sketches, "event_type").withColumnRenamed("event_type", "_type")
    off = F.abs(F.col("estimate") - F.col("n_users"))
    return exact.join(near, F.col("event_type").eqNullSafe(F.col("_type"))).select(
        "event_type", "n_users", (off <= sketch_error() * F.col("n_users") + 1).alias("estimate_in_bound"))


@query("backfill_replay", LATEST_SQL, "S22")
def backfill_replay(spark: SparkSession, d: str) -> DataFrame:
    """Build the mart, then back it up and replay the whole log into an empty one
    from a fresh checkpoint: the replay equals the batch answer."""
    path, schema = _landed_events(spark, d)

    def run(target: str, ckpt: str) -> None:
        fold_stream(file_stream(spark, path, schema), target, ckpt, LATEST)

    target = scratch_path(spark, "latest_by_user")
    run(target, scratch_path(spark, "ckpt"))
    _, fresh = backfill(spark, target, LATEST, run)
    return read_target(spark, fresh, LATEST)
