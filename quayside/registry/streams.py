"""Stand-ins for the streaming jobs, checked against the batch truth.

The landing folder receives the events in two drops (the first half of the
month, then the rest) and, later, a re-delivery of the 'click' events; each
stream runs with ``availableNow`` over what has landed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import tables as T
from quayside.registry.base import register, src
from quayside.session import scratch_path
from quayside.streaming import streams as S

KEY = ["project_id", "event_name", "event_time", "insert_id"]


def _rows(spark, sf):
    ev = src(spark, sf, "events")
    return ev.select(
        F.lit("p1").alias("project_id"), F.col("event_type").alias("event_name"), F.col("ts").alias("event_time"),
        F.col("event_id").cast("string").alias("insert_id"), F.col("user_id").cast("string").alias("distinct_id"),
    )


def _land(spark, sf, redeliver: bool):
    """Land events in time order as two drops (+ optional click re-delivery)."""
    folder = scratch_path(spark, "landing")
    rows = _rows(spark, sf)
    mid = F.lit("2024-01-16").cast("timestamp_ntz")
    rows.filter(F.col("event_time") < mid).write.mode("append").parquet(folder)
    rows.filter(F.col("event_time") >= mid).write.mode("append").parquet(folder)
    if redeliver:
        rows.filter(F.col("event_name") == "click").write.mode("append").parquet(folder)
    return folder, rows.schema


_EVENTS_SQL = """SELECT 'p1' AS project_id, event_type AS event_name, ts AS event_time, CAST(event_id AS VARCHAR) AS insert_id,
       CAST(user_id AS VARCHAR) AS distinct_id FROM events"""


@register("stream_upsert", _EVENTS_SQL)
def stream_upsert(spark, sf):
    """Landing folder → replacing table via foreachBatch; re-deliveries collapse on read."""
    folder, schema = _land(spark, sf, redeliver=True)
    spec = T.TableSpec(path=scratch_path(spark, "stream_table"), key=tuple(KEY))
    S.stream_upsert(spark, folder, schema, spec, scratch_path(spark, "ckpt"), max_files_per_trigger=4)
    return T.read_latest(spark, spec)


@register("stream_dedupe", _EVENTS_SQL)
def stream_dedupe(spark, sf):
    """Re-delivered events dropped by key, whatever their age."""
    folder, schema = _land(spark, sf, redeliver=True)
    spec = T.TableSpec(path=scratch_path(spark, "dedupe_out"), key=tuple(KEY))
    S.dedupe_to_table(S.file_stream(spark, folder, schema, max_files_per_trigger=4), spec, scratch_path(spark, "ckpt"))
    return T.read_latest(spark, spec)


@register(
    "stream_daily_counts",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1",
)
def stream_daily_counts(spark, sf):
    """Per-day counts of events of any age, upserted per micro-batch."""
    folder, schema = _land(spark, sf, redeliver=False)
    spec = T.TableSpec(path=scratch_path(spark, "daily_counts"), key=("day",))
    counts = S.daily_counts(S.file_stream(spark, folder, schema, max_files_per_trigger=2), "event_time")
    S.counts_to_table(counts, spec, scratch_path(spark, "ckpt"))
    return T.read_latest(spark, spec)
