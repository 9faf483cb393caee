"""The daily loads as Structured Streaming jobs.

Landing folders are file-stream sources; every sink is a replacing table
written from ``foreachBatch`` with the same clock-based load sequence as the batch
loads, so the last delivery wins whichever way it came.  A replayed batch (after a
failure) adds the same rows again, which collapse on read.  Checkpoints live under the shared root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators import tables as T


def file_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A landing folder as an unbounded table (new files are new rows)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def upsert_batches(stream: DataFrame, spec: T.TableSpec, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Continuous landing → replacing table: each micro-batch is appended as a
    load of its own (cheap insert; newest wins on read)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        T.upsert(batch, spec)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_upsert(spark: SparkSession, folder: str, schema, spec: T.TableSpec, checkpoint: str,
                  max_files_per_trigger: int | None = None) -> None:
    """Run the landing → table job over everything landed so far (``availableNow``)."""
    q = upsert_batches(file_stream(spark, folder, schema, max_files_per_trigger=max_files_per_trigger), spec, checkpoint)
    q.awaitTermination()


def _as_event_time(stream: DataFrame, ts: str) -> DataFrame:
    """Wall-clock NTZ columns are read as UTC."""
    from pyspark.sql.types import TimestampNTZType

    if isinstance(stream.schema[ts].dataType, TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def dedupe_to_table(stream: DataFrame, spec: T.TableSpec, checkpoint: str) -> None:
    """Drop re-delivered events by key, however late they come: the replacing
    table (``spec.key``) is the memory, so no state is kept and no row is dropped
    for its age."""
    upsert_batches(stream, spec, checkpoint).awaitTermination()


def append_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append-mode file sink (exactly-once via the sink's commit log)."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(
        "append"
    ).trigger(availableNow=True).start()
    q.awaitTermination()


def daily_counts(stream: DataFrame, ts: str) -> DataFrame:
    """Per-UTC-day event counts.  The state is one row per day, bounded by the
    calendar, so there is no watermark and a row of any age is counted."""
    return _as_event_time(stream, ts).groupBy(F.to_date(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def counts_to_table(counts: DataFrame, spec: T.TableSpec, checkpoint: str) -> None:
    """Update-mode aggregate → keyed table (day): each batch's changed days are
    upserted, the latest batch wins on read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        T.upsert(batch, spec)

    q = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    q.awaitTermination()
