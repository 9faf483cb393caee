"""Streaming jobs: restart from the checkpoint is exactly-once; stream equals batch."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators import joins as J
from quayside.operators import tables as T
from quayside.streaming import streams as S

DDL = "project_id STRING, event_name STRING, event_time TIMESTAMP_NTZ, insert_id STRING, n BIGINT"


def _rows(spark, ids, n=1):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("p", "e", base + dt.timedelta(hours=i), str(i), n) for i in ids], DDL)


def test_restart_is_exactly_once(spark, scratch):
    landing, ckpt = scratch("landing"), scratch("ckpt")
    spec = T.TableSpec(path=scratch("tbl"), key=("project_id", "event_name", "event_time", "insert_id"))
    schema = _rows(spark, [0]).schema
    _rows(spark, range(0, 10)).write.mode("append").parquet(landing)
    S.stream_upsert(spark, landing, schema, spec, ckpt)
    S.stream_upsert(spark, landing, schema, spec, ckpt)  # restart, nothing new: no batch
    _rows(spark, range(5, 15), n=2).write.mode("append").parquet(landing)  # re-delivery + new
    S.stream_upsert(spark, landing, schema, spec, ckpt)
    got = {r.insert_id: r.n for r in T.read_latest(spark, spec).collect()}
    assert got == {**{str(i): 1 for i in range(0, 5)}, **{str(i): 2 for i in range(5, 15)}}
    assert T.read_raw(spark, spec).count() == 20  # two landed batches, no replays


def test_daily_counts_stream_equals_batch(spark, scratch):
    landing, ckpt = scratch("landing"), scratch("ckpt")
    rows = _rows(spark, range(0, 72))
    rows.filter(F.col("event_time") < F.lit("2024-01-02").cast("timestamp_ntz")).write.mode("append").parquet(landing)
    rows.filter(F.col("event_time") >= F.lit("2024-01-02").cast("timestamp_ntz")).write.mode("append").parquet(landing)
    spec = T.TableSpec(path=scratch("daily"), key=("day",))
    counts = S.daily_counts(S.file_stream(spark, landing, rows.schema, max_files_per_trigger=1), "event_time")
    S.counts_to_table(counts, spec, ckpt)
    got = sorted((str(r.day), r.n) for r in T.read_latest(spark, spec).collect())
    assert got == [("2024-01-01", 24), ("2024-01-02", 24), ("2024-01-03", 24)]


def test_a_late_first_delivery_is_kept(spark, scratch):
    landing = scratch("landing")
    spec = T.TableSpec(path=scratch("tbl"), key=("project_id", "event_name", "event_time", "insert_id"))
    for hours in (24 * 20, 24 * 21, 24 * 5, 24 * 20):
        _rows(spark, [hours]).coalesce(1).write.mode("append").parquet(landing)
        S.dedupe_to_table(S.file_stream(spark, landing, _rows(spark, [0]).schema, max_files_per_trigger=1), spec, landing + "-ckpt")
    assert sorted(r.insert_id for r in T.read_latest(spark, spec).collect()) == ["120", "480", "504"]


def test_stream_and_batch_share_one_sequence(spark, scratch):
    spec = T.TableSpec(path=scratch("tbl"), key=("project_id", "event_name", "event_time", "insert_id"))
    T.upsert(_rows(spark, [0], n=1), spec)
    for n in (2, 3):  # the second with a new checkpoint
        landing = scratch("landing")
        _rows(spark, [0], n=n).write.parquet(landing)
        S.stream_upsert(spark, landing, _rows(spark, [0]).schema, spec, scratch("ckpt"))
        assert [r.n for r in T.read_latest(spark, spec).collect()] == [n]
    T.upsert(_rows(spark, [0], n=4), spec)
    assert [r.n for r in T.read_latest(spark, spec).collect()] == [4]
