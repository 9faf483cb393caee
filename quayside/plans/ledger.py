"""Load reports, the run ledger and bounded writes (SURVEY 2.2 ``rows_inserted``,
``run_ledger``, ``bounded_write``)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.coerce import month_start
from quayside.operators import tables as T

LEDGER_DDL = (
    "job STRING, ingestor STRING, operation STRING, result STRING, "
    "duration_s DOUBLE, rows BIGINT, table_name STRING, logged_at TIMESTAMP"
)


def load_report(spark: SparkSession, spec: T.TableSpec, load: Callable[[], int]) -> DataFrame:
    """Row count before and after a load and the rows the load wrote.

    The written count comes from the write itself (an ``Observation``); the
    before/after counts are Parquet footer counts.  A failing count never fails
    the load: it is reported as NULL.
    """

    def count():
        try:
            return T.read_raw(spark, spec).count() if T.path_exists(spark, spec.path) else 0
        except Exception:  # report, never fail the load
            return None

    before = count()
    written = load()
    after = count()
    return spark.createDataFrame(
        [(before, after, written)], "rows_before BIGINT, rows_after BIGINT, rows_inserted BIGINT"
    )


def ledger_entry(spark: SparkSession, job: str, ingestor: str, operation: str, result: str,
                 duration_s: float, rows: int | None, table_name: str) -> DataFrame:
    """One ledger row (append it with ``tables.append``)."""
    return spark.createDataFrame(
        [(job, ingestor, operation, result, float(duration_s), rows, table_name)],
        "job STRING, ingestor STRING, operation STRING, result STRING, duration_s DOUBLE, rows BIGINT, table_name STRING",
    ).withColumn("logged_at", F.current_timestamp())


def timed(spark: SparkSession, ledger: T.TableSpec, job: str, ingestor: str, operation: str,
          table_name: str, fn: Callable[[], int | None]) -> int | None:
    """Run ``fn`` and append its outcome (inserted / failed, duration, rows) to the ledger."""
    t0 = time.monotonic()
    try:
        rows = fn()
        result = "inserted" if rows else "skipped"
    except Exception:
        rows, result = None, "failed"
        T.append(ledger_entry(spark, job, ingestor, operation, result, time.monotonic() - t0, rows, table_name), ledger)
        raise
    T.append(ledger_entry(spark, job, ingestor, operation, result, time.monotonic() - t0, rows, table_name), ledger)
    return rows


def table_totals(ledger: DataFrame) -> DataFrame:
    """Rows inserted and operations per table, from the ledger."""
    return ledger.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("operations"),
        F.sum(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows"),
    )


def month_batches(df: DataFrame, date_col: str, max_months: int) -> DataFrame:
    """Commit-group number per calendar month: ``_month, batch_no``, groups of
    ``max_months`` consecutive months, rows without a date in the first.

    Months are ranked on the distinct-month list, which has one row per calendar
    month (bounded by the time span, not the data)."""
    months = df.select(month_start(date_col).alias(T.MONTH)).distinct()
    number = F.greatest(F.lit(0), F.sum(F.col(T.MONTH).isNotNull().cast("int")).over(_all_months_window()) - 1)
    return months.select(F.col(T.MONTH).alias("_month"), (number / F.lit(max_months)).cast("bigint").alias("batch_no"))


def _all_months_window():
    from pyspark.sql import Window

    # One row per calendar month: a handful of rows, so a global order is cheap.
    return Window.orderBy(T.MONTH)


COMMITS_DDL = (
    "load_id STRING, batch_no BIGINT, first_month DATE, last_month DATE, n_months BIGINT, n_rows BIGINT, min_files BIGINT, "
    "seq BIGINT, state STRING"
)


def commits_spec(path: str) -> T.TableSpec:
    """The resume record of bounded writes: a row when a group is planned, one when it is committed."""
    return T.TableSpec(path=path, key=("load_id", "batch_no"), version="state_no", schema=COMMITS_DDL + ", state_no INT")


def _record(plan: DataFrame, state: str) -> DataFrame:
    return plan.withColumn("state", F.lit(state)).withColumn("state_no", F.lit({"planned": 0, "committed": 1}[state]))


def bounded_write(spark: SparkSession, df: DataFrame, spec: T.TableSpec, max_months: int = 90,
                  commits: T.TableSpec | None = None, load_id: str | None = None) -> DataFrame:
    """Write ``df`` month-partitioned in commits of at most ``max_months`` months
    each, with at most ``spec.max_records_per_file`` rows per file.

    The load is written once, by month, beside the resume record; each commit
    appends one group of consecutive months and is recorded when it is done.
    Called again with the same ``load_id`` after a failure, it goes on with the
    groups that are not recorded, from the rows written at first.  A group's rows
    carry its own load sequence, so a commit that was lost before its record is
    found in the table and only recorded.  Returns the plan: a row per group.
    """
    load_id = load_id or uuid.uuid4().hex
    commits = commits or commits_spec(spec.path.rstrip("/") + "__commits")
    staged = f"{commits.path.rstrip('/')}__loads/{load_id}"
    record = T.read_latest(spark, commits).filter(F.col("load_id") == load_id)
    columns = [f.strip().split()[0] for f in COMMITS_DDL.split(",")]
    if record.isEmpty():
        # The plan comes after the whole load is written: a load without a plan starts anew.
        T.with_defaults(df, spec).withColumn(T.MONTH, month_start(spec.month_of)).hint("rebalance", T.MONTH).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy(T.MONTH).parquet(staged)
        load = _staged_load(spark, staged, df, spec)
        files = F.ceil(F.col("n") / F.lit(spec.max_records_per_file)) if spec.max_records_per_file else F.lit(1)
        per_month = load.groupBy(T.MONTH).agg(F.count(F.lit(1)).alias("n"))
        first_seq = T.next_load_seq()
        plan = per_month.join(month_batches(load, T.MONTH, max_months), F.col(T.MONTH).eqNullSafe(F.col("_month"))).groupBy("batch_no").agg(
            F.min(T.MONTH).alias("first_month"), F.max(T.MONTH).alias("last_month"), F.count(F.lit(1)).alias("n_months"),
            F.sum("n").cast("bigint").alias("n_rows"), F.sum(files).cast("bigint").alias("min_files"),
        ).select(F.lit(load_id).alias("load_id"), "*", (F.lit(first_seq) + F.col("batch_no")).alias("seq"))
        T.append(_record(plan, "planned"), commits)
        record = T.read_latest(spark, commits).filter(F.col("load_id") == load_id)
    load = _staged_load(spark, staged, df, spec)
    # One row per group of months.
    for row in record.filter("state = 'planned'").orderBy("batch_no").collect():
        group = load.filter(F.col(T.MONTH).between(F.lit(row.first_month), F.lit(row.last_month)) if row.first_month else F.lit(False))
        if row.batch_no == 0:
            group = load.filter(F.col(T.MONTH).isNull() | F.coalesce(F.col(T.MONTH) <= F.lit(row.last_month).cast("date"), F.lit(False)))
        if not _has_seq(spark, spec, row.seq):
            T.append(group.withColumn(T.SEQ, F.lit(row.seq).cast("bigint")), spec)
        T.append(_record(spark.createDataFrame([row], record.schema).drop("state", "state_no"), "committed"), commits)
    return T.read_latest(spark, commits).filter(F.col("load_id") == load_id).select(*columns).drop("load_id", "seq")


def _staged_load(spark: SparkSession, path: str, df: DataFrame, spec: T.TableSpec) -> DataFrame:
    schema = T.with_defaults(df, spec).drop(T.MONTH).schema.add(T.MONTH, "date")
    return spark.read.schema(schema).parquet(path)


def _has_seq(spark: SparkSession, spec: T.TableSpec, seq: int) -> bool:
    """Whether rows of a commit are stored; Parquet's bounds on the sequence leave its files only."""
    if not T.path_bytes(spark, spec.path):
        return False
    stored = T.read_raw(spark, spec, merge=True)
    return T.SEQ in stored.columns and not stored.filter(F.col(T.SEQ) == seq).isEmpty()
