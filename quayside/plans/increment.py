"""Incremental planning on batch tables.

The driver only ever reads one-row results here (a watermark, a ledger maximum);
day lists are generated with ``sequence`` and are bounded by the calendar, not
by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.coerce import epoch
from quayside.operators import tables as T

LEDGER_SCHEMA = "project_id STRING, completed_date DATE, rows_indexed BIGINT, completed_at TIMESTAMP_NTZ, status STRING"
LATE_DATA_DAYS = 3


def watermark_value(stored: DataFrame, col: str):
    """Greatest stored value, or None when empty or only the epoch sentinel."""
    c = F.col(col)
    return stored.agg(F.max(F.when(c > epoch().cast(stored.schema[col].dataType), c))).first()[0]


def watermark_increment(stubs: DataFrame, stored: DataFrame, bumped: str, created: str, stored_col: str) -> DataFrame:
    """Stubs newer than the stored watermark (``bumped``, else ``created``); all when none stored."""
    wm = watermark_value(stored, stored_col)
    ts = F.coalesce(F.col(bumped), F.col(created))
    return stubs if wm is None else stubs.filter(ts > F.lit(wm))


def days_between(spark: SparkSession, start, end, name: str = "day") -> DataFrame:
    """Inclusive list of days (empty when start > end)."""
    if start is None or end is None or start > end:
        return spark.createDataFrame([], f"{name} DATE")
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias(name)
    )


def _as_date(v):
    if v is None or isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def date_plan(spark: SparkSession, ledger: DataFrame, today, backfill: tuple | None = None,
              from_date=None, day_col: str = "completed_date", project_id: str | None = None) -> DataFrame:
    """Days to process (of one project, where ``project_id`` is given).

    backfill=(from, to): exactly that range.  Daily: last completed day + 1 up to
    yesterday; without any completed day, ``from_date`` or yesterday.  Up to
    date → empty plan.
    """
    today = _as_date(today)
    yesterday = today - dt.timedelta(days=1)
    if backfill is not None:
        return days_between(spark, _as_date(backfill[0]), _as_date(backfill[1]))
    last = _as_date(_completed(ledger, project_id).agg(F.max(day_col)).first()[0])
    if last is not None:
        start = last + dt.timedelta(days=1)
    else:
        start = _as_date(from_date) or yesterday
    return days_between(spark, start, yesterday)


def _completed(ledger: DataFrame, project_id: str | None) -> DataFrame:
    """Ledger rows marked complete, of one project or of all."""
    if "status" in ledger.columns:
        ledger = ledger.filter(F.col("status") == "complete")
    return ledger if project_id is None else ledger.filter(F.col("project_id") == project_id)


def pending_dates(plan: DataFrame, ledger: DataFrame, day_col: str = "completed_date", project_id: str | None = None) -> DataFrame:
    """Planned days not yet completed (restartable backfill), of one project where given."""
    done = _completed(ledger, project_id).select(F.col(day_col).alias("day")).distinct()
    return plan.join(done, "day", "left_anti")


def ledger_gaps(ledger: DataFrame, group: str = "project_id", day_col: str = "completed_date") -> DataFrame:
    """Holes below each project's last completed day (never revisited by max+1
    resume): days with no mark, or with one that is not ``complete``."""
    span = _completed(ledger, None).groupBy(group).agg(F.max(day_col).alias("_hi")).join(
        ledger.groupBy(group).agg(F.min(day_col).alias("_lo")), group)
    every = span.select(group, F.explode(F.sequence(F.least("_lo", "_hi"), "_hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    done = _completed(ledger, None).select(group, F.col(day_col).alias("day")).distinct()
    return every.join(done, [group, "day"], "left_anti")


def late_data_guard(day_counts: DataFrame, today, min_age_days: int = LATE_DATA_DAYS) -> DataFrame:
    """Adds ``mark_complete``: a day with events is complete; an empty day only
    once it is at least ``min_age_days`` old."""
    age = F.datediff(F.lit(today).cast("date"), F.col("day"))
    return day_counts.withColumn("mark_complete", (F.col("rows") > 0) | (age >= min_age_days))


def mark_complete(spark: SparkSession, days: DataFrame, ledger: T.TableSpec, project_id: str, run_ts) -> None:
    """Record (project, day, rows, 'complete') for the given days; the latest mark wins."""
    rows = days.select(
        F.lit(project_id).alias("project_id"), F.col("day").alias("completed_date"),
        F.col("rows").cast("bigint").alias("rows_indexed"),
        F.lit(run_ts).cast("timestamp_ntz").alias("completed_at"), F.lit("complete").alias("status"),
    )
    T.upsert(rows, ledger)


def ledger_spec(path: str) -> T.TableSpec:
    return T.TableSpec(path=path, key=("project_id", "completed_date"), version="completed_at", schema=LEDGER_SCHEMA)


def lookback_window(df: DataFrame, day_col: str, days: int, today) -> DataFrame:
    """Rows of the last ``days`` days before ``today`` (overlapping re-load window)."""
    d = F.col(day_col).cast("date")
    t = F.lit(today).cast("date")
    return df.filter((d >= F.date_sub(t, days)) & (d < t))
