"""Stand-ins for incremental planning and the run ledger.

* orders: watermarks, lookback overlap, open-or-recent, today exclusion, day stamp
* events: the completed-date ledger (days that saw a purchase of value ≥ 150),
  date plans, gaps, marking complete, the late-data guard
* events as run-ledger rows (operation = event type)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import filters as FL
from quayside.operators import metrics as M
from quayside.operators import tables as T
from quayside.plans import increment as I
from quayside.plans import ledger as L
from quayside.registry.base import ORDERS_COLS, register, src
from quayside.session import scratch_path

_O = ", ".join(ORDERS_COLS)

# --------------------------------------------------------------------------- #
# Orders
# --------------------------------------------------------------------------- #

_WM_SQL = """WITH wm AS (
  SELECT max(o_orderdate) AS m FROM orders
  WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '2000-01-01' AND o_orderdate > TIMESTAMP '1970-01-01'
)"""


def _stored_topics(spark, sf):
    o = src(spark, sf, "orders")
    return o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))


@register(
    "watermark_increment",
    _WM_SQL + """
SELECT o_orderkey, o_orderdate FROM orders
WHERE coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END, o_orderdate) > (SELECT m FROM wm)""",
)
def watermark_increment(spark, sf):
    """Stubs bumped after the stored maximum (created time when bump is missing)."""
    o = src(spark, sf, "orders")
    stubs = o.select(
        "o_orderkey", "o_orderdate",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("bumped_at"),
    )
    return I.watermark_increment(stubs, _stored_topics(spark, sf), "bumped_at", "o_orderdate", "o_orderdate").select(
        "o_orderkey", "o_orderdate"
    )


@register("watermark_max", _WM_SQL + "\nSELECT m AS watermark FROM wm")
def watermark_max(spark, sf):
    """max(bumped_at) with the epoch sentinel treated as no watermark."""
    return M.watermark_max(_stored_topics(spark, sf), "o_orderdate")


@register("latest_data_date", "SELECT CAST(max(l_shipdate) AS DATE) AS latest_date FROM lineitem")
def latest_data_date(spark, sf):
    """Newest data date of a table (resume point)."""
    return M.latest_data_date(src(spark, sf, "lineitem"), "l_shipdate")


@register(
    "lookback_overlap",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-07-30' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""",
)
def lookback_overlap(spark, sf):
    """Daily load re-reads the last 3 days; the replacing key makes the overlap idempotent."""
    o = src(spark, sf, "orders")
    spec = T.TableSpec(path=scratch_path(spark, "orders_lb"), key=("o_orderkey",), month_of="o_orderdate")
    T.upsert(o.filter(F.col("o_orderdate") < F.lit("2001-07-31").cast("timestamp_ntz")), spec, seq=1)
    daily = I.lookback_window(o, "o_orderdate", 3, "2001-08-02").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    T.upsert(daily, spec, seq=2)
    return T.read_latest(spark, spec).select(*ORDERS_COLS)


_STATE = "CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'pending' ELSE 'closed' END"


@register(
    "open_or_recent",
    f"""SELECT o_orderkey, {_STATE} AS state, o_orderdate AS end_at FROM orders
WHERE {_STATE} IN ('active', 'pending') OR o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""",
)
def open_or_recent(spark, sf):
    """Proposals needing votes: active/pending, or ended within the last 30 days."""
    o = src(spark, sf, "orders")
    state = F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "P", "pending").otherwise("closed")
    p = o.select("o_orderkey", state.alias("state"), F.col("o_orderdate").alias("end_at"))
    return FL.open_or_recent(p, "state", "end_at", 30, "2001-08-01")


@register("exclude_today", "SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-01'")
def exclude_today(spark, sf):
    """The current UTC day is dropped unless asked for."""
    return FL.exclude_today(src(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "2001-08-01")


@register("target_day_stamp", "SELECT o_orderkey, o_totalprice, DATE '2001-07-31' AS block_date FROM orders")
def target_day_stamp(spark, sf):
    """Rows carry the requested day (today − 1), never the returned timestamp."""
    return FL.target_day_stamp(src(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "2001-08-01", 1)


# --------------------------------------------------------------------------- #
# Events: completed-date ledger
# --------------------------------------------------------------------------- #

PROJECT = "p1"
TODAY = "2024-02-03"
RUN1, RUN2 = "2024-02-01 00:00:00", "2024-02-03 00:00:00"

_LEDGER_SQL = """WITH counts AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
ledger AS (
  SELECT 'p1' AS project_id, day AS completed_date, n AS rows_indexed FROM counts
  WHERE day IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'purchase' AND value >= 150)
)"""


def _day_counts(spark, sf, only=None):
    ev = src(spark, sf, "events")
    if only is not None:
        ev = ev.filter(only)
    return ev.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def _ledger(spark, sf):
    ev = src(spark, sf, "events")
    big = ev.filter((F.col("event_type") == "purchase") & (F.col("value") >= 150)).select(F.to_date("ts").alias("day"))
    counts = _day_counts(spark, sf).join(big, "day", "left_semi")
    return counts.select(
        F.lit(PROJECT).alias("project_id"), F.col("day").alias("completed_date"), F.col("rows").alias("rows_indexed"),
        F.lit(RUN1).cast("timestamp_ntz").alias("completed_at"), F.lit("complete").alias("status"),
    )


@register(
    "date_plan",
    _LEDGER_SQL + f"""
SELECT CAST(unnest(generate_series(CAST(coalesce((SELECT max(completed_date) FROM ledger) + 1, DATE '2024-02-02') AS TIMESTAMP),
                                   TIMESTAMP '{TODAY}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day""",
)
def date_plan(spark, sf):
    """Daily mode: last completed day + 1 up to yesterday."""
    return I.date_plan(spark, _ledger(spark, sf), TODAY)


@register(
    "pending_dates",
    _LEDGER_SQL + """
SELECT CAST(d AS DATE) AS day FROM unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT completed_date FROM ledger)""",
)
def pending_dates(spark, sf):
    """Backfill plan minus completed days (restartable)."""
    ledger = _ledger(spark, sf)
    plan = I.date_plan(spark, ledger, TODAY, backfill=("2024-01-01", "2024-01-30"))
    return I.pending_dates(plan, ledger)


@register(
    "ledger_gaps",
    _LEDGER_SQL + """
SELECT 'p1' AS project_id, CAST(d AS DATE) AS day
FROM unnest(generate_series(CAST((SELECT min(completed_date) FROM ledger) AS TIMESTAMP),
                            CAST((SELECT max(completed_date) FROM ledger) AS TIMESTAMP), INTERVAL 1 DAY)) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT completed_date FROM ledger)""",
)
def ledger_gaps(spark, sf):
    """Completed-date holes below the maximum."""
    return I.ledger_gaps(_ledger(spark, sf))


@register(
    "mark_complete",
    """WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT 'p1' AS project_id, CAST(d AS DATE) AS completed_date, coalesce(c.n, 0) AS rows_indexed, 'complete' AS status
FROM unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) t(d)
LEFT JOIN c ON c.day = CAST(d AS DATE)""",
)
def mark_complete(spark, sf):
    """Re-marking days replaces their ledger row: the latest mark wins."""
    spec = I.ledger_spec(scratch_path(spark, "ledger"))
    T.upsert(_ledger(spark, sf), spec)
    plan = I.date_plan(spark, _ledger(spark, sf), TODAY, backfill=("2024-01-01", "2024-01-30"))
    counts = _day_counts(spark, sf, F.col("event_type") != "error")
    days = plan.join(counts, "day", "left").fillna(0, ["rows"])
    I.mark_complete(spark, days, spec, PROJECT, RUN2)
    return T.read_latest(spark, spec).select("project_id", "completed_date", "rows_indexed", "status")


@register(
    "late_data_guard",
    f"""WITH c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(d AS DATE) AS day, coalesce(c.n, 0) AS rows,
       coalesce(c.n, 0) > 0 OR DATE '{TODAY}' - CAST(d AS DATE) >= 3 AS mark_complete
FROM unnest(generate_series(TIMESTAMP '2024-01-25', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) t(d)
LEFT JOIN c ON c.day = CAST(d AS DATE)""",
)
def late_data_guard(spark, sf):
    """An empty day younger than 3 days is not marked complete."""
    plan = I.days_between(spark, "2024-01-25", "2024-02-02")
    days = plan.join(_day_counts(spark, sf), "day", "left").fillna(0, ["rows"])
    return I.late_data_guard(days, TODAY)


# --------------------------------------------------------------------------- #
# Run ledger
# --------------------------------------------------------------------------- #

_RESULT = "CASE WHEN value < 5 THEN 'failed' WHEN value < 20 THEN 'skipped' ELSE 'inserted' END"


def _ledger_rows(spark, sf):
    ev = src(spark, sf, "events")
    result = F.when(F.col("value") < 5, "failed").when(F.col("value") < 20, "skipped").otherwise("inserted")
    return ev.select(
        F.lit("daily").alias("job"), F.lit("events").alias("ingestor"), F.col("event_type").alias("operation"),
        result.alias("result"), (F.col("value") / 100).alias("duration_s"),
        F.when(result == "inserted", F.col("value").cast("bigint")).alias("rows"),
        F.concat(F.lit("raw_"), F.col("event_type")).alias("table_name"), F.col("ts").alias("logged_at"),
    )


@register(
    "run_ledger",
    f"""SELECT 'raw_' || event_type AS table_name, count(*) AS operations,
       CAST(sum(CASE WHEN {_RESULT} = 'inserted' THEN CAST(trunc(value) AS BIGINT) ELSE 0 END) AS BIGINT) AS rows
FROM events GROUP BY 1""",
)
def run_ledger(spark, sf):
    """Ledger rows appended to the run-ledger table, then per-table totals."""
    spec = T.TableSpec(path=scratch_path(spark, "run_ledger"), schema=L.LEDGER_DDL)
    T.append(_ledger_rows(spark, sf), spec)
    return L.table_totals(T.read_raw(spark, spec))


@register(
    "load_totals",
    f"""SELECT event_type AS operation,
       count(*) FILTER (WHERE {_RESULT} = 'skipped') AS skipped,
       count(*) FILTER (WHERE {_RESULT} = 'failed') AS failed,
       count(*) FILTER (WHERE {_RESULT} = 'inserted') AS inserted,
       CAST(sum(CASE WHEN {_RESULT} = 'inserted' THEN CAST(trunc(value) AS BIGINT) ELSE 0 END) AS BIGINT) AS rows
FROM events GROUP BY 1""",
)
def load_totals(spark, sf):
    """Skipped / failed / inserted counts by operation."""
    return M.load_totals(_ledger_rows(spark, sf))
