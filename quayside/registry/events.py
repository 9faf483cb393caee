"""Stand-ins on ``events``: the replacing event table, breakdowns and truncation.

Landed events: one load of every event plus a re-delivery of the 'click'
events (a second load), keyed like the raw-events table by (project, event name,
event time, insert id).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import metrics as M
from quayside.operators import tables as T
from quayside.registry.base import register, src

PROJECT = "p1"
EVENT_KEY = ["project_id", "event_name", "event_time", "insert_id"]


def landed_events(spark, sf):
    """Events as stored rows of the raw-events table, with one re-delivered load."""
    ev = src(spark, sf, "events")
    rows = ev.select(
        F.lit(PROJECT).alias("project_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").alias("event_time"),
        F.col("event_id").cast("string").alias("insert_id"),
        F.col("user_id").cast("string").alias("distinct_id"),
        F.col("props").alias("properties"),
    )
    first = rows.withColumn(T.SEQ, F.lit(1).cast("bigint"))
    again = rows.filter(F.col("event_name") == "click").withColumn(T.SEQ, F.lit(2).cast("bigint"))
    return first.unionByName(again)


def latest_events(spark, sf):
    landed = landed_events(spark, sf)
    cols = [c for c in landed.columns if c != T.SEQ]
    return T.latest(landed, EVENT_KEY, [T.SEQ], keep=cols + [T.SEQ]).select(*cols)


_LATEST_EVENTS_SQL = """
WITH landed AS (
  SELECT 'p1' AS project_id, event_type AS event_name, ts AS event_time, CAST(event_id AS VARCHAR) AS insert_id,
         CAST(user_id AS VARCHAR) AS distinct_id, props AS properties, 1 AS load_seq FROM events
  UNION ALL
  SELECT 'p1', event_type, ts, CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), props, 2 FROM events
  WHERE event_type = 'click'
),
latest AS (
  SELECT * FROM landed
  QUALIFY row_number() OVER (PARTITION BY project_id, event_name, event_time, insert_id
                             ORDER BY load_seq DESC, distinct_id DESC, properties DESC) = 1
)"""

BREAKDOWN_SINCE = "2024-01-10"
BREAKDOWN_PROPS = {"prop_k": "$.k", "prop_city": "$.$city"}

BREAKDOWN_SQL = f"""{_LATEST_EVENTS_SQL}
SELECT event_name, coalesce(json_extract_string(properties, '$.k'), '') AS prop_k,
       coalesce(json_extract_string(properties, '$."$city"'), '') AS prop_city, count(*) AS n
FROM latest WHERE event_time >= TIMESTAMP '{BREAKDOWN_SINCE}'
GROUP BY ALL ORDER BY n DESC, event_name, prop_k, prop_city
"""


@register("event_property_breakdown", BREAKDOWN_SQL)
def event_property_breakdown(spark, sf):
    """Flagship: latest rows of the replacing event table → count by event and two
    JSON properties since a date, busiest first."""
    return M.event_property_breakdown(latest_events(spark, sf), BREAKDOWN_PROPS, BREAKDOWN_SINCE)


@register(
    "truncation_check",
    """SELECT day, CAST(sum(n) AS BIGINT) AS events, max(n) AS max_hour_events,
       sum(n) >= 25 AS suspect, max(n) < 25 AS complete
FROM (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2)
GROUP BY day""",
)
def truncation_check(spark, sf):
    """Days at or above the cap are suspect; complete only if every hour is below it.

    The cap is a parameter (100,000 in production); 25 here gives the small table
    both outcomes."""
    return M.truncation_check(src(spark, sf, "events"), "ts", cap=25)
