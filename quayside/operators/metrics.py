"""Aggregations, rankings and series collapses.

"Last in payload order" and "first occurrence" rules are per-group ``max``/
``min`` of a struct led by the position columns: Spark aggregates partially
before the shuffle, positions are unique, and no group is ever collected into
one task the way a per-group window would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.coerce import boundary_day, epoch, json_text


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def exact_distinct(df: DataFrame, group, col: str, name: str) -> DataFrame:
    """Exact distinct count per group (``uniqExact``), never approximate."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(F.countDistinct(col).alias(name))


def distinct_owners(source: DataFrame, owner_col: str = "taker", ts_col: str = "block_timestamp",
                    since=None) -> DataFrame:
    """Distinct non-blank owners, optionally from ``since`` on (lookback or backfill start)."""
    s = source.filter(F.col(owner_col).isNotNull() & (F.col(owner_col) != ""))
    if since is not None:
        s = s.filter(F.col(ts_col) >= (since if isinstance(since, Column) else F.lit(since).cast("timestamp")))
    return s.select(owner_col).distinct()


def edges_per_user(edges: DataFrame, user_col: str, name: str = "edges") -> DataFrame:
    return edges.groupBy(user_col).agg(F.count(F.lit(1)).alias(name))


def watermark_max(df: DataFrame, col: str, name: str = "watermark") -> DataFrame:
    """Greatest value, where the epoch sentinel counts as "no watermark" (NULL)."""
    c = F.col(col)
    return df.agg(F.max(F.when(c > epoch(), c)).alias(name))


def latest_data_date(df: DataFrame, col: str, name: str = "latest_date") -> DataFrame:
    return df.agg(F.to_date(F.max(col)).alias(name))


def last_per_group(df: DataFrame, group, order, value_cols) -> DataFrame:
    """Per group, the value columns of the row greatest by ``order`` (unique positions)."""
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, str) else list(order)
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    w = df.groupBy(*group).agg(F.max(F.struct(*order, *value_cols)).alias("_w"))
    return w.select(*group, *[F.col("_w")[c].alias(c) for c in value_cols])


def last_price_per_day(points: DataFrame, asset_col: str, ts_col: str, price_col: str, pos_col: str) -> DataFrame:
    """Collapse intraday points to the last one in payload order per (asset, UTC day).

    Points with a NULL time or price are skipped (malformed ticks).
    """
    p = points.filter(F.col(ts_col).isNotNull() & F.col(price_col).isNotNull())
    p = p.withColumn("day", F.to_date(F.col(ts_col)))
    return last_per_group(p, [asset_col, "day"], pos_col, price_col)


def merge_chart_windows(points: DataFrame, asset_col: str, day_col: str, price_col: str,
                        window_col: str, pos_col: str, conf_col: str, confidences: DataFrame | None = None) -> DataFrame:
    """Many chart windows per asset → one point per day; the later-fetched window
    wins, and the confidence is the last non-NULL one in fetch order.

    ``confidences`` (asset, window, confidence) holds those of all windows: one
    without points has no row among ``points`` but its confidence counts."""
    p = points.filter(F.col(price_col).isNotNull())
    price = F.max(F.struct(window_col, pos_col, price_col))[price_col].alias(price_col)
    conf = F.max(F.when(F.col(conf_col).isNotNull(), F.struct(window_col, conf_col)))[conf_col].alias(conf_col)
    days = p.groupBy(asset_col, day_col).agg(price)
    # Confidence is a per-asset property of the series (last non-null seen).
    confs = (points if confidences is None else confidences).groupBy(asset_col).agg(conf)
    return days.join(confs, asset_col, "left")


def series_coverage(series: DataFrame, asset_col: str, day_col: str) -> DataFrame:
    """Per asset: number of points, first day, last day."""
    return series.groupBy(asset_col).agg(
        F.count(F.lit(1)).alias("points"), F.min(day_col).alias("first_day"), F.max(day_col).alias("last_day")
    )


def capture_rate(expected: DataFrame, captured: DataFrame, user_col: str, expected_col: str) -> DataFrame:
    """Captured / expected edges in percent, and users whose feed returned nothing."""
    got = captured.groupBy(user_col).agg(F.count(F.lit(1)).alias("_got"))
    j = expected.join(got, user_col, "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
    return j.agg(
        F.sum(expected_col).cast("bigint").alias("expected_edges"),
        F.sum("_got").cast("bigint").alias("captured_edges"),
        F.round(F.sum("_got") * 100.0 / F.sum(expected_col), 4).cast("double").alias("capture_pct"),
        F.count_if((F.col("_got") == 0) & (F.col(expected_col) > 0)).alias("users_empty"),
    )


def truncation_check(events: DataFrame, ts_col: str, cap: int) -> DataFrame:
    """Per day: total, busiest hour, and whether the day is suspect / complete.

    A day with ≥ cap events is suspect; it is complete only if every hour of it
    stays below the cap (re-judged hour by hour).
    """
    hourly = events.groupBy(F.to_date(ts_col).alias("day"), F.hour(ts_col).alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return hourly.groupBy("day").agg(
        F.sum("n").cast("bigint").alias("events"),
        F.max("n").alias("max_hour_events"),
        F.count(F.lit(1)).alias("hours_seen"),
    ).select(
        "day", "events", "max_hour_events",
        (F.col("events") >= cap).alias("suspect"),
        (F.col("max_hour_events") < cap).alias("complete"),
    )


def load_totals(ledger: DataFrame, group: str = "operation") -> DataFrame:
    """Skipped / failed / inserted counts and inserted rows per group of the run ledger."""
    return ledger.groupBy(group).agg(
        F.count_if(F.col("result") == "skipped").alias("skipped"),
        F.count_if(F.col("result") == "failed").alias("failed"),
        F.count_if(F.col("result") == "inserted").alias("inserted"),
        F.sum(F.when(F.col("result") == "inserted", F.col("rows")).otherwise(0)).cast("bigint").alias("rows"),
    )


def poll_openness(polls: DataFrame) -> DataFrame:
    """Per poll: open by ``status`` (not close date), options, and vote sums with
    withheld counts (−1) excluded."""
    return polls.groupBy("post_id", "poll_name").agg(
        F.max((F.col("status") == "open").cast("int")).alias("is_open"),
        F.count(F.lit(1)).alias("options"),
        F.sum(F.nullif(F.col("option_votes"), F.lit(-1))).cast("bigint").alias("votes"),
        F.count_if(F.col("option_votes") == -1).alias("withheld_options"),
    )


def event_property_breakdown(events: DataFrame, props: dict[str, str], since,
                             name_col: str = "event_name", time_col: str = "event_time",
                             props_col: str = "properties") -> DataFrame:
    """Count by event name and JSON properties since a date, busiest first.

    ``props`` maps output column → JSON path; a missing property reads as ''.
    """
    e = events.filter(F.col(time_col) >= F.lit(since).cast(events.schema[time_col].dataType))
    cols = [json_text(props_col, path).alias(alias) for alias, path in props.items()]
    out = e.groupBy(F.col(name_col), *cols).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), name_col, *props.keys())


def first_per_id(df: DataFrame, id_col, pos_cols, value_cols) -> DataFrame:
    """First occurrence per id by position (config order, page then position)."""
    id_col = [id_col] if isinstance(id_col, str) else list(id_col)
    pos_cols = [pos_cols] if isinstance(pos_cols, str) else list(pos_cols)
    value_cols = [c for c in value_cols if c not in id_col]
    w = df.groupBy(*id_col).agg(F.min(F.struct(*pos_cols, *value_cols)).alias("_w"))
    return w.select(*id_col, *[F.col("_w")[c].alias(c) for c in pos_cols + value_cols])
