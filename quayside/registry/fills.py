"""Stand-ins for the fills repair path on lineitem ⋈ orders.

On-chain fills: one per lineitem row — taker = customer, order uid = order key,
transaction hash in upper case (so the lowercase rule matters), log index =
line number, block time = ship date.  The landed fills table holds the fills
whose return flag is 'A'.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import filters as FL
from quayside.operators import joins as J
from quayside.operators import metrics as M
from quayside.registry.base import register, src

NOW = "2001-08-01"
LOOKBACK_DAYS = 90
KNOWN_DAYS = 365
BACKFILL_FROM = "1999-01-01"


def onchain_fills(spark, sf):
    li = src(spark, sf, "lineitem")
    o = src(spark, sf, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat(F.lit("0x"), F.col("o_custkey").cast("string")).alias("taker"),
        F.concat(F.lit("0x"), F.col("l_orderkey").cast("string")).alias("order_uid"),
        F.concat(F.lit("0xAB"), F.col("l_orderkey").cast("string")).alias("transaction_hash"),
        F.col("l_linenumber").alias("log_index"),
        F.col("l_shipdate").alias("block_timestamp"),
        "l_returnflag",
        "l_linestatus",
    )


def landed_fills(spark, sf):
    s = onchain_fills(spark, sf).filter(F.col("l_returnflag") == "A")
    return s.select(
        "order_uid",
        F.lower("transaction_hash").alias("tx_hash"),
        "log_index",
        F.col("taker").alias("owner"),
        F.col("block_timestamp").alias("ingested_at"),
    )


_SRC_SQL = """WITH src AS (
  SELECT '0x' || CAST(o_custkey AS VARCHAR) AS taker, '0x' || CAST(l_orderkey AS VARCHAR) AS order_uid,
         '0xAB' || CAST(l_orderkey AS VARCHAR) AS transaction_hash, l_linenumber AS log_index,
         l_shipdate AS block_timestamp, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
tgt AS (
  SELECT order_uid, lower(transaction_hash) AS tx_hash, log_index, taker AS owner, block_timestamp AS ingested_at
  FROM src WHERE l_returnflag = 'A'
),
missing AS (
  SELECT taker, order_uid, lower(transaction_hash) AS tx_hash, log_index FROM src s
  WHERE order_uid IS NOT NULL AND order_uid <> '' AND block_timestamp >= DATE '1999-01-01'
    AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.order_uid = s.order_uid
                    AND t.tx_hash = lower(s.transaction_hash) AND t.log_index = s.log_index)
)"""


def _missing(spark, sf):
    return J.missing_fills(onchain_fills(spark, sf), landed_fills(spark, sf), start=BACKFILL_FROM)


@register("missing_fills", _SRC_SQL + "\nSELECT * FROM missing")
def missing_fills(spark, sf):
    """Left anti join on (order_uid, lower(tx_hash), log_index) from the backfill date."""
    return _missing(spark, sf)


@register(
    "missing_by_owner",
    _SRC_SQL + "\nSELECT taker, count(DISTINCT order_uid) AS missing_orders FROM missing GROUP BY taker "
    "ORDER BY missing_orders DESC, taker",
)
def missing_by_owner(spark, sf):
    """Distinct missing orders per owner, heaviest first."""
    return J.missing_by_owner(_missing(spark, sf))


_OWNERS_SQL = "SELECT DISTINCT taker FROM src WHERE taker IS NOT NULL AND taker <> '' AND block_timestamp >= TIMESTAMP '2000-01-01'"


def _owners(spark, sf):
    return M.distinct_owners(onchain_fills(spark, sf), since="2000-01-01")


@register("distinct_owners", _SRC_SQL + "\n" + _OWNERS_SQL)
def distinct_owners(spark, sf):
    """Distinct non-blank takers from a start date."""
    return _owners(spark, sf)


@register(
    "owner_semi",
    _SRC_SQL + f"\nSELECT * FROM tgt WHERE owner IN ({_OWNERS_SQL})",
)
def owner_semi(spark, sf):
    """Landed fills restricted to the discovered owners (IN-list → semi join)."""
    return J.owner_semi(landed_fills(spark, sf), _owners(spark, sf))


@register(
    "skip_known_fills",
    _SRC_SQL
    + f""",
known AS (
  SELECT DISTINCT lower(order_uid) AS u, lower(tx_hash) AS t, log_index AS l FROM tgt
  WHERE owner IN ({_OWNERS_SQL}) AND ingested_at >= TIMESTAMP '{NOW}' - INTERVAL {KNOWN_DAYS} DAY
),
fresh AS (SELECT order_uid, transaction_hash AS tx_hash, log_index, taker FROM src WHERE l_linestatus = 'O')
SELECT * FROM fresh n WHERE NOT EXISTS (
  SELECT 1 FROM known k WHERE k.u = lower(n.order_uid) AND k.t = lower(n.tx_hash) AND k.l = n.log_index)""",
)
def skip_known_fills(spark, sf):
    """Fetched trades minus keys already held for these owners within the known-key window."""
    fresh = onchain_fills(spark, sf).filter(F.col("l_linestatus") == "O").select(
        "order_uid", F.col("transaction_hash").alias("tx_hash"), "log_index", "taker"
    )
    return J.skip_known_fills(fresh, landed_fills(spark, sf), _owners(spark, sf), NOW, KNOWN_DAYS)


@register(
    "lookback_filter",
    _SRC_SQL + f"\nSELECT taker, order_uid, log_index, block_timestamp FROM src "
    f"WHERE block_timestamp >= TIMESTAMP '{NOW}' - INTERVAL {LOOKBACK_DAYS} DAY",
)
def lookback_filter(spark, sf):
    """Last N days before a reference time (the reference clock is a parameter)."""
    s = onchain_fills(spark, sf).select("taker", "order_uid", "log_index", "block_timestamp")
    return FL.lookback_filter(s, "block_timestamp", LOOKBACK_DAYS, NOW)


@register(
    "from_date_filter",
    _SRC_SQL + f"\nSELECT taker, order_uid, log_index, block_timestamp FROM src WHERE block_timestamp >= DATE '{BACKFILL_FROM}'",
)
def from_date_filter(spark, sf):
    """Optional lower bound of a backfill or repair."""
    s = onchain_fills(spark, sf).select("taker", "order_uid", "log_index", "block_timestamp")
    return FL.from_date_filter(s, "block_timestamp", BACKFILL_FROM)
