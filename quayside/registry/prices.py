"""Stand-ins for the price paths: allowlist, quotes, series collapses, prunes.

* allowlist: one token per ``part`` (config order = part key), chain from the
  part type (exercising aliases and the default), address from the part key
  (PROMO parts get a malformed one), CoinGecko id from the brand.
* spot quotes: one payload per ``lineitem`` row keyed ``GNOSIS:0XAB<partkey>``
  (upper case on purpose); NULL price when tax is 0, NULL confidence when the
  discount is 0.
* price tables for the prunes: ``orders`` as (asset = customer, day = order date).
* chart series: ``events`` as (asset = event type, time, value), position =
  event id, fetched in windows of 500 ids.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import filters as FL
from quayside.operators import joins as J
from quayside.operators import metrics as M
from quayside.operators import payloads as P
from quayside.operators import tables as T
from quayside.registry.base import register, src
from quayside.session import scratch_path
from quayside.sources.allowlist import load_allowlist

# --------------------------------------------------------------------------- #
# Allowlist
# --------------------------------------------------------------------------- #


def raw_allowlist(spark, sf):
    p = src(spark, sf, "part")
    chain = (
        F.when(F.col("p_type") == "ECONOMY", "XDAI")
        .when(F.col("p_type") == "STANDARD", "eth")
        .when(F.col("p_type") == "LARGE", "Arbitrum-One")
        .when(F.col("p_type") == "SMALL", F.lit(None))
        .when(F.col("p_type") == "MEDIUM", "base")
        .otherwise(F.lower("p_type"))
    )
    return p.select(
        F.col("p_partkey").alias("pos"),
        F.when(F.col("p_size") == 1, F.lit(" ")).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("symbol"),
        chain.alias("chain"),
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("not-hex-"), F.col("p_partkey").cast("string")))
        .otherwise(F.concat(F.lit("0xAB"), F.col("p_partkey").cast("string"))).alias("address"),
        F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.lower(F.regexp_replace("p_brand", "#", "-"))).alias("coingecko_id"),
        (F.col("p_size") > 10).alias("defillama"),
        (F.col("p_size") <= 40).alias("coingecko"),
    )


def allowlist(spark, sf):
    return load_allowlist(raw_allowlist(spark, sf))


_DIM_SQL = """WITH raw AS (
  SELECT p_partkey AS pos,
         CASE WHEN p_size = 1 THEN ' ' ELSE ' ' || p_name || ' ' END AS symbol,
         CASE p_type WHEN 'ECONOMY' THEN 'XDAI' WHEN 'STANDARD' THEN 'eth' WHEN 'LARGE' THEN 'Arbitrum-One'
                     WHEN 'SMALL' THEN NULL WHEN 'MEDIUM' THEN 'base' ELSE lower(p_type) END AS chain,
         CASE WHEN p_type = 'PROMO' THEN 'not-hex-' || CAST(p_partkey AS VARCHAR)
              ELSE '0xAB' || CAST(p_partkey AS VARCHAR) END AS address,
         CASE WHEN p_size > 45 THEN NULL ELSE lower(replace(p_brand, '#', '-')) END AS coingecko_id,
         p_size > 10 AS defillama, p_size <= 40 AS coingecko
  FROM part
),
dim AS (
  SELECT pos, trim(coalesce(symbol, '')) AS symbol,
         CASE lower(trim(coalesce(nullif(chain, ''), 'gnosis')))
           WHEN 'xdai' THEN 'gnosis' WHEN 'eth' THEN 'ethereum' WHEN 'arbitrum-one' THEN 'arbitrum'
           ELSE lower(trim(coalesce(nullif(chain, ''), 'gnosis'))) END AS chain,
         lower(trim(coalesce(address, ''))) AS address, nullif(coingecko_id, '') AS coingecko_id,
         coalesce(defillama, false) AS defillama, coalesce(coingecko, false) AS coingecko
  FROM raw WHERE trim(coalesce(symbol, '')) <> ''
)"""


@register("allowlist_dim", _DIM_SQL + "\nSELECT * FROM dim")
def allowlist_dim(spark, sf):
    """Trim symbols, drop blanks, resolve chain aliases (default gnosis), lowercase addresses."""
    return allowlist(spark, sf)


@register(
    "first_per_asset_id",
    _DIM_SQL + """
SELECT coingecko_id, pos, symbol FROM dim WHERE coingecko AND coingecko_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY coingecko_id ORDER BY pos) = 1""",
)
def first_per_asset_id(spark, sf):
    """One row per CoinGecko id: the first in configuration order."""
    d = allowlist(spark, sf).filter(F.col("coingecko") & F.col("coingecko_id").isNotNull())
    return M.first_per_id(d, "coingecko_id", "pos", ["symbol"])


@register(
    "safe_id_filter",
    _DIM_SQL + "\nSELECT pos, address, regexp_matches(address, '^0x[0-9a-f]+$') AS safe FROM dim",
)
def safe_id_filter(spark, sf):
    """Split identifiers into well-formed hex addresses and the rest (reported)."""
    ok, bad = FL.safe_id_split(allowlist(spark, sf), "address")
    return ok.select("pos", "address", F.lit(True).alias("safe")).unionByName(
        bad.select("pos", "address", F.lit(False).alias("safe"))
    )


WANTED = ["RED PLATE", "brand-7", "no-such-token"]


@register(
    "only_filter",
    _DIM_SQL + """
SELECT * FROM dim WHERE lower(symbol) IN ('red plate', 'brand-7', 'no-such-token')
   OR lower(coingecko_id) IN ('red plate', 'brand-7', 'no-such-token')""",
)
def only_filter(spark, sf):
    """Keep tokens whose symbol or id was asked for, case-insensitively."""
    wanted = spark.createDataFrame([(w,) for w in WANTED], "wanted STRING")
    kept, _unknown = FL.only_filter(allowlist(spark, sf), wanted)
    return kept


# --------------------------------------------------------------------------- #
# Spot quotes
# --------------------------------------------------------------------------- #


def spot_payloads(spark, sf):
    """Landed spot-price payloads ``(requested_day, body)``, one per lineitem row."""
    li = src(spark, sf, "lineitem", spread=True)
    coin = F.concat(F.lit("GNOSIS:0XAB"), F.col("l_partkey").cast("string"))
    quote = F.struct(
        F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("confidence"),
    )
    body = F.to_json(F.struct(F.create_map(coin, quote).alias("coins")))
    return li.select(F.to_date("l_shipdate").alias("requested_day"), body.alias("body"))


_SPOT_SQL = """spot AS (
  SELECT CAST(l_shipdate AS DATE) AS block_date, 'GNOSIS:0XAB' || CAST(l_partkey AS VARCHAR) AS coin,
         l_extendedprice AS price, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS confidence
  FROM lineitem WHERE l_tax <> 0
)"""


def spot_rows(spark, sf):
    return P.spot_price_rows(spot_payloads(spark, sf), "requested_day")


@register("spot_price_rows", "WITH " + _SPOT_SQL + "\nSELECT * FROM spot")
def spot_price_rows(spark, sf):
    """``{coins:{key:{price,confidence}}}`` → rows stamped with the requested day; NULL prices skipped."""
    return spot_rows(spark, sf)


_LOOKUP_SQL = _DIM_SQL + ", " + _SPOT_SQL + """,
matched AS (
  SELECT s.block_date, d.symbol, d.chain, d.address, s.price, s.confidence
  FROM spot s JOIN dim d ON lower(trim(s.coin)) = d.chain || ':' || d.address
)"""


@register("allowlist_lookup", _LOOKUP_SQL + "\nSELECT * FROM matched")
def allowlist_lookup(spark, sf):
    """Quotes ⋈ allowlist on ``chain:address`` (case-insensitive; checked-size broadcast)."""
    m = J.allowlist_lookup(spot_rows(spark, sf), allowlist(spark, sf))
    return m.select("block_date", "symbol", "chain", "address", "price", "confidence")


@register(
    "missing_assets",
    _LOOKUP_SQL + """
SELECT pos, symbol, chain, address FROM dim d WHERE defillama
  AND NOT EXISTS (SELECT 1 FROM matched m WHERE m.chain = d.chain AND m.address = d.address)""",
)
def missing_assets(spark, sf):
    """DefiLlama-enabled tokens without any returned quote."""
    d = allowlist(spark, sf).filter("defillama")
    m = J.allowlist_lookup(spot_rows(spark, sf), allowlist(spark, sf))
    return J.missing_assets(d, m, ["chain", "address"]).select("pos", "symbol", "chain", "address")


@register(
    "set_difference",
    _DIM_SQL + ", " + _SPOT_SQL + """
SELECT DISTINCT chain || ':' || address AS coin FROM dim WHERE defillama
EXCEPT SELECT lower(coin) FROM spot""",
)
def set_difference(spark, sf):
    """Requested coin keys minus returned coin keys."""
    req = allowlist(spark, sf).filter("defillama").select(F.concat_ws(":", "chain", "address").alias("coin"))
    got = spot_rows(spark, sf).select(F.lower("coin").alias("coin"))
    return J.set_difference(req, got)


# --------------------------------------------------------------------------- #
# Price history payloads
# --------------------------------------------------------------------------- #


@register(
    "history_price_rows",
    """SELECT 'part-' || CAST(p_partkey AS VARCHAR) AS asset_id, DATE '2001-07-31' AS block_date,
       p_retailprice AS price FROM part WHERE p_size <= 48""",
)
def history_price_rows(spark, sf):
    """Per-asset ``market_data.current_price.usd``; NULL skipped; stamped with the requested day."""
    p = src(spark, sf, "part")
    body = F.to_json(
        F.struct(
            F.struct(
                F.struct(F.when(F.col("p_size") <= 48, F.col("p_retailprice")).alias("usd")).alias("current_price")
            ).alias("market_data")
        )
    )
    payloads = p.select(F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("asset_id"), body.alias("body"))
    rows = P.history_price_rows(payloads, "asset_id")
    return FL.target_day_stamp(rows, "2001-08-01", 1)


def chart_windows(spark, sf):
    """Chart payloads: per event type, windows of 500 event ids, points in id order."""
    ev = src(spark, sf, "events")
    point = F.struct(
        F.col("event_id").alias("pos"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("price"),
    )
    win = ev.groupBy(F.col("event_type").alias("coin"), F.floor(F.col("event_id") / 500).alias("window_no")).agg(
        F.sort_array(F.collect_list(point)).alias("pts"),
        F.max(F.when(F.col("event_type") != "view", F.col("user_id") / F.lit(1000.0))).alias("confidence"),
    )
    body = F.to_json(
        F.struct(
            F.create_map(
                F.col("coin"),
                F.struct(
                    F.transform("pts", lambda p: F.struct(p["timestamp"].alias("timestamp"), p["price"].alias("price"))).alias("prices"),
                    F.col("confidence"),
                ),
            ).alias("coins")
        )
    )
    return win.select("coin", "window_no", body.alias("body"))


_CHART_SQL = """pts AS (
  SELECT event_type AS coin, event_id // 500 AS window_no, event_id AS pos,
         epoch_us(ts) // 1000000 AS ts_s, CASE WHEN event_type <> 'error' THEN value END AS price,
         CAST(ts AS DATE) AS day
  FROM events
)"""


@register(
    "chart_points",
    "WITH " + _CHART_SQL + """
SELECT coin, CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS day, price
FROM pts WHERE price IS NOT NULL""",
)
def chart_points(spark, sf):
    """``coins[coin].prices[{timestamp,price}]`` → (asset, nearest-midnight day, price); NULL skipped."""
    pts = P.chart_points(chart_windows(spark, sf))
    return pts.select("coin", "day", "price")


@register(
    "boundary_day",
    "WITH " + _CHART_SQL + """
SELECT coin, CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS day,
       arg_max(price, pos) AS price
FROM pts WHERE price IS NOT NULL GROUP BY ALL""",
)
def boundary_day_q(spark, sf):
    """Ticks snapped to the nearest UTC midnight (half-even); the last tick per day wins."""
    pts = P.chart_points(chart_windows(spark, sf))
    return M.last_per_group(pts, ["coin", "day"], ["window_no", "pos"], "price")


@register(
    "merge_chart_windows",
    "WITH " + _CHART_SQL + """,
conf AS (
  SELECT event_type AS coin, event_id // 500 AS window_no,
         max(CASE WHEN event_type <> 'view' THEN user_id / 1000.0 END) AS confidence
  FROM events GROUP BY ALL
),
last_conf AS (SELECT coin, arg_max(confidence, window_no) AS confidence FROM conf WHERE confidence IS NOT NULL GROUP BY coin)
SELECT p.coin, p.day, p.price, c.confidence
FROM (SELECT coin, CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS day,
             arg_max(price, window_no * 1000000000 + pos) AS price
      FROM pts WHERE price IS NOT NULL GROUP BY ALL) p
LEFT JOIN last_conf c ON p.coin = c.coin""",
)
def merge_chart_windows(spark, sf):
    """Windows → one point per day (later window wins) + last non-NULL confidence."""
    windows = chart_windows(spark, sf)
    return M.merge_chart_windows(P.chart_points(windows), "coin", "day", "price", "window_no", "pos", "confidence", P.chart_confidences(windows))


@register(
    "merge_empty_windows",
    "WITH " + _CHART_SQL + """
SELECT coin, CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS day,
       arg_max(price, window_no * 1000000000 + pos) AS price, CASE WHEN coin < 'p' THEN 0.9 ELSE 0.7 END::DOUBLE AS confidence
FROM pts WHERE price IS NOT NULL GROUP BY ALL""",
)
def merge_empty_windows(spark, sf):
    """The last window of some coins has a confidence and no points; it counts."""
    windows = chart_windows(spark, sf)
    quote = lambda c: F.to_json(F.struct(F.create_map("coin", F.struct(F.array().cast("array<string>").alias("prices"), F.lit(c).alias("confidence"))).alias("coins")))
    coins = windows.select("coin").distinct()
    windows = windows.unionByName(coins.select("coin", F.lit(1 << 40).alias("window_no"), quote(0.7).alias("body")))
    windows = windows.unionByName(coins.filter("coin < 'p'").select("coin", F.lit(1 << 41).alias("window_no"), quote(0.9).alias("body")))
    return M.merge_chart_windows(P.chart_points(windows), "coin", "day", "price", "window_no", "pos", "confidence", P.chart_confidences(windows))


def market_charts(spark, sf):
    """Market charts of the second price source: points of 500 event ids per page;
    the chart of 'error' is cut off."""
    point = F.struct("event_id", F.array(F.unix_millis(F.col("ts").cast("timestamp")).cast("double"), F.col("value")).alias("p"))
    pages = src(spark, sf, "events").groupBy(F.col("event_type").alias("coingecko_id"), F.floor(F.col("event_id") / 500).alias("page")).agg(
        F.sort_array(F.collect_list(point)).alias("pts"))
    body = F.to_json(F.struct(F.col("pts.p").alias("prices")))
    cut = F.when(F.col("coingecko_id") == "error", F.substring(body, F.lit(1), F.length(body) - 2)).otherwise(body)
    return pages.select("coingecko_id", "page", cut.alias("body"))


@register(
    "market_chart_rows",
    """SELECT event_type AS coingecko_id, date_trunc('milliseconds', ts) AS ts, CAST(ts AS DATE) AS day, value AS price
FROM events WHERE event_type <> 'error' AND value IS NOT NULL""",
)
def market_chart_rows(spark, sf):
    """``prices[[ms, price]]`` → (asset id, time, day, price); a chart that is cut off gives none."""
    return P.market_chart_rows(market_charts(spark, sf), "coingecko_id").drop("pos")


_SERIES_SQL = """series AS (
  SELECT event_type AS asset, CAST(ts AS DATE) AS day, arg_max(value, event_id) AS price
  FROM events WHERE value IS NOT NULL GROUP BY ALL
)"""


def daily_series(spark, sf):
    ev = src(spark, sf, "events")
    return M.last_price_per_day(ev, "event_type", "ts", "value", "event_id").withColumnRenamed("event_type", "asset").withColumnRenamed("value", "price")


@register("last_price_per_day", "WITH " + _SERIES_SQL + "\nSELECT * FROM series")
def last_price_per_day(spark, sf):
    """Intraday points → the last in payload order per (asset, UTC day)."""
    return daily_series(spark, sf)


@register(
    "series_coverage",
    "WITH " + _SERIES_SQL + "\nSELECT asset, count(*) AS points, min(day) AS first_day, max(day) AS last_day FROM series GROUP BY asset",
)
def series_coverage(spark, sf):
    """Per asset: points, first and last day of the collapsed series."""
    return M.series_coverage(daily_series(spark, sf), "asset", "day")


# --------------------------------------------------------------------------- #
# Cross-source comparison and priority
# --------------------------------------------------------------------------- #


def _daily(spark, sf, flags, agg):
    li = src(spark, sf, "lineitem").filter(F.col("l_returnflag").isin(flags))
    return li.groupBy(F.col("l_partkey").alias("asset"), F.to_date("l_shipdate").alias("day")).agg(
        agg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )


@register(
    "price_compare",
    """WITH a AS (SELECT l_partkey AS asset, CAST(l_shipdate AS DATE) AS day, max(l_extendedprice / l_quantity) AS price
           FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY ALL),
b AS (SELECT l_partkey AS asset, CAST(l_shipdate AS DATE) AS day, min(l_extendedprice / l_quantity) AS price
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT coalesce(a.asset, b.asset) AS asset, coalesce(a.day, b.day) AS day, a.price AS price_a, b.price AS price_b,
       CASE WHEN b.price <> 0 THEN abs(a.price - b.price) / b.price END AS rel_diff
FROM a FULL OUTER JOIN b ON a.asset = b.asset AND a.day = b.day""",
)
def price_compare(spark, sf):
    """Same day and asset across two sources: full outer join and relative difference."""
    return J.price_compare(_daily(spark, sf, ["A", "N"], F.max), _daily(spark, sf, ["R"], F.min), ["asset", "day"])


@register(
    "price_priority",
    """WITH u AS (
  SELECT l_partkey AS asset, CAST(l_shipdate AS DATE) AS day, 1 AS source_rank, l_extendedprice AS price,
         CASE WHEN l_discount = 0 THEN NULL ELSE 1 - l_discount * 5 END AS confidence
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL SELECT l_partkey, CAST(l_shipdate AS DATE), 2, l_extendedprice, NULL FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT l_partkey, CAST(l_shipdate AS DATE), 3, l_extendedprice, NULL FROM lineitem WHERE l_returnflag = 'N'
)
SELECT asset, day, source_rank, price, confidence FROM u
WHERE source_rank > 1 OR confidence IS NULL OR confidence >= 0.9
QUALIFY row_number() OVER (PARTITION BY asset, day ORDER BY source_rank, price, confidence NULLS FIRST) = 1""",
)
def price_priority(spark, sf):
    """Best source per (asset, day): the first source only when confident enough."""
    li = src(spark, sf, "lineitem")
    base = li.select(F.col("l_partkey").alias("asset"), F.to_date("l_shipdate").alias("day"), "l_returnflag",
                     F.col("l_extendedprice").alias("price"),
                     F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(1 - F.col("l_discount") * 5).alias("confidence"))
    first = base.filter(F.col("l_returnflag") == "A")
    second = base.filter(F.col("l_returnflag") == "R").withColumn("confidence", F.lit(None).cast("double"))
    third = base.filter(F.col("l_returnflag") == "N").withColumn("confidence", F.lit(None).cast("double"))
    return J.price_priority([first, second, third], ["asset", "day"], 0.9)


# --------------------------------------------------------------------------- #
# Insert-then-prune on a month-partitioned price table
# --------------------------------------------------------------------------- #

RUN1, RUN2 = "2001-08-02 00:00:00", "2001-08-03 00:00:00"
PRUNE_DAY = "1998-08-02"
_PRICE_DDL = "asset STRING, block_date DATE, price DOUBLE, ingested_at TIMESTAMP_NTZ"


def _stored_prices(spark, sf):
    o = src(spark, sf, "orders")
    asset = F.concat(F.when(F.col("o_orderpriority") == "5-LOW", F.lit("X")).otherwise(F.lit("0x")), F.col("o_custkey").cast("string"))
    return o.select(
        asset.alias("asset"), F.to_date("o_orderdate").alias("block_date"), F.col("o_totalprice").alias("price"),
        F.lit(RUN1).cast("timestamp_ntz").alias("ingested_at"), "o_orderstatus",
    )


def _price_table(spark, sf):
    spec = T.TableSpec(path=scratch_path(spark, "prices"), month_of="block_date", schema=_PRICE_DDL)
    T.append(_stored_prices(spark, sf).drop("o_orderstatus"), spec)
    return spec


def _refetch(df):
    return df.select("asset", "block_date", (F.col("price") + 1).alias("price"), F.lit(RUN2).cast("timestamp_ntz").alias("ingested_at"))


_PRICES_SQL = f"""WITH existing AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE '0x' END || CAST(o_custkey AS VARCHAR) AS asset,
         CAST(o_orderdate AS DATE) AS block_date, o_totalprice AS price, TIMESTAMP '{RUN1}' AS ingested_at, o_orderstatus
  FROM orders
)"""
_OUT = "asset, block_date, price, ingested_at"


@register(
    "prune_day",
    _PRICES_SQL + f"""
SELECT {_OUT} FROM existing WHERE block_date <> DATE '{PRUNE_DAY}'
UNION ALL SELECT asset, block_date, price + 1, TIMESTAMP '{RUN2}' FROM existing WHERE block_date = DATE '{PRUNE_DAY}'""",
)
def prune_day(spark, sf):
    """Re-run one day: insert the new rows, drop that day's older rows (one month rewritten)."""
    spec = _price_table(spark, sf)
    new = _refetch(_stored_prices(spark, sf).filter(F.col("block_date") == F.lit(PRUNE_DAY).cast("date")))
    T.prune_day(spark, spec, new, "block_date", PRUNE_DAY, "ingested_at")
    return T.read_raw(spark, spec).select("asset", "block_date", "price", "ingested_at")


_NEW_SQL = f""",
new AS (SELECT asset, block_date, price + 1 AS price, TIMESTAMP '{RUN2}' AS ingested_at FROM existing WHERE o_orderstatus = 'P')"""


@register(
    "prune_series",
    _PRICES_SQL + _NEW_SQL + f""",
bound AS (SELECT max(block_date) AS b FROM new WHERE regexp_matches(asset, '^0x[0-9a-f]+$')),
returned AS (SELECT DISTINCT asset FROM new WHERE regexp_matches(asset, '^0x[0-9a-f]+$'))
SELECT {_OUT} FROM existing e WHERE NOT (e.asset IN (SELECT asset FROM returned) AND e.block_date <= (SELECT b FROM bound))
UNION ALL SELECT {_OUT} FROM new""",
)
def prune_series(spark, sf):
    """Insert a series load, then drop older rows of returned assets up to the newest new date.
    Malformed asset ids are never pruned."""
    spec = _price_table(spark, sf)
    new = _refetch(_stored_prices(spark, sf).filter(F.col("o_orderstatus") == "P"))
    T.prune_series(spark, spec, new, "asset", "block_date", "ingested_at", valid=F.col("asset").rlike(FL.HEX_ADDRESS))
    return T.read_raw(spark, spec).select("asset", "block_date", "price", "ingested_at")


@register(
    "prune_per_asset",
    _PRICES_SQL + _NEW_SQL + f""",
bounds AS (SELECT asset, max(block_date) AS b FROM new WHERE regexp_matches(asset, '^0x[0-9a-f]+$') GROUP BY asset)
SELECT {_OUT} FROM existing e WHERE NOT EXISTS (SELECT 1 FROM bounds x WHERE x.asset = e.asset AND e.block_date <= x.b)
UNION ALL SELECT {_OUT} FROM new""",
)
def prune_per_asset(spark, sf):
    """Per-asset bound: each asset's own newest new date; later stored rows survive."""
    spec = _price_table(spark, sf)
    new = _refetch(_stored_prices(spark, sf).filter(F.col("o_orderstatus") == "P"))
    T.prune_series(spark, spec, new, "asset", "block_date", "ingested_at", per_asset=True,
                   valid=F.col("asset").rlike(FL.HEX_ADDRESS))
    return T.read_raw(spark, spec).select("asset", "block_date", "price", "ingested_at")

