"""Stand-ins for the dataset loads.

Each query lands driver-table data in the load's input format, runs the whole
load job (usually twice, to show re-run behaviour) and returns the table it
maintains.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import payloads as P
from quayside.operators import tables as TB
from quayside.plans import increment as I
from quayside.plans import loads as LD
from quayside.registry import fills as FR
from quayside.registry import governance as G
from quayside.registry import landing as LA
from quayside.registry import prices as PR
from quayside.registry.base import ORDERS_COLS, register, src
from quayside.session import scratch_path

T0, T1 = "2001-07-25 00:00:00", "2001-08-01 00:00:00"


def _land_csv(spark, df, name, rebalance=True):
    """``rebalance=False`` leaves each row with the split it was read in: a large
    export is not shuffled only to be written."""
    path = scratch_path(spark, name)
    LA._csv_writer(df, rebalance).csv(path)
    return path


def _utc_text(ts_col):
    return F.concat(F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" UTC"))


# --------------------------------------------------------------------------- #
# Plain CSV loads
# --------------------------------------------------------------------------- #


@register(
    "labels_load",
    """SELECT lower('0xAB' || CAST(s_suppkey AS VARCHAR)) AS address, s_name AS label,
       TIMESTAMP '2024-01-01' + to_days(s_suppkey) AS introduced_at, 'dune' AS source
FROM supplier, range(2)""",
)
def labels_load(spark, sf):
    """Declared-structure CSV appended to a plain month-partitioned table; a re-run duplicates."""
    s = src(spark, sf, "supplier")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(days=F.col("s_suppkey").cast("int"))
    path = _land_csv(spark, s.select(
        F.lower(F.concat(F.lit("0xAB"), F.col("s_suppkey").cast("string"))).alias("address"), F.col("s_name").alias("label"),
        _utc_text(at).alias("introduced_at"), F.lit("dune").alias("source")), "labels")
    spec = TB.TableSpec(path=scratch_path(spark, "dune_labels"), month_of="introduced_at")
    LD.labels_load(spark, path, spec)
    LD.labels_load(spark, path, spec)
    return TB.read_raw(spark, spec).select("address", "label", "introduced_at", "source")


@register(
    "prices_load",
    "SELECT CAST(o_orderdate AS DATE) AS block_date, o_orderpriority AS symbol, o_totalprice AS price FROM orders",
)
def prices_load(spark, sf):
    o = src(spark, sf, "orders")
    path = _land_csv(spark, o.select(_utc_text(F.col("o_orderdate").cast("timestamp")).alias("block_date"),
                                     F.col("o_orderpriority").alias("symbol"), F.col("o_totalprice").alias("price")), "prices")
    spec = TB.TableSpec(path=scratch_path(spark, "dune_prices"), month_of="block_date")
    LD.prices_load(spark, path, spec)
    return TB.read_raw(spark, spec).select("block_date", "symbol", "price")


@register(
    "bridge_flows_load",
    """SELECT l_shipdate AS timestamp, l_returnflag AS bridge, 'gnosis' AS source_chain, 'ethereum' AS dest_chain,
       l_linestatus AS token, l_quantity AS amount_token, l_extendedprice AS amount_usd,
       l_extendedprice * (1 - l_discount) AS net_usd FROM lineitem""",
)
def bridge_flows_load(spark, sf):
    """Timestamps must parse (ISO with Z); an unparseable one fails the load."""
    li = src(spark, sf, "lineitem")
    path = _land_csv(spark, li.select(
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("l_returnflag").alias("bridge"), F.lit("gnosis").alias("source_chain"), F.lit("ethereum").alias("dest_chain"),
        F.col("l_linestatus").alias("token"), F.col("l_quantity").alias("amount_token"),
        F.col("l_extendedprice").alias("amount_usd"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_usd"),
    ), "bridge")
    spec = TB.TableSpec(path=scratch_path(spark, "bridge_flows"), month_of="timestamp")
    LD.bridge_flows_load(spark, path, spec)
    return TB.read_raw(spark, spec).drop(TB.MONTH)


@register(
    "supply_load",
    "SELECT n_name AS label, CAST(DATE '2024-01-01' + n_nationkey AS DATE) AS block_date, CAST(n_regionkey * 1.5 AS DOUBLE) AS supply FROM nation",
)
def supply_load(spark, sf):
    n = src(spark, sf, "nation")
    path = _land_csv(spark, n.select(
        F.col("n_name").alias("label"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey")), "yyyy-MM-dd").alias("block_date"),
        (F.col("n_regionkey") * 1.5).alias("supply")), "supply")
    spec = TB.TableSpec(path=scratch_path(spark, "gno_supply"))
    LD.supply_load(spark, path, spec)
    return TB.read_raw(spark, spec)


# --------------------------------------------------------------------------- #
# Replacing CSV loads
# --------------------------------------------------------------------------- #

_TRANSFERS_SQL = """WITH t AS (
  SELECT CAST(l_shipdate AS DATE) AS block_date, l_shipdate AS block_time,
         '0x' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_hash,
         lower('0xAB' || CAST(l_suppkey AS VARCHAR)) AS sender, lower('0xCD' || CAST(l_partkey AS VARCHAR)) AS receiver,
         l_returnflag AS token_symbol, lower('0xEF' || l_returnflag) AS token_address, l_quantity AS amount,
         l_extendedprice AS amount_usd, 1 AS load_seq FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'
),
landed AS (
  SELECT * FROM t
  UNION ALL
  SELECT block_date, block_time, tx_hash, sender, receiver, token_symbol, token_address, amount, amount_usd + 1, 2
  FROM (SELECT CAST(l_shipdate AS DATE) AS block_date, l_shipdate AS block_time,
         '0x' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_hash,
         lower('0xAB' || CAST(l_suppkey AS VARCHAR)) AS sender, lower('0xCD' || CAST(l_partkey AS VARCHAR)) AS receiver,
         l_returnflag AS token_symbol, lower('0xEF' || l_returnflag) AS token_address, l_quantity AS amount,
         l_extendedprice AS amount_usd FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-12-29')
)
SELECT block_date, block_time, tx_hash, sender, receiver, token_symbol, token_address, amount, amount_usd FROM landed
QUALIFY row_number() OVER (PARTITION BY sender, receiver, block_time, tx_hash, token_address
  ORDER BY load_seq DESC, block_date DESC, token_symbol DESC, amount DESC, amount_usd DESC) = 1"""


def _transfers_csv(df):
    return df.select(
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd").alias("block_date"),
        _utc_text(F.col("l_shipdate").cast("timestamp")).alias("block_time"),
        F.concat(F.lit("0x"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("tx_hash"),
        F.concat(F.lit("0xAB"), F.col("l_suppkey").cast("string")).alias("sender"),
        F.concat(F.lit("0xCD"), F.col("l_partkey").cast("string")).alias("receiver"),
        F.col("l_returnflag").alias("token_symbol"), F.concat(F.lit("0xEF"), F.col("l_returnflag")).alias("token_address"),
        F.col("l_quantity").alias("amount"), F.col("l_extendedprice").alias("amount_usd"),
    )


@register("celo_transfers_load", _TRANSFERS_SQL)
def celo_transfers_load(spark, sf):
    """Full load, then a daily load overlapping 3 days; last load wins per transfer key; compacted."""
    li = src(spark, sf, "lineitem")
    full = _land_csv(spark, _transfers_csv(li.filter(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))), "transfers_full", rebalance=False)
    daily = _land_csv(spark, _transfers_csv(li.filter(F.col("l_shipdate") >= F.lit("1998-12-29").cast("timestamp_ntz")))
                      .withColumn("amount_usd", F.col("amount_usd") + 1), "transfers_daily", rebalance=False)
    spec = TB.TableSpec(path=scratch_path(spark, "transfers"), key=LD.TRANSFER_KEY, month_of="block_date")
    LD.celo_transfers_load(spark, full, spec, seq=1)
    LD.celo_transfers_load(spark, daily, spec, seq=2)
    TB.compact(spark, spec)
    return TB.read_raw(spark, spec).select("block_date", "block_time", "tx_hash", "sender", "receiver", "token_symbol",
                                           "token_address", "amount", "amount_usd")


@register(
    "celo_wallet_events_load",
    """SELECT lower('0xAB' || CAST(c_custkey AS VARCHAR)) AS safe_address, c_mktsegment AS action,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE lower(c_name) END AS action_value,
       TIMESTAMP '2024-01-01' + to_hours(c_custkey) AS event_time FROM customer""",
)
def celo_wallet_events_load(spark, sf):
    """Sentinel owners → NULL inside the replacing key; re-loading a segment changes nothing."""
    c = src(spark, sf, "customer")
    value = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "<nil>").otherwise(F.col("c_name"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.col("c_custkey").cast("int"))
    csv = c.select(F.concat(F.lit("0xAB"), F.col("c_custkey").cast("string")).alias("safe_address"),
                   F.col("c_mktsegment").alias("action"), value.alias("action_value"),
                   F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("event_time"))
    spec = TB.TableSpec(path=scratch_path(spark, "wallet_events"), key=LD.WALLET_EVENT_KEY, month_of="event_time")
    LD.celo_wallet_events_load(spark, _land_csv(spark, csv, "we_full"), spec, seq=1)
    LD.celo_wallet_events_load(spark, _land_csv(spark, csv.filter(F.col("action").isin("BUILDING", "MACHINERY")), "we_again"), spec, seq=2)
    return TB.read_latest(spark, spec)


@register(
    "blacklist_load",
    """SELECT lower('0xAB' || CAST(s_suppkey AS VARCHAR)) AS address,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE 'sybil-' || CAST(s_nationkey AS VARCHAR) END AS reason FROM supplier""",
)
def blacklist_load(spark, sf):
    """Whole document → full replace; a second day's list replaces the first entirely."""
    spec = TB.TableSpec(path=scratch_path(spark, "blacklist"), schema="address STRING, reason STRING")
    TB.full_replace(spark, src(spark, sf, "nation").select(F.col("n_name").alias("address"), F.lit(None).cast("string").alias("reason")), spec)
    folder = scratch_path(spark, "json_docs")
    s = src(spark, sf, "supplier")
    item = F.struct(
        F.concat(F.lit("0xAB"), F.col("s_suppkey").cast("string")).alias("address"),
        F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("sybil-"), F.col("s_nationkey").cast("string"))).alias("reason"),
    )
    docs = s.groupBy(F.floor(F.col("s_suppkey") / 50).alias("doc")).agg(F.collect_list(item).alias("items"))
    docs.select("doc", F.to_json(F.struct(F.col("items").alias("addresses"))).alias("value")).write.partitionBy("doc").text(folder)
    LD.blacklist_load(spark, folder, spec)
    return TB.read_raw(spark, spec)


WALLET_TARGET = T.StructType([T.StructField("SAFE_address", T.StringType()), T.StructField("SAFE_createdAt", T.TimestampNTZType())])


@register(
    "wallets_load",
    "SELECT '0xAB' || CAST(c_custkey AS VARCHAR) AS SAFE_address, TIMESTAMP '2023-01-01' + to_hours(c_custkey) AS SAFE_createdAt FROM customer",
)
def wallets_load(spark, sf):
    """Drifting-header CSV conformed to the wallets table, appended, files compacted."""
    c = src(spark, sf, "customer")
    at = F.lit("2023-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.col("c_custkey").cast("int"))
    csv = c.select(F.concat(F.lit("0xAB"), F.col("c_custkey").cast("string")).alias("﻿safe address"),
                   F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(" Safe_CreatedAt "),
                   F.col("c_mktsegment").alias("segment"))
    spec = TB.TableSpec(path=scratch_path(spark, "wallets"))
    LD.wallets_load(spark, _land_csv(spark, csv, "wallets_csv"), spec, WALLET_TARGET)
    return TB.read_raw(spark, spec)


@register(
    "ember_load",
    """SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS area, o_orderstatus AS category,
       CAST(o_orderkey AS INTEGER) AS variable, 'USD' AS unit,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS value,
       CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS version
FROM orders""",
)
def ember_load(spark, sf):
    """Inferred CSV with spaced/`%` headers → versioned replacing table; a revised release wins."""
    o = src(spark, sf, "orders")
    csv = o.select(
        F.col("o_orderpriority").alias("Area"), F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd").alias("Date"),
        F.col("o_orderstatus").alias("Category"), F.col("o_orderkey").cast("string").alias("Variable"),
        F.lit("USD").alias("Unit"), F.col("o_totalprice").alias("Value"), F.lit(None).cast("double").alias("YoY % change"),
    )
    renames = {"Date": "date", "Area": "area", "Category": "category", "Variable": "variable", "Unit": "unit", "Value": "value"}
    spec = TB.TableSpec(path=scratch_path(spark, "ember"), key=("date", "area", "category", "variable"), version="version")
    LD.ember_load(spark, _land_csv(spark, csv, "ember1"), spec, "2024-01-01 00:00:00", renames)
    revised = csv.filter(F.col("Category") == "P").withColumn("Value", F.col("Value") + 1)
    LD.ember_load(spark, _land_csv(spark, revised, "ember2"), spec, "2024-02-01 00:00:00", renames)
    return TB.read_raw(spark, spec).select("date", "area", "category", "variable", "unit", F.col("value").cast("double"), "version")


_CRAWL_YEAR_TABLES = [t for t in LD.CRAWL_KEYS if t.endswith("_avg_1d")] + ["quic_support_over_7d"]
_CRAWL_MONTH_TABLES = [t for t in LD.CRAWL_KEYS if t.endswith("_over_7d") and t != "quic_support_over_7d"]


def _crawl_drops(spark, sf):
    """Yearly drops of all 13 crawl tables, made of orders: the priority is the agent
    type, what a table is about is NULL for '5-LOW', counts are orders."""
    o = src(spark, sf, "orders").withColumn("y", F.date_trunc("year", "o_orderdate")).withColumn("m", F.date_trunc("month", "o_orderdate"))
    about = F.when(F.col("p") != "5-LOW", F.concat(F.lit("s-"), F.col("p")))
    root = scratch_path(spark, "crawl")
    for table in LD.CRAWL_KEYS:
        monthly = table in _CRAWL_MONTH_TABLES
        keys = [F.col("y")] if table == "discv5_stale_records" else [F.col("o_orderpriority").alias("p"), F.col("y")] + ([F.col("m")] if monthly else [])
        g = o.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("t"))
        at = F.col("m") if monthly else F.col("y")
        given = {"min_crawl_created_at": F.col("y"), "max_crawl_created_at": F.col("y"), "crawl_created_at": at, "__count": F.col("n"), "__samples": F.col("n"),
                 "__pct": F.lit(0.5), "__total": F.col("t"), "crawl_id": F.date_format("y", "yyyy"), "total": F.col("t"), "count": F.col("n"),
                 "percentage": F.lit(0.5), "reachability": F.lit("online"), "agent_version_semver": F.array(F.lit(1), F.lit(None).cast("bigint"))}
        if table != "discv5_stale_records":
            given["agent_version_type"] = F.col("p")
        fields = T.StructType.fromDDL(LD.crawl_schema(table)).fields
        df = g.select(F.date_format("y", "yyyy-01-01").alias("drop"), *[given.get(f.name, about).cast(f.dataType).alias(f.name) for f in fields])
        staging = f"{root}-staging/{table}"
        df.hint("rebalance", "drop").write.partitionBy("drop").parquet(staging)
        fs, at_ = TB._fs(spark, staging)
        fs.mkdirs(TB._fs(spark, f"{root}/{table}")[1])
        for st in fs.listStatus(at_):
            name = st.getPath().getName()
            if name.startswith("drop=") and not fs.rename(st.getPath(), TB._fs(spark, f"{root}/{table}/{name[5:]}.parquet")[1]):
                raise OSError(f"could not move {name}")
    return root


def _named(tables):
    return ", ".join(f"('{t}')" for t in tables)


@register(
    "crawl_load",
    f"""WITH o AS (SELECT *, date_trunc('year', o_orderdate) AS y, date_trunc('month', o_orderdate) AS m FROM orders)
SELECT t.name AS table_name, y AS first_crawl, o_orderpriority AS agent_type, CASE WHEN t.name = 'quic_support_over_7d' THEN y END AS crawl,
       count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS total
FROM o, (VALUES {_named(_CRAWL_YEAR_TABLES)}) t(name) GROUP BY t.name, y, o_orderpriority
UNION ALL
SELECT t.name, y, o_orderpriority, m, count(*), CAST(sum(o_custkey) AS BIGINT)
FROM o, (VALUES {_named(_CRAWL_MONTH_TABLES)}) t(name) GROUP BY t.name, y, m, o_orderpriority
UNION ALL
SELECT 'discv5_stale_records', NULL, strftime(y, '%Y'), y, count(*), CAST(sum(o_custkey) AS BIGINT) FROM o GROUP BY y""",
)
def crawl_load(spark, sf):
    """All drops of the 13 crawl tables → replacing tables with nullable keys, loaded twice."""
    landing, root = _crawl_drops(spark, sf), scratch_path(spark, "crawl_tables")
    LD.crawl_load(spark, landing, root)
    LD.crawl_load(spark, landing, root)
    out = None
    for table in LD.CRAWL_KEYS:
        df = TB.read_latest(spark, LD.crawl_spec(root, table))
        stale, daily = table == "discv5_stale_records", table.endswith("_avg_1d")
        none = F.lit(None).cast("timestamp_ntz")
        one = df.select(
            F.lit(table).alias("table_name"), (none if stale else F.col("min_crawl_created_at")).alias("first_crawl"),
            F.col("crawl_id" if stale else "agent_version_type").alias("agent_type"), (none if daily else F.col("crawl_created_at")).alias("crawl"),
            F.col("count" if stale else "__count").cast("bigint").alias("n"), F.col("total" if stale else "__total").cast("bigint").alias("total"))
        out = one if out is None else out.unionAll(one)
    return out


# --------------------------------------------------------------------------- #
# Payload loads
# --------------------------------------------------------------------------- #


@register(
    "fills_load",
    f"""WITH owners AS (SELECT DISTINCT '0x' || CAST(o_custkey AS VARCHAR) AS taker
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '2000-01-01'),
trades AS (
  SELECT o.*, f.l_linenumber FROM orders o
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) f ON f.l_orderkey = o.o_orderkey
)
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(l_linenumber, 0) AS BIGINT) AS log_index,
       '0x' || CAST(o_custkey AS VARCHAR) AS owner,
       CASE WHEN o_orderstatus = 'F' AND '0x' || CAST(o_custkey AS VARCHAR) IN (SELECT taker FROM owners)
            THEN TIMESTAMP '{T0}' ELSE TIMESTAMP '{T1}' END AS ingested_at
FROM trades""",
)
def fills_load(spark, sf):
    """Known fills of discovered owners are skipped; the rest are upserted with this run's version."""
    pages = TB._staged(spark, G.trade_pages(spark, sf))  # fetched once, read by what is held and by the load
    spec = TB.TableSpec(path=scratch_path(spark, "fills"), key=("order_uid", "tx_hash", "log_index"), version="ingested_at")
    held = P.fills_rows(pages).join(
        src(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
            F.concat(F.lit("0x"), F.col("o_orderkey").cast("string")).alias("order_uid")), "order_uid", "left_semi")
    TB.upsert(held.withColumn("ingested_at", F.lit(T0).cast("timestamp_ntz")), spec)
    LD.fills_load(spark, pages, spec, FR._owners(spark, sf), T1, known_days=14)
    return TB.read_latest(spark, spec, columns=["order_uid", "log_index", "owner", "ingested_at"])


EVENT_LIMIT = 25  # events of one answer here; 100,000 in production

_EVENTS_SQL = """all_events AS (
  SELECT *, CAST(ts AS DATE) AS day, event_type = 'purchase' AND value < 5 AS no_time,
    CASE WHEN event_type = 'error' AND value < 5 THEN 'malformed' WHEN event_type = 'view' AND value < 5 THEN 'not_an_object'
         WHEN event_type = 'click' AND value < 5 THEN 'no_event' WHEN event_type = 'signup' AND value < 5 THEN 'blank'
         WHEN event_type = 'purchase' AND value >= 5 AND value < 10 THEN 'bad_time' END AS bad FROM events),
dated AS (SELECT * FROM all_events WHERE bad IS NULL AND NOT no_time),
days AS (SELECT CAST(d AS DATE) AS day FROM unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) t(d)),
judged AS (
  SELECT day, sum(n) >= {limit} AND max(n) >= {limit} AS cut FROM (SELECT day, hour(ts) AS h, count(*) AS n FROM dated GROUP BY ALL) GROUP BY day),
first_cut AS (SELECT min(day) AS d FROM days JOIN judged USING (day) WHERE cut),
loaded AS (SELECT day FROM days, first_cut WHERE d IS NULL OR day < d),
counts AS (SELECT day, count(*) AS n FROM dated GROUP BY day),
marks AS (
  SELECT loaded.day, coalesce(n, 0) AS rows, coalesce(n, 0) > 0 OR DATE '2024-02-01' - loaded.day >= 3 AS done FROM loaded LEFT JOIN counts USING (day))"""


def _events_load_sql(limit):
    return "WITH " + _EVENTS_SQL.replace("{limit}", str(limit)) + """
SELECT 'ledger' AS tbl, CAST(NULL AS VARCHAR) AS id, day, rows AS n, 'complete' AS note FROM marks WHERE done
UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), CASE WHEN no_time THEN DATE '1970-01-01' ELSE day END, 1, event_type FROM all_events
  WHERE bad IS NULL AND (no_time OR day IN (SELECT day FROM loaded))
UNION ALL SELECT 'rejects', NULL, NULL, count(*), bad FROM all_events WHERE bad <> 'blank' GROUP BY bad
UNION ALL SELECT 'outcome', NULL, day, coalesce(m.rows, 0),
  CASE WHEN m.done THEN 'complete' WHEN NOT m.done THEN 'waiting' WHEN coalesce(cut, false) THEN 'truncated' ELSE 'stopped' END
  FROM days LEFT JOIN marks m USING (day) LEFT JOIN judged USING (day)"""


def _events_load(spark, sf, limit):
    """The export of January loaded, and loaded again; every table it writes."""
    ndjson = LA._ndjson(spark, sf)
    events = TB.TableSpec(path=scratch_path(spark, "events_tbl"), key=("project_id", "event_name", "event_time", "insert_id"))
    ledger = I.ledger_spec(scratch_path(spark, "ledger"))
    run = {"project_id": "p1", "today": "2024-02-01", "backfill": ("2024-01-01", "2024-01-30"), "limit": limit}
    outcome = LD.events_load(spark, ndjson, events, ledger, run_ts="2024-02-01 00:00:00", **run)
    rejects = TB.read_raw(spark, P.rejects_of(events)).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    LD.events_load(spark, ndjson, events, ledger, run_ts="2024-02-01 01:00:00", **run)
    # Rows of completed days are stored once; events without a time come with each run.
    stored = TB.read_raw(spark, events)
    dated = stored.filter(F.col("event_time") > F.lit("1970-01-01").cast("timestamp"))
    undated = TB.read_latest(spark, events).filter(F.col("event_time") <= F.lit("1970-01-01").cast("timestamp"))
    rows = dated.select("insert_id", "event_time", "event_name").unionAll(undated.select("insert_id", "event_time", "event_name"))
    none, no_day = F.lit(None).cast("string"), F.lit(None).cast("date")
    parts = [
        TB.read_latest(spark, ledger).select(F.lit("ledger").alias("tbl"), none.alias("id"), F.col("completed_date").alias("day"), F.col("rows_indexed").alias("n"), F.col("status").alias("note")),
        rows.select(F.lit("events"), "insert_id", F.to_date("event_time"), F.lit(1).cast("bigint"), "event_name"),
        rejects.select(F.lit("rejects"), none, no_day, "n", "reason"),
        outcome.select(F.lit("outcome"), none, "day", "rows", "outcome"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@register("events_load", _events_load_sql(100_000))
def events_load(spark, sf):
    """NDJSON export → events, rejects, ledger marks of committed days; a second run adds none."""
    return _events_load(spark, sf, 100_000)


@register("events_load_truncated", _events_load_sql(EVENT_LIMIT))
def events_load_truncated(spark, sf):
    """A day with an hour at the limit stops the load there; the days before it are complete."""
    return _events_load(spark, sf, EVENT_LIMIT)


@register(
    "profiles_load",
    """SELECT CAST(c_custkey AS VARCHAR) AS distinct_id, 'p1' AS project_id, c_mktsegment AS segment,
       TIMESTAMP '2024-02-01' AS synced_at FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def profiles_load(spark, sf):
    """Profile pages synced twice; the later sync wins per distinct id."""
    spec = TB.TableSpec(path=scratch_path(spark, "profiles"), key=("project_id", "distinct_id"), version="synced_at")
    c = src(spark, sf, "customer")
    item = F.struct(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_custkey").cast("string")).alias("$distinct_id"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("$properties"),
    )
    pages = G._bucket_pages(c, item).select(F.to_json(F.struct(F.col("items").alias("results"))).alias("body"))
    LD.profiles_load(spark, pages, spec, "p1", "2024-01-01 00:00:00")
    LD.profiles_load(spark, pages, spec, "p1", "2024-02-01 00:00:00")
    return TB.read_latest(spark, spec).select(
        "distinct_id", "project_id", F.get_json_object("properties", "$.segment").alias("segment"), "synced_at")


@register(
    "governance_votes_load",
    """WITH p AS (
  SELECT 'prop-' || CAST(o_orderkey AS VARCHAR) AS pid, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN TIMESTAMP '1970-01-01'
              ELSE o_orderdate + INTERVAL 7 DAY END AS end_at FROM orders),
v AS (
  SELECT 'v-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         'prop-' || CAST(l_orderkey AS VARCHAR) AS proposal_id, '0x' || CAST(l_suppkey AS VARCHAR) AS voter,
         l_shipdate AS created_at, l_quantity AS vp
  FROM lineitem JOIN p ON p.pid = 'prop-' || CAST(l_orderkey AS VARCHAR)
  WHERE p.o_orderstatus IN ('O', 'P') OR p.end_at >= TIMESTAMP '2001-07-31' - INTERVAL 30 DAY)
SELECT 'votes' AS tbl, id, proposal_id AS of, vp FROM v
QUALIFY row_number() OVER (PARTITION BY proposal_id, id ORDER BY voter DESC, vp DESC) = 1
UNION ALL SELECT 'proposals', pid, NULL, NULL FROM p
UNION ALL SELECT 'space', 'default.eth', NULL, NULL
UNION ALL SELECT 'space', lower(n_name), NULL, NULL FROM nation WHERE n_nationkey > 0
UNION ALL SELECT 'follows', 'f-' || c_custkey, 'default.eth', NULL FROM customer
UNION ALL SELECT 'rejects of follows', 'malformed', NULL, NULL FROM region""",
)
def governance_votes_load(spark, sf):
    """Space, proposals, follows, and votes of proposals open or ended within 30 days;
    pages that are cut off are rejects."""
    o = src(spark, sf, "orders")
    created = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    state = F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "P", "pending").otherwise("closed")
    prop = F.struct(
        F.concat(F.lit("prop-"), F.col("o_orderkey").cast("string")).alias("id"), state.alias("state"),
        created.alias("created"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), F.lit(-5)).otherwise(created + 7 * 86400).alias("end"),
    )
    proposal_pages = o.select(G._one(prop).alias("body"))
    li = src(spark, sf, "lineitem")
    vote = F.struct(
        F.concat(F.lit("v-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id"),
        F.concat(F.lit("0x"), F.col("l_suppkey").cast("string")).alias("voter"), F.col("l_quantity").alias("vp"),
        F.struct(F.concat(F.lit("prop-"), F.col("l_orderkey").cast("string")).alias("id")).alias("proposal"),
    )
    vote_pages = li.select(G._one(vote).alias("body"))
    n, customers = src(spark, sf, "nation"), src(spark, sf, "customer")
    spaces = n.select(F.to_json(F.struct(F.when(F.col("n_nationkey") > 0, F.lower("n_name")).alias("id"), F.col("n_name").alias("name"))).alias("body"))
    follow = F.struct(F.concat(F.lit("f-"), F.col("c_custkey").cast("string")).alias("id"))
    follow_pages = customers.select(G._one(follow).alias("body")).unionAll(src(spark, sf, "region").select(F.lit('[{"id": "f')))
    tables = {name: TB.TableSpec(path=scratch_path(spark, name), key=key, version="ingested_at") for name, key in {
        "space": ("space_id",), "proposals": ("id",), "votes": ("proposal_id", "id"), "follows": ("id",)}.items()}
    for now in ("2001-07-31 00:00:00", "2001-08-01 00:00:00"):
        LD.governance_load(spark, tables, G.SPACE, now, spaces, proposal_pages, vote_pages, follow_pages, days=30)
    none, no_vp = F.lit(None).cast("string"), F.lit(None).cast("double")
    shown = {"space": ["space_id"], "proposals": ["id"], "votes": ["id", "proposal_id", "vp"], "follows": ["id", "space_id"]}
    held = {name: TB.read_latest(spark, spec, columns=shown[name]) for name, spec in tables.items()}
    rejects = TB.read_raw(spark, P.rejects_of(tables["follows"])).filter(F.col("rejected_at") == F.lit("2001-08-01").cast("timestamp_ntz"))
    return (held["votes"].select(F.lit("votes").alias("tbl"), "id", F.col("proposal_id").alias("of"), "vp")
            .unionAll(held["proposals"].select(F.lit("proposals"), "id", none, no_vp))
            .unionAll(held["space"].select(F.lit("space"), "space_id", none, no_vp))
            .unionAll(held["follows"].select(F.lit("follows"), "id", "space_id", no_vp))
            .unionAll(rejects.select(F.lit("rejects of follows"), "reason", none, no_vp)))


FORUM_KEYS = {
    "categories": ("id",), "users": ("id",), "likes": ("post_id", "acting_user_id"), "topics": ("id",),
    "posts": ("topic_id", "post_number"), "polls": ("post_id", "poll_name", "option_id")}


@register(
    "forum_load",
    f"""WITH {G._POLLS_SQL}, {G._LIKES_SQL}, conv AS (SELECT DISTINCT conv_id FROM conversations),
work AS (
  SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN 'bumped' ELSE 'open_poll' END AS why FROM conv
  WHERE conv_id % 7 = 0 OR conv_id IN (SELECT topic_id FROM polls WHERE status = 'open')),
users AS (SELECT c_custkey, lower(replace(c_name, '#', '_')) AS username, CAST(floor(c_acctbal / 100) AS BIGINT) AS base, c_mktsegment FROM customer)
SELECT 'topics' AS tbl, CAST(conv_id AS VARCHAR) AS id, CASE WHEN conv_id IN (SELECT conv_id FROM work) THEN 2 ELSE 1 END AS run FROM conv
UNION ALL SELECT 'posts', CAST(conv_id * 1000 + turn AS VARCHAR), CASE WHEN conv_id IN (SELECT conv_id FROM work) THEN 2 ELSE 1 END FROM conversations
UNION ALL SELECT 'polls', CAST(post_id AS VARCHAR) || option_id || option_votes,
  CASE WHEN topic_id % 7 = 0 AND option_id = 'o1' THEN 2 ELSE 1 END
  FROM (SELECT post_id, topic_id, option_id, CASE WHEN topic_id % 7 = 0 AND option_id = 'o1' THEN '9' ELSE '' END || option_votes AS option_votes FROM polls)
UNION ALL SELECT 'likes', CAST(post_id AS VARCHAR) || acting_username, 2 FROM likes
UNION ALL SELECT 'users', CAST(c_custkey AS VARCHAR), 2 FROM users
UNION ALL SELECT 'users', role, 2 FROM (SELECT DISTINCT role FROM conversations)
UNION ALL SELECT 'categories', CAST(r_regionkey + 1000 AS VARCHAR), 2 FROM region UNION ALL SELECT 'categories', CAST(n_nationkey AS VARCHAR), 2 FROM nation
UNION ALL SELECT 'work: ' || why, CAST(conv_id AS VARCHAR), 2 FROM work
UNION ALL SELECT 'targets', username, 2 FROM users WHERE c_mktsegment = 'AUTOMOBILE' AND base + 1 > 0
UNION ALL SELECT 'targets', role, 2 FROM (SELECT DISTINCT role FROM conversations)
UNION ALL SELECT 'missing posts', CAST(conv_id * 1000 + 999 AS VARCHAR), 2 FROM work""",
)
def forum_load(spark, sf):
    """Two daily runs over six tables.  In the second some topics were bumped and their
    first poll options gained votes; topics with open polls are read again without a
    bump, and what did not change is not written."""
    tables = {n: TB.TableSpec(path=scratch_path(spark, f"forum_{n}"), key=k, version="ingested_at") for n, k in FORUM_KEYS.items()}
    c = src(spark, sf, "customer")

    def user_pages(run):
        likes = F.floor(F.col("c_acctbal") / 100).cast("bigint") + F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(run - 1)).otherwise(0)
        item = F.struct(
            F.struct(F.col("c_custkey").cast("string").alias("id"), F.lower(F.regexp_replace("c_name", "#", "_")).alias("username")).alias("user"),
            likes.alias("likes_given"))
        roles = src(spark, sf, "conversations").select("role").distinct().select(F.to_json(F.struct(F.array(F.struct(
            F.struct((-F.length("role")).alias("id"), F.col("role").alias("username")).alias("user"), F.lit(run).alias("likes_given"))).alias("directory_items"))).alias("body"))
        return G._bucket_pages(c, item).select(F.to_json(F.struct(F.col("items").alias("directory_items"))).alias("body")).unionAll(roles)

    r, n = src(spark, sf, "region"), src(spark, sf, "nation")
    sub = n.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))).alias("subs"))
    cat_payloads = r.join(sub, r.r_regionkey == sub.n_regionkey, "left").select(F.to_json(F.struct(F.struct(F.array(F.struct(
        (F.col("r_regionkey") + 1000).alias("id"), F.col("r_name").alias("name"), F.col("subs").alias("subcategory_list"))).alias("categories")).alias("category_list"))).alias("body"))
    details, likes, pages = G.topic_details(spark, sf), G.like_pages(spark, sf), G.post_pages(spark, sf)
    all_stubs = src(spark, sf, "conversations").select("conv_id").distinct()

    def stubs(run):
        return all_stubs.select("conv_id", F.when((F.col("conv_id") % 7 == 0) & F.lit(run == 2), "2030-02-01T00:00:00Z").otherwise("2030-01-01T00:00:00Z").alias("bumped_at")
                                ).withColumnRenamed("conv_id", "id")

    def bumped(payloads):
        """The detail of a bumped topic carries no time of its own: its stub's counts."""
        return payloads.withColumn("body", F.regexp_replace("body", '"bumped_at":"[^"]*",', ""))

    more_votes = F.when(F.get_json_object("body", "$.id").cast("bigint") % 7 == 0, F.regexp_replace(
        "body", r'"html":"yes","votes":([0-9]+)', r'"html":"yes","votes":9$1')).otherwise(F.col("body"))
    voted = pages.withColumn("body", more_votes)
    for run, day in ((1, "2024-02-01 00:00:00"), (2, "2024-02-02 00:00:00")):
        posts = pages if run == 1 else voted
        done = LD.forum_load(spark, cat_payloads, user_pages(run), likes, bumped(details), stubs(run), tables, day, posts)
    run_no = F.when(F.col("ingested_at") == F.lit("2024-02-02").cast("timestamp_ntz"), 2).otherwise(1).alias("run")
    held = {name: TB.read_latest(spark, spec) for name, spec in tables.items()}
    second = F.lit(2)
    parts = [held["topics"].select(F.lit("topics").alias("tbl"), F.col("id").cast("string").alias("id"), run_no),
             held["posts"].select(F.lit("posts"), F.col("id").cast("string"), run_no),
             held["polls"].select(F.lit("polls"), F.concat(F.col("post_id").cast("string"), "option_id", F.col("option_votes").cast("string")), run_no),
             held["likes"].select(F.lit("likes"), F.concat(F.col("post_id").cast("string"), "acting_username"), run_no),
             held["users"].select(F.lit("users"), F.when(F.col("id") < 0, F.col("username")).otherwise(F.col("id").cast("string")), run_no),
             held["categories"].select(F.lit("categories"), F.col("id").cast("string"), run_no),
             done.work.select(F.concat(F.lit("work: "), "why"), F.col("topic_id").cast("string"), second),
             done.targets.select(F.lit("targets"), "username", second),
             done.missing_posts.select(F.lit("missing posts"), F.col("post_id").cast("string"), second)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


# --------------------------------------------------------------------------- #
# Fills: repair and backfill
# --------------------------------------------------------------------------- #


def _fills_in_mode(spark, sf, mode):
    """Fills of closed orders are held; then a load in the given mode."""
    pages = TB._staged(spark, G.trade_pages(spark, sf))  # fetched once, read by what is held and by the load
    spec = TB.TableSpec(path=scratch_path(spark, "fills"), key=("order_uid", "tx_hash", "log_index"), version="ingested_at", month_of="ingested_at")
    held = P.fills_rows(pages).join(src(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("0x"), F.col("o_orderkey").cast("string")).alias("order_uid")), "order_uid", "left_semi")
    TB.upsert(held.withColumn("tx_hash", F.lower("tx_hash")).withColumn("ingested_at", F.lit(T0).cast("timestamp_ntz")), spec, rebalance=False)
    fetched = pages.withColumn("body", F.regexp_replace("body", "0xAB", "0xab"))
    LD.fills_load(spark, fetched, spec, None, T1, mode=mode, source=FR.onchain_fills(spark, sf))
    return TB.read_latest(spark, spec, columns=["order_uid", "log_index", "owner", "ingested_at"])


_HELD_SQL = """trades AS (
  SELECT o.*, f.l_linenumber FROM orders o
  LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) f ON f.l_orderkey = o.o_orderkey
),
behind AS (SELECT DISTINCT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F')"""


@register(
    "fills_load_repair",
    f"""WITH {_HELD_SQL}
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(l_linenumber, 0) AS BIGINT) AS log_index,
       '0x' || CAST(o_custkey AS VARCHAR) AS owner,
       CASE WHEN o_custkey IN (SELECT o_custkey FROM behind) THEN TIMESTAMP '{T1}' ELSE TIMESTAMP '{T0}' END AS ingested_at
FROM trades WHERE o_orderstatus = 'F' OR o_custkey IN (SELECT o_custkey FROM behind)""",
)
def fills_load_repair(spark, sf):
    """Owners with a fill that the table lacks have all their fills written again."""
    return _fills_in_mode(spark, sf, "repair")


@register(
    "fills_load_backfill",
    f"""WITH {_HELD_SQL}
SELECT '0x' || CAST(o_orderkey AS VARCHAR) AS order_uid, CAST(coalesce(l_linenumber, 0) AS BIGINT) AS log_index,
       '0x' || CAST(o_custkey AS VARCHAR) AS owner, TIMESTAMP '{T1}' AS ingested_at FROM trades""",
)
def fills_load_backfill(spark, sf):
    """Every fill is written, held or not."""
    return _fills_in_mode(spark, sf, "backfill")


# --------------------------------------------------------------------------- #
# Price loads
# --------------------------------------------------------------------------- #

@register("spot_prices_load", PR._LOOKUP_SQL + "\nSELECT block_date, symbol, chain, address, price, confidence FROM matched")
def spot_prices_load(spark, sf):
    """Quotes of all days matched to the allowlist, inserted, those days' older rows pruned (run twice)."""
    spec = TB.TableSpec(path=scratch_path(spark, "spot"), month_of="block_date", schema=(
        "block_date DATE, symbol STRING, chain STRING, address STRING, price DOUBLE, confidence DOUBLE, ingested_at TIMESTAMP_NTZ"))
    payloads = PR.spot_payloads(spark, sf)
    allow = PR.allowlist(spark, sf)
    LD.spot_prices_load(spark, payloads, allow, spec, "requested_day", "2024-01-01 00:00:00")
    LD.spot_prices_load(spark, payloads, allow, spec, "requested_day", "2024-01-02 00:00:00")
    return TB.read_raw(spark, spec).select("block_date", "symbol", "chain", "address", "price", "confidence")


@register(
    "price_backfill_load",
    "WITH " + PR._CHART_SQL + """,
conf AS (
  SELECT event_type AS coin, event_id // 500 AS window_no,
         max(CASE WHEN event_type <> 'view' THEN user_id / 1000.0 END) AS confidence
  FROM events GROUP BY ALL
),
last_conf AS (SELECT coin, arg_max(confidence, window_no) AS confidence FROM conf WHERE confidence IS NOT NULL GROUP BY coin)
SELECT p.coin AS asset, p.day AS block_date, p.price, c.confidence
FROM (SELECT coin, CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS day,
             arg_max(price, window_no * 1000000000 + pos) AS price
      FROM pts WHERE price IS NOT NULL GROUP BY ALL) p
LEFT JOIN last_conf c ON p.coin = c.coin""",
)
def price_backfill_load(spark, sf):
    """Chart windows merged per day, inserted; the re-run prunes the previous series."""
    spec = TB.TableSpec(path=scratch_path(spark, "backfill"), month_of="block_date", schema=(
        "asset STRING, block_date DATE, price DOUBLE, confidence DOUBLE, ingested_at TIMESTAMP_NTZ"))
    windows = PR.chart_windows(spark, sf)
    LD.price_backfill_load(spark, windows, spec, "2024-02-01 00:00:00")
    LD.price_backfill_load(spark, windows, spec, "2024-02-02 00:00:00")
    return TB.read_raw(spark, spec).select("asset", "block_date", "price", "confidence")


@register(
    "full_history_load",
    """SELECT event_type AS asset, CAST(ts AS DATE) AS block_date, arg_max(value, event_id) AS price
FROM events WHERE value IS NOT NULL AND CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY ALL""",
)
def full_history_load(spark, sf):
    """Last point per day, today excluded, per-asset prune; a re-run leaves no duplicates."""
    spec = TB.TableSpec(path=scratch_path(spark, "history"), month_of="block_date", schema=(
        "asset STRING, block_date DATE, price DOUBLE, ingested_at TIMESTAMP_NTZ"))
    ev = src(spark, sf, "events").select(F.col("event_type").alias("asset"), "ts", F.col("value").alias("price"), F.col("event_id").alias("pos"))
    LD.full_history_load(spark, ev, spec, "2024-01-30", "2024-02-01 00:00:00")
    LD.full_history_load(spark, ev, spec, "2024-01-30", "2024-02-02 00:00:00")
    return TB.read_raw(spark, spec).select("asset", "block_date", "price")


@register(
    "price_backfill_by_token",
    "WITH " + PR._CHART_SQL + """
SELECT CAST(DATE '1970-01-01' + CAST(round_even(ts_s / 86400.0, 0) AS INTEGER) AS DATE) AS block_date, upper(coin) AS symbol, 'gnosis' AS chain,
       '0x' || coin AS address, arg_max(price, window_no * 1000000000 + pos) AS price
FROM pts WHERE price IS NOT NULL AND coin <> 'signup' GROUP BY ALL""",
)
def price_backfill_by_token(spark, sf):
    """The backfill's own row shape: symbol, chain and token address from the allowlist;
    a coin that is not on it brings no row; run twice."""
    coins = src(spark, sf, "events").select("event_type").distinct().filter("event_type <> 'signup'")
    allow = coins.select(F.upper("event_type").alias("symbol"), F.lit("gnosis").alias("chain"), F.concat(F.lit("0x"), "event_type").alias("address"))
    windows = PR.chart_windows(spark, sf).withColumn("body", F.regexp_replace("body", r'^\{"coins":\{"', '{"coins":{"gnosis:0X'))
    spec = TB.TableSpec(path=scratch_path(spark, "backfill"), month_of="block_date", schema=(
        "block_date DATE, symbol STRING, chain STRING, address STRING, price DOUBLE, confidence DOUBLE, ingested_at TIMESTAMP_NTZ"))
    LD.price_backfill_load(spark, windows, spec, "2024-02-01 00:00:00", allow)
    LD.price_backfill_load(spark, windows, spec, "2024-02-02 00:00:00", allow)
    return TB.read_raw(spark, spec).select("block_date", "symbol", "chain", "address", "price")


@register(
    "market_prices_load",
    """SELECT 'row' AS kind, event_type AS coingecko_id, upper(event_type) AS symbol, CAST(ts AS DATE) AS block_date, arg_max(value, epoch_ms(ts) * 1000000 + event_id) AS price
FROM events WHERE value IS NOT NULL AND event_type NOT IN ('error', 'signup') AND CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY ALL
UNION ALL SELECT DISTINCT 'missing', event_type, NULL, NULL, CAST(NULL AS DOUBLE) FROM events WHERE event_type = 'error'
UNION ALL SELECT DISTINCT 'reject', event_type, 'malformed', NULL, NULL FROM events WHERE event_type = 'error'""",
)
def market_prices_load(spark, sf):
    """Second source: last point per day and id, today left out; the chart that is cut
    off is a reject and its asset reported, the others load; run twice."""
    ids = src(spark, sf, "events").select("event_type").distinct().filter("event_type <> 'signup'")
    allow = ids.select(F.lit(1).alias("pos"), F.col("event_type").alias("coingecko_id"), F.upper("event_type").alias("symbol"))
    spec = TB.TableSpec(path=scratch_path(spark, "market"), month_of="block_date", schema=(
        "block_date DATE, coingecko_id STRING, symbol STRING, price DOUBLE, ingested_at TIMESTAMP_NTZ"))
    charts = PR.market_charts(spark, sf)
    for day in ("2024-02-01 00:00:00", "2024-02-02 00:00:00"):
        missing = LD.market_prices_load(spark, charts, allow, spec, "2024-01-30", day)
    no_day, no_price = F.lit(None).cast("date"), F.lit(None).cast("double")
    rejects = TB.read_raw(spark, P.rejects_of(spec)).select("page", "reason").distinct()
    return (TB.read_raw(spark, spec).select(F.lit("row").alias("kind"), "coingecko_id", "symbol", "block_date", "price")
            .unionAll(missing.select(F.lit("missing"), "coingecko_id", F.lit(None).cast("string"), no_day, no_price))
            .unionAll(rejects.select(F.lit("reject"), "page", "reason", no_day, no_price)))
