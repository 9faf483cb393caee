"""Join and filter semantics on literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from quayside.operators import filters as FL
from quayside.operators import joins as J
from quayside.operators import metrics as M
from quayside.plans import increment as I
from quayside.sources.allowlist import load_allowlist, ALLOWLIST_DDL


def test_allowlist_normalisation(spark):
    raw = spark.createDataFrame([
        (0, " GNO ", None, "0xABC", "gnosis", True, True),
        (1, "WETH", "eth", " 0xDEF ", "weth", True, False),
        (2, "ARB", "Arbitrum-One", "0x1", "", False, True),
        (3, "  ", "base", "0x2", "x", True, True),       # blank symbol dropped
        (4, "FOO", "solana", "0x3", None, None, None),    # unknown chain kept as is
    ], ALLOWLIST_DDL)
    got = [(r.symbol, r.chain, r.address, r.coingecko_id, r.defillama) for r in load_allowlist(raw).orderBy("pos").collect()]
    assert got == [
        ("GNO", "gnosis", "0xabc", "gnosis", True), ("WETH", "ethereum", "0xdef", "weth", True),
        ("ARB", "arbitrum", "0x1", None, False), ("FOO", "solana", "0x3", None, False),
    ]


def test_only_filter_reports_unknown(spark):
    dim = spark.createDataFrame([("GNO", "gnosis"), ("WETH", "weth")], "symbol STRING, coingecko_id STRING")
    wanted = spark.createDataFrame([("gno",), ("WETH",), ("nope",)], "w STRING")
    kept, unknown = FL.only_filter(dim, wanted)
    assert sorted(r.symbol for r in kept.collect()) == ["GNO", "WETH"]
    assert [r.wanted for r in unknown.collect()] == ["nope"]


def test_missing_fills_rules(spark):
    src = spark.createDataFrame([
        ("t1", "U1", "0xAA", 1, dt.datetime(2024, 1, 5)),
        ("t1", "U1", "0xAA", 2, dt.datetime(2024, 1, 5)),   # second fill of the same order
        ("t2", "", "0xBB", 1, dt.datetime(2024, 1, 5)),     # blank uid excluded
        ("t3", "U3", "0xCC", 1, dt.datetime(2023, 1, 5)),   # before the backfill start
        ("t4", "u4", "0xDD", 1, dt.datetime(2024, 1, 5)),   # uid compares case-sensitively
    ], "taker STRING, order_uid STRING, transaction_hash STRING, log_index INT, block_timestamp TIMESTAMP_NTZ")
    tgt = spark.createDataFrame([("U1", "0xaa", 1), ("U4", "0xdd", 1)], "order_uid STRING, tx_hash STRING, log_index INT")
    got = sorted((r.order_uid, r.log_index) for r in J.missing_fills(src, tgt, start="2024-01-01").collect())
    assert got == [("U1", 2), ("u4", 1)]
    owners = J.missing_by_owner(J.missing_fills(src, tgt, start="2024-01-01")).collect()
    assert [(r.taker, r.missing_orders) for r in owners] == [("t1", 1), ("t4", 1)]


def test_skip_known_fills_window(spark):
    new = spark.createDataFrame([("A", "0xT", 1), ("B", "0xT", 1), ("C", "0xT", 1)], "order_uid STRING, tx_hash STRING, log_index INT")
    held = spark.createDataFrame([
        ("a", "0XT", 1, "o1", dt.datetime(2024, 1, 20)),    # known (case differs) → skipped
        ("B", "0xT", 1, "o1", dt.datetime(2023, 12, 1)),    # outside the 14-day window → refetched
        ("C", "0xT", 1, "o2", dt.datetime(2024, 1, 20)),    # owner not in the list → refetched
    ], "order_uid STRING, tx_hash STRING, log_index INT, owner STRING, ingested_at TIMESTAMP_NTZ")
    owners = spark.createDataFrame([("o1",)], "taker STRING")
    got = sorted(r.order_uid for r in J.skip_known_fills(new, held, owners, "2024-01-25", 14).collect())
    assert got == ["B", "C"]


def test_watermarks(spark):
    df = spark.createDataFrame([(dt.datetime(1970, 1, 1),)], "t TIMESTAMP_NTZ")
    assert M.watermark_max(df, "t").first()[0] is None  # epoch only → no watermark
    stubs = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 3)), (2, dt.datetime(2024, 1, 1), dt.datetime(2023, 1, 1))],
                                  "id INT, bumped TIMESTAMP_NTZ, created TIMESTAMP_NTZ")
    stored = spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "b TIMESTAMP_NTZ")
    assert [r.id for r in I.watermark_increment(stubs, stored, "bumped", "created", "b").collect()] == [1]
    assert I.watermark_increment(stubs, df.withColumnRenamed("t", "b"), "bumped", "created", "b").count() == 2


def test_growth_and_capture(spark):
    users = spark.createDataFrame([("a", 5), ("b", 3), ("c", 0), ("d", 2)], "u STRING, likes BIGINT")
    base = spark.createDataFrame([("a", 5), ("b", 1)], "u STRING, likes BIGINT")
    got = sorted((r.u, r.baseline) for r in J.growth_targets(users, base, "u", "likes").collect())
    assert got == [("b", 1), ("d", 0)]
    edges = spark.createDataFrame([("a",), ("a",), ("b",)], "u STRING")
    r = M.capture_rate(users, edges, "u", "likes").first()
    assert (r.expected_edges, r.captured_edges, r.users_empty) == (10, 3, 1)
