"""Loads that resume, repair, skip what did not change, and read drifting folders."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import joins as J
from quayside.operators import payloads as P
from quayside.operators import tables as TB
from quayside.plans import increment as I
from quayside.plans import ledger as L
from quayside.plans import loads as LD
from quayside.sources import readers as R


def write(path, **files):
    for name, text in files.items():
        (path / name.replace("_csv", ".csv").replace("_json", ".json")).write_text(text, newline="")
    return str(path)


# --------------------------------------------------------------------------- CSV


TARGET = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("note", T.StringType())])


def test_headers_in_another_order(spark, tmp_path):
    path = write(tmp_path, a_csv="symbol,price\nx,1\n", b_csv="price,symbol\n2,y\n")
    got = sorted(tuple(r) for r in R.conform_csv(spark, path, TARGET).collect())
    assert got == [("x", 1.0), ("y", 2.0)]


def test_names_that_differ_in_case(spark, tmp_path):
    path = write(tmp_path, a_csv="symbol,Symbol\nx,wrong\n", b_csv="Symbol,SYMBOL,PRICE\nfirst,second,3\n", c_csv="nothing,here\n1,2\n")
    got = sorted((r.symbol, r.price) for r in R.conform_csv(spark, path, TARGET).collect())
    assert got == [("first", 3.0), ("x", None)]


def test_line_ends_in_cells_and_odd_file_names(spark, tmp_path):
    path = write(tmp_path, **{"a b[1]_csv": 'symbol,note\n"x\ny","say ""hi"""\nz,plain\n', "c%20d_csv": "﻿note,symbol\r\nn,w\r\n"})
    files = {r.header: r.multi_line for r in R.csv_files(spark, path).collect()}
    assert sorted(files.values()) == [False, True]
    got = sorted(tuple(r) for r in R.conform_csv(spark, path, TARGET).collect())
    assert got == [("w", "n"), ("x\ny", 'say "hi"'), ("z", "plain")]
    named = sorted(tuple(r) for r in R.read_csv(spark, path, "symbol STRING, price DOUBLE").collect())
    assert named == [("w", None), ("x\ny", None), ("z", None)]


def test_declared_columns_must_be_there(spark, tmp_path):
    with pytest.raises(ValueError, match="no declared column"):
        R.read_csv(spark, write(tmp_path, a_csv="x,y\n1,2\n"), "symbol STRING")


def test_dates_that_do_not_parse_fail_plain_loads(spark, tmp_path, scratch):
    path = write(tmp_path, a_csv="block_date,symbol,price\nsoon,x,1\n")
    with pytest.raises(Exception, match="unparseable timestamp"):
        LD.prices_load(spark, path, TB.TableSpec(path=scratch("prices")))


def test_rows_without_a_time_are_rejects(spark, tmp_path, scratch):
    path = write(tmp_path, a_csv="safe_address,action,action_value,event_time\nA,x,,2024-01-01 00:00:00\nB,y,1,never\n")
    spec = TB.TableSpec(path=scratch("wallet"), key=LD.WALLET_EVENT_KEY)
    LD.celo_wallet_events_load(spark, path, spec)
    assert [r.safe_address for r in TB.read_latest(spark, spec).collect()] == ["a"]
    bad = TB.read_raw(spark, P.rejects_of(spec)).collect()
    assert [(r.entity, r.reason, json.loads(r.text)["safe_address"]) for r in bad] == [("wallet_events", "no_event_time", "b")]


# --------------------------------------------------------------------------- changed rows


def test_unchanged_rows_write_nothing(spark, scratch):
    spec = TB.TableSpec(path=scratch("polls"), key=("k", "j"), version="ingested_at")
    ddl = "k INT, j STRING, votes INT, tags ARRAY<STRING>, ingested_at TIMESTAMP"

    def load(day, *rows):
        return TB.upsert_changed(spark, spark.createDataFrame([(*r, dt.datetime(2024, 1, day)) for r in rows], ddl), spec)

    assert load(1, (1, "a", 5, ["x, y"]), (2, None, 6, None), (2, None, 6, None)) == 2
    assert load(2, (1, "a", 5, ["x, y"]), (2, None, 6, None)) == 0
    assert load(3, (1, "a", 5, ["x", "y"]), (2, None, 7, None), (3, "c", None, [])) == 3
    assert load(4, (1, "a", 5, ["x, y"])) == 1  # changed back
    held = {(r.k, r.j): (r.votes, r.ingested_at.day) for r in TB.read_latest(spark, spec).collect()}
    assert held == {(1, "a"): (5, 4), (2, None): (7, 3), (3, "c"): (None, 3)}
    TB.compact(spark, spec)
    assert load(5, (1, "a", 5, ["x, y"]), (2, None, 7, None)) == 0


def test_rows_stored_without_a_hash(spark, scratch):
    spec = TB.TableSpec(path=scratch("old"), key=("k",), version="ingested_at")
    rows = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 1)), (2, 6, dt.datetime(2024, 1, 1))], "k INT, v INT, ingested_at TIMESTAMP")
    TB.upsert(rows, spec)
    later = rows.withColumn("ingested_at", F.lit("2024-01-02").cast("timestamp")).withColumn("v", F.when(F.col("k") == 1, 9).otherwise(F.col("v")))
    assert TB.upsert_changed(spark, later, spec) == 1
    assert TB.upsert_changed(spark, later, spec) == 0


# --------------------------------------------------------------------------- bounded commits


def months(spark, n):
    return spark.range(n).select(F.col("id"), F.add_months(F.lit("2000-01-15").cast("date"), F.col("id").cast("int")).alias("d"))


def test_two_hundred_months_are_three_commits(spark, scratch, monkeypatch):
    spec = TB.TableSpec(path=scratch("bounded"), month_of="d")
    appended, real = [], TB.append

    def counted(df, to, seq=None):
        if to.path == spec.path:
            if len(appended) == 1:
                appended.append("failed")
                raise OSError("lost")
            appended.append(df.count())
        return real(df, to, seq)

    monkeypatch.setattr(TB, "append", counted)
    with pytest.raises(OSError):
        L.bounded_write(spark, months(spark, 200), spec, max_months=90, load_id="one")
    assert TB.read_raw(spark, spec).count() == 90
    plan = L.bounded_write(spark, months(spark, 200).filter("id < 5"), spec, max_months=90, load_id="one")  # from the rows written at first
    assert appended == [90, "failed", 90, 20]
    assert sorted((r.batch_no, r.n_months, r.state) for r in plan.collect()) == [(0, 90, "committed"), (1, 90, "committed"), (2, 20, "committed")]
    assert sorted(r.id for r in TB.read_latest(spark, spec).collect()) == list(range(200))


def test_a_commit_lost_before_its_record_is_not_written_again(spark, scratch, monkeypatch):
    spec = TB.TableSpec(path=scratch("bounded"), month_of="d")
    commits, real, lost = L.commits_spec(scratch("commits")), TB.append, []
    rows = months(spark, 30).unionAll(spark.range(30, 33).select("id", F.lit(None).cast("date")))

    def unrecorded(df, to, seq=None):
        if to.path == commits.path and TB.path_exists(spark, spec.path) and not lost:
            lost.append(1)
            raise OSError("lost")
        return real(df, to, seq)

    monkeypatch.setattr(TB, "append", unrecorded)
    with pytest.raises(OSError):
        L.bounded_write(spark, rows, spec, 20, commits, "two")
    L.bounded_write(spark, rows, spec, 20, commits, "two")
    assert sorted(r.id for r in TB.read_latest(spark, spec).collect()) == list(range(33))


# --------------------------------------------------------------------------- events


def export(tmp_path, *events):
    lines = [json.dumps({"event": "e", "properties": {"$insert_id": str(i), **({"time": int(t.replace(tzinfo=dt.timezone.utc).timestamp()) + 0.75} if t else {})}})
             for i, t in enumerate(events)]
    (tmp_path / "export.json").write_text("\n".join([*lines, "[1]", ""]))
    return str(tmp_path)


def event_tables(scratch):
    return (TB.TableSpec(path=scratch("events"), key=("project_id", "event_name", "event_time", "insert_id")), I.ledger_spec(scratch("ledger")))


def marks(spark, ledger):
    return {r.completed_date.day: r.rows_indexed for r in TB.read_latest(spark, ledger).collect()}


RUN = {"project_id": "p", "today": "2024-01-06", "run_ts": "2024-01-06 00:00:00", "backfill": ("2024-01-01", "2024-01-05")}


def test_killed_between_append_and_mark_leaves_no_hole(spark, tmp_path, scratch, monkeypatch):
    day = lambda d, h=1: dt.datetime(2024, 1, d, h)
    path = export(tmp_path, day(1), day(1, 2), day(2), None, day(4))
    events, ledger = event_tables(scratch)
    real = I.mark_complete

    def dies(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(I, "mark_complete", dies)
    with pytest.raises(OSError):
        LD.events_load(spark, path, events, ledger, **RUN)
    monkeypatch.setattr(I, "mark_complete", real)
    outcome = {r.day.day: (r.rows, r.outcome) for r in LD.events_load(spark, path, events, ledger, **RUN).collect()}
    # Day 3 is empty and old enough; day 5 is empty and may still get events.
    assert outcome == {1: (2, "complete"), 2: (1, "complete"), 3: (0, "complete"), 4: (1, "complete"), 5: (0, "waiting")}
    assert marks(spark, ledger) == {1: 2, 2: 1, 3: 0, 4: 1}
    assert sorted(r.insert_id for r in TB.read_latest(spark, events).collect()) == ["0", "1", "2", "3", "4"]
    assert {r.event_time.microsecond for r in TB.read_latest(spark, events).collect()} == {0}
    stored = TB.read_raw(spark, events).filter("insert_id <> '3'").count()
    LD.events_load(spark, path, events, ledger, **RUN)  # completed days are not loaded again
    assert TB.read_raw(spark, events).filter("insert_id <> '3'").count() == stored
    assert "not_an_object" in {r.reason for r in TB.read_raw(spark, P.rejects_of(events)).collect()}


def test_a_truncated_hour_stops_the_load_there(spark, tmp_path, scratch):
    one, two, three = ([dt.datetime(2024, 1, d, h) for h in hours] for d, hours in ((1, [1, 2, 3]), (2, [5, 5, 5]), (3, [1])))
    events, ledger = event_tables(scratch)
    got = LD.events_load(spark, export(tmp_path, *one, *two, *three), events, ledger, limit=3, **RUN)
    # Day 1 reaches the limit as a whole but in no hour.
    assert {r.day.day: r.outcome for r in got.collect()} == {1: "complete", 2: "truncated", 3: "stopped", 4: "stopped", 5: "stopped"}
    assert marks(spark, ledger) == {1: 3} and TB.read_latest(spark, events).count() == 3


def test_gaps_are_days_without_a_complete_mark(spark):
    rows = [("p", dt.date(2024, 1, d), s) for d, s in ((1, "complete"), (2, "failed"), (4, "complete"), (6, "pending"))] + [("q", dt.date(2024, 1, 1), "failed")]
    got = I.ledger_gaps(spark.createDataFrame(rows, "project_id STRING, completed_date DATE, status STRING")).collect()
    assert sorted((r.project_id, r.day.day) for r in got) == [("p", 2), ("p", 3)]


# --------------------------------------------------------------------------- fills


def trades(spark, *rows):
    return spark.createDataFrame([(json.dumps([{"orderUid": u, "txHash": "0xA", "logIndex": n, "owner": o} for u, n, o in rows]),)], "body STRING")


def test_fills_in_three_modes(spark, scratch):
    spec = TB.TableSpec(path=scratch("fills"), key=("order_uid", "tx_hash", "log_index"), version="ingested_at", month_of="ingested_at")
    source = spark.createDataFrame([("O1", "u1", "0xa", 1, dt.datetime(2024, 1, 1)), ("O1", "u2", "0xa", 1, dt.datetime(2024, 1, 1)),
                                    ("o2", "u3", "0xA", 1, dt.datetime(2024, 1, 1))],
                                   "taker STRING, order_uid STRING, transaction_hash STRING, log_index BIGINT, block_timestamp TIMESTAMP")
    owners = source.select("taker").distinct()
    LD.fills_load(spark, trades(spark, ("u1", 1, "O1"), ("u3", 1, "o2")), spec, owners, "2024-01-02 00:00:00", mode="backfill")
    lower = lambda df: df.withColumn("tx_hash", F.lower("tx_hash"))
    everything = trades(spark, ("u1", 1, "O1"), ("u2", 1, "O1"), ("u3", 1, "o2"))
    assert LD.fills_load(spark, everything, spec, source.select(F.col("taker")).distinct(), "2024-01-05 00:00:00") == 1
    assert {r.order_uid for r in TB.read_latest(spark, spec).filter("ingested_at > '2024-01-04'").collect()} == {"u2"}
    # Repair: only o1 lacks a fill on the key of the chain (u1 is held under another case of the hash).
    held = lower(TB.read_latest(spark, spec))
    want = {r.order_uid for r in source.join(held, [source.order_uid == held.order_uid, F.lower("transaction_hash") == held.tx_hash], "left_anti").collect()}
    assert want == set()
    more = source.unionAll(spark.createDataFrame([("o1", "u9", "0xb", 2, dt.datetime(2024, 1, 3))], source.schema))
    assert LD.fills_load(spark, everything, spec, None, "2024-01-06 00:00:00", mode="repair", source=more) == 2
    assert LD.fills_load(spark, everything, spec, None, "2024-01-07 00:00:00", mode="backfill") == 3
    assert TB.read_latest(spark, spec).count() == 3


@pytest.mark.parametrize("mode", ["daily", "repair", "backfill"])
def test_fills_are_loaded_without_a_copy_of_the_pages(spark, scratch, mode):
    spec = TB.TableSpec(path=scratch("fills"), key=("order_uid", "tx_hash", "log_index"), version="ingested_at", month_of="ingested_at")
    source = spark.createDataFrame([("O1", "u1", "0xa", 1, dt.datetime(2024, 1, 1)), ("O2", "u2", "0xa", 1, dt.datetime(2024, 1, 1))],
                                   "taker STRING, order_uid STRING, transaction_hash STRING, log_index BIGINT, block_timestamp TIMESTAMP")
    held = TB.append(P.fills_rows(trades(spark, ("u1", 1, "O1"))).withColumn("tx_hash", F.lower("tx_hash"))
                     .withColumn("ingested_at", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")), spec)
    assert held == 1
    pages = trades(spark, ("u1", 1, "O1"), ("u2", 1, "O2"), ("U1", 1, "o1")).unionAll(spark.createDataFrame([("[{",)], "body STRING")).repartition(3)
    fs, root = TB._fs(spark, spec.path.rsplit("/", 1)[0])
    copies = lambda: {f.getPath().getName() for f in fs.listStatus(root) if f.getPath().getName().startswith("landed-trades")}
    before, left = copies(), shuffle_files(spark)
    written = LD.fills_load(spark, pages, spec, source.select("taker"), "2024-02-02 00:00:00", mode=mode, source=source)
    assert copies() == before
    for _ in range(10):  # removal is not waited for
        if not shuffle_files(spark) - left:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - left
    new = {r.order_uid for r in TB.read_raw(spark, spec).filter("ingested_at > '2024-02-01'").collect()}
    assert (written, new) == {"daily": (1, {"u2"}), "repair": (1, {"u2"}), "backfill": (3, {"u1", "u2", "U1"})}[mode]
    assert [(r.reason, r.text) for r in TB.read_raw(spark, P.rejects_of(spec)).collect()] == [("malformed", "[{")]


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(k).getName() for k in range(found.size())) if name.endswith(".data")}


def test_known_fills_are_found_without_further_columns(spark):
    """NULL parts of a key are never known; case of uid and hash does not matter."""
    new = spark.createDataFrame([("U1", "0xA", 1, "x"), ("u1", "0xa", 2, "x"), ("u1", None, 1, "x")], "order_uid STRING, tx_hash STRING, log_index BIGINT, fee_policies STRING")
    held = spark.createDataFrame([("o", "u1", "0xa", 1, dt.datetime(2024, 1, 1)), ("o", "u1", None, 1, dt.datetime(2024, 1, 1))],
                                 "owner STRING, order_uid STRING, tx_hash STRING, log_index BIGINT, ingested_at TIMESTAMP")
    got = J.skip_known_fills(new, held, held.select("owner"), "2024-01-02 00:00:00")
    assert sorted((r.order_uid, r.tx_hash, r.log_index) for r in got.collect() if r.tx_hash) == [("u1", "0xa", 2)]
    assert got.count() == 2 and got.columns == new.columns
    dealt = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "AS _u#" in line]
    assert len(dealt) == 1  # of the held side only


@pytest.mark.parametrize("name", ["fills_load", "fills_load_repair", "fills_load_backfill"])
def test_fills_are_shown_without_their_other_columns(spark, tmp_path, name):
    from quayside.registry import QUERIES

    day = dt.datetime(2000, 2, 1)
    spark.createDataFrame([(1, 7, "F", 10.0, day, "5-LOW"), (2, 7, "O", 20.0, day, "5-LOW"), (3, 8, "F", 30.0, day, "1-URGENT"), (None, 8, "F", 1.0, day, "5-LOW")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 1, 1, 1, 1.5, 0.1, "A", "F", day), (1, 1, 2, 1, 1.5, 0.1, "N", "F", day), (2, 1, 1, 3, 1.5, 0.1, "A", "O", day), (None, 1, 1, 3, 1.5, 0.1, "A", "O", day)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    shown = QUERIES[name](spark, str(tmp_path))
    again = {"fills_load": {"0x2"}, "fills_load_repair": {"0x1", "0x2"}, "fills_load_backfill": {"0x1", "0x2", "0x3", ""}}[name]
    rows = [("0x1", 1, "0x7"), ("0x2", 3, "0x7"), ("0x3", 0, "0x8"), ("", 0, "0x8")]
    assert sorted(tuple(r)[:3] + (r.ingested_at.month == 8,) for r in shown.collect()) == sorted(
        r + (r[0] in again or (name == "fills_load" and r[0] in ("0x3", "")),) for r in rows if r[0] or name != "fills_load_repair")
    read, = (line for line in shown._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in line)
    assert "fee_policies" not in read and "sell_token" not in read and "owner" in read


def test_known_fills_read_the_months_of_the_window(spark, scratch):
    spec = TB.TableSpec(path=scratch("fills"), key=("order_uid",), month_of="ingested_at")
    rows = spark.range(400).select(F.col("id").cast("string").alias("order_uid"), F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp").alias("ingested_at"))
    TB.upsert(rows, spec)
    recent = LD.recent_fills(spark, spec, "2024-01-10 00:00:00", 14)
    assert {r.order_uid for r in recent.collect()} == {str(i) for i in range(360, 400)}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_part" in plan
    assert len(recent.inputFiles()) >= 2  # all files are listed, two months of them are read


# --------------------------------------------------------------------------- prices, crawl


def test_confidence_of_a_window_without_points(spark):
    def window(no, prices, confidence):
        return no, json.dumps({"coins": {"a:b": {"prices": [{"timestamp": t, "price": p} for t, p in prices], "confidence": confidence}}})

    from quayside.operators import metrics as M

    w = spark.createDataFrame([window(0, [(86400, 1.0)], 0.5), window(1, [], 0.9), window(2, [(172800, 2.0)], None)], "window_no INT, body STRING")
    got = M.merge_chart_windows(P.chart_points(w), "coin", "day", "price", "window_no", "pos", "confidence", P.chart_confidences(w))
    assert {(r.day.day, r.price, r.confidence) for r in got.collect()} == {(2, 1.0, 0.9), (3, 2.0, 0.9)}


def test_a_bad_chart_fails_its_asset_only(spark, scratch):
    ms = lambda day, h=0: int(dt.datetime(2024, 1, day, h, tzinfo=dt.timezone.utc).timestamp()) * 1000
    allow = spark.createDataFrame([(1, "good", "G"), (2, "bad", "B"), (3, None, "N")], "pos INT, coingecko_id STRING, symbol STRING")
    spec = TB.TableSpec(path=scratch("market"), month_of="block_date", schema="block_date DATE, coingecko_id STRING, symbol STRING, price DOUBLE, ingested_at TIMESTAMP_NTZ")

    def load(day, *charts):
        return LD.market_prices_load(spark, spark.createDataFrame(list(charts), "coingecko_id STRING, body STRING"), allow, spec, "2024-01-04", f"2024-02-0{day} 00:00:00")

    load(1, ("good", json.dumps({"prices": [[ms(1), 1], [ms(1, 5), 2], [ms(4), 9]]})), ("bad", json.dumps({"prices": [[ms(2), 7]]})))
    missing = load(2, ("good", json.dumps({"prices": [[ms(1), 3], [ms(2), None]]})), ("bad", '{"prices": [[1'))
    assert [r.coingecko_id for r in missing.collect()] == ["bad"]
    rows = TB.read_raw(spark, spec).select("coingecko_id", "block_date", "price").collect()
    assert sorted((r[0], r[1].day, r[2]) for r in rows) == [("bad", 2, 7.0), ("good", 1, 3.0)]
    assert [(r.page, r.reason) for r in TB.read_raw(spark, P.rejects_of(spec)).collect()] == [("bad", "malformed")]


def test_crawl_tables(spark, scratch):
    assert len(LD.CRAWL_KEYS) == 13
    for table, key in LD.CRAWL_KEYS.items():
        names = T.StructType.fromDDL(LD.crawl_schema(table)).fieldNames()
        assert set(key) <= set(names) and len(set(names)) == len(names)
    landing, root = scratch("drops"), scratch("crawl")
    spec = LD.crawl_spec(root, "is_cloud_avg_1d")
    row = ("t", dt.datetime(2024, 1, 1), None, None, 1.0, 2, 0.5, 3.0)
    spark.createDataFrame([row, row], spec.schema).write.parquet(f"{landing}/is_cloud_avg_1d/2024-01-01.parquet")
    for _ in range(2):
        got = {r.table_name: r.rows for r in LD.crawl_load(spark, landing, root).collect()}
    assert got["is_cloud_avg_1d"] == 2 and got["countries_avg_1d"] is None and len(got) == 13
    assert [tuple(r) for r in TB.read_latest(spark, spec).select("is_cloud", "__count").collect()] == [(None, 1.0)]


# --------------------------------------------------------------------------- helpers of the loads


def test_statement_files_run_in_order(spark, tmp_path):
    from quayside.plans.sqlfiles import run_files

    (tmp_path / "1.sql").write_text("CREATE OR REPLACE TEMPORARY VIEW {{VIEW}} AS SELECT * FROM range(5)")
    (tmp_path / "2.sql").write_text("SELECT count(*) AS n FROM {{VIEW}} WHERE id >= :least")
    got = run_files(spark, [str(tmp_path / "1.sql"), str(tmp_path / "2.sql")], {"VIEW": "v_files"}, {"least": 2})
    assert got.first().n == 3


def test_allowlist_file(spark, tmp_path):
    pytest.importorskip("yaml")
    from quayside.sources.allowlist import allowlist_from_yaml

    (tmp_path / "a.yml").write_text("tokens:\n- {symbol: ' GNO ', chain: xDai, address: '0xAB', defillama: true}\n- {symbol: ''}\n- {symbol: B, coingecko_id: b}\n")
    got = [tuple(r) for r in allowlist_from_yaml(spark, str(tmp_path / "a.yml")).orderBy("pos").collect()]
    assert got == [(0, "GNO", "gnosis", "0xab", None, True, False), (2, "B", "gnosis", "", "b", False, False)]


def test_timed_runs_reach_the_ledger(spark, scratch):
    ledger = TB.TableSpec(path=scratch("runs"), schema=L.LEDGER_DDL)

    def fails():
        raise OSError("lost")

    assert L.timed(spark, ledger, "daily", "i", "load", "t", lambda: 5) == 5
    assert L.timed(spark, ledger, "daily", "i", "load", "t", lambda: 0) == 0
    with pytest.raises(OSError):
        L.timed(spark, ledger, "daily", "i", "load", "t", fails)
    assert sorted((r.result, r.rows) for r in TB.read_raw(spark, ledger).collect() if r.rows is not None) == [("inserted", 5), ("skipped", 0)]
    assert TB.read_raw(spark, ledger).filter("result = 'failed'").count() == 1


def test_days_and_times(spark):
    from quayside.functions import coerce as C

    day = dt.date(2024, 2, 29)
    r = spark.createDataFrame([(day, 1709251199999)], "d DATE, ms BIGINT").select(C.utc_midnight_seconds("d").alias("s"), C.millis_to_date("ms").alias("d")).first()
    assert r.s == int(dt.datetime(2024, 2, 29, tzinfo=dt.timezone.utc).timestamp()) and r.d == day
    assert spark.range(1).select(C.lenient_int(F.lit("3.7")), C.lenient_int(F.lit(" -4 ")), C.lenient_int(F.lit(3.7))).first() == (0, -4, 3)


# --------------------------------------------------------------------------- governance


def test_governance_pages_go_to_the_table_without_a_staged_copy(spark, scratch, monkeypatch):
    monkeypatch.setattr(P, "land", None)  # would write the pages and read them back
    tables = {n: TB.TableSpec(path=scratch(n), key=k, version="ingested_at") for n, k in {
        "space": ("space_id",), "proposals": ("id",), "votes": ("proposal_id", "id"), "follows": ("id",)}.items()}

    def pages(*bodies):
        return spark.createDataFrame([(b,) for b in bodies], "body string")

    proposals = pages('[{"id":"p1","state":"active"},{"id":"p2","state":"closed","end":5}]', "[{", None)
    votes = pages('[{"id":"v1","vp":1,"proposal":{"id":"p1"}}, 7]', '[{"id":"v2","vp":2,"proposal":{"id":"p2"}}]', '{"errors":[1]}')
    for now in ("2024-01-01 00:00:00", "2024-01-02 00:00:00"):
        LD.governance_load(spark, tables, "s.eth", now, None, proposals, votes, pages('[{"id":"f1"}]'))
    # The second load brings one closed proposal: no vote of it is wanted, what cannot be read is.
    LD.governance_load(spark, tables, "s.eth", "2024-01-03 00:00:00", None, pages('[{"id":"p1","state":"closed","end":5}]'), votes)
    got = [tuple(r) for r in TB.read_latest(spark, tables["votes"], columns=["vp", "id", "proposal_id"]).collect()]
    assert got == [(1.0, "v1", "p1")]
    assert sorted((r.id, r.state) for r in TB.read_latest(spark, tables["proposals"]).collect()) == [("p1", "closed"), ("p2", "closed")]
    bad = {n: sorted((str(r.rejected_at)[:10], r.reason) for r in TB.read_raw(spark, P.rejects_of(tables[n])).collect()) for n in tables}
    days = ("2024-01-01", "2024-01-02", "2024-01-03")
    assert bad["votes"] == sorted((d, r) for d in days for r in ("errors", "not_an_object"))
    assert bad["proposals"] == sorted((d, r) for d in days[:2] for r in ("empty", "malformed"))
    assert bad["space"] == bad["follows"] == []


def test_latest_of_some_columns_is_that_of_all(spark, scratch):
    spec = TB.TableSpec(path=scratch("some"), key=("k",), version="v")
    rows = [(None, "a", 1, "x", None), (None, "b", 1, "w", 1), ("k", "a", 2, "x", 1), ("k", None, 2, "y", 3), ("k", "a", 2, "x", 4), ("k", "z", 1, "z", 9)]
    TB.upsert(spark.createDataFrame(rows, "k string, a string, v int, b string, c int"), spec, seq=1)
    names = ["k", "a", "v", "b", "c"]
    whole = TB.read_latest(spark, spec)
    for columns in (["k"], ["a"], ["b", "k"], ["c"], ["v"], ["v", "a"], names[::-1]):
        want = sorted(map(str, whole.select(*columns).collect()))
        assert sorted(map(str, TB.read_latest(spark, spec, columns=columns).collect())) == want
