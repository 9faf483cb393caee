"""Edge cases of parsing, payload flattening, readers and planning (literal fixtures)."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import coerce as C
from quayside.operators import metrics as M
from quayside.operators import payloads as P
from quayside.plans import increment as I
from quayside.sources import files as FS
from quayside.sources import readers as R


def _one(spark, expr_col, value, ddl="v STRING"):
    return spark.createDataFrame([(value,)], ddl).select(expr_col.alias("o")).first()["o"]


# --------------------------------------------------------------------------- #
# Column functions
# --------------------------------------------------------------------------- #


def test_datetime_layouts(spark):
    f = C.parse_datetime_layouts(F.col("v"))
    assert _one(spark, f, "01/02/2024") == dt.datetime(2024, 2, 1)  # day-first
    assert _one(spark, f, "12/31/2024") == dt.datetime(2024, 12, 31)  # month-first fallback
    assert _one(spark, f, "2024-03-04T05:06:07Z") == dt.datetime(2024, 3, 4, 5, 6, 7)
    assert _one(spark, f, "2024-03-04 05:06:07.5") == dt.datetime(2024, 3, 4, 5, 6, 7, 500000)
    assert _one(spark, f, "") is None
    assert _one(spark, f, "soon") is None


def test_iso_or_epoch_and_null(spark):
    assert _one(spark, C.iso_or_epoch(F.col("v")), None) == dt.datetime(1970, 1, 1)
    assert _one(spark, C.iso_or_epoch(F.col("v")), "2024-01-02T03:04:05.000Z") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert _one(spark, C.iso_or_null(F.col("v")), None) is None


def test_unix_seconds(spark):
    assert _one(spark, C.unix_or_epoch(F.col("v")), "-5") == dt.datetime(1970, 1, 1)
    assert _one(spark, C.unix_or_epoch(F.col("v")), "86400") == dt.datetime(1970, 1, 2)
    assert _one(spark, C.unix_or_null(F.col("v")), "soon") is None


def test_boundary_day_half_even(spark):
    day = 86400
    f = C.boundary_day(F.col("v"))
    # 23:59:04 snaps forward to the next midnight
    assert _one(spark, f, str(19000 * day - 56), "v STRING") == dt.date(2022, 1, 8)
    # exactly noon: half-even → even day number
    assert _one(spark, f, str(19000 * day + day // 2)) == dt.date(2022, 1, 8)   # 19000 even
    assert _one(spark, f, str(19001 * day + day // 2)) == dt.date(2022, 1, 10)  # 19001.5 → 19002


def test_lenient_int(spark):
    f = C.lenient_int(F.col("v"))
    assert _one(spark, f, "42") == 42
    assert _one(spark, f, "n/a") == 0
    assert _one(spark, f, None) == 0
    assert _one(spark, C.lenient_int(F.col("v")), 3.7, "v DOUBLE") == 3


def test_sentinels_and_defaults(spark):
    assert _one(spark, C.sentinel_to_null(F.col("v")), "<nil>") is None
    assert _one(spark, C.sentinel_to_null(F.col("v")), "") is None
    assert _one(spark, C.sentinel_to_null(F.col("v")), "0xAbC") == "0xabc"
    assert _one(spark, C.or_default(F.col("v"), "0"), "") == "0"
    assert _one(spark, C.or_default(F.col("v"), 0), 0, "v BIGINT") == 0


# --------------------------------------------------------------------------- #
# Payloads
# --------------------------------------------------------------------------- #


def _pages(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "body STRING")


def test_fees(spark):
    trades = [
        {"orderUid": "u1", "executedProtocolFees": []},
        {"orderUid": "u2", "executedProtocolFees": [
            {"token": "B", "amount": "5"}, {"token": "A", "amount": "3"}, {"token": "A", "amount": "2"}]},
        {"orderUid": "u3", "executedProtocolFees": [
            {"token": "X", "amount": str(2 ** 64)}, {"token": "X", "amount": str(2 ** 64)}, {"token": None, "amount": None}]},
    ]
    rows = {r.order_uid: r for r in P.fills_rows(_pages(spark, trades)).collect()}
    assert (rows["u1"].fee_token, rows["u1"].fee_amount, rows["u1"].fee_policies) == ("", "0", "[]")
    assert (rows["u2"].fee_token, rows["u2"].fee_amount) == ("B", "5")  # tie 5 vs 5 → first seen
    assert (rows["u3"].fee_token, rows["u3"].fee_amount) == ("X", str(2 ** 65))  # above 2^63, exact
    pol = json.loads(rows["u3"].fee_policies)
    assert pol[2] == {"policy": {}, "amount": "0", "token": ""}
    assert rows["u1"].block_number == 0 and rows["u1"].sell_amount == "0"


def _topic(posts, **kw):
    return {"id": 7, "post_stream": {"posts": posts, "stream": [p["id"] for p in posts] + [999]}, **kw}


def test_polls(spark):
    post = {"id": 70, "polls": [
        {"id": 1, "name": "poll", "status": "open", "options": [
            {"id": "a", "html": "yes", "votes": 0}, {"id": "b", "html": "no"}, {"id": "", "html": "skip"}]},
        {"id": 2, "name": "poll2", "options": []},
        {"id": 3, "status": "closed", "close": "2024-01-01T00:00:00Z", "options": [{"id": "c", "votes": 4}]},
    ]}
    rows = P.forum_poll_options(_pages(spark, _topic([post]))).collect()
    got = sorted((r.poll_name, r.option_id, r.option_votes, r.topic_id, r.close_at) for r in rows)
    assert got == [
        ("poll", "a", 0, 7, None), ("poll", "b", -1, 7, None),
        ("poll", "c", 4, 7, dt.datetime(2024, 1, 1)),  # missing name → 'poll'
    ]


def test_topics_and_posts(spark):
    posts = [{"id": 70, "post_number": 1, "actions_summary": [{"id": 1, "count": 9}, {"id": 2, "count": 3}]},
             {"id": 71, "topic_id": 0, "post_number": 2}]
    detail = _topic(posts, title="t", last_posted_at="2024-01-05T00:00:00Z", tags=None, pinned=True)
    stubs = _pages(spark).limit(0)  # no stub
    t = P.forum_topics_rows(_pages(spark, detail)).first()
    assert (t.category_id, t.tags, t.pinned, t.bumped_at) == (-1, "", 1, dt.datetime(2024, 1, 5))
    assert "post_stream" not in json.loads(t.raw_json)
    assert stubs.count() == 0
    ps = {r.id: r for r in P.forum_posts_rows(_pages(spark, detail)).collect()}
    assert ps[70].like_count == 3 and ps[71].like_count == 0 and ps[71].topic_id == 7
    missing = P.posts_still_missing(_pages(spark, detail), P.forum_posts_rows(_pages(spark, detail))).collect()
    assert [(r.topic_id, r.post_id) for r in missing] == [(7, 999)]


def test_likes(spark):
    pages = spark.createDataFrame(
        [("alice", json.dumps({"user_actions": [{"post_id": 5, "hidden": True}, {"post_id": None}, {"topic_id": 3}]}))],
        "username STRING, body STRING",
    )
    rows = P.forum_likes_rows(pages).collect()
    assert [(r.post_id, r.acting_username, r.hidden) for r in rows] == [(5, "alice", 1)]


def test_categories(spark):
    body = {"category_list": {"categories": [
        {"id": 1, "name": "root", "description": "d", "subcategory_list": [{"id": 2, "parent_category_id": 1, "description_text": "s"}]},
        {"id": 3, "parent_category_id": 0},
    ]}}
    rows = sorted((r.id, r.parent_id, r.description) for r in P.category_tree_flatten(_pages(spark, body)).collect())
    assert rows == [(1, -1, "d"), (2, 1, "s"), (3, -1, "")]


# --------------------------------------------------------------------------- #
# Readers
# --------------------------------------------------------------------------- #


def test_ndjson_rejects(spark, tmp_path):
    p = tmp_path / "e.ndjson"
    p.write_text("\n".join([
        json.dumps({"event": "a", "properties": {"time": 86400, "distinct_id": 1, "$insert_id": "x"}}),
        "",
        "{not json",
        "[1, 2]",
        json.dumps({"properties": {}}),
        json.dumps({"event": "b", "properties": {"time": "soon"}}),
        json.dumps({"event": "c", "properties": {}}),
    ]))
    ok, rejects = R.read_events(spark, str(p))
    assert sorted(r.reject_reason for r in rejects.collect()) == ["malformed", "no_event", "not_an_object"]
    rows, bad = R.events_rows(ok, "p")
    got = {r.event_name: r for r in rows.collect()}
    assert got["a"].event_time == dt.datetime(1970, 1, 2) and got["a"].distinct_id == "1"
    assert got["c"].event_time == dt.datetime(1970, 1, 1)  # missing time → epoch
    assert [r.event_name for r in bad.collect()] == ["b"]  # unparseable time rejected


def test_conform_csv(spark, tmp_path):
    p = tmp_path / "w.csv"
    p.write_text('﻿ SAFE Address ,Safe_CreatedAt,extra\n0xAB,01/02/2024,1\n"0x\nCD",2024-01-03T04:05:06Z\n0xEF,,9\n',
                 encoding="utf-8")
    target = T.StructType([T.StructField("SAFE_address", T.StringType()), T.StructField("SAFE_createdAt", T.TimestampType())])
    rows = R.conform_csv(spark, str(p), target).collect()
    assert [r.SAFE_address for r in rows] == ["0xAB", "0x\nCD", "0xEF"]  # quoted newline kept, short row ok
    assert [r.SAFE_createdAt for r in rows] == [dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 3, 4, 5, 6), None]


def test_file_selection(spark, tmp_path):
    d = tmp_path / "drops"
    d.mkdir()
    df = spark.createDataFrame([(1,)], "x INT")
    for name in ["2024-01-01.parquet", "2024-03-01.parquet", "2024-03-01.v2.parquet", "junk.parquet"]:
        df.write.parquet(str(d / name))
    (d / "2024-09-09.csv").write_text("x\n1\n")
    latest = FS.select_files(spark, str(d), "latest").collect()
    assert [r.name for r in latest] == ["2024-03-01.parquet"]  # tie → first listed
    assert FS.select_files(spark, str(d), "all").count() == 4  # csv skipped
    assert FS.select_files(spark, str(d), "date", "2024-01-01").count() == 1


def test_json_document(spark, tmp_path):
    p = tmp_path / "b.json"
    p.write_text(json.dumps({"addresses": [{"address": "0xAA", "reason": ""}, {"address": "", "reason": "x"}, {"address": "0xbb", "reason": "bot"}]}))
    rows = [(r.address, r.reason) for r in R.read_json_array(spark, str(p)).collect()]
    assert rows == [("0xaa", None), ("0xbb", "bot")]


# --------------------------------------------------------------------------- #
# Planning
# --------------------------------------------------------------------------- #


def _ledger(spark, days):
    return spark.createDataFrame([("p", dt.date.fromisoformat(d)) for d in days], "project_id STRING, completed_date DATE")


def test_date_plan(spark):
    days = lambda df: [str(r.day) for r in df.collect()]
    empty = _ledger(spark, [])
    assert days(I.date_plan(spark, empty, "2024-02-03")) == ["2024-02-02"]  # first run → yesterday
    assert days(I.date_plan(spark, empty, "2024-02-03", from_date="2024-02-01")) == ["2024-02-01", "2024-02-02"]
    assert days(I.date_plan(spark, _ledger(spark, ["2024-02-02"]), "2024-02-03")) == []  # up to date
    holes = I.ledger_gaps(_ledger(spark, ["2024-01-01", "2024-01-04"]))
    assert sorted(str(r.day) for r in holes.collect()) == ["2024-01-02", "2024-01-03"]


def test_late_data_guard(spark):
    counts = spark.createDataFrame([(dt.date(2024, 2, 1), 0), (dt.date(2024, 1, 31), 0), (dt.date(2024, 2, 2), 5)], "day DATE, rows BIGINT")
    got = {str(r.day): r.mark_complete for r in I.late_data_guard(counts, "2024-02-03").collect()}
    assert got == {"2024-02-01": False, "2024-01-31": True, "2024-02-02": True}


def test_truncation_hour_at_cap(spark):
    ts = [dt.datetime(2024, 1, 1, 0, i) for i in range(3)] + [dt.datetime(2024, 1, 2, h) for h in range(3)]
    ev = spark.createDataFrame([(t,) for t in ts], "ts TIMESTAMP")
    got = {str(r.day): (r.suspect, r.complete) for r in M.truncation_check(ev, "ts", cap=3).collect()}
    assert got == {"2024-01-01": (True, False), "2024-01-02": (True, True)}


def test_price_compare_summary(spark):
    from quayside.operators import joins as J

    a = spark.createDataFrame([("x", 1, 100.0), ("y", 1, 50.0), ("z", 1, 10.0), ("w", 1, 1.0)], "asset STRING, day INT, price DOUBLE")
    b = spark.createDataFrame([("x", 1, 100.0), ("y", 1, 40.0), ("z", 1, 8.0), ("v", 1, 3.0)], "asset STRING, day INT, price DOUBLE")
    r = J.price_compare_summary(J.price_compare(a, b, ["asset", "day"])).first()
    assert (r.pairs, r.agreeing, r.only_a, r.only_b) == (3, 1, 1, 1)
    assert abs(r.median_rel_diff - 0.25) < 1e-12 and abs(r.max_rel_diff - 0.25) < 1e-12
