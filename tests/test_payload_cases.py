"""Payload pages that cannot be read, fee sums of any length, the raw objects."""

import json
import random

from pyspark.sql import functions as F

from quayside.operators import payloads as P
from quayside.operators import tables as TB


def pages(spark, *bodies):
    return spark.createDataFrame([("trades", i, b) for i, b in enumerate(bodies)], "entity string, page_no int, body string")


def test_a_page_that_is_cut_off_is_one_reject(spark):
    rows, rejects = P.landed_pages(pages(spark, '[{"orderUid":"a"},{"orderUid":"b"', '[{"orderUid":"c"}]'), P.TRADE)
    assert [(r.page_no, r.pos, r.e.orderUid) for r in rows.collect()] == [(1, 0, "c")]
    assert [tuple(r)[:4] for r in rejects.collect()] == [("trades", "0", None, "malformed")]


def test_reasons_of_rejects(spark):
    bodies = ["", None, "junk", '{"errors": [1]}', '{"a": 1}', '[{"orderUid": 1}, "s", null, [2]]', "[]"]
    rows, rejects = P.landed_pages(pages(spark, *bodies), P.TRADE)
    assert rows.count() == 1
    got = sorted((r.page, -1 if r.pos is None else r.pos, r.reason) for r in rejects.collect())
    assert got == [("0", -1, "empty"), ("1", -1, "empty"), ("2", -1, "malformed"), ("3", -1, "errors"), ("4", -1, "not_a_list"),
                   ("5", 1, "not_an_object"), ("5", 2, "not_an_object"), ("5", 3, "not_an_object")]


def test_pages_without_their_list(spark):
    bodies = ['{"directory_items": null}', "{}", '{"directory_items": {"a": 1}}', '{"directory_items": [{"user": {"id": 5}}]}']
    parsed = P.landed(pages(spark, *bodies), P.USERS, keep=("page_no",))
    assert [r.id for r in P.forum_users_rows(parsed).collect()] == [5]
    assert [(r.page, r.reason) for r in P.page_rejects(parsed, P.USERS, ("page_no",)).collect()] == [("2", "not_a_list")]


def test_land_writes_one_parse_and_its_rejects(spark, scratch):
    spec = TB.TableSpec(path=scratch("rejects"))
    parsed = P.land(pages(spark, '[{"id":"v1","vp":2}]', "[{"), P.VOTES, spec, page=("entity", "page_no"), run_ts="2024-01-01 00:00:00")
    assert [(r.id, r.vp) for r in P.snapshot_votes_rows(parsed, "s").collect()] == [("v1", 2.0)]
    assert [(r.entity, r.page, r.reason) for r in TB.read_raw(spark, spec).collect()] == [("votes", "trades/1", "malformed")]


def test_sums_of_any_length(spark):
    rng = random.Random(3)
    cases = [["9" * 38, "9" * 38], ["-5", "3"], ["0" * 50 + "12"], ["+7", " 8 "], ["1.5"], ["x", "1"], [], ["9" * 60] * 7 + ["-" + "9" * 61]]
    cases += [[("-" if rng.random() < 0.4 else "") + str(rng.randrange(10 ** rng.randrange(1, 80))) for _ in range(rng.randrange(1, 9))] for _ in range(200)]

    def want(case):
        try:
            return str(sum(int(x) for x in case))
        except ValueError:
            return None

    df = spark.createDataFrame(list(enumerate(cases)), "i int, c array<string>")
    got = {r.i: r.s for r in df.select("i", P.sum_of_wholes(F.col("c")).alias("s")).collect()}
    assert got == {i: want(c) for i, c in enumerate(cases)}


def test_dominant_fee_past_every_number_type(spark):
    def fee(*fees):
        trade = {"orderUid": "a", "executedProtocolFees": [{"amount": a, "token": t} for a, t in fees]}
        r = P.fills_rows(pages(spark, json.dumps([trade]))).first()
        return r.fee_token, r.fee_amount

    assert fee(("7", "U"), ("9" * 38, "T"), ("9" * 38, "T")) == ("T", str(2 * int("9" * 38)))
    assert fee(("5", "A"), ("5", "B")) == ("A", "5")
    assert fee(("-3", "A"), ("-20", "B")) == ("A", "-3")
    assert fee(("x", "A"), ("-1", "B")) == ("B", "-1")
    assert fee(("x", "A")) == ("A", None)


def test_raw_objects(spark):
    poll = {"id": 1, "name": "p", "status": "open", "options": [{"id": "o", "votes": 2}], "preloaded_voters": {"o": [1]}}
    post = {"id": 5, "polls": [poll], "extra": {"b": 1, "a": [1, None]}}
    topic = {"id": 9, "title": "t", "post_stream": {"posts": [post], "stream": [5]}}
    d = pages(spark, json.dumps(topic))
    assert json.loads(P.forum_posts_rows(d).first().raw_json) == post
    assert json.loads(P.forum_poll_options(d).first().raw_json) == {"id": 1, "name": "p", "status": "open"}
    cats = {"category_list": {"categories": [{"id": 1, "subcategory_list": [{"id": 2, "x": "y"}]}]}}
    got = {r.id: json.loads(r.raw_json) for r in P.category_tree_flatten(pages(spark, json.dumps(cats))).collect()}
    assert got == {1: cats["category_list"]["categories"][0], 2: {"id": 2, "x": "y"}}
    text = json.dumps([{"id": "q", "é": "\n", "n": 123456789012345678901234567890}])
    assert json.loads(P.snapshot_proposals_rows(pages(spark, text), "s").first().raw_json) == json.loads(text)[0]


def test_fees_are_computed_once_a_trade(spark):
    d = P.fills_rows(pages(spark, json.dumps([{"orderUid": "a", "executedProtocolFees": [{"amount": "1", "token": "T"}]}])))
    plan = d.select("fee_token", "fee_amount")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 1


def test_sums_of_any_sign_and_length(spark):
    cases = [["-" + "9" * 60, "9" * 60], ["+007"], ["-0"], ["-" + "0" * 40], ["1" * 28, "-5", "+3"], ["-" + "8" * 43] * 7, []]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c array<string>")
    got = {r.i: r.s for r in df.select("i", P.sum_of_wholes(F.col("c")).alias("s")).collect()}
    assert got == {i: str(sum(map(int, c))) for i, c in enumerate(cases)}
