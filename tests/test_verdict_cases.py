"""Literal inputs beyond the stand-ins: odd fees, times, folders, plans, headers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quayside.functions import coerce as C
from quayside.operators import filters as FL
from quayside.operators import payloads as P
from quayside.operators import tables as T
from quayside.plans import increment as I
from quayside.sources import files


def test_fees_with_empty_amount_and_text_policy(spark):
    fees = [("plain text", "", "a"), ('{"k": 1}', "5", "b"), (None, None, "a")]
    df = spark.createDataFrame([(fees,)], "fees array<struct<policy: string, amount: string, token: string>>")
    row = df.select(P.fee_by_dominant_token(F.col("fees")).alias("d"), P.fee_policies_json(F.col("fees")).alias("p")).first()
    assert (row.d.fee_token, row.d.fee_amount) == ("b", "5")
    assert json.loads(row.p) == [{"policy": {}, "amount": "0", "token": "a"}, {"policy": {"k": 1}, "amount": "5", "token": "b"},
                                 {"policy": {}, "amount": "0", "token": "a"}]


def test_times_of_day_and_unix_seconds(spark):
    texts = ["12:30", "T12:30", "1704067200", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00 UTC", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    new_year = dt.datetime(2024, 1, 1)
    got = [r.v for r in df.select(C.best_effort_timestamp("t").alias("v")).collect()]
    assert got == [None, None, new_year, new_year, new_year, None, None, None]


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_drops_are_listed_under_any_spelling(spark, tmp_path, scheme):
    for name in ("2024-01-01.parquet", "2024-01-02.parquet", "x-2024-01-01-y.parquet"):
        spark.range(1).write.parquet(str(tmp_path / name))
    folder = f"{scheme}{tmp_path}"
    assert files.list_drops(spark, folder).count() == 3
    assert [r.name for r in files.select_files(spark, folder).collect()] == ["2024-01-02.parquet"]
    chosen = files.select_files(spark, folder, "date", "2024-01-01", pattern="x-{{DATE}}-y.parquet").collect()
    assert [r.name for r in chosen] == ["x-2024-01-01-y.parquet"]


def test_plans_are_made_by_project_and_status(spark):
    day = dt.date
    ledger = spark.createDataFrame(
        [("p1", day(2024, 1, 10), "complete"), ("p1", day(2024, 1, 20), "failed"), ("p2", day(2024, 2, 1), "complete")],
        "project_id string, completed_date date, status string")
    plan = I.date_plan(spark, ledger, "2024-02-03", project_id="p1")
    days = sorted(r.day for r in plan.collect())
    assert days[0] == day(2024, 1, 11) and days[-1] == day(2024, 2, 2) and len(days) == 23
    assert I.pending_dates(plan, ledger, project_id="p1").count() == 23
    assert I.pending_dates(plan, ledger, project_id="p2").count() == 22


def test_months_need_the_month_in_the_key(spark, scratch):
    spec = T.TableSpec(path=scratch("m"), key=("k",), version="v", month_of="d", schema="k bigint, v bigint, d date")
    with pytest.raises(ValueError):
        T.read_latest(spark, spec, months=[dt.date(2024, 1, 1)])


def test_header_names():
    assert [FL.clean_name(n) for n in ("﻿ Price (USD) ", "a - b", "été\t2", "_x!")] == ["Price_USD", "a__b", "été_2", "_x"]
