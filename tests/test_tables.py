"""Replacing-table laws and prune edge cases on small literal fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.operators import tables as T

DDL = "k STRING, v BIGINT, ver BIGINT, d DATE, note STRING"


def _df(spark, rows):
    return spark.createDataFrame(rows, DDL)


def _latest(spark, spec):
    return sorted(tuple(r) for r in T.read_latest(spark, spec).collect())


def test_upsert_rules(spark, scratch):
    spec = T.TableSpec(path=scratch("up"), key=("k",), version="ver", month_of="d", schema=DDL)
    d1, d2 = dt.date(2024, 1, 31), dt.date(2024, 2, 1)
    # same key twice in one load; older version arriving later; equal versions; key spanning two months
    T.upsert(_df(spark, [("a", 1, 5, d1, "x"), ("a", 2, 7, d1, "y"), ("b", 1, 3, d1, "p"), ("c", 1, 1, d1, "m")]), spec, seq=1)
    T.upsert(_df(spark, [("a", 9, 6, d2, "old"), ("b", 2, 3, d2, "q"), ("c", 5, 2, d2, "moved")]), spec, seq=2)
    assert _latest(spark, spec) == [
        ("a", 2, 7, d1, "y"),      # greater version wins even though loaded earlier
        ("b", 2, 3, d2, "q"),      # equal version → later load
        ("c", 5, 2, d2, "moved"),  # newer row lives in another month partition
    ]


def test_null_key_parts_are_equal(spark, scratch):
    spec = T.TableSpec(path=scratch("nk"), key=("k", "note"), schema=DDL)
    T.upsert(_df(spark, [("a", 1, 1, None, None)]), spec, seq=1)
    T.upsert(_df(spark, [("a", 2, 1, None, None)]), spec, seq=2)
    assert _latest(spark, spec) == [("a", 2, 1, None, None)]


def test_upsert_is_idempotent_and_order_free(spark, scratch):
    rows1 = [("a", 1, 1, None, "x"), ("b", 1, 4, None, "y")]
    rows2 = [("a", 2, 2, None, "x2"), ("b", 2, 3, None, "y2")]
    one = T.TableSpec(path=scratch("o1"), key=("k",), version="ver", schema=DDL)
    two = T.TableSpec(path=scratch("o2"), key=("k",), version="ver", schema=DDL)
    T.upsert(_df(spark, rows1), one, seq=1)
    T.upsert(_df(spark, rows2), one, seq=2)
    T.upsert(_df(spark, rows2), one, seq=3)  # re-run of the same load
    T.upsert(_df(spark, rows2), two, seq=1)
    T.upsert(_df(spark, rows1), two, seq=2)
    assert _latest(spark, one) == _latest(spark, two) == [("a", 2, 2, None, "x2"), ("b", 1, 4, None, "y")]


def test_compact_preserves_latest_view(spark, scratch):
    spec = T.TableSpec(path=scratch("c"), key=("k",), version="ver", month_of="d", schema=DDL)
    d = dt.date(2024, 3, 3)
    T.upsert(_df(spark, [("a", 1, 1, d, "x"), ("a", 2, 2, d, "y")]), spec, seq=1)
    before = _latest(spark, spec)
    T.compact(spark, spec)
    assert T.read_raw(spark, spec).count() == 1
    assert _latest(spark, spec) == before


def test_plain_compact_keeps_duplicates(spark, scratch):
    spec = T.TableSpec(path=scratch("p"), schema=DDL)
    rows = [("a", 1, 1, None, "x")]
    T.append(_df(spark, rows), spec)
    T.append(_df(spark, rows), spec)
    T.compact(spark, spec)
    assert T.read_raw(spark, spec).count() == 2


def test_full_replace_swaps_whole_table(spark, scratch):
    spec = T.TableSpec(path=scratch("fr"), schema=DDL)
    T.full_replace(spark, _df(spark, [("a", 1, 1, None, "x"), ("b", 1, 1, None, "x")]), spec)
    T.full_replace(spark, _df(spark, [("c", 1, 1, None, "x")]), spec)
    assert [r.k for r in T.read_raw(spark, spec).collect()] == ["c"]


PDDL = "asset STRING, block_date DATE, price DOUBLE, ingested_at TIMESTAMP_NTZ"


def _prices(spark, rows):
    return spark.createDataFrame(rows, PDDL)


def test_prune_day(spark, scratch):
    spec = T.TableSpec(path=scratch("pd"), month_of="block_date", schema=PDDL)
    d, other = dt.date(2024, 5, 2), dt.date(2024, 5, 1)
    t1, t2 = dt.datetime(2024, 5, 3), dt.datetime(2024, 5, 4)
    T.append(_prices(spark, [("0xa", d, 1.0, t1), ("0xb", d, 2.0, t1), ("0xa", other, 3.0, t1)]), spec)
    T.prune_day(spark, spec, _prices(spark, [("0xa", d, 10.0, t2)]), "block_date", d, "ingested_at")
    got = sorted((r.asset, r.block_date, r.price) for r in T.read_raw(spark, spec).collect())
    # the asset whose fetch failed (0xb) loses its row for that day: the day is replaced wholesale
    assert got == [("0xa", other, 3.0), ("0xa", d, 10.0)]
    # zero new rows → no prune
    assert T.prune_day(spark, spec, _prices(spark, []), "block_date", d, "ingested_at") == 0


def test_prune_series_rules(spark, scratch):
    spec = T.TableSpec(path=scratch("ps"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    old = [
        ("0xa", dt.date(2023, 11, 5), 1.0, t1),   # pruned (≤ bound, older)
        ("0xa", dt.date(2024, 1, 20), 2.0, t1),   # later than the bound → survives
        ("0xb", dt.date(2023, 11, 5), 3.0, t1),   # asset did not return data → survives
        ("BAD", dt.date(2023, 11, 5), 4.0, t1),   # malformed id → never pruned
    ]
    T.append(_prices(spark, old), spec)
    new = _prices(spark, [("0xa", dt.date(2023, 12, 1), 9.0, t2), ("BAD", dt.date(2023, 12, 1), 8.0, t2)])
    valid = F.col("asset").rlike(r"^0x[0-9a-f]+$")
    T.prune_series(spark, spec, new, "asset", "block_date", "ingested_at", valid=valid)
    got = sorted((r.asset, str(r.block_date), r.price) for r in T.read_raw(spark, spec).collect())
    assert got == [
        ("0xa", "2023-12-01", 9.0), ("0xa", "2024-01-20", 2.0), ("0xb", "2023-11-05", 3.0),
        ("BAD", "2023-11-05", 4.0), ("BAD", "2023-12-01", 8.0),
    ]


def test_prune_series_drops_emptied_partition(spark, scratch):
    spec = T.TableSpec(path=scratch("pe"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    T.append(_prices(spark, [("0xa", dt.date(2023, 10, 5), 1.0, t1)]), spec)
    T.prune_series(spark, spec, _prices(spark, [("0xa", dt.date(2023, 12, 1), 2.0, t2)]), "asset", "block_date", "ingested_at")
    assert [(r.asset, str(r.block_date)) for r in T.read_raw(spark, spec).collect()] == [("0xa", "2023-12-01")]
    assert not T.path_exists(spark, f"{spec.path}/{T.MONTH}=2023-10-01")


def test_prune_per_asset_keeps_later_rows(spark, scratch):
    spec = T.TableSpec(path=scratch("pp"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    T.append(_prices(spark, [("0xa", dt.date(2023, 11, 1), 1.0, t1), ("0xb", dt.date(2023, 11, 1), 1.0, t1)]), spec)
    new = _prices(spark, [("0xa", dt.date(2023, 10, 1), 5.0, t2), ("0xb", dt.date(2023, 12, 1), 6.0, t2)])
    T.prune_series(spark, spec, new, "asset", "block_date", "ingested_at", per_asset=True)
    got = sorted((r.asset, str(r.block_date)) for r in T.read_raw(spark, spec).collect())
    assert got == [("0xa", "2023-10-01"), ("0xa", "2023-11-01"), ("0xb", "2023-12-01")]


def test_month_predicate_prunes_partitions(spark, scratch):
    spec = T.TableSpec(path=scratch("mp"), month_of="block_date", schema=PDDL)
    t = dt.datetime(2024, 1, 1)
    T.append(_prices(spark, [("0xa", dt.date(2023, m, 1), 1.0, t) for m in range(1, 13)]), spec)
    df = T.read_between(spark, spec, "2023-03-01", "2023-05-01")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and T.MONTH in plan


def test_empty_loads(spark, scratch):
    spec = T.TableSpec(path=scratch("em"), key=("k",), month_of="d", schema=DDL)
    assert T.append(_df(spark, []), spec) == 0          # no metrics from an empty write: counted fallback
    assert T.append(_df(spark, [("a", 1, 1, None, "x")]), spec) == 1  # NULL month partition
    assert _latest(spark, spec) == [("a", 1, 1, None, "x")]
    plain = T.TableSpec(path=scratch("emp"), schema=DDL)
    assert T.full_replace(spark, _df(spark, []), plain) == 0
    assert T.read_raw(spark, plain).count() == 0


def test_prune_series_inserts_even_when_nothing_prunable(spark, scratch):
    spec = T.TableSpec(path=scratch("pn"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    T.append(_prices(spark, [("BAD", dt.date(2023, 11, 5), 1.0, t1)]), spec)
    valid = F.col("asset").rlike(r"^0x[0-9a-f]+$")
    T.prune_series(spark, spec, _prices(spark, [("BAD", dt.date(2023, 12, 1), 2.0, t2)]), "asset", "block_date",
                   "ingested_at", valid=valid)
    assert sorted(str(r.block_date) for r in T.read_raw(spark, spec).collect()) == ["2023-11-05", "2023-12-01"]


def _rows(spark, spec):
    return sorted(tuple(r) for r in T.read_raw(spark, spec).select("asset", "price").collect())


@pytest.mark.parametrize("step", ["_writer", "drop_files", "_delete_files"])
def test_a_failed_rewrite_loses_nothing(spark, scratch, monkeypatch, step):
    spec = T.TableSpec(path=scratch("fail"), month_of="block_date", schema=PDDL)
    t = dt.datetime(2024, 1, 1)
    T.append(_prices(spark, [("0xa", dt.date(2023, 11, 1), 1.0, t), ("0xb", dt.date(2023, 12, 1), 2.0, t), ("0xc", None, 3.0, t)]), spec)
    before = _rows(spark, spec)

    def fail(*_, **__):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(T, step, fail)
        with pytest.raises(RuntimeError):
            T.compact(spark, spec)
    assert set(_rows(spark, spec)) == set(before)  # perhaps twice, never a gap
    T.finish_rewrites(spark, spec)
    if step != "drop_files":  # the one moment of which no note is left
        assert _rows(spark, spec) == before


@pytest.mark.parametrize("step", ["_move_in", "_delete_files"])
@pytest.mark.parametrize("keyed", [False, True])
def test_a_noted_rewrite_is_settled_by_the_next_call(spark, scratch, monkeypatch, step, keyed):
    spec = T.TableSpec(path=scratch("noted"), key=("asset",) if keyed else (), month_of="block_date", schema=PDDL)
    t, d = dt.datetime(2024, 1, 1), dt.date(2023, 11, 1)
    for price in (1.0, 2.0):
        T.append(_prices(spark, [("0xa", d, price, t), (f"0x{price}", None, price, t)]), spec)
    want = [("0x1.0", 1.0), ("0x2.0", 2.0), ("0xa", 2.0)] if keyed else _rows(spark, spec)

    def fail(*_, **__):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(T, step, fail)
        with pytest.raises(RuntimeError):
            T.compact(spark, spec)
    T.compact(spark, spec)
    assert _rows(spark, spec) == want
    assert not T.path_exists(spark, f"{spec.path}/{T.NOTES}")
    assert T.full_replace(spark, _prices(spark, [("0xz", d, 9.0, t)]), spec) == 1 and _rows(spark, spec) == [("0xz", 9.0)]
    assert T.full_replace(spark, _prices(spark, []), spec) == 0 and _rows(spark, spec) == []


def test_a_load_during_a_rewrite_stays(spark, scratch, monkeypatch):
    spec = T.TableSpec(path=scratch("during"), key=("asset",), month_of="block_date", schema=PDDL)
    t, d = dt.datetime(2024, 1, 1), dt.date(2023, 11, 1)
    T.append(_prices(spark, [("0xa", d, 1.0, t)]), spec)
    drop = T.drop_files

    def drop_late(*args):
        T.append(_prices(spark, [("0xb", d, 2.0, t)]), spec)
        drop(*args)

    monkeypatch.setattr(T, "drop_files", drop_late)
    T.compact(spark, spec)
    assert _rows(spark, spec) == [("0xa", 1.0), ("0xb", 2.0)]


def test_prune_evaluates_the_load_once_and_takes_null_dates(spark, scratch):
    spec = T.TableSpec(path=scratch("once"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    T.append(_prices(spark, [("0xa", dt.date(2023, 11, 1), 1.0, t1), ("0xa", None, 2.0, t1)]), spec)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    new = _prices(spark, [("0xa", dt.date(2023, 12, 1), 9.0, t2), ("0xa", None, 8.0, t2)])
    new = new.mapInArrow(counted, new.schema)
    T.prune_series(spark, spec, new, "asset", "block_date", "ingested_at")
    assert seen.value == 2
    assert _rows(spark, spec) == [("0xa", 2.0), ("0xa", 8.0), ("0xa", 9.0)]


def test_prune_days_replaces_only_the_days_returned(spark, scratch):
    spec = T.TableSpec(path=scratch("days"), month_of="block_date", schema=PDDL)
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    a, b, c = dt.date(2023, 11, 1), dt.date(2023, 11, 2), dt.date(2023, 12, 1)
    T.append(_prices(spark, [("0xa", a, 1.0, t1), ("0xa", b, 2.0, t1), ("0xb", c, 3.0, t1), ("0xb", None, 4.0, t1)]), spec)
    assert T.prune_days(spark, spec, _prices(spark, [("0xa", a, 9.0, t2), ("0xc", c, 8.0, t2)]), "block_date", "ingested_at") == 2
    assert _rows(spark, spec) == [("0xa", 2.0), ("0xa", 9.0), ("0xb", 4.0), ("0xc", 8.0)]
    assert T.prune_days(spark, spec, _prices(spark, []), "block_date", "ingested_at") == 0


@pytest.mark.parametrize("hot", [False, True])
def test_compact_of_many_ranges_shuffles_once(spark, scratch, monkeypatch, hot):
    """Rows of a key lie in two months; a frequent key takes the map-side dedupe."""
    monkeypatch.setattr(T, "RANGE_BYTES", 1 << 10)
    spec = T.TableSpec(path=scratch(), key=("at", "id"), month_of="day")
    rows = spark.range(3000).select(
        F.when((F.col("id") % 3 == 0) & F.lit(hot), F.lit(1)).otherwise(F.col("id") % 2000).alias("id"),
        F.expr("CAST('2024-01-31' AS TIMESTAMP_NTZ)").alias("at"), F.expr("date_add(DATE'2024-01-31', CAST(id % 2 AS INT))").alias("day"), F.col("id").alias("v"))
    T.upsert(rows, spec, seq=1)
    T.upsert(rows.filter("v < 100").withColumn("v", F.col("v") + 10_000), spec, seq=2)
    raw = T.read_raw(spark, spec)
    ranges = T._month_ranges(spark, spec, raw)
    assert (ranges is None) == hot
    if not hot:
        plan = T.latest(ranges, [T._RANGE, T._HASH, *spec.key], spec.order)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1
    want = sorted(map(tuple, T.read_latest(spark, spec).collect()), key=str)
    T.compact(spark, spec)
    held = T.read_raw(spark, spec)
    assert sorted(map(tuple, held.select(*T.business_columns(held)).collect()), key=str) == want
    assert {c for c in held.columns} == {"id", "at", "day", "v", T.SEQ, T.MONTH}
