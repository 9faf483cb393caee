"""Stand-ins for table maintenance on ``lineitem`` and ``orders``.

``lineitem`` keyed by (l_orderkey, l_linenumber) is a ready-made duplicate-key
table.  Two loads overlap on the 'N' return flag: load 1 holds flags A and N,
load 2 holds N and R with ``l_linestatus`` rewritten to 'U', so later-load and
version rules are both visible in the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.operators import tables as T
from quayside.registry.base import LINEITEM_COLS, ORDERS_COLS, register, sql_order_desc, src
from quayside.session import scratch_path

KEY = ("l_orderkey", "l_linenumber")


def _loads(spark, sf):
    li = src(spark, sf, "lineitem")
    load1 = li.filter(F.col("l_returnflag") != "R")
    load2 = li.filter(F.col("l_returnflag") != "A").withColumn("l_linestatus", F.lit("U"))
    return load1, load2


_LANDED_SQL = """
WITH landed AS (
  SELECT *, 1 AS load_seq FROM lineitem WHERE l_returnflag <> 'R'
  UNION ALL
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, 'U' AS l_linestatus, l_shipdate, 2 AS load_seq
  FROM lineitem WHERE l_returnflag <> 'A'
)"""

_REST_V = [c for c in LINEITEM_COLS if c not in KEY and c != "l_shipdate"]
_REST = [c for c in LINEITEM_COLS if c not in KEY]
_COLS = ", ".join(LINEITEM_COLS)

_VERSIONED_SQL = f"""{_LANDED_SQL}
SELECT {_COLS} FROM landed
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, load_seq DESC, {sql_order_desc(_REST_V)}) = 1
"""


def _versioned_table(spark, sf):
    spec = T.TableSpec(path=scratch_path(spark, "lineitem_v"), key=KEY, version="l_shipdate", month_of="l_shipdate")
    load1, load2 = _loads(spark, sf)
    T.upsert(load1, spec, seq=1)
    T.upsert(load2, spec, seq=2)
    return spec


@register("replace_versioned", _VERSIONED_SQL)
def replace_versioned(spark, sf):
    """Upsert two loads; per key the greatest ship date wins, equal dates → later load."""
    return T.read_latest(spark, _versioned_table(spark, sf))


@register("compact", _VERSIONED_SQL)
def compact(spark, sf):
    """Physical dedupe of a replacing table; the raw files afterwards equal the merged view."""
    spec = _versioned_table(spark, sf)
    T.compact(spark, spec)
    return T.read_raw(spark, spec).select(*LINEITEM_COLS)


@register(
    "replace_last_loaded",
    f"""{_LANDED_SQL}
SELECT {_COLS} FROM landed
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY load_seq DESC, {sql_order_desc(_REST)}) = 1
""",
)
def replace_last_loaded(spark, sf):
    """Replacing key without a version column: the later load wins."""
    spec = T.TableSpec(path=scratch_path(spark, "lineitem_l"), key=KEY, month_of="l_shipdate")
    load1, load2 = _loads(spark, sf)
    T.upsert(load1, spec, seq=1)
    T.upsert(load2, spec, seq=2)
    return T.read_latest(spark, spec)


@register(
    "read_latest",
    f"""{_LANDED_SQL},
again AS (SELECT * FROM landed UNION ALL SELECT * REPLACE (3 AS load_seq) FROM landed WHERE load_seq = 1)
SELECT {_COLS} FROM again
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY load_seq DESC, {sql_order_desc(_REST)}) = 1
""",
)
def read_latest(spark, sf):
    """Merge-on-read after load 1 is re-delivered last: without versions it wins again."""
    spec = T.TableSpec(path=scratch_path(spark, "lineitem_r"), key=KEY, month_of="l_shipdate")
    load1, load2 = _loads(spark, sf)
    for seq, load in ((1, load1), (2, load2), (3, load1)):
        T.upsert(load, spec, seq=seq)
    return T.read_latest(spark, spec)


@register(
    "replace_null_key",
    f"""{_LANDED_SQL}
SELECT {_COLS} FROM landed
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, nullif(l_returnflag, 'N')
  ORDER BY l_shipdate DESC NULLS LAST, load_seq DESC, {sql_order_desc(_REST_V)}) = 1
""",
)
def replace_null_key(spark, sf):
    """Replacing key with a nullable part: NULL equals NULL inside the key."""
    spec = T.TableSpec(
        path=scratch_path(spark, "lineitem_n"),
        key=(*KEY, "flag_key"),
        version="l_shipdate",
        month_of="l_shipdate",
    )
    load1, load2 = _loads(spark, sf)
    nk = F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag_key")
    T.upsert(load1.select("*", nk), spec, seq=1)
    T.upsert(load2.select("*", nk), spec, seq=2)
    return T.read_latest(spark, spec).select(*LINEITEM_COLS)


@register(
    "skip_unchanged",
    f"""WITH held AS (
  SELECT * FROM lineitem WHERE l_returnflag <> 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, {sql_order_desc(_REST_V)}) = 1
)
SELECT {_COLS} FROM lineitem n WHERE l_returnflag <> 'A'
  AND NOT EXISTS (SELECT 1 FROM held h WHERE {" AND ".join(f"h.{c} IS NOT DISTINCT FROM n.{c}" for c in LINEITEM_COLS)})
""",
)
def skip_unchanged(spark, sf):
    """Rows of a re-observation that differ from the held state; identical rows write nothing."""
    from quayside.operators.joins import changed_rows

    li = src(spark, sf, "lineitem")
    spec = T.TableSpec(path=scratch_path(spark, "lineitem_s"), key=KEY, version="l_shipdate", month_of="l_shipdate")
    T.upsert(li.filter(F.col("l_returnflag") != "R"), spec, seq=1)
    held = T.read_latest(spark, spec)
    fresh = li.filter(F.col("l_returnflag") != "A")
    return changed_rows(fresh, held, list(KEY))


@register(
    "skip_unchanged_write",
    """WITH first AS (SELECT o_orderkey, o_orderstatus, o_totalprice, TIMESTAMP '2024-01-01' AS ingested_at FROM orders WHERE o_orderstatus <> 'P')
SELECT * FROM first
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END, TIMESTAMP '2024-01-02'
FROM orders WHERE o_orderstatus = 'P' OR o_custkey % 10 = 0
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, TIMESTAMP '2024-01-04' FROM orders WHERE o_custkey % 10 = 0""",
)
def skip_unchanged_write(spark, sf):
    """Four observations of a state: the second changes some rows, the third none,
    the fourth changes them back.  Every stored row is returned."""
    o = src(spark, sf, "orders")
    spec = T.TableSpec(path=scratch_path(spark, "orders_seen"), key=("o_orderkey",), version="ingested_at")

    def observe(df, raised, day):
        price = F.col("o_totalprice") + (F.when(F.col("o_custkey") % 10 == 0, 1).otherwise(0) if raised else 0)
        T.upsert_changed(spark, df.select("o_orderkey", "o_orderstatus", price.cast("double").alias("o_totalprice"),
                                          F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz").alias("ingested_at")), spec)

    observe(o.filter("o_orderstatus <> 'P'"), False, 1)
    observe(o, True, 2)
    observe(o, True, 3)
    observe(o, False, 4)
    return T.read_raw(spark, spec).select("o_orderkey", "o_orderstatus", "o_totalprice", "ingested_at")


@register(
    "exact_distinct_per_group",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey""",
)
def exact_distinct_per_group(spark, sf):
    from quayside.operators.metrics import exact_distinct

    return exact_distinct(src(spark, sf, "lineitem"), "l_suppkey", "l_orderkey", "n_orders")


@register("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf):
    from quayside.operators.metrics import row_count as rc

    return rc(src(spark, sf, "lineitem"))


# --------------------------------------------------------------------------- #
# Writes of ``orders``, read back
# --------------------------------------------------------------------------- #

_ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
_O = ", ".join(ORDERS_COLS)


@register("full_replace", f"SELECT {_O} FROM orders")
def full_replace(spark, sf):
    """Table first holds the 'F' orders, then is replaced by the current full state."""
    o = src(spark, sf, "orders")
    spec = T.TableSpec(path=scratch_path(spark, "orders_fr"), schema=_ORDERS_DDL)
    T.full_replace(spark, o.filter(F.col("o_orderstatus") == "F"), spec)
    T.full_replace(spark, o, spec)
    return T.read_raw(spark, spec).select(*ORDERS_COLS)


@register(
    "append_rows",
    f"SELECT {_O} FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT {_O} FROM orders",
)
def append_rows(spark, sf):
    """Plain table: re-running a load duplicates rows."""
    o = src(spark, sf, "orders")
    spec = T.TableSpec(path=scratch_path(spark, "orders_ap"), schema=_ORDERS_DDL)
    T.append(o.filter(F.col("o_orderstatus") == "F"), spec)
    T.append(o, spec)
    return T.read_raw(spark, spec).select(*ORDERS_COLS)


@register("create_if_absent", f"SELECT {_O} FROM orders")
def create_if_absent(spark, sf):
    """``CREATE TABLE IF NOT EXISTS`` twice, insert, read the catalog table back."""
    spec = T.TableSpec(path=scratch_path(spark, "orders_ct"), schema=_ORDERS_DDL)
    name = T.create_if_absent(spark, spec)
    T.create_if_absent(spark, spec, name)  # second call is a no-op
    src(spark, sf, "orders").select(*ORDERS_COLS).write.insertInto(name)
    return spark.table(name).select(*ORDERS_COLS)


@register(
    "default_columns",
    f"SELECT {_O}, '' AS source, 'complete' AS status, 0 AS retries FROM orders",
)
def default_columns(spark, sf):
    """A load that omits columns gets the table defaults."""
    spec = T.TableSpec(
        path=scratch_path(spark, "orders_df"),
        defaults={"source": "''", "status": "'complete'", "retries": "0"},
    )
    T.append(src(spark, sf, "orders"), spec)
    return T.read_raw(spark, spec).select(*ORDERS_COLS, "source", "status", "retries")


@register(
    "rows_inserted",
    """SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS rows_before,
          (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') + (SELECT count(*) FROM orders) AS rows_after,
          (SELECT count(*) FROM orders) AS rows_inserted""",
)
def rows_inserted(spark, sf):
    """Before/after counts around a load; the written count comes from the write itself."""
    from quayside.plans.ledger import load_report

    o = src(spark, sf, "orders")
    spec = T.TableSpec(path=scratch_path(spark, "orders_ri"), schema=_ORDERS_DDL)
    T.append(o.filter(F.col("o_orderstatus") == "F"), spec)
    return load_report(spark, spec, lambda: T.append(o, spec))


@register(
    "month_layout",
    f"SELECT {_O}, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_part FROM orders",
)
def month_layout(spark, sf):
    """Partition by month of the order date; the partition column reads back as a date."""
    spec = T.TableSpec(path=scratch_path(spark, "orders_ml"), month_of="o_orderdate")
    T.append(src(spark, sf, "orders"), spec)
    return T.read_raw(spark, spec).select(*ORDERS_COLS, T.MONTH)


@register("sort_layout", f"SELECT {_O} FROM orders")
def sort_layout(spark, sf):
    """Files sorted by key inside each month partition (Parquet min/max skipping)."""
    spec = T.TableSpec(path=scratch_path(spark, "orders_sl"), month_of="o_orderdate", sort_by=("o_custkey", "o_orderkey"))
    T.append(src(spark, sf, "orders"), spec)
    return T.read_raw(spark, spec).select(*ORDERS_COLS)


@register(
    "bounded_write",
    """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_part, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT *, CAST((dense_rank() OVER (ORDER BY month_part) - 1) // 24 AS BIGINT) AS batch_no FROM m)
SELECT batch_no, count(*) AS n_months, CAST(sum(n) AS BIGINT) AS n_rows, min(month_part) AS first_month,
       max(month_part) AS last_month, CAST(sum((n + 999) // 1000) AS BIGINT) AS min_files
FROM r GROUP BY batch_no""",
)
def bounded_write(spark, sf):
    """Write with ≤ 1,000 rows per file, in commits of ≤ 24 months each; the plan."""
    from quayside.plans.ledger import bounded_write as bw

    spec = T.TableSpec(path=scratch_path(spark, "orders_bw"), month_of="o_orderdate", max_records_per_file=1000)
    plan = bw(spark, src(spark, sf, "orders"), spec, max_months=24)
    return plan.filter("state = 'committed'").drop("state")


@register("bounded_write_rows", "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders")
def bounded_write_rows(spark, sf):
    """What bounded commits leave in the table, after a second call with the same load id."""
    from quayside.plans.ledger import bounded_write as bw

    spec = T.TableSpec(path=scratch_path(spark, "orders_bw"), month_of="o_orderdate")
    for _ in range(2):
        bw(spark, src(spark, sf, "orders"), spec, max_months=24, load_id="once")
    return T.read_latest(spark, spec).select(*ORDERS_COLS)
