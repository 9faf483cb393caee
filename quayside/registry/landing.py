"""Stand-ins for landing readers and row-level conform steps.

Each query first lands driver-table data in the format under test (CSV with a
drifting header, whole JSON documents, NDJSON with junk lines, dated Parquet
drops) in a fresh folder under the shared root, then reads it back with the
library reader.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import filters as FL
from quayside.plans.sqlfiles import run_statements
from quayside.registry.base import ORDERS_COLS, register, src
from quayside.session import scratch_path, table_path
from quayside.sources import files as FS
from quayside.sources import readers as R

_O = ", ".join(ORDERS_COLS)
ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def _csv_writer(df, rebalance=True):
    return (
        (df.hint("rebalance") if rebalance else df).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("escape", '"')
    )


@register("csv_named", f"SELECT {_O} FROM orders")
def csv_named(spark, sf):
    """Headed CSV with a declared structure."""
    path = scratch_path(spark, "csv_named")
    _csv_writer(src(spark, sf, "orders")).csv(path)
    return R.read_csv(spark, path, ORDERS_DDL)


@register(
    "csv_inferred",
    "SELECT n_nationkey AS nation_key, n_name AS name, n_regionkey AS region_pct FROM nation",
)
def csv_inferred(spark, sf):
    """CSV without a declared structure; header names with spaces and '%'."""
    path = scratch_path(spark, "csv_inferred")
    n = src(spark, sf, "nation").toDF("Nation Key", "Name", "Region %")
    _csv_writer(n).csv(path)
    df = R.read_csv(spark, path)
    return df.select(
        F.col("`Nation Key`").alias("nation_key"), F.col("Name").alias("name"), F.col("`Region %`").alias("region_pct")
    )


# --------------------------------------------------------------------------- #
# Drifting-header CSV → target table
# --------------------------------------------------------------------------- #

TARGET = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_since", T.TimestampNTZType()),
])


def _since_text():
    base = F.lit("2020-01-01 00:00:00").cast("timestamp") + F.make_interval(
        days=F.col("c_custkey").cast("int"), mins=F.col("c_custkey").cast("int")
    )
    k = F.col("c_nationkey")
    return (
        F.when(k < 5, F.date_format(base, "dd/MM/yyyy"))
        .when(k < 10, F.date_format(base, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k < 15, F.date_format(base, "yyyy-MM-dd HH:mm:ss"))
        .when(k < 20, F.date_format(base, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.lit("not a date"))
    )


def _drifting(spark, sf):
    """Customers as all-text cells under a drifting header (BOM, spaces, case, symbols)."""
    c = src(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("﻿ C_CUSTKEY "),
        F.col("c_name").alias("C Name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("C_ACCTBAL$"),
        _since_text().alias("C  Since"),
        F.col("c_mktsegment").alias("Notes %"),
    )


_SINCE_SQL = """CASE WHEN c_nationkey < 5 THEN date_trunc('day', TIMESTAMP '2020-01-01' + to_days(c_custkey) + to_minutes(c_custkey))
            WHEN c_nationkey < 20 THEN TIMESTAMP '2020-01-01' + to_days(c_custkey) + to_minutes(c_custkey) END"""
_CONFORMED_SQL = f"""SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS c_acctbal,
       {_SINCE_SQL} AS c_since FROM customer"""


def _conform_file(spark, sf, max_rows=None):
    path = scratch_path(spark, "csv_conform")
    _csv_writer(_drifting(spark, sf)).csv(path)
    return R.conform_csv(spark, path, TARGET, max_rows=max_rows, order="c_custkey")


@register("csv_conform", _CONFORMED_SQL)
def csv_conform(spark, sf):
    """Clean header → case-insensitive match (no exact match exists) → typed cast."""
    return _conform_file(spark, sf)


# Headers of the folder's files, by customer key modulo 4: in order and with quoted
# line ends; in another order; cleaned names in another case, a column missing;
# two names that differ in case only.
_FOLDER_HEADERS = ["c_custkey,c_name,c_acctbal", "c_acctbal,c_custkey,c_name", "C CUSTKEY,Notes,C_NAME$", "C_CUSTKEY,c_custkey,c_name"]


def _folder_of_csv(spark, sf):
    """Customers in CSV files of 200 ids under four headers."""
    key, name, balance = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_acctbal").cast("string")
    lines = [F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit('\nx"')), balance), F.concat_ws(",", balance, key, name),
             F.concat_ws(",", key, F.lit("note"), name), F.concat_ws(",", F.lit("-1"), key, name)]
    kind = (F.col("c_custkey") % 4).cast("int")
    rows = src(spark, sf, "customer").select(
        kind.alias("kind"), F.floor(F.col("c_custkey") / 200).alias("part"), "c_custkey", F.get(F.array(*lines), kind).alias("line"),
        F.get(F.array(*[F.lit(h) for h in _FOLDER_HEADERS]), kind).alias("header"))
    whole = rows.groupBy("kind", "part", "header").agg(F.sort_array(F.collect_list(F.struct("c_custkey", "line"))).alias("l"))
    path = scratch_path(spark, "csv_folder")
    whole.select("kind", "part", F.concat_ws("\n", F.col("header"), F.col("l.line")).alias("value")).write.partitionBy("kind", "part").text(path)
    return path


@register(
    "csv_folder",
    """SELECT CASE WHEN c_custkey % 4 = 2 THEN NULL ELSE c_custkey END AS c_custkey,
       c_name || CASE WHEN c_custkey % 4 = 0 THEN chr(10) || 'x' ELSE '' END AS c_name,
       CASE WHEN c_custkey % 4 < 2 THEN c_acctbal END AS c_acctbal
FROM customer WHERE c_custkey % 4 <> 2
UNION ALL SELECT c_custkey, c_name, NULL FROM customer WHERE c_custkey % 4 = 2""",
)
def csv_folder(spark, sf):
    """A folder of CSV files with drifting headers, one scan per header, united by name."""
    return R.conform_csv(spark, _folder_of_csv(spark, sf), T.StructType(TARGET.fields[:3]))


@register("csv_files", """SELECT header, multi_line, count(*) AS n_files FROM (
  SELECT DISTINCT c_custkey // 200 AS part, CASE c_custkey % 4 WHEN 0 THEN 'c_custkey,c_name,c_acctbal' WHEN 1 THEN 'c_acctbal,c_custkey,c_name'
    WHEN 2 THEN 'C CUSTKEY,Notes,C_NAME$' ELSE 'C_CUSTKEY,c_custkey,c_name' END AS header, c_custkey % 4 = 0 AS multi_line FROM customer)
GROUP BY ALL""")
def csv_files(spark, sf):
    """The header line of every file, and which files a reader cannot split."""
    return R.csv_files(spark, _folder_of_csv(spark, sf)).groupBy("header", "multi_line").agg(F.count(F.lit(1)).alias("n_files"))


@register("cap_rows", _CONFORMED_SQL + " ORDER BY c_custkey LIMIT 1000")
def cap_rows(spark, sf):
    """Only the first N rows (explicit order) are kept."""
    return _conform_file(spark, sf, max_rows=1000)


@register(
    "match_columns",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal FROM customer",
)
def match_columns(spark, sf):
    """Exact names first; only when none match, case-insensitive; the rest dropped."""
    raw = FL.clean_header(_drifting(spark, sf)).drop("C_Since")
    return FL.match_columns(raw, TARGET)


@register("cast_to_target", _CONFORMED_SQL)
def cast_to_target(spark, sf):
    """Text cells cast by target type: multi-layout datetimes, failures and blanks → NULL."""
    matched = FL.match_columns(FL.clean_header(_drifting(spark, sf)), TARGET)
    return FL.cast_to_target(matched, TARGET)


_RAW_HEADER = "'﻿' || ' ' || lower(c_mktsegment) || '  ' || c_name || ' %' || chr(9)"


@register(
    "clean_header",
    f"""SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(replace({_RAW_HEADER}, '﻿', ''),
         '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g'), '[^\\p{{L}}\\p{{N}}_]', '', 'g') AS clean_name FROM customer""",
)
def clean_header(spark, sf):
    """Header cleaning as a column job: BOM, trim, whitespace → '_', non-word dropped."""
    c = src(spark, sf, "customer")
    raw = F.concat(F.lit("﻿ "), F.lower("c_mktsegment"), F.lit("  "), F.col("c_name"), F.lit(" %\t"))
    return c.select("c_custkey", FL.clean_name_column(raw).alias("clean_name"))


# --------------------------------------------------------------------------- #
# Sentinels, addresses, keys
# --------------------------------------------------------------------------- #


@register(
    "sentinel_to_null",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN NULL
       ELSE lower(c_name) END AS owner FROM customer""",
)
def sentinel_to_null(spark, sf):
    """'' and '<nil>' mean unknown owner → NULL; other values lowercased."""
    c = src(spark, sf, "customer")
    owner = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "<nil>").otherwise(F.col("c_name"))
    return FL.sentinels_to_null(c.select("c_custkey", owner.alias("owner")), "owner")


@register(
    "normalise_addresses",
    "SELECT s_suppkey, lower('0xAB' || CAST(s_suppkey AS VARCHAR)) AS sender, lower(s_name) AS receiver, s_name AS label FROM supplier",
)
def normalise_addresses(spark, sf):
    """Address columns lowercased; other columns untouched."""
    s = src(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("0xAB"), F.col("s_suppkey").cast("string")).alias("sender"),
        F.col("s_name").alias("receiver"), F.col("s_name").alias("label"),
    )
    return FL.normalise_addresses(s, ["sender", "receiver"])


@register(
    "nonempty_key_filter",
    "SELECT c_custkey, c_name AS profile_id FROM customer WHERE c_acctbal >= 0",
)
def nonempty_key_filter(spark, sf):
    """Rows without their key (NULL or '') are dropped."""
    c = src(spark, sf, "customer")
    key = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.col("c_name"))
    return FL.nonempty_key_filter(c.select("c_custkey", key.alias("profile_id")), "profile_id")


# --------------------------------------------------------------------------- #
# Whole JSON documents
# --------------------------------------------------------------------------- #


@register(
    "json_document",
    """SELECT lower('0xAB' || CAST(s_suppkey AS VARCHAR)) AS address,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE 'sybil-' || CAST(s_nationkey AS VARCHAR) END AS reason FROM supplier""",
)
def json_document(spark, sf):
    """``{addresses:[{address,reason}]}`` documents → one row per address; blank addresses dropped."""
    s = src(spark, sf, "supplier")
    item = F.struct(
        F.concat(F.lit("0xAB"), F.col("s_suppkey").cast("string")).alias("address"),
        F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("sybil-"), F.col("s_nationkey").cast("string"))).alias("reason"),
    )
    blank = F.struct(F.lit("").alias("address"), F.lit("blank").alias("reason"))
    docs = s.groupBy(F.floor(F.col("s_suppkey") / 50).alias("doc")).agg(F.collect_list(item).alias("items"))
    body = F.to_json(F.struct(F.array_append("items", blank).alias("addresses")))
    path = scratch_path(spark, "json_docs")
    docs.select("doc", body.alias("value")).write.partitionBy("doc").text(path)
    return R.read_json_array(spark, path)


# --------------------------------------------------------------------------- #
# NDJSON events with junk lines
# --------------------------------------------------------------------------- #


def _ndjson(spark, sf):
    ev = src(spark, sf, "events")
    purchase = F.col("event_type") == "purchase"
    no_time = purchase & (F.col("value") < 5)
    text_time = purchase & (F.col("value") >= 5) & (F.col("value") < 10)
    fields = [
        F.col("user_id").alias("distinct_id"), F.col("event_id").cast("string").alias("$insert_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ]
    base_props = F.struct(*fields)

    def line_with(*time):
        return F.to_json(F.struct(F.col("event_type").alias("event"), F.struct(*fields, *time).alias("properties")))

    with_time = (
        F.when(no_time, line_with())
        .when(text_time, line_with(F.lit("soon").alias("time")))
        .otherwise(line_with(F.unix_seconds(F.col("ts").cast("timestamp")).alias("time")))
    )
    low = F.col("value") < 5
    line = (
        F.when((F.col("event_type") == "error") & low, F.substring(with_time, 1, 20))
        .when((F.col("event_type") == "view") & low, F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]")))
        .when((F.col("event_type") == "click") & low, F.to_json(base_props))
        .when((F.col("event_type") == "signup") & low, F.lit("   "))
        .otherwise(with_time)
    )
    path = scratch_path(spark, "ndjson")
    ev.select(line.alias("value")).hint("rebalance").write.text(path)
    return path


_NDJSON_OK = """FROM events WHERE NOT (value < 5 AND event_type IN ('error', 'view', 'click', 'signup'))"""


@register("ndjson_lenient", "SELECT event_type AS event_name, CAST(event_id AS VARCHAR) AS insert_id " + _NDJSON_OK)
def ndjson_lenient(spark, sf):
    """Blank lines skipped; malformed lines, arrays and objects without ``event`` rejected."""
    ok, _rejects = R.read_events(spark, _ndjson(spark, sf))
    return ok.select(F.get_json_object("line", "$.event").alias("event_name"), F.get_json_object("line", "$.properties.$insert_id").alias("insert_id"))


@register(
    "events_rows",
    """SELECT event_type AS event_name, CAST(user_id AS VARCHAR) AS distinct_id,
       CASE WHEN event_type = 'purchase' AND value < 5 THEN TIMESTAMP '1970-01-01' ELSE date_trunc('second', ts) END AS event_time,
       CAST(event_id AS VARCHAR) AS insert_id, 'p1' AS project_id, json_extract_string(props, '$.k') AS prop_k
"""
    + _NDJSON_OK
    + " AND NOT (event_type = 'purchase' AND value >= 5 AND value < 10)",
)
def events_rows(spark, sf):
    """Event lines → typed rows: missing time → epoch, non-numeric time rejected."""
    ok, _ = R.read_events(spark, _ndjson(spark, sf))
    rows, _bad_time = R.events_rows(ok, "p1")
    return rows.select(
        "event_name", "distinct_id", "event_time", "insert_id", "project_id",
        F.get_json_object("properties", "$.k").alias("prop_k"),
    )


# --------------------------------------------------------------------------- #
# Dated Parquet drops
# --------------------------------------------------------------------------- #


def _drops(spark, sf):
    """Monthly drops ``YYYY-MM-01.parquet`` of orders, plus an undated Parquet drop
    (the 'P' orders) and a non-Parquet object."""
    from quayside.operators.tables import _fs

    folder = scratch_path(spark, "drops")
    staging = folder + "-staging"
    o = src(spark, sf, "orders")
    o.withColumn("drop", F.date_format(F.trunc(F.to_date("o_orderdate"), "MM"), "yyyy-MM-dd")).hint(
        "rebalance", "drop"
    ).write.partitionBy("drop").parquet(staging)
    fs, root = _fs(spark, staging)
    fs.mkdirs(_fs(spark, folder)[1])
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("drop=") and not fs.rename(st.getPath(), _fs(spark, f"{folder}/{name[5:]}.parquet")[1]):
            raise OSError(f"could not move {name}")
    o.filter(F.col("o_orderstatus") == "P").write.parquet(f"{folder}/undated.parquet")
    spark.createDataFrame([("not data",)], "value STRING").write.text(f"{folder}/notes.txt")
    fs.delete(root, True)
    return folder


@register(
    "files_latest",
    f"SELECT {_O} FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)",
)
def files_latest(spark, sf):
    """Only the newest dated drop is loaded."""
    return FS.read_selected(spark, _drops(spark, sf), "latest").select(*ORDERS_COLS)


@register("files_for_date", f"SELECT {_O} FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '1998-08-01'")
def files_for_date(spark, sf):
    """The drop named for one date."""
    return FS.read_selected(spark, _drops(spark, sf), "date", "1998-08-01").select(*ORDERS_COLS)


@register("files_all", f"SELECT {_O} FROM orders UNION ALL SELECT {_O} FROM orders WHERE o_orderstatus = 'P'")
def files_all(spark, sf):
    """Every Parquet drop under the prefix (dated or not); non-Parquet objects skipped."""
    return FS.read_selected(spark, _drops(spark, sf), "all").select(*ORDERS_COLS)


@register(
    "parquet_files",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total,
       o_orderdate AS ordered_at, o_orderpriority AS priority
FROM orders WHERE date_trunc('month', o_orderdate) IN (TIMESTAMP '1996-01-01', TIMESTAMP '1996-02-01')""",
)
def parquet_files(spark, sf):
    """A chosen list of drops loaded with columns matched by position."""
    folder = _drops(spark, sf)
    paths = [f"{folder}/1996-01-01.parquet", f"{folder}/1996-02-01.parquet"]
    return R.load_parquet(spark, paths, ["order_id", "customer_id", "status", "total", "ordered_at", "priority"])


@register(
    "warehouse_scan",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'",
)
def warehouse_scan(spark, sf):
    """Catalog table read with a projection and a pushed-down filter."""
    import uuid

    name = "orders_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{table_path(sf, 'orders')}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and the frame holds their list
    return table.select("o_orderkey", "o_custkey", "o_orderdate").filter(
        F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    )


@register(
    "sql_files",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority",
)
def sql_files(spark, sf):
    """Ordered single statements with ``{{VAR}}`` templates and bound parameters."""
    import uuid

    statements = [
        "CREATE OR REPLACE TEMPORARY VIEW {{VIEW}} AS SELECT * FROM parquet.`{{ORDERS}}`",
        "SELECT o_orderpriority, count(*) AS n FROM IDENTIFIER(:view) WHERE o_totalprice > :min_price GROUP BY o_orderpriority",
    ]
    view = "v_orders_" + uuid.uuid4().hex[:8]
    return run_statements(
        spark, statements, {"VIEW": view, "ORDERS": table_path(sf, "orders")}, {"view": view, "min_price": 100000}
    )

