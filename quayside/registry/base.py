"""Registration helpers for the stand-in queries over the driver's tables.

Each SURVEY §2 key gets a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where the result is expressible in SQL, the equivalent DuckDB statement over the
same tables.  Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.session import configure, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return naive_timestamps(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return wrap


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Present UTC timestamps as wall-clock ``TIMESTAMP_NTZ`` (the driver tables'
    type), so results line up with the source columns and SQL ``TIMESTAMP``."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import TimestampType

    if not any(isinstance(f.dataType, TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def src(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, sf_dir, name, spread)


def sql_order_desc(cols) -> str:
    """DuckDB ORDER BY list matching Spark's struct ``max`` (NULL smallest)."""
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
