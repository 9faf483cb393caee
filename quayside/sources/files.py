"""Dated file drops: list a landing folder and choose files.

Drops are named ``<prefix>/YYYY-MM-DD.parquet``.  The listing is itself a
DataFrame (``binaryFile`` with only the path selected, so no content is read),
so choosing among millions of objects stays a Spark job; only the chosen path
(one string) reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def list_drops(spark: SparkSession, folder: str) -> DataFrame:
    """One row per object directly under ``folder``: (name, path, drop_date).

    A drop may be a single file or a Spark output directory of that name.
    ``drop_date`` is NULL when the name does not start with a valid date.
    """
    folder = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    )
    # Listed paths may spell scheme and authority differently: compare what follows.
    bare = F.regexp_replace(F.col("path"), _SCHEME, "/")
    rel = F.regexp_extract(bare, "^" + re.escape(re.sub(_SCHEME, "/", folder)) + r"/([^/]+)", 1)
    names = files.select(rel.alias("name")).filter(F.col("name") != "").distinct()
    stem = F.substring_index(F.col("name"), ".", 1)
    date = F.when(stem.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(stem, "yyyy-MM-dd"))
    return names.select("name", F.concat(F.lit(folder + "/"), F.col("name")).alias("path"), date.alias("drop_date"))


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/+"


def select_files(spark: SparkSession, folder: str, mode: str = "latest", date=None, pattern: str = "{{DATE}}.parquet") -> DataFrame:
    """Paths to load: ``latest`` (newest dated ``.parquet``; undated names sort
    lowest; ties → first in listing order), ``date`` (the drop for ``date``,
    mandatory; its name is ``pattern`` with the date put in), ``all`` (every ``.parquet`` drop — non-Parquet objects are
    skipped on purpose)."""
    drops = list_drops(spark, folder).filter(F.col("name").endswith(".parquet"))
    if mode == "all":
        return drops
    if mode == "date":
        if date is None:
            raise ValueError("mode 'date' needs a date")
        return drops.filter(F.col("name") == F.lit(pattern.replace("{{DATE}}", str(date))))
    if mode == "latest":
        return drops.orderBy(F.col("drop_date").desc_nulls_last(), F.col("name").asc()).limit(1)
    raise ValueError(f"unknown mode {mode!r}")


def read_selected(spark: SparkSession, folder: str, mode: str = "latest", date=None) -> DataFrame | None:
    """Read the chosen drops (None when nothing matches).  All of them are read by
    a pattern, so no list of paths is made; the other modes choose one path."""
    if mode == "all":
        if list_drops(spark, folder).filter(F.col("name").endswith(".parquet")).isEmpty():
            return None
        return spark.read.parquet(f"{folder.rstrip('/')}/*.parquet")
    paths = [r["path"] for r in select_files(spark, folder, mode, date).select("path").collect()]
    return spark.read.parquet(*paths) if paths else None
