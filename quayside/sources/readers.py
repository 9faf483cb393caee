"""Landing readers: CSV, whole-document JSON, NDJSON, Parquet drops.

Every reader returns a DataFrame whose scan Spark splits and parallelises; the
only exception is a whole-document JSON body, which is one value by definition
(one file → one task) and is exploded right after parsing.
"""

from __future__ import annotations

import csv
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.coerce import sentinel_to_null
from quayside.operators.filters import cap_rows, cast_to_target, clean_name, match_names


CSV_OPTIONS = {"header": True, "escape": '"'}


def csv_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV file under ``path``: ``file, header`` (its first line that is
    not blank) and ``multi_line`` (whether a quoted cell goes on over a line end).

    The lines are read once, as splittable text; every file is one row of a
    partial aggregate.  A line with an odd number of quotes opens or closes a
    cell that holds a line end; only such files need a reader that cannot split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_n"), "value").filter(F.trim("value") != "")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    first = F.min(F.when(F.col("_block") == 0, F.struct("_n", "value")))
    return lines.groupBy("file").agg(first["value"].alias("header"), F.coalesce(F.bool_or(quotes % 2 == 1), F.lit(False)).alias("multi_line")).filter(
        "header IS NOT NULL")


def csv_groups(spark: SparkSession, path: str, multi_line: bool | None = None) -> list[tuple[list[str], bool, list[str]]]:
    """Files that can be read together: ``(header names, multi_line, files)``.  What
    reaches the driver are paths, which Spark's file index holds there as well."""
    files = csv_files(spark, path)
    if multi_line is not None:
        files = files.withColumn("multi_line", F.lit(multi_line))
    groups = files.groupBy("header", "multi_line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header", "multi_line").collect()
    # Listed paths are percent-encoded; a path given to a reader may hold no open wildcard.
    literal = lambda f: re.sub(r"([*?\[\]{}])", r"\\\1", unquote(f))
    return [(next(csv.reader([g["header"].removeprefix("\ufeff")])), g["multi_line"], [literal(f) for f in g["files"]]) for g in groups]


def _scan(spark: SparkSession, names: list[str], multi_line: bool, files: list[str], types: dict[str, T.DataType]) -> DataFrame:
    """One scan of files with one header; columns are ``c0, c1, ...`` by position,
    so names that differ in case only, or not at all, stay apart."""
    schema = T.StructType([T.StructField(f"c{i}", types.get(n, T.StringType())) for i, n in enumerate(names)])
    return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).schema(schema).csv(files)


def read_csv(spark: SparkSession, path: str, ddl: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Headed CSV.  With ``ddl`` the structure is declared and each file's columns
    are found by the names in its own header (case matters; a column that a file
    lacks is NULL, further ones are left out; of two of one name the first
    counts).  A file without any declared column is an error.  Without ``ddl``
    types are inferred and odd header names (spaces, ``%``) are kept verbatim for
    backticked access.

    Files are split across tasks unless a quoted cell in them holds a line end;
    ``multi_line`` says so for all files instead of looking.
    """
    if ddl is None:
        if multi_line is None:
            multi_line = bool(csv_files(spark, path).agg(F.bool_or("multi_line")).first()[0])
        return spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("inferSchema", True).csv(path)
    target = T.StructType.fromDDL(ddl)
    types = {f.name: f.dataType for f in target.fields}
    out = None
    for names, multi, files in csv_groups(spark, path, multi_line):
        if not set(names) & set(types):
            raise ValueError(f"no declared column in the header {names} of {files[0]}")
        df = _scan(spark, names, multi, files, types)
        df = df.select(*[(F.col(f"c{names.index(n)}") if n in names else F.lit(None).cast(t)).alias(n) for n, t in types.items()])
        out = df if out is None else out.unionAll(df)
    return spark.createDataFrame([], target) if out is None else out


def conform_csv(spark: SparkSession, path: str, target: T.StructType, max_rows: int | None = None,
                order=None, multi_line: bool | None = None) -> DataFrame:
    """CSV files with drifting headers → rows shaped like the target table.

    Files are grouped by their header line and each group is read by one scan,
    every cell as text.  Per header: names are cleaned, columns that match the
    target are kept (exact names, else case-insensitive; of two that match one
    column the first), cells are cast by target type with failures → NULL.  A
    header that matches nothing gives no rows.  The groups are united by name;
    columns that no header has are left out, so that table defaults apply.
    Optionally the row count is capped in an explicit order.
    """
    out = None
    for names, multi, files in csv_groups(spark, path, multi_line):
        picked = match_names([clean_name(n) for n in names], target)
        if not picked:
            continue
        df = _scan(spark, names, multi, files, {}).select(*[F.col(f"c{i}").alias(t) for i, t in picked])
        df = cast_to_target(df, target)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], T.StructType([]))
    out = out.select(*[f.name for f in target.fields if f.name in out.columns])
    if max_rows is not None:
        out = cap_rows(out, max_rows, order or out.columns[0])
    return out


def read_json_array(spark: SparkSession, path: str, field: str = "addresses") -> DataFrame:
    """Whole-body JSON documents → one row per element of ``field``.

    Elements are kept as JSON text (``{address, reason}`` objects); the address
    is lowercased, an empty reason becomes NULL and blank addresses are dropped.
    """
    docs = spark.read.text(path, wholetext=True)
    items = F.from_json(F.col("value"), f"struct<{field}: array<string>>")[field]
    e = docs.select(F.explode(items).alias("item"))
    address = F.coalesce(F.get_json_object("item", "$.address"), F.lit(""))
    reason = F.coalesce(F.get_json_object("item", "$.reason"), F.lit(""))
    return e.filter(address != "").select(
        F.lower(address).alias("address"), sentinel_to_null(reason, [""], lower=False).alias("reason")
    )


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lenient NDJSON: blank lines skipped; malformed lines, non-objects and
    objects without ``event`` go to the reject frame (line text + reason).

    Each line is parsed once, into a VARIANT (``v``) that later steps read from.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter(F.col("line") != "")
    v = lines.select("line", F.try_parse_json("line").alias("v"))
    # An object casts to a struct (missing field → NULL, JSON null → variant null);
    # arrays and scalars do not.
    head = F.try_variant_get(F.col("v"), "$", "struct<event: variant>")
    reason = (
        F.when(F.col("v").isNull(), F.lit("malformed"))
        .when(head.isNull(), F.lit("not_an_object"))
        .when(head["event"].isNull(), F.lit("no_event"))
    )
    tagged = v.select("line", "v", reason.alias("reject_reason"))
    ok = tagged.filter(F.col("reject_reason").isNull()).select("line", "v")
    rejects = tagged.filter(F.col("reject_reason").isNotNull()).select("line", "reject_reason")
    return ok, rejects


def events_rows(ok_lines: DataFrame, project_id: str) -> tuple[DataFrame, DataFrame]:
    """NDJSON events → (event_name, distinct_id, event_time, insert_id, project_id, properties).

    Missing time → epoch; a time that is not a valid unix number is rejected
    (second frame), never written.
    """
    from quayside.functions.coerce import epoch

    def get(path: str, typ: str = "string"):
        return F.try_variant_get(F.col("v"), path, typ)

    secs = get("$.properties.time", "double")
    present = get("$.properties.time", "variant").isNotNull()
    ok_time = secs.isNotNull() & (F.abs(secs) < F.lit(253402300800.0))
    parsed = F.when(ok_time, F.timestamp_seconds(secs.cast("bigint")))  # the key column holds whole seconds
    props = get("$.properties", "variant")
    rows = ok_lines.select(
        F.coalesce(get("$.event"), F.lit("")).alias("event_name"),
        F.coalesce(get("$.properties.distinct_id"), F.lit("")).alias("distinct_id"),
        F.when(~present, epoch()).otherwise(parsed).alias("event_time"),
        F.coalesce(get("$.properties['$insert_id']"), F.lit("")).alias("insert_id"),
        F.lit(project_id).alias("project_id"),
        F.coalesce(F.to_json(props), F.lit("{}")).alias("properties"),
    )
    return rows.filter(F.col("event_time").isNotNull()), rows.filter(F.col("event_time").isNull())


def load_parquet(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """Read a chosen list of Parquet files.  With ``columns`` the file columns are
    matched to the target **by position** (the ``INSERT ... SELECT *`` rule)."""
    df = spark.read.parquet(*paths)
    if columns is not None:
        if len(columns) != len(df.columns):
            raise ValueError(f"positional load: {len(df.columns)} file columns vs {len(columns)} target columns")
        df = df.toDF(*columns)
    return df
