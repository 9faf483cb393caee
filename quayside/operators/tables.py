"""Replacing and plain tables on Parquet.

A table is a Parquet directory described by a :class:`TableSpec`.  Keyed
("replacing") tables keep every loaded row; the newest row per key wins when the
table is read (:func:`read_latest`) and is made physical by :func:`compact`.
Loads therefore stay cheap appends and never shuffle the existing table.

Plain Parquet has no MERGE or DELETE, so a mutation reads the files of the month
partitions it touches, writes their new content to a hidden folder of the table
with Spark's own committer, notes the files it read, moves the new ones into
place and deletes the old ones.  A load that lands meanwhile is another file and
stays.  A crash before the note leaves the table as it was; one after it is
settled by the next rewrite, from the note.  What is not atomic: between the
moves and the deletes both versions are visible.  One rewriter per table at a
time.

"Newest" is a total order: ``(version, _load_seq, every other column)``, all
descending.  ``_load_seq`` is stamped on each load, so equal versions resolve to
the later load and the result never depends on file or task order.  The dedupe is
an aggregation (``max`` of a struct) rather than a window, so Spark combines
rows map-side before the shuffle and a key holding a third of the table never
lands whole in one task.
"""

from __future__ import annotations

import itertools
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, FloatType, MapType, StructType, TimestampNTZType, TimestampType

from quayside.functions.coerce import month_start
from quayside.session import scratch_path, shuffles_end

SEQ = "_load_seq"
MONTH = "month_part"
CONTENT = "_content"
INTERNAL = (SEQ, MONTH, CONTENT)


@dataclass(frozen=True)
class TableSpec:
    """Layout and replacing rules of one table.

    path        Parquet directory of the table.
    key         replacing key; empty → plain table (duplicates kept).
    version     greatest version wins within a key; ties → later load.
    month_of    date/timestamp column whose month partitions the table.
    sort_by     physical order inside files (Parquet min/max skipping).
    schema      DDL of the business columns (used when the table is empty).
    defaults    column → SQL expression filled in when a load omits it.
    max_records_per_file  bound on rows per written file (0 = unbounded).
    """

    path: str
    key: tuple[str, ...] = ()
    version: str | None = None
    month_of: str | None = None
    sort_by: tuple[str, ...] = ()
    schema: str | None = None
    defaults: dict = field(default_factory=dict)
    max_records_per_file: int = 0

    @property
    def keyed(self) -> bool:
        return bool(self.key)

    @property
    def order(self) -> list[str]:
        return ([self.version] if self.version else []) + [SEQ]


_seq_counter = itertools.count()


def next_load_seq() -> int:
    """Strictly increasing load number: microsecond clock plus a process counter."""
    return time.time_ns() // 1000 * 1000 + next(_seq_counter) % 1000


# --------------------------------------------------------------------------- #
# Newest row per key
# --------------------------------------------------------------------------- #


def latest(df: DataFrame, key, order=(), keep: list[str] | None = None) -> DataFrame:
    """One row per ``key``: the greatest by ``order`` then by every other column.

    NULL key parts group together (NULL equals NULL), as replacing keys need.
    Implemented as ``max(struct(order..., rest...))`` per key: partial
    aggregation runs before the shuffle, so duplicates and hot keys are
    collapsed map-side.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    cols = keep or df.columns
    rest = [c for c in cols if c not in key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    out = df.groupBy(*key).agg(F.max(packed).alias("_w"))
    return out.select(*[F.col(c) if c in key else F.col("_w")[c].alias(c) for c in cols])


# --------------------------------------------------------------------------- #
# File-system helpers (metadata only, driver side)
# --------------------------------------------------------------------------- #


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def path_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


NOTES = "_replaced"  # hidden folder of a table: files a rewrite has replaced and still has to delete


def _delete_files(spark: SparkSession, spec: TableSpec, files: list[str]) -> None:
    """Delete replaced files, and the month folders that become empty."""
    parents = {}
    for f in files:
        fs, p = _fs(spark, f)
        fs.delete(p, False)
        parents[p.getParent().toString()] = (fs, p.getParent())
    root = _fs(spark, spec.path)[1].toUri().getPath()
    for fs, folder in parents.values():
        if folder.toUri().getPath() != root and fs.exists(folder) and not len(fs.listStatus(folder)):
            fs.delete(folder, False)


def finish_rewrites(spark: SparkSession, spec: TableSpec) -> None:
    """Settle what earlier rewrites noted: move their new files into place, delete
    the files they replaced.  Content without a note was never part of the table."""
    notes = f"{spec.path}/{NOTES}"
    fs, folder = _fs(spark, notes)
    if not fs.exists(folder):
        return
    for status in fs.listStatus(folder):
        note = status.getPath().toString()
        if note.endswith(".files"):  # complete: renamed when written
            _move_in(spark, spec, note.removesuffix(".files") + ".new")
            _delete_files(spark, spec, [r[0] for r in spark.read.text(note).collect() if r[0]])
            fs.delete(status.getPath(), True)
    fs.delete(folder, True)


def _move_in(spark: SparkSession, spec: TableSpec, staged: str) -> None:
    """Move data files written to ``staged`` to the same place in the table."""
    fs, folder = _fs(spark, staged)
    if not fs.exists(folder):
        return
    top, files = folder.toUri().getPath().rstrip("/") + "/", fs.listFiles(folder, True)
    made = set()
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().startswith(("_", ".")):
            continue
        target = _fs(spark, f"{spec.path}/{file.toUri().getPath().removeprefix(top)}")[1]
        parent = target.getParent()
        if parent.toString() not in made:
            made.add(parent.toString())
            fs.mkdirs(parent)
        if not fs.rename(file, target):
            raise IOError(f"cannot move {file.toString()} to {target.toString()}")


def drop_files(spark: SparkSession, spec: TableSpec, files: list[str], token: str) -> None:
    """Note the replaced files of a rewrite, then settle it."""
    draft = f"{spec.path}/{NOTES}/{token}"
    spark.createDataFrame([(f,) for f in files or [""]], "f string").coalesce(1).write.text(draft)
    fs, p = _fs(spark, draft)
    if not fs.rename(p, _fs(spark, draft + ".files")[1]):
        raise IOError(f"cannot note the replaced files of {spec.path}")
    finish_rewrites(spark, spec)


def _replace_files(spark: SparkSession, spec: TableSpec, content: DataFrame, read: list[str], rebalance: bool = False) -> int:
    """Replace the files ``read`` by ``content``, prepared for the table; returns its rows."""
    token = uuid.uuid4().hex
    observed, o = _observe(content)
    with shuffles_end(spark):
        _writer(observed, spec, "append", rebalance).parquet(f"{spec.path}/{NOTES}/{token}.new")
    n = _rows_written(o, content)
    if not n:
        _keep_schema(spark, spec, content)
    drop_files(spark, spec, read, token)
    return n


def stored_files(df: DataFrame, months: list | None = None) -> list[str]:
    """Files behind a frame of ``read_raw``, of all months or the given ones (paths only)."""
    files = list(df.inputFiles())
    if months is None:
        return files
    names = tuple(f"/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if m is None else m}/" for m in months)
    return [f for f in files if any(n in f for n in names)]


# --------------------------------------------------------------------------- #
# Writing
# --------------------------------------------------------------------------- #


def with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the columns a load omitted, using the table's default expressions."""
    for c, expr in spec.defaults.items():
        if c not in df.columns:
            df = df.withColumn(c, F.expr(expr))
    return df


def _prepare(df: DataFrame, spec: TableSpec, seq: int | None) -> DataFrame:
    df = with_defaults(df, spec)
    if spec.keyed and SEQ not in df.columns:
        df = df.withColumn(SEQ, F.lit(seq if seq is not None else next_load_seq()).cast("bigint"))
    if spec.month_of and MONTH not in df.columns:
        df = df.withColumn(MONTH, month_start(spec.month_of))
    return df


def _writer(df: DataFrame, spec: TableSpec, mode: str, rebalance: bool = False):
    if rebalance and spec.month_of:
        # AQE rebalance by month: tiny loads collapse into a few tasks (few files),
        # a hot month is split across tasks instead of landing in one.
        df = df.hint("rebalance", MONTH)
    if spec.sort_by:
        df = df.sortWithinPartitions(*([MONTH] if spec.month_of else []), *spec.sort_by)
    w = df.write.mode(mode)
    if spec.max_records_per_file:
        w = w.option("maxRecordsPerFile", spec.max_records_per_file)
    if spec.month_of:
        w = w.partitionBy(MONTH)
    return w


def _spread(df: DataFrame, spec: TableSpec, spark: SparkSession, size_hint: int = 0) -> DataFrame:
    """Range-partition by (month, key/sort) so each task writes few, well-sized files.

    One task per ~128 MB of stored data (never fewer tasks than cores): a hot
    month is split across tasks by key range, a small table still uses every core.
    """
    target = 128 << 20
    n = max(spark.sparkContext.defaultParallelism, -(-size_hint // target))
    cols = ([MONTH] if spec.month_of else []) + list(spec.key or spec.sort_by)
    if not cols:
        return df.repartition(n)
    return df.repartitionByRange(n, *cols)


def create_if_absent(spark: SparkSession, spec: TableSpec, name: str | None = None) -> str:
    """Idempotent ``CREATE TABLE IF NOT EXISTS ... USING parquet`` at the spec's path."""
    if not spec.schema:
        raise ValueError("create_if_absent needs spec.schema")
    name = name or "t_" + uuid.uuid4().hex[:10]
    cols = spec.schema
    if spec.keyed:
        cols += f", {SEQ} BIGINT"
    part = ""
    if spec.month_of:
        cols += f", {MONTH} DATE"
        part = f" PARTITIONED BY ({MONTH})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{spec.path}'")
    return name


def append(df: DataFrame, spec: TableSpec, seq: int | None = None, rebalance: bool = True) -> int:
    """Plain append (and the cheap insert of a replacing table); returns rows written.
    ``rebalance=False`` is for a load whose rows all have one month: each task writes
    one file as it is, and the load is not shuffled only to be written."""
    out = _prepare(df, spec, seq)
    observed, o = _observe(out)
    with shuffles_end(df.sparkSession):
        _writer(observed, spec, "append", rebalance).parquet(spec.path)
    return _rows_written(o, out)


upsert = append  # replacing tables resolve duplicates at read / compaction time


def content_hash(df: DataFrame, leave_out=()) -> Column:
    """128-bit hash of a row's business columns, names and NULLs included."""
    def text(f):
        c = F.col(f"`{f.name}`")
        return F.to_json(c) if isinstance(f.dataType, (StructType, ArrayType, MapType)) else c.cast("string")

    fields = sorted((f for f in df.schema.fields if f.name not in INTERNAL and f.name not in leave_out), key=lambda f: f.name)
    return F.md5(F.to_json(F.struct(*[text(f).alias(f.name) for f in fields]), {"ignoreNullFields": "false"}))


def upsert_changed(spark: SparkSession, df: DataFrame, spec: TableSpec, seen: str = "ingested_at") -> int:
    """Upsert of the rows that differ from the newest held row of their key.

    A row as it is held writes nothing, so its ``seen`` stays the time it was
    first observed; a row that changed, or changed back, is written.  Each stored
    row keeps a hash of its content (``seen`` left out), so only keys, order and
    hashes of the table are read.  NULL key parts equal each other.  Rows stored
    without a hash get theirs from their columns.  Returns the rows written.
    """
    df = with_defaults(df, spec)
    order = [spec.version] if spec.version else []
    new = latest(df.withColumn(CONTENT, content_hash(df, (seen,))), spec.key, order)
    if not path_bytes(spark, spec.path):
        return append(new, spec)
    raw = read_raw(spark, spec, merge=True)
    stored = content_hash(raw.select(*[c for c in raw.columns if c in df.columns]), (seen,))
    raw = raw.withColumn(CONTENT, F.coalesce(F.col(CONTENT), stored) if CONTENT in raw.columns else stored)
    held = latest(raw, spec.key, spec.order, keep=[*spec.key, *spec.order, CONTENT]).select(
        *[F.col(k).alias(f"_held_{k}") for k in spec.key], F.col(CONTENT).alias("_held"))
    same = new[CONTENT] == held["_held"]
    for k in spec.key:
        same = same & new[k].eqNullSafe(held[f"_held_{k}"])
    return append(new.join(held, same, "left_anti"), spec)


def _observe(df: DataFrame):
    from pyspark.sql import Observation

    o = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(o, F.count(F.lit(1)).alias("rows")), o


def _rows_written(o, df: DataFrame) -> int:
    """Rows counted by the write itself; when no metrics arrived (an empty
    write runs no task), fall back to counting the input."""
    try:
        return int(o.get.get("rows", 0))
    except Exception:  # no observed metrics
        return df.count()


def full_replace(spark: SparkSession, df: DataFrame, spec: TableSpec, seq: int | None = None) -> int:
    """Truncate-and-insert without a gap: the new rows come into place before the
    files that held the old ones are deleted."""
    finish_rewrites(spark, spec)
    old = stored_files(read_raw(spark, spec)) if path_bytes(spark, spec.path) else []
    return _replace_files(spark, spec, _prepare(df, spec, seq), old, rebalance=True)


def _keep_schema(spark: SparkSession, spec: TableSpec, df: DataFrame) -> None:
    """An empty file, so that a table without rows still has its columns."""
    spark.createDataFrame([], df.schema).write.mode("append").parquet(spec.path)


# --------------------------------------------------------------------------- #
# Reading
# --------------------------------------------------------------------------- #


def _empty(spark: SparkSession, spec: TableSpec) -> DataFrame:
    df = spark.createDataFrame([], spec.schema)
    return _prepare(df, spec, 0)


def read_raw(spark: SparkSession, spec: TableSpec, months: list | None = None, merge: bool = False) -> DataFrame:
    """Every stored row, internal columns included; ``months`` prunes partitions.
    ``merge`` looks for columns in every file, not in one."""
    if not path_bytes(spark, spec.path):
        if not spec.schema:
            raise FileNotFoundError(spec.path)
        return _empty(spark, spec)
    df = spark.read.option("basePath", spec.path).option("mergeSchema", merge).parquet(spec.path)
    if spec.month_of:
        df = df.withColumn(MONTH, F.col(MONTH).cast("date"))
        if months is not None:
            df = df.filter(_in_months(months))
    return df


def _in_months(months: list) -> Column:
    known = F.coalesce(F.col(MONTH).isin([str(m) for m in months if m is not None]), F.lit(False))
    return known | F.col(MONTH).isNull() if None in months else known


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in INTERNAL]


def read_latest(spark: SparkSession, spec: TableSpec, months: list | None = None, columns: list[str] | None = None) -> DataFrame:
    """Merge-on-read view (``FINAL``): newest row per key, internal columns dropped.

    ``months`` needs the month column in the key: otherwise the newest row of a
    key may lie in a month that is not read.  With ``columns`` the view has only
    these; what the newest row holds in them is settled by the columns up to the
    last of them, so those behind it are not read.
    """
    if months is not None and spec.keyed and spec.month_of not in spec.key:
        raise ValueError(f"months of a table whose key lacks {spec.month_of!r} would give superseded rows")
    raw = read_raw(spark, spec, months)
    cols = business_columns(raw)
    wanted = cols if columns is None else list(columns)
    if not spec.keyed:
        return raw.select(*wanted)
    if set(wanted) <= set(spec.key):
        return raw.select(*spec.key).distinct().select(*wanted)
    if columns is not None:
        ruled = [*spec.key, *spec.order]
        last = max((k for k, c in enumerate(cols) if c in wanted and c not in ruled), default=-1)
        cols = [c for k, c in enumerate(cols) if k <= last or c in ruled]
    return latest(raw, spec.key, spec.order, keep=cols + [SEQ]).select(*wanted)


def read_between(spark: SparkSession, spec: TableSpec, lo, hi) -> DataFrame:
    """Rows with ``lo <= month_of < hi``; adds the month predicate Spark cannot derive itself."""
    raw = read_raw(spark, spec)
    c = F.col(spec.month_of)
    out = raw.filter((c >= F.lit(lo)) & (c < F.lit(hi)))
    if spec.month_of:
        out = out.filter((F.col(MONTH) >= month_start(F.lit(lo))) & (F.col(MONTH) <= month_start(F.lit(hi))))
    return out


# --------------------------------------------------------------------------- #
# Compaction and partition rewrites
# --------------------------------------------------------------------------- #


def _months_of(df: DataFrame) -> list:
    """Distinct month partitions of a frame; one row per calendar month, so the
    driver receives a handful of dates, never data rows."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def rewrite_months(spark: SparkSession, spec: TableSpec, content: DataFrame, read: list[str]) -> None:
    """Replace the files ``read``, from which ``content`` was computed, by ``content``."""
    _replace_files(spark, spec, _spread(content, spec, spark, path_bytes(spark, spec.path)), read)


_RANGE, _HASH = "_range", "_hash"
RANGE_BYTES = 32 << 20   # stored bytes of one range of a compaction
SAMPLE_ROWS = 200_000    # rows looked at to tell whether a key is too frequent for a range


def _month_ranges(spark: SparkSession, spec: TableSpec, raw: DataFrame) -> DataFrame | None:
    """Rows by month of the key's time, then by a hash of the key, in ranges of
    ``RANGE_BYTES``; ``None`` for a table of few ranges, a key without a time, and
    where a key holds so many rows that only a map-side dedupe keeps it from one
    task.  The sample decides between two plans of the same result."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    at = next((k for k in spec.key if isinstance(types[k], (DateType, TimestampType, TimestampNTZType))), None)
    n = path_bytes(spark, spec.path) // RANGE_BYTES
    # Numbers that are equal and stored otherwise (0.0 and -0.0) have two hashes.
    if not spec.month_of or at is None or n < 2 or any(isinstance(types[k], (FloatType, DoubleType, ArrayType, StructType)) for k in spec.key):
        return None
    placed = raw.withColumn(_RANGE, month_start(at)).withColumn(_HASH, F.xxhash64(*spec.key))
    share = min(1.0, SAMPLE_ROWS / max(1, raw.count()))
    seen = placed.select(_HASH).sample(share, seed=1).groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if seen["most"] is None or seen["most"] > max(16, seen["rows"] // (4 * n)):
        return None
    return placed.repartitionByRange(max(n, spark.sparkContext.defaultParallelism), _RANGE, _HASH)


def compact(spark: SparkSession, spec: TableSpec, months: list | None = None) -> None:
    """``OPTIMIZE ... FINAL``: keyed tables are physically deduplicated, plain
    tables only have their files merged (duplicates stay)."""
    finish_rewrites(spark, spec)
    raw = read_raw(spark, spec, months)
    files = stored_files(raw, months)
    if not spec.keyed:
        return rewrite_months(spark, spec, raw, files)
    ranges = _month_ranges(spark, spec, raw)
    if ranges is None:
        return rewrite_months(spark, spec, latest(raw, spec.key, spec.order), files)
    # Ranges that keep the rows of a key together serve the dedupe and the write: one shuffle.
    merged = latest(ranges, [_RANGE, _HASH, *spec.key], spec.order).drop(_RANGE, _HASH)
    _replace_files(spark, spec, merged, files)


def _staged(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The load, written once and read back, so that it is evaluated once."""
    path = scratch_path(spark, "stage")
    with shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prune_day(spark: SparkSession, spec: TableSpec, new: DataFrame, day_col: str, day, run_col: str) -> int:
    """Insert-then-prune for one day: rows of ``day`` older than this run are removed.

    Only the month partition holding ``day`` is rewritten.
    """
    finish_rewrites(spark, spec)
    new = _staged(spark, _prepare(new, spec, None))
    run_ts = new.agg(F.max(run_col)).first()[0]
    if run_ts is None:
        return 0  # nothing fetched → nothing pruned
    if not path_bytes(spark, spec.path):
        append(new, spec)  # first load: nothing older to prune
        return 1
    months = [_month_of_value(spark, day)]
    existing = read_raw(spark, spec, months)
    append(new, spec)
    doomed = (F.col(day_col) == F.lit(day).cast("date")) & (F.col(run_col) < F.lit(run_ts))
    _prune(spark, spec, existing, existing.filter(~F.coalesce(doomed, F.lit(False))), months)
    return 1


def prune_days(spark: SparkSession, spec: TableSpec, new: DataFrame, day_col: str, run_col: str) -> int:
    """:func:`prune_day` for every day that the load holds, in one pass over the
    months in which rows die.  Returns the number of those months."""
    finish_rewrites(spark, spec)
    new = _staged(spark, _prepare(new, spec, None))
    run_ts = new.agg(F.max(run_col)).first()[0]
    if run_ts is None:
        return 0
    if not path_bytes(spark, spec.path):
        append(new, spec)
        return 0
    existing = read_raw(spark, spec)
    append(new, spec)
    days = new.select(F.col(day_col)).distinct().withColumn("_returned", F.lit(True))
    doomed = F.coalesce(F.col("_returned") & (F.col(run_col) < F.lit(run_ts)), F.lit(False))
    months = _months_of(existing.join(days, day_col).filter(doomed))
    if not months:
        return 0
    scope = existing.filter(_in_months(months))
    _prune(spark, spec, existing, scope.join(days, day_col, "left").filter(~doomed).select(*scope.columns), months)
    return len(months)


def _prune(spark: SparkSession, spec: TableSpec, existing: DataFrame, survivors: DataFrame, months: list) -> None:
    """Keep only ``survivors`` of the rows ``existing`` held when it was listed."""
    files = stored_files(existing, months)
    if not files:
        return
    rewrite_months(spark, spec, survivors, files)


def _month_of_value(spark, day):
    return spark.range(1).select(month_start(F.lit(day))).first()[0]


def prune_series(
    spark: SparkSession,
    spec: TableSpec,
    new: DataFrame,
    asset_cols,
    date_col: str,
    run_col: str,
    per_asset: bool = False,
    valid: Column | None = None,
) -> int:
    """Insert, then drop older rows of the assets that returned data.

    The bound is the newest new date over the whole load, or each asset's own
    newest new date when ``per_asset`` (later stored rows then survive).
    Assets failing ``valid`` (e.g. a malformed address) are never pruned.
    Returns the number of month partitions rewritten.
    """
    asset_cols = [asset_cols] if isinstance(asset_cols, str) else list(asset_cols)
    finish_rewrites(spark, spec)
    new = _staged(spark, _prepare(new, spec, None))
    if not path_bytes(spark, spec.path):
        append(new, spec)  # first load: nothing older to prune
        return 0
    returned = new if valid is None else new.filter(valid)
    # One row for the whole load: the bound, the run, and the least and greatest asset.
    ends = [f(c) for c in asset_cols for f in (F.min, F.max)]
    bound, run, *ends = returned.agg(F.max(date_col), F.max(run_col), *ends).first()
    existing = read_raw(spark, spec)
    append(new, spec)
    if bound is None:
        return 0  # nothing prunable returned: insert only
    if per_asset:
        bounds = returned.groupBy(*asset_cols).agg(F.max(date_col).alias("_bound"), F.max(run_col).alias("_run"))
    else:
        bounds = returned.select(*asset_cols).distinct().select(
            *asset_cols, F.lit(bound).alias("_bound"), F.lit(run).alias("_run"))
    doomed = F.coalesce((F.col(date_col) <= F.col("_bound")) & (F.col(run_col) < F.col("_run")), F.lit(False))
    # Months in which stored rows die.  Every condition that holds for all of them is a
    # literal, so Parquet's own bounds pass over the row groups that hold none, and three
    # or four narrow columns are read of the others.
    reached = existing.filter((F.col(date_col) <= F.lit(bound)) & (F.col(run_col) < F.lit(run)))
    for c, (lo, hi) in zip(asset_cols, zip(ends[::2], ends[1::2])):
        reached = reached.filter(F.col(c).between(F.lit(lo), F.lit(hi)))
    if spec.month_of == date_col:
        reached = reached.filter(F.col(MONTH) <= month_start(F.lit(bound)))
    months = _months_of(reached.join(bounds, asset_cols).filter(doomed))
    if not months:
        return 0
    scope = existing.filter(_in_months(months))
    survivors = scope.join(bounds, asset_cols, "left").filter(~doomed).select(*scope.columns)
    _prune(spark, spec, existing, survivors, months)
    return len(months)
