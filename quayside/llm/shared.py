"""Helpers the operators of this subpackage share: written intermediates,
connected components, a bounded membership bitmap, memoised text chunks."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path, shuffles_end

# Rows of one Arrow batch between the JVM and Python: texts can be long, and a
# batch is held whole on both sides.
ARROW_ROWS = 1000
READ_ROWS = 4096  # Spark's own batch of a Parquet scan


def prepare(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Session settings the Python-backed operators rely on, and the library
    itself for the Python workers of executors that do not have it installed.
    Rows that hold much each are read and go to Python ``rows`` at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(min(rows, READ_ROWS) if rows < ARROW_ROWS else READ_ROWS))
    sc = spark.sparkContext
    if _SHIPPED.get("to") != sc.applicationId:
        _SHIPPED["to"] = sc.applicationId
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="quayside-code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))  # Spark serves the file from the driver


_SHIPPED: dict[str, str] = {}


class Scratch:
    """Intermediate tables of one operator call under the shared folder.

    ``keep`` writes a frame and reads it back, which cuts the lineage: a lost
    executor costs a re-read, not a recomputation.  ``drop`` removes tables no
    later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self._kept: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, by: str | None = None, row_group: int | None = None) -> DataFrame:
        """``by`` makes folders by a column; ``row_group`` bounds the bytes that a
        writer holds before it writes them out."""
        path = f"{self.root}/{len(self._kept):03d}"
        writer = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
        with shuffles_end(self.spark):
            (writer.partitionBy(by) if by else writer).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._kept.append((back, path))
        return back

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for kept, path in self._kept:
            if any(kept is df for df in frames):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(id, component_id)``,
    one row per id that occurs in an edge between two different ids; the
    component is its smallest id.

    Each round every node learns the smallest id next to it and passes that id
    on to all its neighbours; an edge (a, b) becomes (b, least(a)) and
    (a, least(a)).  Rounds grow with the logarithm of the longest chain.  A hub
    is only ever met by a partially aggregated minimum and by a sort-merge join
    whose large partitions Spark splits.  Empty edges give an empty table.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = scratch.keep(edges.filter("a <> b").select(high.alias("hi"), low.alias("lo")).distinct())
    while True:
        heads = now.groupBy("hi").agg(F.count("*").alias("n"))
        # Stars only: every id has one smaller neighbour, which has none itself.
        open_ids = heads.filter("n > 1").select("hi").unionAll(now.select(F.col("lo").alias("hi")).join(heads, "hi", "left_semi"))
        if open_ids.isEmpty():
            break
        both = now.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionAll(
            now.select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("p"))
        step = both.join(least, "a")
        pairs = step.select(F.explode(F.array("a", "b")).alias("v"), "p").filter("v <> p")
        new = scratch.keep(pairs.select(F.greatest("v", "p").alias("hi"), F.least("v", "p").alias("lo")).distinct())
        scratch.drop(now)
        now = new
    roots = now.select(F.col("lo").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component_id")).unionAll(roots)


# A bitmap never holds more words of 64 bits than this (16 MB as rows), however
# many ids there are: past that it lets more rows through to the exact join.
BITMAP_WORDS = 1 << 20


def maybe_member(df: DataFrame, key: str, ids: DataFrame, flag: str, n_ids: int) -> DataFrame:
    """Adds boolean ``flag``: false only where ``df[key]`` is certainly not in
    ``ids[key]``; true for every member and for a few others.

    The ids are folded into a one-hash bitmap whose words (at most
    ``BITMAP_WORDS`` rows) are broadcast, so a wide table meets an exact join
    only with the rows that may match.
    """
    words = 64
    while words < min(BITMAP_WORDS, max(64, n_ids // 2)):
        words *= 2
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(words * 64))
    word, bit = F.shiftright(at, 6), F.expr("shiftleft(1L, CAST(__at & 63 AS INT))")
    bitmap = (ids.select(at.alias("__at")).select(F.shiftright("__at", 6).alias("__word"), bit.alias("__bit"))
              .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    return (df.withColumn("__at", at).withColumn("__word", F.shiftright("__at", 6))
            .join(F.broadcast(bitmap), "__word", "left")
            .withColumn(flag, F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False)))
            .drop("__at", "__word", "__bits"))


class Memo(dict):
    """``memo[key]`` computes ``fn(key)`` once and remembers it.  Two generations
    of at most ``size`` entries bound the memory; keys in use move to the young
    one, so frequent keys survive."""

    def __init__(self, fn, size: int = 200_000):
        super().__init__()
        self.fn, self.size, self.old = fn, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        if len(key) <= 64:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


_EDGE_SPACE = re.compile(r" \s|\s ")


def chunks(text: str) -> list[str]:
    """Cuts a text before single spaces; the pre-tokenizer pattern never matches
    across such a cut, so a chunk's tokens do not depend on its neighbours.

    Where a space stands beside other white space the text is left whole there.
    """
    if not text:
        return []
    parts = text.split(" ")
    if _EDGE_SPACE.search(text) is None:
        out = [" " + p for p in parts]
        if parts[0]:
            out[0] = parts[0]
        else:
            del out[0]
        return out
    out, held = [], ""
    for k, p in enumerate(parts):
        piece = p if k == 0 else " " + p
        if k and p and not p[0].isspace() and held and not held[-1].isspace():
            out.append(held)
            held = piece
        else:
            held += piece
    if held:
        out.append(held)
    return out


def ranked(df: DataFrame, order: list[str], scratch: Scratch, within: str | None = None) -> DataFrame:
    """Adds ``__rank`` (from 0) of each row in the total order of ``order`` and
    ``__of``, the number of rows ranked together: all, or those equal in
    ``within`` (never null).

    Rows are range-partitioned and sorted, so a value of ``within`` that holds a
    third of all rows is spread over tasks; only one count per partition and
    value is added up.  The sorted rows are written once, as their partitions
    must not change between counting and numbering.
    """
    keys = ([within] if within else []) + order
    rows = scratch.keep(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    group = ["__part"] + ([within] if within else [])
    counts = rows.groupBy(*group).agg(F.count("*").alias("__n"), F.min("__pos").alias("__first"))
    together = Window.partitionBy(*([within] if within else [])) if within else Window.partitionBy()
    before = together.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
              .withColumn("__of", F.sum("__n").over(together)).drop("__n", "__first"))
    return (rows.join(starts, group).withColumn("__rank", F.col("__pos") + F.col("__start"))
            .drop("__part", "__pos", "__start"))
