"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; row k of n
stands at the fraction (k + 1/2) / n.  Sorted by that fraction, every stretch of
rows holds the sources in the proportions of the whole, so cutting it into
equal stretches gives shards of the same mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, ranked


def interleave(docs: DataFrame, shards: int, seed: int = 17, text: str = "text", id: str = "doc_id", source: str = "source") -> DataFrame:
    """Assigns every row to a shard: ``id, size, text_crc32, stratum, shard, slot``.

    Law ``rows``: shard row counts differ by at most one, and each shard's count
    of a source differs from its share by a few rows.  ``size`` is the UTF-8
    bytes of the text (null: none) plus 8, ``slot`` numbers a shard's rows from
    0 in interleaved order.  The shuffle depends on seed, id and text alone, so it
    is the same on any cluster; only rows equal in both take any order.  A null source is a stratum of its own; repeated
    rows and ids keep a row each; empty tables give an empty table.  Only ids,
    sizes and checksums are shuffled, never texts.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = scratch.keep(docs.select(
        F.col(id),
        (F.octet_length(data) + F.lit(8)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(source).cast("string"))).alias("stratum"),
        F.monotonically_increasing_id().alias("__row"),
        F.xxhash64(F.lit(seed), F.col(id).cast("string"), data).alias("__hash"),
    ))
    placed = ranked(rows, ["__hash", "__row"], scratch, within="stratum")
    fraction = (F.col("__rank") + F.lit(0.5)) / F.col("__of")
    line = ranked(placed.withColumn("__fraction", fraction).drop("__rank", "__of"), ["__fraction", "__hash", "__row"], scratch)
    shard = F.expr(f"__rank * {int(shards)} DIV __of")
    first = F.expr(f"(shard * __of + {int(shards) - 1}) DIV {int(shards)}")
    return (line.withColumn("shard", shard).withColumn("slot", F.col("__rank") - first)
            .select(id, "size", "text_crc32", "stratum", F.col("shard").cast("int").alias("shard"), "slot"))
