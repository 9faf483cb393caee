"""Token allowlist → dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Chain aliases of the price source's coin keys, and the default chain.
CHAIN_ALIASES = {
    "gnosis": "gnosis",
    "xdai": "gnosis",
    "ethereum": "ethereum",
    "eth": "ethereum",
    "base": "base",
    "arbitrum": "arbitrum",
    "arbitrum-one": "arbitrum",
}
DEFAULT_CHAIN = "gnosis"

ALLOWLIST_DDL = (
    "pos BIGINT, symbol STRING, chain STRING, address STRING, coingecko_id STRING, "
    "defillama BOOLEAN, coingecko BOOLEAN"
)


def load_allowlist(raw: DataFrame) -> DataFrame:
    """Normalise raw allowlist rows (pos, symbol, chain, address, coingecko_id, defillama, coingecko).

    Symbols are trimmed and blank ones dropped; the chain defaults to gnosis,
    is lowercased and mapped through the alias table; addresses are lowercased;
    flags become booleans.  ``pos`` keeps the configuration order.
    """
    alias = F.create_map(*[F.lit(x) for kv in CHAIN_ALIASES.items() for x in kv])
    raw_chain = F.lower(F.trim(F.coalesce(F.nullif(F.col("chain"), F.lit("")), F.lit(DEFAULT_CHAIN))))
    return raw.select(
        F.col("pos").cast("bigint").alias("pos"),
        F.trim(F.coalesce(F.col("symbol"), F.lit(""))).alias("symbol"),
        F.coalesce(F.element_at(alias, raw_chain), raw_chain).alias("chain"),
        F.lower(F.trim(F.coalesce(F.col("address"), F.lit("")))).alias("address"),
        F.nullif(F.col("coingecko_id"), F.lit("")).alias("coingecko_id"),
        F.coalesce(F.col("defillama").cast("boolean"), F.lit(False)).alias("defillama"),
        F.coalesce(F.col("coingecko").cast("boolean"), F.lit(False)).alias("coingecko"),
    ).filter(F.col("symbol") != "")


def allowlist_from_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Read the YAML allowlist file (a few dozen entries of configuration)."""
    import yaml  # optional dependency; only needed for YAML configs

    with open(path, encoding="utf-8") as fh:
        data = yaml.safe_load(fh) or {}
    rows = [
        (i, t.get("symbol"), t.get("chain"), t.get("address"), t.get("coingecko_id"),
         bool(t.get("defillama")), bool(t.get("coingecko")))
        for i, t in enumerate(data.get("tokens") or [])
    ]
    return load_allowlist(spark.createDataFrame(rows, ALLOWLIST_DDL))
