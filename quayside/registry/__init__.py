"""All registered stand-in queries and their DuckDB oracles."""

from quayside.registry import events, fills, governance, increment, landing, loads, maintenance, prices, streams  # noqa: F401  (registration side effects)
from quayside.registry.base import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
