"""Ordered SQL statement files with variables."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_TEMPLATE = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def render(text: str, variables: dict[str, str]) -> str:
    """``{{NAME}}`` → value; an unknown variable is an error, never left in place."""

    def sub(m):
        if m.group(1) not in variables:
            raise KeyError(f"undefined SQL variable {m.group(1)}")
        return str(variables[m.group(1)])

    return _TEMPLATE.sub(sub, text)


def run_statements(spark: SparkSession, statements: list[str], variables: dict[str, str] | None = None,
                   args: dict | None = None) -> DataFrame | None:
    """Run single-statement SQL texts in order; the first failure stops the run.

    ``variables`` fills ``{{NAME}}`` templates (identifiers, paths); ``args``
    binds ``:name`` parameter markers (values), so values are never spliced
    into SQL text.  Returns the last statement's result.
    """
    result = None
    for text in statements:
        sql = render(text, variables or {})
        uses = {k: v for k, v in (args or {}).items() if f":{k}" in sql}
        result = spark.sql(sql, args=uses) if uses else spark.sql(sql)
    return result


def run_files(spark: SparkSession, paths: list[str], variables: dict[str, str] | None = None,
              args: dict | None = None) -> DataFrame | None:
    """Same as :func:`run_statements` over statement files (small text files on the driver)."""
    return run_statements(spark, [Path(p).read_text(encoding="utf-8") for p in paths], variables, args)
