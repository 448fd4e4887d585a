"""Runs a file of SQL statements."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

STATEMENT_END = r";\s*\n"


def statements(script: str) -> list[str]:
    """Statements of a script, split where a semicolon ends a line; a lone comment line is none."""
    found = []
    for part in re.split(STATEMENT_END, script):
        text = part.strip().removesuffix(";").rstrip()
        is_comment = text.startswith("--") and "\n" not in text
        if text and not is_comment:
            found.append(text)
    return found


def run_sql_script(spark: SparkSession, script: str, params: dict[str, object] | None = None) -> DataFrame | None:
    """Runs the statements in order; returns the frame of the last one.

    Values are named parameters (``:name``); table names go through ``IDENTIFIER(:name)``.
    """
    result = None
    for statement in statements(script):
        used = {k: v for k, v in (params or {}).items() if re.search(rf":{k}\b", statement)}
        result = spark.sql(statement, args=used) if used else spark.sql(statement)
    return result
