"""Registered analyses: Spark callables by name and the SQL that states the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to six digits, negative zero to zero: engines differ in the last bits."""
    return df.select(*[(F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if kind == "double" else F.col(f"`{c}`") for c, kind in df.dtypes])


def query(name: str, sql: str | None = None, digits: int = 6):
    """Registers a callable (spark, sf_dir) -> DataFrame and the SQL for the same rows."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir), digits)
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add
