"""All queries of the analytics engine and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.plans import registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in registry().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in registry().items() if sql}
