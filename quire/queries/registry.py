"""All queries of the library outside the training-data operators, each with SQL for an independent engine where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.queries import layout, runs, text, timing  # noqa: F401  (they register their queries)
from quire.queries.base import Q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in Q.items() if sql}
