"""Named queries over the driver tables, each with the SQL it must agree with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` is the ANSI form (None: compared by row count only)."""

    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        if fn.__name__ in QUERIES:
            raise ValueError(f"{fn.__name__} is registered twice")
        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return run

    return add


def total(x: str) -> str:
    """SQL for an exact money sum as a double."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def text(ts: str) -> str:
    """SQL for a timestamp as text."""
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
