"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accesslens.plans import registry
from accesslens.plans import (  # noqa: F401  (importing registers the queries)
    dim_queries,
    function_queries,
    io_queries,
    join_queries,
    parse_queries,
    rollup_queries,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: registry.callable_for(name) for name in registry.QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
