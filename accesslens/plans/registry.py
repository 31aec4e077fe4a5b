"""Named queries over the view, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accesslens.plans.view import LogView

QUERIES: dict[str, Callable[[LogView], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(build: Callable[[LogView], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return add


def callable_for(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # text labels follow the session zone; SQL on the same files is UTC
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(LogView(spark, sf_dir))

    run.__name__ = name
    return run
