"""Registration of queries with their checking statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.inputs import Inputs
from catalog.reference_sql import statement

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Inputs` under a name; without `sql` only its rows can be looked at."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            ORACLES[name] = statement(sql)
        return build

    return register
