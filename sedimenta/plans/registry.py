"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sedimenta.session import tune

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    expected: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, expected: str | None = None) -> Callable[[Build], Build]:
    """Register a query builder, with the SQL text of its expected result where SQL can state it."""

    def register(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, run, expected)
        return build

    return register
