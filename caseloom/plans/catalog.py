"""Decorator that files a query together with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def file(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn
        return file
