"""A registry holds named queries and, where SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
        """Register a function of Tables under a name; sql is run by the oracle engine."""

        def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = sql
            return f

        return register

    def merge(self, other: Registry) -> Registry:
        clash = self.queries.keys() & other.queries.keys()
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        self.queries |= other.queries
        self.oracles |= other.oracles
        return self
