"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Register:
    """Collects functions under their own or a given name, each with the SQL that gives the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            key = name or function.__name__
            self.queries[key] = function
            if sql is not None:
                self.sql[key] = sql
            return function

        return register
