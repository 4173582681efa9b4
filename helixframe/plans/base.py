"""A set of queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Query = Callable[..., DataFrame]


class Queries:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a function under its name; without ``sql`` its tests compare it with a plain version."""

        def add(f: Query) -> Query:
            self.put(f.__name__, f, sql)
            return f

        return add

    def put(self, name: str, f: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"two queries are named {name!r}")
        self.queries[name] = f
        if sql is not None:
            self.oracles[name] = sql
