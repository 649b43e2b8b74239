"""Named queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from filigree.sources.fixtures import Tables


@dataclass
class Catalog:
    """A set of named queries over the test tables."""

    runs: dict[str, Callable[[Tables], DataFrame]] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None):
        """Register the decorated function under ``name``."""

        def register(run: Callable[[Tables], DataFrame]):
            if name in self.runs:
                raise ValueError(f"{name} is registered twice")
            self.runs[name] = run
            if sql is not None:
                self.sql[name] = sql.strip()
            return run

        return register

    def callables(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        def bind(run):
            return lambda spark, folder: run(Tables(spark, folder))

        return {name: bind(run) for name, run in self.runs.items()}
