"""Registered queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(oracle: str | None = None) -> Callable[[Run], Run]:
    """Registers a function under its own name."""

    def register(run: Run) -> Run:
        if run.__name__ in QUERIES:
            raise ValueError(f"Query {run.__name__!r} is registered twice")
        QUERIES[run.__name__] = Query(run, oracle)
        return run

    return register
