"""The catalogue of queries: each is a function of (spark, sf_dir) and, where SQL can say the same, an oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its oracle."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load() -> None:
    """Import the families, which registers their queries."""
    from . import documents, fields, history, measures, stages  # noqa: F401
