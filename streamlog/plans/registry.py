"""Queries by name, each with the SQL it must agree with, if SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixture import L_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name. The SQL may use ``l``, the log, and ``b``, its bounds."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"WITH RECURSIVE {L_SQL}{', ' if not sql.lstrip().upper().startswith('SELECT') else ' '}{sql.strip()}"
        return f

    return register
