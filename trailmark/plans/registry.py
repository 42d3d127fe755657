"""The table of queries that the modules of this package fill."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import carriers as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(name: str, sql: str | None, *ctes: str):
    """Registers a function under a name, with its SQL after the named CTEs."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = (T.with_(*ctes) if ctes else "") + sql
        return f

    return keep


def r(x, digits: int = 6):
    return F.round(x, digits)
