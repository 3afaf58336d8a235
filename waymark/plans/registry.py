"""Where query modules put their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) under its name, with the SQL that gives the same rows, if there is any."""

    def add(function):
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"{name} occurs twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def stamp(column: Column) -> Column:
    """A time as text, to compare across engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


#: The same in DuckDB.
STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
