"""Ageing: which entities and tracks are stale, by environment or by a query, and how many."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.scalars import field

#: Hours without an update after which an entity goes.
HOURS = {"AIR": 4.0, "GROUND": 24.0, "SEA_SURFACE": 48.0, "SEA_SUBSURFACE": 48.0, "SPACE": 168.0, "UNKNOWN": 24.0}


def hours_for(environment: Column, hours: Mapping[str, float] = HOURS) -> Column:
    """Null for an environment that isn't listed: such rows never age."""
    out = F.lit(None).cast("double")
    for name, value in hours.items():
        out = F.when(environment == name, F.lit(float(value))).otherwise(out)
    return out


def is_stale(environment: Column, updated: Column, now: Column, status: Column | None = None, hours: Mapping[str, float] = HOURS) -> Column:
    """Updated longer ago than its environment allows; not if CONFIRMED, nor without a status, a time, or a listed environment."""
    old = now.cast("double") - updated.cast("timestamp").cast("double") > hours_for(environment, hours) * 3600
    return F.coalesce(old if status is None else old & (status != "CONFIRMED"), F.lit(False))


def stale_entities(df: DataFrame, now: Column, environment: str = "identity.environment.environment", updated: str = "header.updatedDate", status: str | None = "entityStatus", hours: Mapping[str, float] = HOURS) -> DataFrame:
    return df.filter(is_stale(field(environment), field(updated), now, field(status) if status else None, hours))


def stale_tracks(df: DataFrame, now: Column, environment: str = "environment", updated: str = "trackUpdatedTimestamp", hours: Mapping[str, float] = HOURS) -> DataFrame:
    return stale_entities(df, now, environment, updated, None, hours)


def capped(df: DataFrame, cap: int, order: Column) -> DataFrame:
    """At most `cap` rows of a cycle, the oldest first: a limit that a caller asks for, not one of the engine's."""
    return df.orderBy(order).limit(cap)


def without_limit(sql: str) -> str:
    return re.sub(r"\s+limit\s+\d+\s*;?\s*$", "", sql.strip(), flags=re.IGNORECASE)


def query_rows(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows that a deletion query names, without the limit that its text may end with."""
    return spark.sql(without_limit(sql), **tables)


def count_where(df: DataFrame, where: Column | str = "true") -> int:
    return df.filter(where).count()
