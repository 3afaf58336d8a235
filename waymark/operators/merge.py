"""Merges by key: last values, patches, write-once fields, sources of an entity, duplicates of a key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import field, iso_millis, seconds

SOURCES = 20


def last_non_null(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """A row per key (nulls are a key): of each column the value that isn't null and comes last by `seq`. Combined before the shuffle."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*[field(k).alias(k) for k in keys]).agg(*[F.max_by(field(c), F.when(field(c).isNotNull(), field(seq))).alias(c) for c in values])


def last_row(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """A whole row per key, the last by `order`; nulls of it stay nulls."""
    whole = F.struct(*[field(c) for c in df.columns])
    rank = F.struct(F.lit(True), *order)
    return df.groupBy(*[field(k).alias(f"__wm_{k}") for k in keys]).agg(F.max_by(whole, rank).alias("__wm_row")).select("__wm_row.*")


def first_row(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """A whole row per key, the first by `order`."""
    whole = F.struct(*[field(c) for c in df.columns])
    return df.groupBy(*[field(k).alias(f"__wm_{k}") for k in keys]).agg(F.min_by(whole, F.struct(F.lit(True), *order)).alias("__wm_row")).select("__wm_row.*")


def patched(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """All rows of both by key; a value of the patch that isn't null wins. One row per key on both sides."""
    named = patch.select(field(key).alias("__wm_key"), *[field(c).alias(f"__wm_{c}") for c in patch.columns if c != key])
    joined = base.join(named, field(key) == F.col("__wm_key"), "full")
    out = [F.coalesce(field(key), F.col("__wm_key")).alias(key)]
    for c in dict.fromkeys([*base.columns, *patch.columns]):
        if c != key:
            out.append(F.coalesce(*[field(n) for n, there in ((f"__wm_{c}", c in patch.columns), (c, c in base.columns)) if there]).alias(c))
    return joined.select(*out)


def additions(base: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return rows.join(base.select(field(key).alias(key)), key, "left_anti")


def filled(base: DataFrame, rows: DataFrame, key: str, write_once: Iterable[str]) -> DataFrame:
    """The rows as a patch in which write-once fields that the entity already has (not null, not blank) are null."""
    once = [c for c in write_once if c in rows.columns and c in base.columns]
    kinds = dict(base.dtypes)
    named = base.select(field(key).alias("__wm_key"), *[present(field(c), kinds[c]).alias(f"__wm_{c}") for c in once])
    joined = rows.join(named, field(key) == F.col("__wm_key"), "left")
    return joined.select(*[F.when(~F.coalesce(field(f"__wm_{c}"), F.lit(False)), field(c)).alias(c) if c in once else field(c) for c in rows.columns])


def present(value: Column, kind: str) -> Column:
    """Whether a field counts as set: not null, NaN, blank, nor a list of nothing but such."""
    if kind == "string":
        return F.coalesce(F.trim(value) != "", F.lit(False))
    if kind in ("double", "float"):
        return F.coalesce(~F.isnan(value), F.lit(False))
    if kind == "array<string>":
        return F.coalesce(F.exists(value, lambda x: F.coalesce(F.trim(x) != "", F.lit(False))), F.lit(False))
    if kind.startswith("array"):
        return F.coalesce(F.size(F.filter(value, lambda x: x.isNotNull())) > 0, F.lit(False))
    return value.isNotNull()


def fields_present(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field): which fields each entity has set; grouped by field it is the reverse table."""
    kinds = dict(df.dtypes)
    some = F.array(*[F.when(present(field(f), kinds[f]), F.lit(f)) for f in fields])
    return df.select(field(key).alias(key), F.explode(F.filter(some, lambda x: x.isNotNull())).alias("field")).distinct()


def tally(events: DataFrame, seq: str, tracked: Iterable[str] = (), track_label: str | None = None, at: str = "updatedDate") -> DataFrame:
    """The latest time and collection type of each (entity, dataset, upstream source, event type).

    Columns of events: objectId, eventType, datasetName, upstreamSource, collectionType, `at`, `seq`. Track heads have the
    type 'empty', and no dataset nor upstream source (rows that do are left out); they count for `track_label`. Kinematic
    events of tracked feeds are left out, others are called passthrough. Of equal times the first by `seq` counts."""
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    rows = events.select("objectId", F.col("eventType").alias("e"), blank("datasetName").alias("d"), blank("upstreamSource").alias("u"), blank("collectionType").alias("c"), F.col(at).alias("at"), F.col(seq).alias("seq"))
    head = F.col("e") == "empty"
    kinematic = F.col("e") == "KINEMATIC_UPDATE"
    theirs = F.coalesce(F.col("d").isin(*list(tracked)), F.lit(False)) if list(tracked) else F.lit(False)
    keep = F.when(head, F.col("d").isNull() & F.col("u").isNull() & F.lit(track_label is not None)).otherwise(F.col("d").isNotNull() & ~(kinematic & theirs))
    rows = rows.filter((F.col("objectId") != "") & (F.col("e") != "") & keep)
    named = rows.select(
        "objectId",
        F.when(head, F.lit(track_label)).otherwise(F.col("d")).alias("datasetName"),
        "u",
        F.when(head, F.lit("TRACKER_KINEMATIC_UPDATE")).when(kinematic, F.lit("PASSTHROUGH_KINEMATIC_UPDATE")).otherwise(F.col("e")).alias("eventType"),
        "at",
        "c",
        "seq",
    )
    newest = F.struct("at", (-F.col("seq")).alias("s"))
    return named.groupBy("objectId", "datasetName", F.col("u").alias("upstreamSource"), "eventType").agg(F.max("at").alias("at"), F.max_by("c", newest).alias("collectionType"))


def merged_tally(a: DataFrame, b: DataFrame) -> DataFrame:
    """Of two tallies the later entry of each source; of equal ones the first's."""
    both = a.withColumn("__wm_old", F.lit(1)).unionByName(b.withColumn("__wm_old", F.lit(0)))
    keys = ("objectId", "datasetName", "upstreamSource", "eventType")
    newest = F.struct("at", "__wm_old")
    return both.groupBy(*keys).agg(F.max("at").alias("at"), F.max_by("collectionType", newest).alias("collectionType"))


def sources_array(tally_: DataFrame, most: int = SOURCES) -> DataFrame:
    """(objectId, sources): an entity's sources in order of dataset and event type, so that equal tallies give equal lists; the first `most`."""
    entry = F.struct(
        "datasetName",
        F.col("eventType").alias("eventType"),
        F.coalesce("upstreamSource", F.lit("")).alias("upstreamSource"),
        iso_millis(F.col("at")).alias("latestUpdatedDate"),
        "collectionType",
    )
    return tally_.groupBy("objectId").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, most).alias("sources"))


def id_duplicates(df: DataFrame, keys: Sequence[str], updated: str, id_col: str) -> DataFrame:
    """Rows to delete: of those with one key (no null or blank part) all but the one updated last, then with the largest id.

    By an aggregate and a join, not by sorted groups, so that a common key stays divided."""
    usable = df
    for k in keys:
        usable = usable.filter(F.trim(field(k).cast("string")) != "")
    rank = F.struct(field(updated).alias("u"), field(id_col).alias("i"))
    best = usable.groupBy(*[field(k).alias(f"__wm_{k}") for k in keys]).agg(F.max(rank).alias("__wm_best"), F.count(F.lit(1)).alias("__wm_n")).filter("__wm_n > 1")
    same = F.lit(True)
    for k in keys:
        same = same & (field(k) == F.col(f"`__wm_{k}`"))
    return usable.join(best, same).filter(~rank.eqNullSafe(F.col("__wm_best"))).select(*[field(c) for c in df.columns])


def coalesced_events(df: DataFrame, seq: str) -> DataFrame:
    """One row per (entity, event type, dataset, upstream source, collection type), nulls being a group, with the last value of each field."""
    return last_non_null(df, ["objectId", "eventType", "datasetName", "upstreamSource", "collectionType"], seq)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one doesn't have are null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*[field(c).alias(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))


def stable_sort(df: DataFrame, columns: Sequence[str], seq: str) -> DataFrame:
    """By the first time column that a row has a value in, then by arrival."""
    there = [field(c) for c in columns if c in df.columns]
    return df.orderBy(F.coalesce(*there).asc_nulls_last() if there else F.lit(0), field(seq))


def passes(df: DataFrame, key: str, seq: str, name: str = "pass_no") -> DataFrame:
    """Number of the pass a row is in if each pass takes one row per key, in order of `seq`."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(field(key)).orderBy(field(seq))) - 1)


def segments(df: DataFrame, key: str, at: str, max_gap_seconds: float, seq: str | None = None) -> DataFrame:
    """Adds dt (seconds since the row before, null at first) and segment, which grows after a gap that is too long."""
    order = [field(at)] + ([field(seq)] if seq else [])
    by_key = Window.partitionBy(field(key)).orderBy(*order)
    dt = seconds(field(at)) - F.lag(seconds(field(at))).over(by_key)
    rows = df.withColumn("dt", dt)
    return rows.withColumn("segment", F.sum(F.when(F.col("dt") > max_gap_seconds, 1).otherwise(0)).over(by_key.rowsBetween(Window.unboundedPreceding, 0)))


def first_changes(df: DataFrame, key: Sequence[str], signature: Column, *order: Column) -> DataFrame:
    """Rows whose signature differs from the one before of their key, the first included: state de-duplication without heartbeats."""
    w = Window.partitionBy(*[field(k) for k in key]).orderBy(*order)
    marked = df.withColumn("__wm_s", signature).withColumn("__wm_n", F.row_number().over(w)).withColumn("__wm_p", F.lag("__wm_s").over(w))
    return marked.filter((F.col("__wm_n") == 1) | ~F.col("__wm_s").eqNullSafe(F.col("__wm_p"))).drop("__wm_s", "__wm_n", "__wm_p")
