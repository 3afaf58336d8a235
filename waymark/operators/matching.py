"""Reports to entities: matching, creation with defaults, enrichment, and the current-state table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions.scalars import field, finite, not_blank, uuid5_hex
from waymark.operators.mapping import CREATED, ENTITY, KEY, LABEL, LABEL_PATHS, TEMPLATE, keyed, label, with_prefixes, without_prefixes
from waymark.operators.merge import filled, last_non_null, last_row, patched
from waymark.sources.feeds import FeedSpec

KINEMATIC_PREFIXES = ("estimatedKinematics", "objectId", "source", "upstreamSource", "collectionType", "edhControlSet", "mode", "identity", "ecef", "positionCovariance")
CREATE_EXCLUDES = ("source", "upstreamSource", "collectionType", "header", "estimatedKinematics.uncertainty.uncertaintyEllipse", KEY, CREATED)
STATE_EXCLUDES = ("estimatedKinematics", "header", KEY, CREATED)
UPDATE_EXCLUDES = ("header", "source", "eventType", "positionCovariance", "velocityCovariance", "upstreamSource", "latestSource", "latestUpstreamSource", "collectionType")
POSITION, VELOCITY, ELLIPSE = "estimatedKinematics.position.", "estimatedKinematics.velocity.", "estimatedKinematics.uncertainty.uncertaintyEllipse."
TIME = "estimatedKinematics.kinematicsTimestamp"


def known_entities(entities: DataFrame, spec: FeedSpec, updated: str = "header.updatedDate") -> DataFrame:
    """Entities with an id, one row per id, and their keys for this feed."""
    if ENTITY not in entities.columns:
        entities = entities.withColumn(ENTITY, F.lit(None).cast("string"))
    order = [field(updated)] if updated in entities.columns else []
    rows = entities.filter(not_blank(field(ENTITY)).isNotNull())
    return keyed(last_row(rows, [ENTITY], *order), spec.destination_ids)


def match(events: DataFrame, entities: DataFrame, spec: FeedSpec) -> DataFrame:
    """Events by key with their entity's id, `created` where there was none; a left join, or inner for static feeds.

    A new id is the event's own if one is mapped, else the name-based one of the key. New entities get defaults."""
    by_key = last_row(known_entities(entities, spec).filter(field(KEY).isNotNull()), [KEY], field(ENTITY))
    known = [p for p in LABEL_PATHS if p in by_key.columns]
    prior = by_key.select(field(KEY).alias("__wm_key"), field(ENTITY).alias("__wm_id"), *[field(p).alias(p + "__label") for p in known])
    joined = events.join(prior, field(KEY) == F.col("__wm_key"), "left" if spec.dynamic else "inner")
    joined = joined.withColumn(CREATED, F.col("__wm_id").isNull())
    if any(t.destination == ENTITY for t in spec.targets):
        joined = joined.filter(~field(CREATED) | not_blank(field(ENTITY)).isNotNull())
        new = field(ENTITY).cast("string")
    else:
        new = uuid5_hex(field(KEY))
    joined = joined.withColumn(ENTITY, F.coalesce(F.col("__wm_id"), new)).drop("__wm_id", "__wm_key")
    for name, value in TEMPLATE.items():
        default = F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)
        current = field(name) if name in joined.columns else F.lit(None)
        joined = joined.withColumn(name, F.when(field(CREATED), F.coalesce(current, default)).otherwise(current))
    return joined.withColumn(LABEL, label(joined)).select(*[field(c) for c in joined.columns if not c.endswith("__label") and c != LABEL], field(LABEL))


def enrich(matched: DataFrame, enricher: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Fields that the enricher returns for created entities, by id or by key; what it knows wins over what was reported."""
    if enricher is None:
        return matched
    found = enricher(matched.filter(field(CREATED)).drop(CREATED))
    key = ENTITY if ENTITY in found.columns else KEY
    if key not in found.columns:
        raise ValueError(f"an enricher must keep {ENTITY} or {KEY}")
    fields = [c for c in found.columns if c not in (key, KEY, CREATED)]
    one = last_row(found, [key]).select(field(key).alias("__wm_k"), *[field(c).alias(f"__wm_{c}") for c in fields])
    joined = matched.join(one, field(key) == F.col("__wm_k"), "left")
    out = {c: field(c) for c in matched.columns}
    out |= {c: F.coalesce(field(f"__wm_{c}"), field(c)) if c in matched.columns else field(f"__wm_{c}") for c in fields}
    named = joined.select(*[c.alias(n) for n, c in out.items()])
    return named.withColumn(LABEL, label(named))


def outputs(matched: DataFrame, spec: FeedSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new entities, state events, kinematic events)."""
    created = without_prefixes(matched.filter(field(CREATED)), CREATE_EXCLUDES)
    state = without_prefixes(matched, STATE_EXCLUDES).withColumn("eventType", F.lit("STATE_UPDATE"))
    kinematic = with_prefixes(matched, KINEMATIC_PREFIXES).withColumn("eventType", F.lit("KINEMATIC_UPDATE"))
    return created, state, with_ecef(kinematic) if spec.convert_to_ecef else kinematic


def with_ecef(df: DataFrame) -> DataFrame:
    """Rows with a time and a finite position, with earth-fixed position, velocity and covariance; missing altitude and down speed are 0."""
    if not {TIME, POSITION + "latitude", POSITION + "longitude"} <= set(df.columns):
        return df.filter("false")
    # numbers as columns of their own, as each is used many times
    defaults = {POSITION + "latitude": None, POSITION + "longitude": None, POSITION + "altitude": 0.0, VELOCITY + "eastSpeed": None, VELOCITY + "northSpeed": None, VELOCITY + "downSpeed": 0.0, ELLIPSE + "semiMajorAxisLength": 1000.0, ELLIPSE + "semiMinorAxisLength": 1000.0, ELLIPSE + "orientation": 0.0}
    numbers = {}
    for name, default in defaults.items():
        value = finite(field(name).try_cast("double")) if name in df.columns else F.lit(None).cast("double")
        numbers[f"__wm_{name}"] = value if default is None else F.coalesce(value, F.lit(default))
    rows = df.withColumns(numbers)
    number = {name: field(f"__wm_{name}") for name in defaults}
    latitude, longitude, altitude = (number[POSITION + n] for n in ("latitude", "longitude", "altitude"))
    rows = rows.filter(field(TIME).isNotNull() & latitude.isNotNull() & longitude.isNotNull())
    out = {POSITION + "altitude": altitude}
    out |= {f"ecefPosition.{n}": c for n, c in zip("xyz", geo.to_ecef(latitude, longitude, altitude), strict=True)}
    if {VELOCITY + "eastSpeed", VELOCITY + "northSpeed"} <= set(df.columns):
        v = geo.enu_to_ecef(latitude, longitude, geo.Vector(number[VELOCITY + "eastSpeed"], number[VELOCITY + "northSpeed"], -number[VELOCITY + "downSpeed"]))
        out |= {f"ecefVelocity.{n}": c for n, c in zip(("dx", "dy", "dz"), v, strict=True)}
    if ELLIPSE + "semiMajorAxisLength" in df.columns:
        ellipse = geo.Ellipse(*[number[ELLIPSE + n] for n in ("semiMajorAxisLength", "semiMinorAxisLength", "orientation")])
        out |= {f"positionCovariance.{n}": c for n, c in geo.ellipse_covariance(latitude, longitude, ellipse)._asdict().items()}
    return rows.select(*[field(c) for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def tracked_state(heads: DataFrame) -> DataFrame:
    """Track heads as current kinematics: geodetic position, local velocity, uncertainty ellipse and quality from the earth-fixed ones.

    The time is the track's own; where a head has none it stays null."""
    times = [field(c) for c in ("interceptTimestamp", "trackUpdatedTimestamp") if c in heads.columns]
    rows = heads.filter(field("ecefPosition.x").isNotNull() | field("ecefPosition.y").isNotNull() | field("ecefPosition.z").isNotNull())
    rows, p = geo.staged(rows, "p", geo.to_geodetic(geo.Vector(*[field(f"ecefPosition.{n}") for n in "xyz"])))
    out = {TIME: times[0] if times else F.lit(None).cast("string"), POSITION + "latitude": p.x, POSITION + "longitude": p.y, POSITION + "altitude": p.z}
    if "ecefVelocity.dx" in heads.columns:
        rows, v = geo.staged(rows, "v", geo.ecef_to_enu(p.x, p.y, geo.Vector(*[field(f"ecefVelocity.{n}") for n in ("dx", "dy", "dz")])))
        out |= {VELOCITY + "eastSpeed": v.x, VELOCITY + "northSpeed": v.y, VELOCITY + "downSpeed": -v.z}
    if "positionCovariance.xx" in heads.columns:
        c = geo.rotate_to_enu(p.x, p.y, geo.Covariance(*[field(f"positionCovariance.{n}") for n in geo.Covariance._fields]))
        rows, local = geo.staged(rows, "c", geo.Vector(c.xx, c.xy, c.yy))
        rows, e = geo.staged(rows, "e", geo.Vector(*geo.covariance_ellipse(local.x, local.y, local.z)))
        base = POSITION + "uncertainty.uncertaintyEllipse."
        out |= {base + "semiMajorAxisLength": e.x, base + "semiMinorAxisLength": e.y, base + "orientation": e.z, "trackQuality": geo.track_quality(geo.circular_area(e.x, e.y))}
    keep = [c for c in heads.columns if c not in out and not c.startswith("estimatedKinematics")]
    return rows.select(*[field(c) for c in keep], *[c.alias(n) for n, c in out.items()])


def untracked_state(events: DataFrame) -> DataFrame:
    """Kinematic events of feeds without tracks as current kinematics, the ellipse below the position, with its quality."""
    kept = events.select(*[field(c) for c in events.columns if any(s in c for s in ("estimatedKinematics", "objectId", "edhControlSet"))])
    renamed = kept.select(*[field(c).alias(c.replace(ELLIPSE, POSITION + "uncertainty.uncertaintyEllipse.")) for c in kept.columns])
    base = POSITION + "uncertainty.uncertaintyEllipse."
    if {base + "semiMajorAxisLength", base + "semiMinorAxisLength"} <= set(renamed.columns):
        area = geo.circular_area(field(base + "semiMajorAxisLength").try_cast("double"), field(base + "semiMinorAxisLength").try_cast("double"))
        renamed = renamed.withColumn("trackQuality", geo.track_quality(area))
    return renamed


def current_state(entities: DataFrame, events: DataFrame, seq: str, tracked: Iterable[str] = (), sources: DataFrame | None = None, overwritable: Iterable[str] = ()) -> DataFrame:
    """The current-state table after a batch: heads ('empty'), state events and kinematic events of untracked feeds, in this order.

    Of each way the last values per entity are written; identity fields only where the entity has none. Entities that the
    table doesn't have are not made: their creation is `match`'s."""
    tracked = list(tracked)
    kind = field("eventType")
    ways = [
        tracked_state(events.filter(kind == "empty")) if "ecefPosition.x" in events.columns else None,
        without_prefixes(events.filter(kind == "STATE_UPDATE"), ("estimatedKinematics",)),
        untracked_state(events.filter((kind == "KINEMATIC_UPDATE") & (~field("source.datasetName").isin(*tracked) if tracked and "source.datasetName" in events.columns else F.lit(True))).withColumn("objectId.__seq", field(seq))),
    ]
    out = entities
    for way in ways:
        if way is None:
            continue
        rows = way.withColumnRenamed("objectId.__seq", seq) if "objectId.__seq" in way.columns else way
        rows = without_prefixes(rows, UPDATE_EXCLUDES)
        last = last_non_null(rows.filter(field(ENTITY).isNotNull()), [ENTITY], seq).drop(seq)
        once = [c for c in last.columns if c.startswith("identity") and c not in set(overwritable)]
        patch = filled(out, last, ENTITY, once).join(out.select(field(ENTITY).alias("__wm_e")), field(ENTITY) == F.col("__wm_e"), "left_semi")
        out = patched(out, patch, ENTITY)
    if sources is not None:
        out = out.drop("sources") if "sources" in out.columns else out
        out = out.join(sources.select(F.col("objectId").alias("__wm_o"), "sources"), field(ENTITY) == F.col("__wm_o"), "left").drop("__wm_o")
    return out


def apply_remote(entities: DataFrame, remote: DataFrame, key: str = ENTITY, status: str = "entityStatus") -> DataFrame:
    """A cache after news from elsewhere: dropped entities go, unknown ones are added, known ones stay as they are. A drop wins over an addition."""
    dropped = remote.filter(field(status) == "DROPPED").select(field(key).alias(key)).distinct()
    new = last_row(remote.filter(F.coalesce(field(status), F.lit("")) != "DROPPED"), [key])
    kept = entities.join(dropped, key, "left_anti")
    added = new.join(dropped, key, "left_anti").join(entities.select(field(key).alias(key)), key, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True)


def reconcile(entities: DataFrame, remote_ids: DataFrame, now: Column, updated: str = "header.updatedDate", safety_seconds: float = 10.0, key: str = ENTITY) -> DataFrame:
    """Entities that exist elsewhere too, or were updated so recently that a read may lag behind."""
    there = remote_ids.select(field(key).alias("__wm_id")).distinct()
    marked = entities.join(there, field(key) == F.col("__wm_id"), "left")
    fresh = now.cast("double") - field(updated).cast("timestamp").cast("double") < safety_seconds
    return marked.filter(F.col("__wm_id").isNotNull() | F.coalesce(fresh, F.lit(False))).drop("__wm_id")


def snapshot_is_safe(count: int | None, previous: int | None, observations: int) -> tuple[bool, int | None, int]:
    """(whether to prune by this snapshot, count to remember, observations): an empty one, or one under three quarters of the last,
    must be seen twice; None is a failed read."""
    if count is None:
        return False, previous, 0
    smaller = previous is not None and previous > 0 and count < previous * 0.75
    if ((count == 0 and previous != 0) or smaller) and observations < 1:
        return False, previous, observations + 1
    return True, count, 0
