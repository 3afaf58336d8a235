"""Queries on positions and tracks. There are no geographic tables: positions are made from keys by arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.operators import duplicates, matching, merge, spatial, tracks
from waymark.plans import filter_sql
from waymark.plans.registry import STAMP, query, stamp
from waymark.sources.tables import stored, table
from waymark.streaming import stateful

LATITUDE, LONGITUDE, ALTITUDE = "(c_custkey * 37 % 170 - 85) * pi() / 180", "(c_custkey * 91 % 359 - 179) * pi() / 180", "c_acctbal"
#: DuckDB: earth-fixed coordinates of latitude lat, longitude lon and altitude h.
_ECEF = f"""
g AS (SELECT c_custkey, {LATITUDE} AS lat, {LONGITUDE} AS lon, {ALTITUDE} AS h FROM customer),
p AS (SELECT *, {geo.A} / sqrt(1 - {geo.E2} * sin(lat) * sin(lat)) AS n FROM g),
x AS (SELECT *, (n + h) * cos(lat) * cos(lon) AS x, (n + h) * cos(lat) * sin(lon) AS y, (n * (1 - {geo.E2}) + h) * sin(lat) AS z FROM p)
"""
_AXES = "[-sin(lon), cos(lon), 0] AS e, [-sin(lat) * cos(lon), -sin(lat) * sin(lon), cos(lat)] AS n3, [cos(lat) * cos(lon), cos(lat) * sin(lon), sin(lat)] AS u"


def places(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer").select("c_custkey", F.expr(LATITUDE).alias("lat"), F.expr(LONGITUDE).alias("lon"), F.expr(ALTITUDE).alias("h"))
    return c.select("*", *[v.alias(n) for n, v in zip("xyz", geo.to_ecef(F.col("lat"), F.col("lon"), F.col("h")), strict=True)])


def _xyz(prefix: str = "") -> geo.Vector:
    return geo.Vector(*[F.col(prefix + n) for n in "xyz"])


@query(f"WITH {_ECEF} SELECT c_custkey, round(x, 3) AS x, round(y, 3) AS y, round(z, 3) AS z FROM x")
def ecef_positions(spark, folder):
    return places(spark, folder).select("c_custkey", *[F.round(n, 3).alias(n) for n in "xyz"])


@query(f"WITH {_ECEF} SELECT c_custkey, round(lat, 7) AS latitude, round(lon, 7) AS longitude, round(h, 2) AS altitude FROM x")
def geodetic_positions(spark, folder):
    """Back from earth-fixed coordinates."""
    g = geo.to_geodetic(_xyz())
    return places(spark, folder).select("c_custkey", F.round(g.x, 7).alias("latitude"), F.round(g.y, 7).alias("longitude"), F.round(g.z, 2).alias("altitude"))


@query(f"""
WITH {_ECEF}, v AS (SELECT *, h / 100 * sin(lon) AS east, h / 100 * cos(lon) AS north, c_custkey % 7 AS up, {_AXES} FROM x),
m AS (SELECT *, [e[i] * east + n3[i] * north + u[i] * up for i in [1, 2, 3]] AS d FROM v)
SELECT c_custkey, round(d[1], 5) + 0.0 AS dx, round(d[2], 5) + 0.0 AS dy, round(d[3], 5) + 0.0 AS dz, round(east, 5) + 0.0 AS east, round(north, 5) + 0.0 AS north, up::DOUBLE AS up FROM m
""")
def velocities(spark, folder):
    """Speed and course to local, to earth-fixed, and back."""
    east, north = geo.course_velocity(F.col("h") / 100, F.col("lon"))
    df = places(spark, folder).select("*", *[c.alias(n) for c, n in ((east, "ve"), (north, "vn"), ((F.col("c_custkey") % 7).cast("double"), "vu"))])
    df = df.select("*", *[c.alias(n) for n, c in zip(("vx", "vy", "vz"), geo.enu_to_ecef(F.col("lat"), F.col("lon"), geo.Vector(F.col("ve"), F.col("vn"), F.col("vu"))), strict=True)])
    back = geo.ecef_to_enu(F.col("lat"), F.col("lon"), geo.Vector(F.col("vx"), F.col("vy"), F.col("vz")))
    found = {"dx": F.col("vx"), "dy": F.col("vy"), "dz": F.col("vz"), "east": back.x, "north": back.y, "up": back.z}
    return df.select("c_custkey", *[(F.round(c, 5) + 0.0).alias(n) for n, c in found.items()])


@query(f"""
WITH {_ECEF}, v AS (SELECT *, 1000 + c_custkey AS major, 10 + c_custkey % 900 AS minor, (c_custkey % 314) / 100 AS o, {_AXES} FROM x),
w AS (SELECT *, pow(major / 2.448, 2) AS a, pow(minor / 2.448, 2) AS b FROM v),
l AS (SELECT *, a * sin(o) * sin(o) + b * cos(o) * cos(o) AS ee, (a - b) * sin(o) * cos(o) AS en, a * cos(o) * cos(o) + b * sin(o) * sin(o) AS nn FROM w),
c AS (SELECT *, [[e[i] * (ee * e[j] + en * n3[j]) + n3[i] * (en * e[j] + nn * n3[j]) + u[i] * 10000 * u[j] for j in [1, 2, 3]] for i in [1, 2, 3]] AS m FROM l)
SELECT c_custkey, round(m[1][1], 2) AS xx, round(m[1][2], 2) AS xy, round(m[1][3], 2) AS xz, round(m[2][2], 2) AS yy, round(m[2][3], 2) AS yz, round(m[3][3], 2) AS zz,
  round(major, 3)::DOUBLE AS major, round(minor, 3)::DOUBLE AS minor FROM c
""")
def ellipse_covariances(spark, folder):
    """An uncertainty ellipse to an earth-fixed covariance, and back to its axes."""
    k = F.col("c_custkey")
    ellipse = geo.Ellipse((1000 + k).cast("double"), (10 + k % 900).cast("double"), (k % 314) / 100)
    df = places(spark, folder)
    df = df.select("c_custkey", "lat", "lon", *[c.alias(n) for n, c in geo.ellipse_covariance(F.col("lat"), F.col("lon"), ellipse)._asdict().items()])
    local = geo.rotate_to_enu(F.col("lat"), F.col("lon"), geo.Covariance(*[F.col(n) for n in geo.Covariance._fields]))
    back = geo.covariance_ellipse(local.xx, local.xy, local.yy)
    return df.select("c_custkey", *[F.round(n, 2).alias(n) for n in geo.Covariance._fields], F.round(back.major, 3).alias("major"), F.round(back.minor, 3).alias("minor"))


_STEPS = " ".join(f"WHEN a < {limit * geo.FT2!r} THEN {15 - k}" for k, limit in enumerate(geo.QUALITY_FT2))


@query(f"""
WITH t AS (SELECT c_custkey, pi() * 0.5625 * (pow(abs(c_acctbal), 2) + pow(c_custkey, 2)) * CASE WHEN c_custkey % 50 = 0 THEN -1 ELSE 1 END AS a FROM customer)
SELECT c_custkey, CASE WHEN a < 0 THEN 0 {_STEPS} ELSE 1 END::BIGINT AS quality FROM t
""")
def track_quality(spark, folder):
    area = geo.circular_area(F.abs("c_acctbal"), F.col("c_custkey").cast("double"))
    sign = F.when(F.col("c_custkey") % 50 == 0, -1).otherwise(1)
    return table(spark, folder, "customer").select("c_custkey", geo.track_quality(area * sign).alias("quality"))


@query(f"""
WITH {_ECEF}, q AS (SELECT a.c_custkey, [a.x, a.y, a.z] AS p, [b.x, b.y, b.z] AS q FROM x a JOIN x b ON b.c_custkey = a.c_custkey + 170 * 359),
s AS (SELECT c_custkey, p, [p[1] + 120, p[2] - 80, p[3] + 40] AS q FROM (SELECT c_custkey, [x, y, z] AS p FROM x)),
m AS (SELECT *, [(p[i] + q[i]) / 2 for i in [1, 2, 3]] AS c FROM s), r AS (SELECT *, sqrt(list_sum([v * v for v in c])) AS r FROM m),
n AS (SELECT *, [v / r for v in c] AS u FROM r), k AS (SELECT *, CASE WHEN abs(u[3]) > 0.9 THEN [1, 0, 0] ELSE [0, 0, 1] END AS s FROM n),
e AS (SELECT *, [u[2] * s[3] - u[3] * s[2], u[3] * s[1] - u[1] * s[3], u[1] * s[2] - u[2] * s[1]] AS e0 FROM k), f AS (SELECT *, [v / sqrt(list_sum([w * w for w in e0])) for v in e0] AS e1 FROM e),
h AS (SELECT *, [u[2] * e1[3] - u[3] * e1[2], u[3] * e1[1] - u[1] * e1[3], u[1] * e1[2] - u[2] * e1[1]] AS n1, [p[i] - q[i] for i in [1, 2, 3]] AS d FROM f),
z AS (SELECT *, list_sum([e1[i] * d[i] for i in [1, 2, 3]]) AS de, list_sum([n1[i] * d[i] for i in [1, 2, 3]]) AS dn FROM h)
SELECT c_custkey, round(sqrt((de * de + dn * dn) / (2 * 2500 + 2 * 30 * 30)), 6) AS sigma, round(sqrt(list_sum([v * v for v in d])), 4) AS distance FROM z
""")
def mahalanobis_distances(spark, folder):
    df = places(spark, folder).select("c_custkey", "x", "y", "z", (F.col("x") + 120).alias("qx"), (F.col("y") - 80).alias("qy"), (F.col("z") + 40).alias("qz"))
    c = geo.Covariance(*[F.lit(v) for v in (5000.0, 0.0, 0.0, 5000.0, 0.0, 5000.0)])
    df = geo.with_mahalanobis(df, "sigma", _xyz(), _xyz("q"), c, 30.0)
    return df.select("c_custkey", F.round("sigma", 6).alias("sigma"), F.round(geo.distance(_xyz(), _xyz("q")), 4).alias("distance"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", "label", *[F.col("embedding")[k].cast("double").alias(n) for k, n in enumerate("xyz")])


@query("""
WITH v AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)), 6) AS distance
FROM v a JOIN v b ON a.vec_id < b.vec_id AND a.label = b.label AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 0.1 * 0.1
""")
def radius_pairs(spark, folder):
    got = spatial.radius_pairs(vectors(spark, folder), 0.1, "vec_id", group="label")
    return got.select(F.col("a_vec_id").alias("a"), F.col("b_vec_id").alias("b"), F.round("distance", 6).alias("distance"))


_SESSIONS = """
g AS (SELECT *, sum(CASE WHEN epoch_us(ts) - coalesce(epoch_us(before), 0) > 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)),
s AS (SELECT min(event_id) AS id, min(ts) AS start, max(ts) AS finish FROM g GROUP BY user_id, part)
"""


@query(f"WITH {_SESSIONS} SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.id < b.id AND epoch_us(a.finish) + 600000000 >= epoch_us(b.start) AND epoch_us(b.finish) + 600000000 >= epoch_us(a.start)")
def overlapping_spans(spark, folder):
    """Sessions of all users (events no further apart than two hours) that overlap when extended by five minutes at both ends."""
    parts = merge.segments(table(spark, folder, "events"), "user_id", "ts", 7200.0, "event_id")
    s = parts.groupBy("user_id", "segment").agg(F.min("event_id").alias("id"), F.min("ts").alias("start"), F.max("ts").alias("end"))
    return spatial.overlapping_spans(s.select("id", "start", "end"), "id", 3600.0, 300.0).select("a", "b")


@query("""
SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'click' AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 21600000000
""")
def time_aligned_pairs(spark, folder):
    e = table(spark, folder, "events")
    got = spatial.time_aligned(e.filter("event_type = 'view'"), e.filter("event_type = 'click'"), "ts", 21600, ["user_id"])
    return got.select(F.col("a_event_id").alias("a"), F.col("b_event_id").alias("b"))


@query("""
WITH v AS (SELECT * FROM events WHERE event_type = 'view'), q AS (SELECT * FROM events WHERE event_type = 'click')
SELECT q.event_id, (SELECT arg_max(v.event_id, v.ts) FROM v WHERE v.user_id = q.user_id AND v.ts <= q.ts) AS before, (SELECT arg_min(v.event_id, v.ts) FROM v WHERE v.user_id = q.user_id AND v.ts > q.ts) AS after FROM q
""")
def bracketing_points(spark, folder):
    """The points before and after each query, in one sorted pass."""
    e = table(spark, folder, "events")
    q = e.filter("event_type = 'click'")
    got = spatial.bracket(e.filter("event_type = 'view'"), q, "user_id", "ts", ["event_id"])
    return got.join(q.select("user_id", "ts", "event_id"), ["user_id", "ts"]).select("event_id", F.col("before.event_id").alias("before"), F.col("after.event_id").alias("after"))


_LOOSE = max(v.radius for v in duplicates.LIMITS.values())


@query(f"""
WITH p AS (SELECT c_custkey % 60 AS track, c_custkey::DOUBLE AS t, c_acctbal * 8 AS x, c_custkey % 97 * 400.0 AS y, c_nationkey * 300.0 AS z, ['AIR', 'GROUND', ''][c_custkey % 60 % 3 + 1] AS environment FROM customer)
SELECT a.track AS a, b.track AS b FROM p a JOIN p b ON a.environment = b.environment AND a.track < b.track AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= {_LOOSE**2}
GROUP BY a.track, b.track HAVING least(count(DISTINCT a.t), count(DISTINCT b.t)) >= {min(v.points for v in duplicates.LIMITS.values())}
""")
def candidate_pairs(spark, folder):
    """Tracks that come near each other at enough different times of each."""
    c = table(spark, folder, "customer")
    track = F.col("c_custkey") % 60
    points = c.select(track.alias("track"), F.col("c_custkey").cast("double").alias("t"), (F.col("c_acctbal") * 8).alias("x"), (F.col("c_custkey") % 97 * 400.0).alias("y"), (F.col("c_nationkey") * 300.0).alias("z"), F.element_at(F.array(F.lit("AIR"), F.lit("ground"), F.lit(None)), (track % 3 + 1).cast("int")).alias("environment"))
    return duplicates.candidates(points)


# ---- tracks: those without SQL are tested against loops ----


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """Events as measurements: a track per user, positions near a point of the equator moved by the running sum of values."""
    e = table(spark, folder, "events")
    offset = F.col("event_id") % 97
    env = F.element_at(F.array(*[F.lit(x) for x in ("AIR", "GROUND", "SEA_SURFACE", "SPACE", "UNKNOWN")]), (F.col("user_id") % 5 + 1).cast("int"))
    return tracks.measurements(
        e,
        track=F.col("user_id").cast("string"),
        at=F.expr("timestamp_micros(1704067200000000 + cast(event_id as bigint) * 2500000)"),
        seq=F.col("event_id"),
        environment=env,
        x=F.lit(geo.A) + F.col("user_id") * 10 + F.col("value"),
        y=F.col("event_id") * 0.05 + offset,
        z=F.col("value") * math.pi,
        dx=F.when(F.col("event_id") % 4 > 0, F.col("value") / 10),
        dy=F.lit(2.0),
        dz=F.lit(0.5),
        p_xx=F.when(F.col("event_id") % 5 > 0, 400.0),
        p_xy=F.lit(10.0),
        p_xz=F.lit(0.0),
        p_yy=F.lit(300.0),
        p_yz=F.lit(5.0),
        p_zz=F.lit(200.0),
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


_FILTER = filter_sql.component_filter()


@query(f"""
WITH RECURSIVE {_FILTER}
SELECT track::VARCHAR AS track, seq, round(m[1], 2) + 0.0 AS x, round(m[2], 2) + 0.0 AS y, round(m[3], 2) + 0.0 AS z, round(m[4], 3) + 0.0 AS dx, round(m[5], 3) + 0.0 AS dy, round(m[6], 3) + 0.0 AS dz,
  round(p[1]) + 0.0 AS p_xx, round(p[2]) + 0.0 AS p_xy, round(p[22], 1) + 0.0 AS v_dxdx, round(p[4]) + 0.0 AS c_xdx FROM k WHERE rank > 0
""")
def component_tracks(spark, folder):
    """A filter per track."""
    digits = {"x": 2, "y": 2, "z": 2, "dx": 3, "dy": 3, "dz": 3, "p_xx": 0, "p_xy": 0, "v_dxdx": 1, "c_xdx": 0}
    return tracks.component_tracks(measured(spark, folder)).select("track", "seq", *[(F.round(c, n) + 0.0).alias(c) for c, n in digits.items()])


@query()
def component_tracks_ci(spark, folder):
    return _rounded(tracks.component_tracks(measured(spark, folder), method="ci", second_generation=True))


@query("SELECT user_id::VARCHAR AS track, event_id AS seq, round(6378137.0 + user_id * 10 + value, 3) AS x FROM events")
def passthrough_tracks(spark, folder):
    return tracks.passthrough_tracks(measured(spark, folder)).select("track", "seq", F.round("x", 3).alias("x"))


def _components(spark: SparkSession, folder: str, track=tracks.component_tracks) -> DataFrame:
    """Component track events, every third user's track being superseded by the user before."""
    c = stored(track(measured(spark, folder)), "components")
    item = F.col("track")
    root = F.when(item.cast("int") % 3 == 1, (item.cast("int") - 1).cast("string")).otherwise(item)
    env = F.when(item.cast("int") % 3 == 1, F.when(item.cast("int") % 2 == 0, "AIR").otherwise("SPACE")).otherwise("AIR")
    return tracks.principal_keys(c.withColumn("item", item).withColumn("root", root).withColumn("environment", env))


@query()
def principal_tracks(spark, folder):
    """Fused by covariance intersection."""
    return _rounded(tracks.principal_tracks(_components(spark, folder)))


@query("""
WITH f AS (SELECT user_id, min(event_id) AS first FROM events GROUP BY user_id)
SELECT f.user_id::VARCHAR AS track, CASE WHEN f.user_id % 3 = 1 AND (f.user_id % 2 = 0 OR coalesce(f.first < g.first, TRUE)) THEN f.user_id - 1 ELSE f.user_id END::VARCHAR AS principal
FROM f LEFT JOIN f g ON g.user_id = f.user_id - 1
""")
def track_associations(spark, folder):
    """The fused track of each component: a superseded one of another environment keeps its own."""
    return tracks.associations(_components(spark, folder))


@query(f"""
SELECT user_id::VARCHAR AS track, max(event_id) AS seq, count(*) AS n_events, {STAMP.format("make_timestamp(1704067200000000 + min(event_id) * 2500000)")} AS originated,
  {STAMP.format("make_timestamp(1704067200000000 + max(event_id) * 2500000)")} AS updated FROM events GROUP BY user_id
""")
def track_heads(spark, folder):
    h = tracks.heads(tracks.component_tracks(measured(spark, folder)))
    at = lambda c: stamp(F.timestamp_micros((F.col(c) * 1_000_000).cast("long")))
    return h.select("track", "seq", "n_events", at("originated").alias("originated"), at("updated").alias("updated"))


@query(f"""
WITH RECURSIVE {_FILTER}, {filter_sql.geodetic_heads()}
SELECT track::VARCHAR AS entity, round(lat, 8) AS latitude, round(lon, 8) AS longitude, CASE WHEN area < 0 THEN 0 {_STEPS.replace("WHEN a <", "WHEN area <")} ELSE 1 END::BIGINT AS "trackQuality" FROM f
""")
def tracked_current_state(spark, folder):
    """Heads as geodetic positions with velocity, ellipse and quality."""
    h = tracks.heads(tracks.component_tracks(measured(spark, folder)))
    names = {"x": "ecefPosition.x", "y": "ecefPosition.y", "z": "ecefPosition.z", "dx": "ecefVelocity.dx", "dy": "ecefVelocity.dy", "dz": "ecefVelocity.dz"} | {f"p_{n}": f"positionCovariance.{n}" for n in tracks.POSITION_COV}
    flat = h.select(F.col("track").alias("objectId.uuid"), F.col("updated").cast("string").alias("trackUpdatedTimestamp"), *[F.col(k).alias(v) for k, v in names.items()])
    state = matching.tracked_state(flat)
    return state.select(F.col("`objectId.uuid`").alias("entity"), F.round("`estimatedKinematics.position.latitude`", 8).alias("latitude"), F.round("`estimatedKinematics.position.longitude`", 8).alias("longitude"), "trackQuality")


@query("""
WITH f AS (SELECT user_id, min(event_id) AS first FROM events GROUP BY user_id),
p AS (SELECT f.user_id, CASE WHEN f.user_id % 3 = 1 AND (f.user_id % 2 = 0 OR coalesce(f.first < g.first, TRUE)) THEN f.user_id - 1 ELSE f.user_id END AS principal FROM f LEFT JOIN f g ON g.user_id = f.user_id - 1),
m AS (SELECT principal, list(user_id::VARCHAR ORDER BY user_id::VARCHAR) AS members FROM p GROUP BY principal)
SELECT e.user_id::VARCHAR AS track, event_id AS seq, p.principal::VARCHAR AS principal, array_to_string(members, ',') AS components FROM events e JOIN p USING (user_id) JOIN m ON m.principal = p.principal
""")
def passthrough_principals(spark, folder):
    """Fused tracks that are their components' events."""
    got = tracks.passthrough_principals(_components(spark, folder, tracks.passthrough_tracks))
    return got.select("track", "seq", "principal", F.array_join("components", ",").alias("components"))


@query()
def smoothed_tracks(spark, folder):
    return _rounded(tracks.smoothed(measured(spark, folder)).select("track", "t", *tracks.STATE, "p_xx", "v_dxdx"))


def _twins(spark: SparkSession, folder: str) -> DataFrame:
    """Tracks of all users on a common clock, each twice: as it is, and staggered by a few seconds and metres."""
    e = table(spark, folder, "events")
    t = F.expr("timestamp_micros(1704067200000000 + (event_id div 12) * 4000000)")
    rows = [tracks.measurements(e, track=F.concat(F.lit(name), F.col("user_id")), at=t + F.expr(f"interval {shift} seconds"), seq=F.col("event_id"), environment=F.lit("SEA_SURFACE"), x=F.lit(geo.A), y=F.col("user_id") * 200_000 + F.col("event_id") / 12 * 20 + shift * 5 + F.col("value") % 3, z=F.lit(float(shift))) for name, shift in (("a", 0), ("b", 2))]
    return rows[0].unionByName(rows[1])


@query()
def duplicate_tracks(spark, folder):
    """Pairs that are one vessel by their motion, surest first."""
    return _rounded(duplicates.find(_twins(spark, folder)))


_SEA = duplicates.LIMITS["SEA_SURFACE"]
#: A shorter look-back than the usual one, as the tables' tracks don't last as long.
_HALF_HOUR = duplicates.LOOK_BACK_HOURS | {"SEA_SURFACE": 0.5}


def _nearest_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.find(_twins(spark, folder), second_generation=True, look_back=_HALF_HOUR)


@query(f"""
WITH {filter_sql.agreeing(_SEA, 0.5)}
SELECT a, b, 'SEA_SURFACE' AS environment, round(sigma, 4) AS sigma, round(separation, 4) AS separation, 0.0::DOUBLE AS velocity, points, round(overlap, 4) AS overlap, round(confidence, 4) AS confidence FROM r WHERE confidence >= {_SEA.confidence}
""")
def nearest_duplicates(spark, folder):
    """The same in the second generation's way, evaluated from the nearest states, within the look-back."""
    return _rounded(_nearest_duplicates(spark, folder))


@query(f"""
WITH {filter_sql.agreeing(_SEA, 0.5)}
SELECT CASE WHEN b = 'b3' THEN a ELSE b END AS "objectId", CASE WHEN b = 'b3' THEN b ELSE a END AS "supersededBy", 'SEA_SURFACE' AS environment, round(confidence, 4) AS confidence FROM r WHERE confidence >= {_SEA.confidence}
""")
def supersede_actions(spark, folder):
    """What is done about duplicates: the newer twin goes, unless it is confirmed."""
    ids = _twins(spark, folder).select(F.col("track").alias("id")).distinct()
    entities = ids.select("id", (F.col("id") == "b3").alias("confirmed"), F.when(F.startswith("id", F.lit("a")), F.lit("2024-01-01")).otherwise("2024-01-02").cast("timestamp").alias("created"))
    return _rounded(duplicates.decide(_nearest_duplicates(spark, folder), entities))


@query("""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM customer),
p AS (SELECT least(k, o) AS a, greatest(k, o) AS b, c FROM (SELECT DISTINCT c_custkey AS k, (c_custkey * 7 + 3) % n AS o, c_acctbal AS c FROM customer, n) WHERE k <> o),
s AS (SELECT a, b, c, CASE WHEN (a % 5 = 0) <> (b % 5 = 0) THEN CASE WHEN a % 5 = 0 THEN a ELSE b END ELSE a END AS stays FROM p WHERE NOT (a % 5 = 0 AND b % 5 = 0)),
g AS (SELECT stays::VARCHAR AS stays, CASE WHEN stays = a THEN b ELSE a END::VARCHAR AS goes, c FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY c DESC, goes, stays) AS i FROM (SELECT DISTINCT * FROM g)),
d AS (SELECT 0::BIGINT AS i, NULL::VARCHAR AS goes, NULL::VARCHAR AS stays, NULL::DOUBLE AS c, FALSE AS taken, []::VARCHAR[] AS locked
  UNION ALL SELECT r.i, r.goes, r.stays, r.c, NOT list_contains(locked, r.goes), CASE WHEN list_contains(locked, r.goes) THEN locked ELSE list_concat(locked, [r.goes, r.stays]) END FROM d JOIN r ON r.i = d.i + 1)
SELECT goes AS "objectId", stays AS "supersededBy", c AS confidence FROM d WHERE taken
""")
def greedy_actions(spark, folder):
    """Pairs that share entities, decided in order of confidence; confirmed entities never go."""
    c = table(spark, folder, "customer")
    n = c.count()
    other, k = (F.col("c_custkey") * 7 + 3) % n, F.col("c_custkey")
    # the smaller number stays where none is confirmed: it is the older
    pairs = c.filter(k != other).select(F.least(k, other).cast("string").alias("a"), F.greatest(k, other).cast("string").alias("b"), F.lit("AIR").alias("environment"), F.col("c_acctbal").alias("confidence"))
    entities = c.select(k.cast("string").alias("id"), (k % 5 == 0).alias("confirmed"), F.timestamp_seconds(k).alias("created"))
    return duplicates.decide(pairs, entities).select("objectId", "supersededBy", "confidence")


#: Of each three users the first two's twins are superseded by the first's track, and the third's by the one before it.
_RESTORED = f"""
WITH {filter_sql.twins(1e6)}, {filter_sql.evaluated("SELECT 'b' || user_id AS a, 'a' || (user_id - user_id % 3 // 2) AS b FROM (SELECT DISTINCT user_id FROM n) WHERE user_id % 3 > 0", _SEA.interval, _SEA.extend, _SEA.restore_seconds)},
c AS (SELECT a, b, finish FROM sp), e AS (SELECT a, b, sqrt(dx * dx + dy * dy + dz * dz) AS far FROM d),
o AS (SELECT c.a, c.b FROM c JOIN pts p ON p.track = c.a GROUP BY c.a, c.b HAVING count(*) FILTER (p.t >= finish - {_SEA.restore_seconds}) >= {_SEA.points}),
q AS (SELECT c.a, c.b FROM c JOIN pts p ON p.track = c.b GROUP BY c.a, c.b HAVING count(*) FILTER (p.t >= finish - {_SEA.restore_seconds}) >= {_SEA.points})
SELECT a AS "objectId", round(median(far), 4) AS separation FROM e JOIN o USING (a, b) JOIN q USING (a, b) GROUP BY a, b HAVING count(*) >= {_SEA.points} AND median(far) > {_SEA.restore_separation}
"""


@query(_RESTORED)
def restored_entities(spark, folder):
    """Superseded entities that have moved away from their survivor."""
    h = duplicates.histories(_twins(spark, folder), second_generation=True)
    user = F.col("user_id")
    root = F.when(user % 3 == 1, user).when(user % 3 == 2, user - 1)
    roots = table(spark, folder, "events").select("user_id").distinct().select(F.concat(F.lit("b"), user).alias("id"), F.concat(F.lit("a"), root).alias("root"))
    return _rounded(duplicates.parted(roots, h))


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, epoch_us(ts) / 1e6 AS now, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, 86400 + (user_id * 37 % 1000 / 1000 - 0.5) * 0.5 * 86400 AS wait FROM events),
h AS (SELECT user_id, event_id, event_type, n, now AS since, 0 AS repeats, TRUE AS told FROM e WHERE n = 1
  UNION ALL SELECT user_id, event_id, event_type, n, CASE WHEN told THEN now ELSE since END, CASE WHEN told THEN 0 ELSE repeats + 1 END, told
  FROM (SELECT e.*, h.since, h.repeats, e.event_type <> h.event_type OR now - h.since >= wait OR h.repeats + 1 >= 3 AS told FROM h JOIN e ON e.user_id = h.user_id AND e.n = h.n + 1))
SELECT user_id, event_id AS seq, event_type FROM h WHERE told
""")
def heartbeat_states(spark, folder):
    """Changed states and heartbeats."""
    e = table(spark, folder, "events").select("user_id", "event_type", F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    jitter = F.col("user_id") * 37 % 1000 / 1000
    return stateful.changed_states(e, ["user_id"], ["event_type"], heartbeat_seconds=86400, heartbeat_every=3, jitter=jitter).select("user_id", "seq", "event_type")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS now, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
r AS (SELECT user_id, event_id, n, now AS last, TRUE AS told FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.n, CASE WHEN e.now - last >= 43200000000 THEN e.now ELSE last END, e.now - last >= 43200000000 FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT user_id, event_id AS seq FROM r WHERE told
""")
def rate_limited_heads(spark, folder):
    e = table(spark, folder, "events").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    return stateful.rate_limited(e, "user_id", interval_seconds=43200).select("user_id", "seq")


@query("""
WITH m AS (SELECT event_id, user_id, event_type = 'error' AS gone FROM events),
g AS (SELECT *, sum(CASE WHEN gone THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS streak FROM m),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, streak, gone ORDER BY event_id) AS n FROM g)
SELECT user_id, event_id AS seq FROM n WHERE gone AND n = 3
""")
def missing_streaks(spark, folder):
    """Taken as deleted after three misses on end."""
    e = table(spark, folder, "events").select("user_id", (F.col("event_type") == "error").alias("gone"), F.col("event_id").alias("seq"))
    return stateful.missing_streaks(e, "user_id", "gone").select("user_id", "seq")
