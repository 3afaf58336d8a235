"""DuckDB SQL that says independently what the sequential operators compute: a filter as a recursion over each track's
measurements, and the comparison of two tracks on a common grid.

The filter takes the components of a measurement one by one, after decorrelating them, where the operator inverts matrices."""

from __future__ import annotations

import math

from waymark.functions import geo, kalman

#: Constant covariance of positions in the queries: xx, xy, xz, yy, yz, zz.
POSITION_COV = (400.0, 10.0, 0.0, 300.0, 5.0, 200.0)


def _decorrelating(xx: float, xy: float, xz: float, yy: float, yz: float, zz: float) -> list[float]:
    """Rows of the inverse of the covariance's lower triangular root: w11, w21, w22, w31, w32, w33."""
    l11 = math.sqrt(xx)
    l21, l31 = xy / l11, xz / l11
    l22 = math.sqrt(yy - l21 * l21)
    l32 = (yz - l31 * l21) / l22
    l33 = math.sqrt(zz - l31 * l31 - l32 * l32)
    w11, w22, w33 = 1 / l11, 1 / l22, 1 / l33
    w21, w32 = -l21 * w11 * w22, -l32 * w22 * w33
    return [w11, w21, w22, -(l31 * w11 + l32 * w21) * w33, w32, w33]


def _case(column: str, values: dict[str, float], default: float) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END::DOUBLE"


def _predicted() -> tuple[str, str]:
    mean = [f"m[{i}] + dt * m[{i + 3}]" for i in (1, 2, 3)] + [f"m[{i}]" for i in (4, 5, 6)]
    cov = []
    for i in range(6):
        for j in range(6):
            k = 6 * i + j + 1
            terms = [f"p[{k}]"]
            if i < 3:
                terms.append(f"dt * p[{k + 18}]")
            if j < 3:
                terms.append(f"dt * p[{k + 3}]")
            if i < 3 and j < 3:
                terms.append(f"dt * dt * p[{k + 21}]")
            if i % 3 == j % 3:
                terms.append("q * dt * dt * dt / 3" if i < 3 and j < 3 else "q * dt" if i >= 3 and j >= 3 else "q * dt * dt / 2")
            cov.append(" + ".join(terms))
    return f"[{', '.join(mean)}]", f"[{', '.join(cov)}]"


def _updated(source: str, h: dict[int, str], measured: str) -> str:
    """The state after one number of variance 1 that measures the sum of h[i] * component i."""
    ph = ", ".join(" + ".join(f"{c} * p[{6 * i + j + 1}]" for j, c in h.items()) for i in range(6))
    s = "1 + " + " + ".join(f"{c} * ph[{j + 1}]" for j, c in h.items())
    innovation = f"({measured} - (" + " + ".join(f"{c} * m[{j + 1}]" for j, c in h.items()) + "))"
    mean = ", ".join(f"m[{i + 1}] + ph[{i + 1}] * d / s" for i in range(6))
    cov = ", ".join(f"p[{6 * i + j + 1}] - ph[{i + 1}] * ph[{j + 1}] / s" for i in range(6) for j in range(6))
    return f"SELECT * EXCLUDE (ph, s, d) REPLACE ([{mean}] AS m, [{cov}] AS p) FROM (SELECT *, {s} AS s, {innovation} AS d FROM (SELECT *, [{ph}] AS ph FROM ({source})))"


def component_filter() -> str:
    """CTEs `ev` (measurements of the events table, numbered by track) and `k` (states: track, rank, seq, t, m, p); rank 0 is the start."""
    env = "['AIR', 'GROUND', 'SEA_SURFACE', 'SPACE', 'UNKNOWN'][user_id % 5 + 1]"
    wide = 1 / math.sqrt(kalman.FRESH_VARIANCE)
    fresh = "[" + ", ".join(str(kalman.FRESH_VARIANCE) if i == j else "0.0" for i in range(6) for j in range(6)) + "]"
    events = f"""SELECT user_id AS track, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rank, event_id * 2.5::DOUBLE AS t,
  {_case(env, kalman.COMPONENT_NOISE, kalman.COMPONENT_NOISE_DEFAULT)} AS q, event_id % 4 > 0 AS six,
  CASE WHEN event_id % 4 > 0 THEN 1 / sqrt({_case(env, kalman.VELOCITY_VARIANCE, kalman.VELOCITY_VARIANCE_DEFAULT)}) ELSE 0 END AS v,
  CASE WHEN event_id % 5 > 0 THEN {_decorrelating(*POSITION_COV)} ELSE {[wide, 0.0, wide, 0.0, 0.0, wide]} END AS w,
  [{geo.A} + user_id * 10 + value, event_id * 0.05::DOUBLE + event_id % 97, value * pi(), CASE WHEN event_id % 4 > 0 THEN value / 10 ELSE 0 END, CASE WHEN event_id % 4 > 0 THEN 2.0 ELSE 0 END, CASE WHEN event_id % 4 > 0 THEN 0.5 ELSE 0 END]::DOUBLE[] AS z
  FROM events"""
    mean, cov = _predicted()
    step = f"SELECT * REPLACE ({mean} AS m, {cov} AS p) FROM (SELECT e.*, e.t - k.t AS dt, k.m, k.p FROM k JOIN ev e ON e.track = k.track AND e.rank = k.rank + 1)"
    step = _updated(step, {0: "w[1]"}, "w[1] * z[1]")
    step = _updated(step, {0: "w[2]", 1: "w[3]"}, "(w[2] * z[1] + w[3] * z[2])")
    step = _updated(step, {0: "w[4]", 1: "w[5]", 2: "w[6]"}, "(w[4] * z[1] + w[5] * z[2] + w[6] * z[3])")
    for i in (3, 4, 5):
        step = _updated(step, {i: "v"}, f"v * z[{i + 1}]")
    return f"""ev AS MATERIALIZED ({events}),
k AS (SELECT track, 0::BIGINT AS rank, seq, t, z AS m, {fresh}::DOUBLE[] AS p FROM ev WHERE rank = 1
  UNION ALL SELECT track, rank, seq, t, CASE WHEN dt > {kalman.MAX_GAP} THEN z ELSE m END, CASE WHEN dt > {kalman.MAX_GAP} THEN {fresh}::DOUBLE[] ELSE p END FROM ({step}))"""


def geodetic_heads() -> str:
    """After `k`: CTE `f` (track, lat, lon, area) of the last state of each track."""
    b = geo.A * math.sqrt(1 - geo.E2)
    second = (geo.A**2 - b * b) / (b * b)
    quad = lambda u, v: " + ".join(f"{u}[{i + 1}] * c.p[{6 * i + j + 1}] * {v}[{j + 1}]" for i in range(3) for j in range(3))
    return f"""h AS (SELECT track, arg_max(m, rank) AS m, arg_max(p, rank) AS p FROM k WHERE rank > 0 GROUP BY track),
r AS (SELECT *, sqrt(m[1] * m[1] + m[2] * m[2]) AS r, atan2(m[2], m[1]) AS lon FROM h),
a AS (SELECT *, atan2(m[3] * {geo.A}, r * {b}) AS o FROM r),
l AS (SELECT *, atan2(m[3] + {second * b} * pow(sin(o), 3), r - {geo.E2 * geo.A} * pow(cos(o), 3)) AS lat FROM a),
c AS (SELECT *, [-sin(lon), cos(lon), 0] AS e, [-sin(lat) * cos(lon), -sin(lat) * sin(lon), cos(lat)] AS n FROM l),
s AS (SELECT track, lat, lon, {quad("e", "e")} AS ee, {quad("e", "n")} AS en, {quad("n", "n")} AS nn FROM c),
g AS (SELECT *, (ee + nn) / 2 AS mean, sqrt(pow((ee - nn) / 2, 2) + en * en) AS spread FROM s),
f AS (SELECT track, lat, lon, pi() * 0.5625 * {geo.SIGMA_95 ** 2} * (mean + spread + abs(mean - spread)) AS area FROM g)"""


def twins(hours: float) -> str:
    """CTEs `pts` (points of the twin tracks within the look-back) and `u` (one row a track and time, with the first and last point then)."""
    t = "1704067200 + (event_id // 12) * 4 + shift"
    return f"""raw AS (SELECT side || user_id AS track, user_id, event_id AS seq, ({t})::DOUBLE AS t, {geo.A} AS x, user_id * 200000 + event_id / 12 * 20 + shift * 5 + value % 3 AS y, shift::DOUBLE AS z
  FROM events, (VALUES ('a', 0), ('b', 2)) AS s(side, shift)),
pts AS (SELECT * FROM raw WHERE t >= (SELECT max(t) FROM raw) - {hours} * 3600),
u AS (SELECT track, t, arg_min(y, seq) AS y_first, arg_max(y, seq) AS y_last, any_value(x) AS x, any_value(z) AS z FROM pts GROUP BY track, t),
n AS (SELECT track, any_value(user_id) AS user_id, count(DISTINCT t) AS points, min(t) AS start, max(t) AS finish FROM pts GROUP BY track)"""


def evaluated(pairs: str, interval: float, extend: float, recent: float | None = None) -> str:
    """After `twins`: CTE `d` (a, b, tm, dx, dy, dz, mx, my, mz, ta, tb) for grid times of the pairs (a, b): differences of the positions, their
    middle, and the time from each nearest state; recent: the last seconds of the grid only."""
    sides = {s: f"""
v{s} AS (SELECT g.a, g.b, g.tm, max(t) FILTER (t <= tm) AS tp, arg_max(y_last, t) FILTER (t <= tm) AS yp, min(t) FILTER (t > tm) AS tn, arg_min(y_first, t) FILTER (t > tm) AS yn,
  min(t) AS t0, arg_min(y_first, t) AS y0, max(t) AS t1, any_value(u.x) AS x, any_value(u.z) AS z FROM g JOIN u ON u.track = g.{s} GROUP BY g.a, g.b, g.tm),
w{s} AS (SELECT a, b, tm, x, z, CASE WHEN tp IS NULL THEN y0 WHEN tn - tm < tm - tp THEN yn ELSE yp END AS y, tm - CASE WHEN tp IS NULL THEN t0 WHEN tn - tm < tm - tp THEN tn ELSE tp END AS dt
  FROM v{s} WHERE tm >= t0 - {extend} AND tm <= t1 + {extend})""" for s in "ab"}
    cut = "" if recent is None else f" WHERE tm >= finish - {recent}"
    return f"""pr AS ({pairs}),
sp AS (SELECT a, b, greatest(p.start, q.start) - {extend} AS start, least(p.finish, q.finish) + {extend} AS finish FROM pr JOIN n p ON p.track = a JOIN n q ON q.track = b),
gn AS (SELECT *, least(500, greatest(2, floor((finish - start) / {interval})::BIGINT + 1)) AS k FROM sp WHERE finish > start),
gi AS (SELECT a, b, start, finish, k, unnest(range(0, k)) AS i FROM gn),
g AS (SELECT * FROM (SELECT a, b, finish, CASE WHEN i = k - 1 THEN finish ELSE i * ((finish - start) / (k - 1)) + start END AS tm FROM gi){cut}),{sides["a"]},{sides["b"]},
d AS (SELECT a, b, tm, p.x - q.x AS dx, p.y - q.y AS dy, p.z - q.z AS dz, (p.x + q.x) / 2 AS mx, (p.y + q.y) / 2 AS my, (p.z + q.z) / 2 AS mz, p.dt AS ta, q.dt AS tb FROM wa p JOIN wb q USING (a, b, tm))"""


def agreeing(limits, hours: float) -> str:
    """CTEs up to `r`: the twin tracks that are duplicates, with what tells how well they agree (second generation: nearest states)."""
    pairs = f"SELECT p.track AS a, q.track AS b FROM n p JOIN n q ON p.user_id = q.user_id AND p.track < q.track AND least(p.points, q.points) >= {limits.points}"
    return f"""{twins(hours)}, {evaluated(pairs, limits.interval, limits.extend)},
e AS (SELECT a, b, sqrt(dx * dx + dy * dy + dz * dz) AS far, sqrt(greatest(0, dx * dx + dy * dy + dz * dz - pow(dx * mx + dy * my + dz * mz, 2) / (mx * mx + my * my + mz * mz)) / (20000 + ta * ta + tb * tb + 2 * {limits.noise_floor**2})) AS sigma FROM d),
s AS (SELECT a, b, count(*) AS c, median(far) AS separation, avg(sigma) AS sigma, stddev_pop(sigma) AS spread FROM e GROUP BY a, b),
r AS (SELECT a, b, sigma, separation, least(p.points, q.points) AS points, least(p.finish, q.finish) - greatest(p.start, q.start) AS overlap,
  0.4 * least(1.0, least(p.points, q.points) / 10) + 0.4 / (1 + spread / {limits.sigma}) + 0.2 AS confidence
  FROM s JOIN n p ON p.track = a JOIN n q ON q.track = b WHERE c >= {limits.points} AND separation <= {limits.separation} AND sigma <= {limits.sigma})"""
