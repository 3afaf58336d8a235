"""Positions, velocities and uncertainty on the WGS-84 ellipsoid as column expressions (angles in radians, metres).

Everything is plain arithmetic, so that it stays within generated code; nulls propagate."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The ellipsoid's half axis and squared eccentricity; a 95 % ellipse's axis in standard deviations.
A = 6_378_137.0
E2 = 6.69437999014e-3
SIGMA_95 = 2.448
#: Areas (m^2, from square feet) up to which quality is 15, 14, ... 2.
QUALITY_FT2 = (1080, 3600, 14400, 64800, 252_000, 1_011_600, 39_600_000, 158_400_000, 972_000_000, 3_960_000_000, 8_892_000_000, 15_804_000_000, 24_696_000_000, 99_180_000_000)
FT2 = 0.092903


class Vector(NamedTuple):
    x: Column
    y: Column
    z: Column


class Covariance(NamedTuple):
    """Upper half of a symmetric 3 x 3 matrix."""

    xx: Column
    xy: Column
    xz: Column
    yy: Column
    yz: Column
    zz: Column


class Ellipse(NamedTuple):
    major: Column
    minor: Column
    orientation: Column


def to_ecef(latitude: Column, longitude: Column, altitude: Column) -> Vector:
    s, c = F.sin(latitude), F.cos(latitude)
    n = A / F.sqrt(1 - E2 * s * s)
    return Vector((n + altitude) * c * F.cos(longitude), (n + altitude) * c * F.sin(longitude), (n * (1 - E2) + altitude) * s)


def to_geodetic(p: Vector) -> Vector:
    """(latitude, longitude, altitude) by Bowring's formula; good to a millimetre near the ground."""
    b = A * math.sqrt(1 - E2)
    r = F.sqrt(p.x * p.x + p.y * p.y)
    theta = F.atan2(p.z * A, r * b)
    second = (A * A - b * b) / (b * b)
    latitude = F.atan2(p.z + second * b * F.pow(F.sin(theta), 3), r - E2 * A * F.pow(F.cos(theta), 3))
    s, c = F.sin(latitude), F.cos(latitude)
    n = A / F.sqrt(1 - E2 * s * s)
    # the projection on the normal, which holds at the poles too
    altitude = r * c + p.z * s - A * A / n
    return Vector(latitude, F.atan2(p.y, p.x), altitude)


def _axes(latitude: Column, longitude: Column) -> tuple[Vector, Vector, Vector]:
    """East, north and up as vectors of the earth-fixed frame."""
    sp, cp, sl, cl = F.sin(latitude), F.cos(latitude), F.sin(longitude), F.cos(longitude)
    return Vector(-sl, cl, F.lit(0.0)), Vector(-sp * cl, -sp * sl, cp), Vector(cp * cl, cp * sl, sp)


def enu_to_ecef(latitude: Column, longitude: Column, v: Vector) -> Vector:
    e, n, u = _axes(latitude, longitude)
    return Vector(*[e[k] * v.x + n[k] * v.y + u[k] * v.z for k in range(3)])


def ecef_to_enu(latitude: Column, longitude: Column, v: Vector) -> Vector:
    return Vector(*[dot(axis, v) for axis in _axes(latitude, longitude)])


def _quadratic(a: Vector, b: Vector, c: Covariance) -> Column:
    """a' C b."""
    return (
        a.x * (c.xx * b.x + c.xy * b.y + c.xz * b.z)
        + a.y * (c.xy * b.x + c.yy * b.y + c.yz * b.z)
        + a.z * (c.xz * b.x + c.yz * b.y + c.zz * b.z)
    )


def rotate_to_enu(latitude: Column, longitude: Column, c: Covariance) -> Covariance:
    e, n, u = _axes(latitude, longitude)
    return Covariance(*[_quadratic(a, b, c) for a, b in ((e, e), (e, n), (e, u), (n, n), (n, u), (u, u))])


def rotate_to_ecef(latitude: Column, longitude: Column, c: Covariance) -> Covariance:
    e, n, u = _axes(latitude, longitude)
    rows = [Vector(e[k], n[k], u[k]) for k in range(3)]
    return Covariance(*[_quadratic(rows[i], rows[j], c) for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))])


def ellipse_covariance(latitude: Column, longitude: Column, ellipse: Ellipse, vertical: float = 10_000.0) -> Covariance:
    """Earth-fixed covariance of a 95 % ellipse whose orientation runs clockwise from north."""
    a, b = F.pow(ellipse.major / SIGMA_95, 2), F.pow(ellipse.minor / SIGMA_95, 2)
    s, c = F.sin(ellipse.orientation), F.cos(ellipse.orientation)
    zero = F.lit(0.0)
    return rotate_to_ecef(latitude, longitude, Covariance(a * s * s + b * c * c, (a - b) * s * c, zero, a * c * c + b * s * s, zero, F.lit(vertical)))


def covariance_ellipse(east: Column, cross: Column, north: Column) -> Ellipse:
    """95 % ellipse of a horizontal covariance: the eigenvalues of a 2 x 2 matrix in closed form. Null if not finite."""
    mean, half = (east + north) / 2, (east - north) / 2
    spread = F.sqrt(half * half + cross * cross)
    angle = F.when(spread == 0, F.lit(0.0)).otherwise(F.atan2(2 * cross, east - north) / 2)
    azimuth = F.pmod(F.lit(math.pi / 2) - angle, F.lit(math.pi))
    good = ~F.isnan(spread) & ~F.isnan(mean)
    azimuth = F.when(azimuth >= 6.283185, F.lit(0.0)).otherwise(azimuth)
    return Ellipse(*[F.when(good, x) for x in (SIGMA_95 * F.sqrt(mean + spread), SIGMA_95 * F.sqrt(F.abs(mean - spread)), azimuth)])


def circular_area(major: Column, minor: Column) -> Column:
    return math.pi * 0.5625 * (major * major + minor * minor)


def track_quality(area: Column) -> Column:
    """15 for the smallest areas, down to 1; 0 for null, negative and what isn't finite."""
    out = F.when(area.isNull() | F.isnan(area) | (area < 0) | (area == float("inf")), 0)
    for k, limit in enumerate(QUALITY_FT2):
        out = out.when(area < limit * FT2, 15 - k)
    return out.otherwise(1).cast("long")


def course_velocity(speed: Column, course: Column) -> tuple[Column, Column]:
    """(east, north) of a speed and a course in radians clockwise from north."""
    return speed * F.sin(course), speed * F.cos(course)


def dot(a: Vector, b: Vector) -> Column:
    return a.x * b.x + a.y * b.y + a.z * b.z


def minus(a: Vector, b: Vector) -> Vector:
    return Vector(a.x - b.x, a.y - b.y, a.z - b.z)


def length(v: Vector) -> Column:
    return F.sqrt(dot(v, v))


def distance(a: Vector, b: Vector) -> Column:
    return length(minus(a, b))


def _cross(a: Vector, b: Vector) -> Vector:
    return Vector(a.y * b.z - a.z * b.y, a.z * b.x - a.x * b.z, a.x * b.y - a.y * b.x)


def _over(v: Vector, by: Column) -> Vector:
    return Vector(v.x / by, v.y / by, v.z / by)


def staged(df: DataFrame, name: str, v: Vector) -> tuple[DataFrame, Vector]:
    """The vector as columns of the frame, so that what uses it several times doesn't repeat how it is made."""
    names = [f"__wm_{name}_{n}" for n in "xyz"]
    return df.withColumns(dict(zip(names, v, strict=True))), Vector(*[F.col(n) for n in names])


def with_horizontal_basis(df: DataFrame, a: Vector, b: Vector) -> tuple[DataFrame, Vector, Vector]:
    """Two unit vectors across the radius of the midpoint; the x and y axes next to the earth's centre."""
    df, middle = staged(df, "m", Vector((a.x + b.x) / 2, (a.y + b.y) / 2, (a.z + b.z) / 2))
    df = df.withColumn("__wm_r", length(middle))
    r = F.col("__wm_r")
    df, up = staged(df, "u", _over(middle, F.when(r < 1, F.lit(1.0)).otherwise(r)))
    polar = F.abs(up.z) > 0.9
    df, seed = staged(df, "s", Vector(F.when(polar, 1.0).otherwise(0.0), F.lit(0.0), F.when(polar, 0.0).otherwise(1.0)))
    df, e = staged(df, "e", _cross(up, seed))
    df, e = staged(df, "f", _over(e, F.when(r < 1, F.lit(1.0)).otherwise(length(e))))
    df, n = staged(df, "n", _cross(up, e))

    def pick(v: Vector, axis: int) -> Vector:
        return Vector(*[F.when(r < 1, float(k == axis)).otherwise(v[k]) for k in range(3)])

    df, e = staged(df, "g", pick(e, 0))
    df, n = staged(df, "h", pick(n, 1))
    return df, e, n


def with_mahalanobis(df: DataFrame, name: str, a: Vector, b: Vector, c: Covariance, floor: Column | float = 0.0) -> DataFrame:
    """Adds the horizontal distance in standard deviations for the sum c of both covariances, each widened by the noise floor. Where
    there is no covariance, or it is singular: the distance over sqrt(2) times the floor, or over 100 m without a floor."""
    floor = F.lit(float(floor)) if isinstance(floor, (int, float)) else floor
    kept = df.columns
    df, e, n = with_horizontal_basis(df, a, b)
    df, d = staged(df, "d", minus(a, b))
    wide = 2 * floor * floor
    df = df.withColumns({"__wm_p": dot(e, d), "__wm_q": dot(n, d), "__wm_ee": _quadratic(e, e, c) + wide, "__wm_en": _quadratic(e, n, c), "__wm_nn": _quadratic(n, n, c) + wide})
    p, q, ee, en, nn = (F.col(f"__wm_{x}") for x in ("p", "q", "ee", "en", "nn"))
    det = ee * nn - en * en
    plain = F.sqrt(p * p + q * q) / F.when(floor > 0, math.sqrt(2) * floor).otherwise(100.0)
    sigma = F.coalesce(F.when(F.abs(det) > 0, F.sqrt((nn * p * p - 2 * en * p * q + ee * q * q) / det)), plain)
    return df.select(*[F.col("`" + k + "`") for k in kept], sigma.alias(name))
