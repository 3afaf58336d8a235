import hashlib
import math
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions.scalars import CONVERSIONS, correlation_key, entity_id_text, exact_long, id_text, identity_key, interval_seconds, label_list, md5_shard, normal_timestamp, normal_uuid, plain_key, uuid5_hex


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    ("value", "kind", "expected"),
    [
        ("123", "int", "123"), ("123.0D", "double", "123"), ("'123.0'", "string", "123"), ("'1.5'", "string", "1.5"), ("'abc.def'", "string", "abc.def"),
        ("9007199254740993L", "bigint", "9007199254740993"), ("double('NaN')", "double", ""), ("double('inf')", "double", ""), ("cast(null as string)", "string", ""),
        ("array(1)", "array<int>", ""), ("'1234567890123456789.0'", "string", str(int(1234567890123456789.0))), ("true", "boolean", "True"), ("' x '", "string", " x "), ("-0.5D", "double", "-0.5"),
    ],
)
def test_id_text(spark, value, kind, expected):
    assert one(spark, x=id_text(F.expr(value), kind))["x"] == expected


def test_entity_id_text_keeps_lists(spark):
    assert one(spark, x=entity_id_text(F.expr("array(1, 2)"), "array<int>"))["x"] == "[1,2]"


def test_keys(spark):
    df = spark.createDataFrame([("x", 1.0, ""), ("y", None, "z"), ("a-b", 2.5, "c")], "b string, a double, c string")
    kinds = dict(df.dtypes)
    got = df.select(correlation_key({"b": "string", "a": "double"}).alias("k"), identity_key(kinds).alias("i"), plain_key({"b": "string", "c": "string"}).alias("p")).collect()
    assert [r["k"] for r in got] == ["a-1_b-x", None, "a-2.5_b-a-b"]
    assert [r["i"] for r in got] == ["a:1-b:x", "b:y-c:z", "a:2.5-b:a-b-c:c"]
    assert [r["p"] for r in got] == ["b-x_c-", "b-y_c-z", "b-a-b_c-c"]


def test_names_and_shards(spark):
    names = ["a", "identity.callsign-X", "", "é", "x" * 300]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for r in df.select("n", uuid5_hex(F.col("n")).alias("u"), md5_shard(F.col("n"), 7).alias("s"), md5_shard(F.col("n"), 2_000_003).alias("t")).collect():
        assert r["u"] == uuid.uuid5(uuid.NAMESPACE_DNS, r["n"]).hex
        number = int(hashlib.md5(r["n"].encode()).hexdigest(), 16)
        assert (r["s"], r["t"]) == (number % 7, number % 2_000_003)


def test_exact_long(spark):
    for text, expected in [("12", 12), ("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -(2**63)), ("12.0", 12), ("x", None), (None, None), ("NaN", None)]:
        assert one(spark, x=exact_long(F.lit(text)))["x"] == expected
    for text in ("1.5", "9223372036854775808", "1e30"):
        with pytest.raises(Exception, match="isn't whole|beyond"):
            one(spark, x=exact_long(F.lit(text)))


def test_times(spark):
    for text, expected in [("2024-01-02T03:04:05.678Z", "2024-01-02T03:04:05.678Z"), ("2024-01-02 03:04:05", "2024-01-02T03:04:05.000Z"), ("2024-01-02T03:04:05+02:00", "2024-01-02T01:04:05.000Z"), ("1970-01-01T00:00:00Z", None), ("", None), ("never", None), (None, None)]:
        assert one(spark, x=normal_timestamp(F.lit(text)))["x"] == expected
    assert [interval_seconds(x) for x in ("150s", "2m", " 1H", "1d", 7, "1.5")] == [150, 120, 3600, 86400, 7, 1.5]
    with pytest.raises(ValueError):
        interval_seconds("inf")


def test_conversions(spark):
    def get(name, value):
        return one(spark, x=CONVERSIONS[name](F.lit(value)))["x"]

    assert get("ft_to_m", 1) == 0.3048 and get("knots_to_mps", 2.0) == pytest.approx(1.028888) and get("degrees_to_radians", 180) == pytest.approx(math.pi)
    assert get("alt_ge_0", -5.0) == 0 and get("alt_ge_0", 5.0) == 5 and math.isnan(get("convert_to_float", "x")) and get("convert_to_float", " 2 ") == 2
    assert [get("standardize_domain", x) for x in ("surface", "Subsurface", "air", "moon")] == ["SEA_SURFACE", "SEA_SUBSURFACE", "AIR", "UNKNOWN"]
    assert get("ms_to_ISO8601", 1700000000123) == "2023-11-14T22:13:20.123Z" == get("sec_to_ISO8601", 1700000000.123)
    assert all(one(spark, x=f(F.lit(None).cast("string")))["x"] is None for f in CONVERSIONS.values())
    assert one(spark, x=label_list(F.lit(" 1234, ,5678 "), "string"), y=label_list(F.array(F.lit("a"), F.lit(" ")), "array<string>"), z=label_list(F.lit(","), "string")) == ("1234,5678", "a", None)
    assert one(spark, x=normal_uuid(F.lit(" A-b-1 ")))["x"] == "Ab1"


def test_geodetic_round_trip(spark):
    """Poles, date line, equator, below and far above the ground."""
    angles = [-math.pi / 2, -1.2, -1e-9, 0.0, 0.7, math.pi / 2]
    points = [(a, b, h) for a in angles for b in (-math.pi, -1.0, 0.0, 2.5, math.pi) for h in (-1000.0, 0.0, 12_000.0, 40_000.0)]
    df = spark.createDataFrame(points, "a double, b double, h double")
    p = df.select("h", *[c.alias(n) for n, c in zip("xyz", geo.to_ecef(F.col("a"), F.col("b"), F.col("h")), strict=True)])
    back = p.select("*", *[c.alias(f"g{k}") for k, c in enumerate(geo.to_geodetic(geo.Vector(F.col("x"), F.col("y"), F.col("z"))))])
    again = geo.to_ecef(F.col("g0"), F.col("g1"), F.col("g2"))
    worst = back.agg(F.max(geo.distance(geo.Vector(F.col("x"), F.col("y"), F.col("z")), again)), F.max(F.abs(F.col("g2") - F.col("h")))).first()
    assert worst[0] < 1e-3 and worst[1] < 1e-3


def test_ellipse_round_trip_and_quality(spark):
    for latitude, major, minor, angle in [(0.5, 1000.0, 700.0, 0.3), (-1.2, 500.0, 500.0, 0.0), (0.0, 100.0, 1.0, math.pi / 2), (1.5, 10.0, 3.0, 2.9)]:
        at = (F.lit(latitude), F.lit(-2.0))
        c = geo.rotate_to_enu(*at, geo.ellipse_covariance(*at, geo.Ellipse(F.lit(major), F.lit(minor), F.lit(angle))))
        e = geo.covariance_ellipse(c.xx, c.xy, c.yy)
        r = one(spark, a=e.major, b=e.minor, o=e.orientation, u=c.zz)
        assert (r["a"], r["b"], r["u"]) == (pytest.approx(major), pytest.approx(minor), pytest.approx(10_000))
        if major != minor:
            assert math.cos(2 * (r["o"] - angle)) == pytest.approx(1, abs=1e-6)
    quality = [one(spark, q=geo.track_quality(F.lit(x).cast("double")))["q"] for x in (None, -1.0, float("nan"), float("inf"), 0.0, 100.0, 100.34, 1080 * 0.092903, 9e9, 99_180_000_000 * 0.092903)]
    assert quality == [0, 0, 0, 0, 15, 15, 14, 14, 2, 1]


def test_distances(spark):
    import numpy as np

    from waymark.operators.duplicates import horizontal_distance

    rng = np.random.default_rng(0)
    for floor in (0.0, 30.0):
        for p in (np.array([6.4e6, 10.0, 20.0]), np.array([0.0, 0.0, 6.4e6]), np.zeros(3)):
            q = p + rng.normal(size=3) * 50
            m = rng.normal(size=(3, 3))
            c = m @ m.T * 100
            upper = [float(c[i, j]) for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]
            df = spark.createDataFrame([(*map(float, p), *map(float, q), *upper)], ", ".join(f"{n} double" for n in ("ax", "ay", "az", "bx", "by", "bz", *geo.Covariance._fields)))
            a, b = (geo.Vector(*[F.col(k + n) for n in "xyz"]) for k in "ab")
            got = geo.with_mahalanobis(df, "d", a, b, geo.Covariance(*[F.col(n) for n in geo.Covariance._fields]), floor).first()
            assert got["d"] == pytest.approx(horizontal_distance(p[None], q[None], c[None], floor)[0], rel=1e-9)
    none = geo.Covariance(*[F.lit(None).cast("double")] * 6)
    far = geo.with_mahalanobis(spark.range(1), "d", geo.Vector(F.lit(6.4e6), F.lit(0.0), F.lit(0.0)), geo.Vector(F.lit(6.4e6), F.lit(300.0), F.lit(400.0)), none)
    assert far.columns == ["id", "d"] and far.first()["d"] == pytest.approx(5.0, rel=1e-3)


def test_years_of_five_digits_have_no_sign(spark):
    """As in SQL: the milliseconds of the last day of year 9999 and of the first of 10000."""
    df = spark.createDataFrame([(253402300799123,), (253402300800000,), (518307601000123,), (None,)], "ms long")
    got = [r[0] for r in df.select(CONVERSIONS["ms_to_ISO8601"](F.col("ms"))).collect()]
    expected = duckdb.sql("SELECT strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' FROM (VALUES (253402300799123), (253402300800000), (518307601000123), (NULL)) t(ms)").fetchall()
    assert got == [r[0] for r in expected] and got[1] == "10000-01-01T00:00:00.000Z"
