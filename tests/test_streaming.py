import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_tracks import frame, sample
from waymark.operators import tracks
from waymark.sources.feeds import report_stream
from waymark.sources.tables import KeyedSink
from waymark.streaming import stateful
from waymark.streaming.ownership import PrincipalOwnership


def run_stream(spark, df, cut, make, tmp_path, name):
    """The rows of `make` over a stream that gets the frame in parts."""
    folder = str(tmp_path / name)
    for k, part in enumerate(cut):
        df.filter(part).coalesce(1).write.parquet(f"{folder}/in/{k}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    query = make(stream).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_component_stream_equals_batch(spark, tmp_path):
    df = frame(spark, [r for r in sample(4, 12)])
    cut = [F.col("seq") < 4, (F.col("seq") >= 4) & (F.col("seq") < 9), F.col("seq") >= 9]
    got = run_stream(spark, df, cut, stateful.component_stream, tmp_path, "c").toPandas().sort_values(["track", "seq"])
    whole = tracks.component_tracks(df).toPandas().sort_values(["track", "seq"])
    assert len(got) == len(whole)
    np.testing.assert_allclose(got[list(tracks.OUT)].to_numpy(), whole[list(tracks.OUT)].to_numpy(), rtol=1e-9)
    batch = stateful.principal_stream(df).count()
    assert batch == tracks.filtered(df, stateful.Filter(principal=True, method="ci"), stateful.kalman.PRINCIPAL_NOISE, 0.5).count()


def test_heads_seed_a_stream(spark):
    df = frame(spark, sample(3, 10)).withColumn("head", F.lit(False))
    first, rest = df.filter("seq < 5"), df.filter("seq >= 5")
    heads = tracks.heads(tracks.component_tracks(first)).select("track", "t", "seq", "environment", *tracks.MEASURED).withColumn("head", F.lit(True))
    on = stateful.component_stream(heads.unionByName(rest)).toPandas().sort_values(["track", "seq"])
    whole = tracks.component_tracks(df.drop("head")).filter("seq >= 5").toPandas().sort_values(["track", "seq"])
    assert on["seq"].tolist() == whole["seq"].tolist()
    np.testing.assert_allclose(on["x"], whole["x"], rtol=1e-3)


def emitted(rows, wait, every):
    out, last, since, n = [], None, 0.0, 0
    for seq, state, at in rows:
        if state != last:
            last, since, n = state, at, 0
            out.append(seq)
            continue
        n += 1
        if wait > 0 and at - since >= wait or 0 < every <= n:
            since, n = at, 0
            out.append(seq)
    return out


@pytest.mark.parametrize(("seconds", "every"), [(0, 0), (0, 3), (0, 100), (1e9, 3)])
def test_states_with_heartbeats(spark, tmp_path, seconds, every):
    states = "aaaabaaaaaabbbbbbbbbbaab"
    rows = [("k", i, s, i * 10.0) for i, s in enumerate(states)]
    df = spark.createDataFrame(rows, "k string, seq int, state string, t double").withColumn("at", F.col("t").cast("timestamp")).drop("t")
    make = lambda d: stateful.changed_states(d, ["k"], ["state"], heartbeat_seconds=seconds, heartbeat_every=every)
    expected = emitted([(i, s, i * 10.0) for _, i, s, _ in rows], seconds, every)
    assert sorted(r["seq"] for r in make(df).collect()) == expected
    if every == 3 and not seconds:
        got = run_stream(spark, df, [F.col("seq") < 9, F.col("seq") >= 9], make, tmp_path, f"h{every}")
        assert sorted(r["seq"] for r in got.collect()) == expected


def test_exactly_at_the_count(spark):
    df = spark.range(102).selectExpr("'k' as k", "cast(id as int) seq", "'s' as state", "timestamp_seconds(0) as at")
    got = sorted(r["seq"] for r in stateful.changed_states(df, ["k"], ["state"], heartbeat_seconds=0).collect())
    assert got == [0, 100]


def test_time_heartbeat_is_spread_and_repeatable(spark):
    df = spark.range(2000).selectExpr("concat('k', id % 4) as k", "cast(id as int) seq", "'s' as state", "timestamp_seconds(id * 10) as at")
    make = lambda: sorted((r["k"], r["seq"]) for r in stateful.changed_states(df, ["k"], ["state"], heartbeat_seconds=400, heartbeat_every=0).collect())
    a = make()
    assert a == make()
    for k in range(4):
        mine = [s for n, s in a if n == f"k{k}"]
        gaps = np.diff(mine) * 10
        assert (gaps >= 300).all() and (gaps <= 540).all()


def test_rate_limit_streaks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([("k", i, float(t)) for i, t in enumerate([0, 5, 10, 11, 19, 20, 31])], "k string, seq int, t double").withColumn("at", F.col("t").cast("timestamp"))
    assert sorted(r["seq"] for r in stateful.rate_limited(df, "k", interval_seconds=10).collect()) == [0, 2, 5, 6]
    misses = spark.createDataFrame([("k", i, g) for i, g in enumerate([True, True, False, True, True, True, True])], "k string, seq int, gone boolean")
    make = lambda d: stateful.missing_streaks(d, "k", "gone")
    assert [r["seq"] for r in make(misses).collect()] == [5]
    assert [r["seq"] for r in run_stream(spark, misses, [F.col("seq") < 4, F.col("seq") >= 4], make, tmp_path, "m").collect()] == [5]
    sources = spark.createDataFrame([("o", "D", None, "S", f"c{i}", i, t) for i, t in enumerate([1, 1, 3, 2])], "objectId string, datasetName string, upstreamSource string, eventType string, collectionType string, seq int, t int").withColumn("at", F.timestamp_seconds("t")).drop("t")
    assert sorted(r["collectionType"] for r in stateful.latest_sources(sources).collect()) == ["c0", "c2"]


def test_reports_to_a_keyed_table(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n, lines in enumerate([[{"id": 1, "v": 1.0}, {"id": 2, "v": 2.0}], [{"id": 1, "v": None, "w": 5.0}]]):
        (folder / f"{n}.txt").write_text(json.dumps(lines) + "\nnot json\n")
    schema = spark.createDataFrame([], "id int, v double, w double").schema
    sink = KeyedSink(str(tmp_path / "out"), "id")
    stream = report_stream(spark, str(folder), schema, max_files=1).writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    stream.awaitTermination()
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, 1.0, 5.0), (2, 2.0, None)]


def test_ownership_over_batches(spark, tmp_path):
    """A superseded component moves to its root's track, keeps away from one of another environment, and starts anew when it is restored."""
    maps = [[], [("b", "a"), ("c", "a")], [("c", "a")]]
    names = ", ".join(f"{n} double" for n in tracks.MEASURED)
    nothing = [float("nan")] * (len(tracks.MEASURED) - 3)

    def events(number):
        rows = [(f"track-{item}", item, env, 100.0 * number + k, 10 * number + k, 1.0 + k, 2.0, 3.0, *nothing) for k, (item, env) in enumerate([("a", "AIR"), ("b", "air"), ("c", "GROUND")])]
        return spark.createDataFrame(rows, f"track string, item string, environment string, t double, seq long, {names}")

    now = []
    own = PrincipalOwnership(str(tmp_path / "own"), lambda: spark.createDataFrame(now, "id string, root string"), buckets=4)
    for number, now in enumerate(maps):
        own(events(number), number)
        if number == 1:
            own(events(number), number)  # a batch that is run again
    changed = [{tuple(r) for r in spark.read.parquet(f"{tmp_path}/own/changed/batch={n}").select("track", "principal").collect()} for n in range(3)]
    # c's environment isn't its root's
    assert changed == [{("track-a", "a"), ("track-b", "b"), ("track-c", "c")}, {("track-b", "a")}, {("track-b", "b")}]
    rows = spark.read.parquet(f"{tmp_path}/own/events")
    assert {r["track"] for r in rows.filter("reset").collect()} == {"a", "b"}
    assert {(r["root"], r["environment"]) for r in own.owners.read(spark).collect()} >= {("a", "AIR"), ("b", "AIR"), ("c", "GROUND")}
    # batch by batch through the filter: after the reset the tracks' states are new ones, with the measurement's own covariance
    cut = [F.col("batch") == n for n in range(3)]
    fused = run_stream(spark, rows, cut, stateful.principal_stream, tmp_path, "p").toPandas().sort_values(["track", "seq"])
    assert fused["track"].tolist() == ["a"] * 4 + ["b"] * 2 + ["c"] * 3
    assert fused[fused["track"] == "a"]["seq"].tolist() == [0, 10, 11, 20]
    restarted = stateful.principal_stream(rows.filter("batch = 2")).toPandas().set_index(["track", "seq"])
    for key in (("a", 20), ("b", 21)):
        np.testing.assert_allclose(fused.set_index(["track", "seq"]).loc[key][list(tracks.OUT)].astype(float), restarted.loc[key][list(tracks.OUT)].astype(float))


def test_keys_expire(spark, tmp_path):
    """A stream with expiry is one that goes on: it looks for what has expired without new data, so it has no end to wait for."""
    folder = str(tmp_path / "x")
    df = spark.createDataFrame([("k", i, float(i)) for i in range(6)], "k string, seq int, t double").withColumn("at", F.col("t").cast("timestamp"))
    df.coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    out = stateful.rate_limited(stream, "k", interval_seconds=2, expire_seconds=1)
    query = out.writeStream.format("memory").queryName("expiring").option("checkpointLocation", f"{folder}/check").trigger(processingTime="1 second").start()
    try:
        began, states = time.monotonic(), []
        while time.monotonic() - began < 120 and not (len(states) > 1 and max(states) == 1 and states[-1] == 0):
            time.sleep(0.5)
            progress = query.lastProgress
            if progress and progress["stateOperators"]:
                states.append(progress["stateOperators"][0]["numRowsTotal"])
        assert sorted(r["seq"] for r in spark.table("expiring").collect()) == [0, 2, 4] and states[-1] == 0
    finally:
        query.stop()
