import pytest
from pyspark.sql import functions as F

from waymark.operators import lineage, matching, merge, retention
from waymark.plans.entities import FEED_BY_CALLSIGN
from waymark.sources import tables


def test_last_non_null(spark):
    rows = [(1, "k", "a", None), (2, "k", None, 2), (3, "k", "", None), (1, None, "n", 7), (2, None, None, None)]
    df = spark.createDataFrame(rows, "seq int, k string, x string, y int")
    got = {r["k"]: (r["x"], r["y"], r["seq"]) for r in merge.last_non_null(df, ["k"], "seq").collect()}
    assert got == {"k": ("", 2, 3), None: ("n", 7, 2)}
    again = merge.last_non_null(merge.last_non_null(df, ["k"], "seq"), ["k"], "seq")
    assert {r["k"]: (r["x"], r["y"], r["seq"]) for r in again.collect()} == got
    assert {r["k"]: r["x"] for r in merge.last_row(df, ["k"], F.col("seq")).collect()} == {"k": "", None: None}


def test_patches_and_write_once(spark):
    base = spark.createDataFrame([(1, "a", None), (2, " ", 5), (3, None, 6)], "k int, name string, n int")
    patch = spark.createDataFrame([(1, "z", 9, "x"), (2, "y", None, None), (4, "new", 1, "w")], "k int, name string, n int, more string")
    got = {r["k"]: tuple(r)[1:] for r in merge.patched(base, patch, "k").collect()}
    assert got == {1: ("z", 9, "x"), 2: ("y", 5, None), 3: (None, 6, None), 4: ("new", 1, "w")}
    assert sorted(map(tuple, merge.patched(merge.patched(base, patch, "k"), patch, "k").collect())) == sorted((k, *v) for k, v in got.items())
    filled = {r["k"]: r["name"] for r in merge.filled(base, patch, "k", ["name"]).collect()}
    assert filled == {1: None, 2: "y", 4: "new"}
    assert merge.additions(base, patch, "k").collect()[0]["k"] == 4


def test_tally(spark):
    t = "2024-01-01 00:00:0"
    rows = [("o", "KINEMATIC_UPDATE", "A", None, "c1", t + "1", 1), ("o", "KINEMATIC_UPDATE", "T", None, "c2", t + "2", 2), ("o", "STATE_UPDATE", "A", "", "c3", t + "3", 3), ("o", "STATE_UPDATE", "A", None, "c4", t + "3", 4), ("o", "empty", None, None, None, t + "5", 5),
            ("o", "empty", "A", None, None, t + "6", 6), ("", "STATE_UPDATE", "A", None, None, t + "7", 7), ("p", None, "A", None, None, t + "8", 8), ("p", "STATE_UPDATE", None, None, None, t + "9", 9)]
    df = spark.createDataFrame(rows, "objectId string, eventType string, datasetName string, upstreamSource string, collectionType string, updatedDate string, seq int").withColumn("updatedDate", F.col("updatedDate").cast("timestamp"))
    got = sorted((r["datasetName"], r["eventType"], r["collectionType"]) for r in merge.tally(df, "seq", ["T"], "Tracks").collect())
    assert got == [("A", "PASSTHROUGH_KINEMATIC_UPDATE", "c1"), ("A", "STATE_UPDATE", "c3"), ("Tracks", "TRACKER_KINEMATIC_UPDATE", None)]
    assert merge.tally(df, "seq").count() == 3  # without a label heads don't count, without tracked feeds T does
    lists = merge.sources_array(merge.tally(df, "seq", ["T"], "Tracks"), most=2).first()["sources"]
    assert [s["datasetName"] for s in lists] == ["A", "A"] and lists[0]["latestUpdatedDate"] == "2024-01-01T00:00:01.000Z"


def test_id_duplicates(spark):
    df = spark.createDataFrame([(1, "x", 10), (2, "x", 20), (3, "x", 20), (4, None, 1), (5, None, 2), (6, " ", 1), (7, " ", 2), (8, "y", None)], "id int, k string, updated int")
    assert sorted(r["id"] for r in merge.id_duplicates(df, ["k"], "updated", "id").collect()) == [1, 2]


def test_supersede_chains(spark):
    rows = [("A", "SUPERSEDE", "B", 1), ("B", "SUPERSEDE", "C", 2), ("X", "SUPERSEDE", "Y", 1), ("Y", "SUPERSEDE", "X", 2), ("W", "SUPERSEDE", "X", 1), ("V", "SUPERSEDE", "W", 1), ("P", "SUPERSEDE", "Q", 1), ("Q", "DELETE", None, 2),
            ("R", "SUPERSEDE", "S", 1), ("R", "RESTORE", None, 2), ("N", "SUPERSEDE", None, 1), ("S1", "SUPERSEDE", "S1", 1), ("T", "DELETE", None, 3), ("T", "SUPERSEDE", "C", 1), (None, "DELETE", None, 1)]
    df = spark.createDataFrame(rows, "objectId string, action string, supersededBy string, updatedDate int")
    got = {r["id"]: r["root"] for r in lineage.supersede_map(df).collect()}
    assert got == {"A": "C", "B": "C", "X": "X", "Y": "Y", "W": "X", "V": "X", "P": None, "Q": None, "N": None, "S1": "S1", "T": None}
    again = lineage.resolve(lineage.supersede_map(df).withColumnRenamed("root", "target"))
    assert {r["id"]: r["root"] for r in again.collect()} == got
    later = spark.createDataFrame([("B", "RESTORE", None, 5), ("C", "SUPERSEDE", "D", 5)], df.schema)
    updated = {r["id"]: r["root"] for r in lineage.supersede_map(later, lineage.edges(df)).collect()}
    assert (updated["A"], updated["C"], updated["T"], "B" in updated) == ("B", "D", None, False)
    long = spark.range(300).selectExpr("cast(id as string) objectId", "'SUPERSEDE' action", "cast(id + 1 as string) supersededBy", "1 updatedDate")
    assert {r["root"] for r in lineage.supersede_map(long).collect()} == {"300"}
    rows = spark.createDataFrame([("A",), ("P",), ("Z",)], "objectId string")
    assert sorted((r["objectId"], r["superseded"]) for r in lineage.apply(rows, lineage.supersede_map(df)).collect()) == [("C", True), ("Z", False)]
    assert lineage.supersede_map(df.limit(0)).count() == 0


def test_equal_times_take_the_first(spark):
    df = spark.createDataFrame([("A", "SUPERSEDE", "B", 1, 0), ("A", "DELETE", None, 1, 1)], "objectId string, action string, supersededBy string, updatedDate int, seq int")
    assert lineage.supersede_map(df, seq="seq").first()["root"] == "B"


def test_archive_and_restore(spark):
    entities = spark.createDataFrame([("a", None), ("b", "CONFIRMED"), ("c", None), ("s", None), ("d", None)], "id string, entityStatus string")
    roots = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "gone"), ("d", None), ("s", "s")], "id string, root string")
    live, archived = lineage.archive(entities, entities.limit(0), roots, "id")
    assert sorted(r["id"] for r in live.collect()) == ["b", "c", "d", "s"] and [r["id"] for r in archived.collect()] == ["a"]
    events = spark.createDataFrame([("a", "RESTORE"), ("zz", "RESTORE")], "objectId string, action string")
    live, left = lineage.restore(live, archived, events, roots.filter("id <> 'a'"), "id")
    assert sorted(r["id"] for r in live.collect()) == ["a", "b", "c", "d", "s"] and left.count() == 0


def test_match_with_mapped_ids_and_labels(spark):
    from dataclasses import replace

    from waymark.sources.feeds import Target

    spec = replace(FEED_BY_CALLSIGN, targets=(Target("objectId.uuid", "u"),))
    events = spark.createDataFrame([("identity.callsign-x", "x", "U1", None), ("identity.callsign-y", "y", None, None), ("identity.callsign-z", "z", "U3", "S")], "key string, `identity.callsign` string, `objectId.uuid` string, mode string")
    entities = spark.createDataFrame([("E", "z"), ("", "x"), (None, "y")], "`objectId.uuid` string, `identity.callsign` string")
    got = {r["identity.callsign"]: (r["objectId.uuid"], r["created"], r["mode"]) for r in matching.match(events, entities, spec).collect()}
    assert got == {"x": ("U1", True, "LIVE"), "z": ("E", False, "S")}


def test_snapshot_guard():
    assert matching.snapshot_is_safe(None, 10, 1) == (False, 10, 0)
    assert matching.snapshot_is_safe(5, 10, 0) == (False, 10, 1) and matching.snapshot_is_safe(5, 10, 1) == (True, 5, 0)
    assert matching.snapshot_is_safe(0, None, 0) == (False, None, 1) and matching.snapshot_is_safe(0, 0, 0) == (True, 0, 0) and matching.snapshot_is_safe(8, 10, 0) == (True, 8, 0)


def test_kinematic_outputs(spark):
    df = spark.createDataFrame([("o", "2024", 0.5, 1.0, None, 3.0, 4.0, 100.0), ("p", None, 0.5, 1.0, None, None, None, None), ("q", "2024", float("nan"), 1.0, None, None, None, None)], "`objectId.uuid` string, `estimatedKinematics.kinematicsTimestamp` string, `estimatedKinematics.position.latitude` double, `estimatedKinematics.position.longitude` double, `estimatedKinematics.position.altitude` double, `estimatedKinematics.velocity.eastSpeed` double, `estimatedKinematics.velocity.northSpeed` double, `estimatedKinematics.uncertainty.uncertaintyEllipse.semiMajorAxisLength` double")
    rows = matching.with_ecef(df)
    assert [r["objectId.uuid"] for r in rows.collect()] == ["o"]
    back = matching.tracked_state(rows).first()
    assert back["estimatedKinematics.position.latitude"] == pytest.approx(0.5) and back["estimatedKinematics.velocity.eastSpeed"] == pytest.approx(3) and back["estimatedKinematics.velocity.northSpeed"] == pytest.approx(4)
    assert back["estimatedKinematics.position.uncertainty.uncertaintyEllipse.semiMajorAxisLength"] == pytest.approx(1000) and 0 < back["trackQuality"] < 15
    assert matching.with_ecef(df.select("`objectId.uuid`")).count() == 0


def test_age_off_edges(spark):
    now = "2024-01-02 00:00:00"
    rows = [("AIR", "2024-01-01 20:00:00", "U"), ("AIR", "2024-01-01 19:59:59", "U"), ("AIR", "2023-01-01 00:00:00", "CONFIRMED"), ("AIR", None, "U"), ("MOON", "2023-01-01 00:00:00", "U"), (None, "2023-01-01 00:00:00", "U"), ("GROUND", "2023-01-01 00:00:00", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, environment string, updated string, entityStatus string")
    at = F.lit(now).cast("timestamp")
    assert [r["id"] for r in retention.stale_entities(df, at, "environment", "updated").collect()] == [1]
    assert [r["id"] for r in retention.stale_tracks(df, at, "environment", "updated").collect()] == [1, 2, 6]
    assert retention.capped(df, 2, F.col("updated")).count() == 2 and retention.count_where(df, "id > 2") == 4
    assert retention.without_limit("select 1 from t LIMIT 50 ;") == "select 1 from t"
    marked, left, events = tables.two_phase_delete(df, retention.is_stale(F.col("environment"), F.col("updated"), at, F.col("entityStatus")), "id", "entityStatus")
    assert marked.first()["entityStatus"] == "DROPPED" and left.count() == 6 and events.first()["action"] == "DELETE"


def test_keyed_sink_is_idempotent(spark, tmp_path):
    sink = tables.KeyedSink(str(tmp_path / "state"), "k")
    assert sink.read(spark) is None
    rows = lambda *r: spark.createDataFrame(r, "k int, a string, b string")
    sink(rows((1, "x", None), (2, "y", None)), 0)
    sink(rows((1, None, "z"), (3, "w", None)), 1)
    sink(rows((1, "again", "again")), 1)  # a batch that was written already
    assert sorted(map(tuple, sink.read(spark).collect())) == [(1, "x", "z"), (2, "y", None), (3, "w", None)]
    for n in range(2, 6):
        sink(rows((9, str(n), None)), n)
    assert list(sink.versions(spark)) == [3, 4, 5]


def test_keyed_sink_writes_touched_buckets_only(spark, tmp_path):
    sink = tables.KeyedSink(str(tmp_path / "state"), "k", buckets=16, keep=2)
    sink(spark.range(200).selectExpr("id k", "'a' v"), 0)
    sink(spark.createDataFrame([(7, "b")], "k long, v string"), 1)
    manifest = sink.manifest(spark, 1)
    assert len(manifest) == 16 and list(manifest.values()).count(1) == 1
    got = {r["k"]: r["v"] for r in sink.read(spark).collect()}
    assert len(got) == 200 and got[7] == "b" and sum(v == "a" for v in got.values()) == 199
    # a draft that was never renamed is no version, and rows of a failed write are overwritten
    (tmp_path / "state" / "versions" / "_2").write_text("{")
    sink(spark.createDataFrame([(500, "c")], "k long, v string"), 2)
    assert list(sink.versions(spark)) == [1, 2] and sink.read(spark).count() == 201
