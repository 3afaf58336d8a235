import json

import pytest
from pyspark.sql import functions as F

from waymark.operators.hooks import HOOKS, frame_hook, insert_values, record_hook
from waymark.operators.mapping import compact_json, configured_fields, convert, domain_label, flatten, get_path, keyed, label, map_fields, move_fields, nest, prepare, remove_path, set_path, without_prefixes
from waymark.sources.feeds import ConfigError, bad_messages, dataset_name, feed_spec, load, not_tracked, parse_records, resolve, save

FEED = {
    "query": "select * from Feed_A where lat is not null",
    "origin_unique_ID_column": "hex",
    "destination_unique_ID_column": "identity.callsign",
    "correlation_type": "dynamic",
    "tracker": "kalman q=7.5",
    "unit_conversions": [{"origin_column": "alt", "unit_conversion": "ft_to_m"}, {"origin_column": "none", "unit_conversion": "ft_to_m"}, {"origin_column": "alt", "unit_conversion": "PLACEHOLDER"}],
    "origin_to_destination_mapping": [
        {"destination_column": "estimatedKinematics.position.altitude", "origin_column": "alt"},
        {"destination_column": "estimatedKinematics.position.latitude", "origin_column": "pos.lat"},
        {"destination_column": "identity.mmsiNumber", "origin_column": "mmsi"},
        {"destination_column": "eventTimestamp", "origin_column": "when"},
        {"destination_column": "identity.environment.environment", "literal": "AIR"},
        {"destination_column": "rank", "literal": "3", "type": "int"},
        {"destination_column": "gone", "origin_column": "missing"},
    ],
}


def frame(spark):
    rows = [(1, "a1", 100.0, (0.5,), "123.0", "2024-01-01T00:00:00Z", " AB-cd "), (2, "a1", None, (0.6,), None, "bad", None), (3, "  ", 1.0, (0.1,), None, None, None), (4, "b", 10.0, None, None, None, None)]
    return spark.createDataFrame(rows, "seq int, hex string, alt double, pos struct<lat:double>, mmsi string, when string, `header.uuid` string")


def test_prepare(spark):
    spec = feed_spec(FEED)
    assert (spec.name, spec.mode, spec.process_noise, spec.dynamic) == ("Feed_A", "tracked", 7.5, True)
    got = {r["key"]: r.asDict() for r in prepare(frame(spark), spec, "seq").collect()}
    assert set(got) == {"identity.callsign-a1", "identity.callsign-b"}
    a = got["identity.callsign-a1"]
    assert a["estimatedKinematics.position.altitude"] == pytest.approx(30.48) and a["estimatedKinematics.position.latitude"] == 0.6
    assert (a["identity.mmsiNumber"], a["eventTimestamp"], a["rank"], a["gone"], a["source.datasetName"], a["source.uuid"]) == (123, "2024-01-01T00:00:00.000Z", 3, None, "Feed_A", "ABcd")


def test_second_generation_mapping(spark):
    spec = feed_spec(FEED)
    moved = move_fields(flatten(frame(spark)), spec)
    assert "alt" not in moved.columns and "hex" in moved.columns and "gone" not in moved.columns and "rank" in moved.columns
    mapped = map_fields(flatten(frame(spark)), spec).withColumn("other", F.lit(1))
    assert "other" not in configured_fields(mapped, spec).columns


def test_bad_specs():
    with pytest.raises(ConfigError, match="twice"):
        feed_spec(FEED | {"origin_to_destination_mapping": [{"destination_column": "x"}, {"destination_column": "x"}]})
    with pytest.raises(ConfigError, match="identifying"):
        feed_spec(FEED | {"origin_unique_ID_column": "a,b"})
    assert dataset_name("SELECT a FROM  'My_Set' x") == "My_Set" and dataset_name("nothing") == "dataset_name_unknown"


def test_resolve_and_folder(tmp_path):
    shared, feeds = resolve({"update_chunk_size": 9, "object_dataset": "O"}, [FEED | {"create_chunk_size": 5}, FEED | {"disabled": "true"}])
    assert (shared["update_chunk_size"], shared["create_chunk_size"], shared["max_concurrent_writes"], len(feeds)) == (9, 5, 4, 1)
    with pytest.raises(ConfigError, match="agree"):
        resolve({}, [FEED | {"create_chunk_size": 5}, FEED | {"create_chunk_size": 6}])
    with pytest.raises(ConfigError, match="perspective"):
        resolve({}, [FEED | {"object_dataset": "O"}])
    assert [f.query for f in resolve({}, [FEED, FEED | {"focus": 1, "query": "select 1 from B"}])[1]] == ["select 1 from B"]
    save(str(tmp_path), {"A": FEED, "X_perspective_config": {"object_dataset": "O"}})
    shared, feeds = load(str(tmp_path))
    assert shared["object_dataset"] == "O" and feeds[0].name == "Feed_A"


def test_paths(spark):
    df = spark.createDataFrame([(1, (2, (3,)))], "a int, b struct<c:int,d:struct<e:int>>")
    flat = flatten(df)
    assert flat.columns == ["a", "b.c", "b.d.e"] and nest(flat).first() == df.first()
    assert df.select(get_path("b.d.e").alias("x")).first()["x"] == 3
    assert set_path(df, "b.d.f", F.lit(9)).first()["b"]["d"]["f"] == 9
    assert remove_path(df, "b.d").first()["b"].asDict() == {"c": 2} and remove_path(remove_path(df, "b.d"), "b.c").columns == ["a"]
    assert without_prefixes(flat, ["b.d"]).columns == ["a", "b.c"]
    empty = nest(flatten(spark.createDataFrame([(1, None)], "a int, b struct<c:int,d:struct<e:int>>")))
    assert empty.first()["b"] is None
    with pytest.raises(ConfigError):
        nest(spark.range(1).selectExpr("1 as a", "2 as `a.b`"))


def test_compact(spark):
    df = spark.createDataFrame([("x", " ", float("nan"), None, [], (None, ""))], "a string, b string, c double, d int, e array<int>, f struct<g:int,h:string>")
    assert json.loads(df.select(compact_json(df).alias("j")).first()["j"]) == {"a": "x"}
    assert json.loads(df.select(compact_json(df, drop_empty_lists=False).alias("j")).first()["j"]) == {"a": "x", "e": []}


def test_labels(spark):
    df = spark.createDataFrame([(None, " ", 12, None), ("C1", "V", None, "old"), (None, None, None, "old")], "`identity.callsign` string, `identity.vesselName` string, `identity.mmsiNumber` long, `identity.vesselName__label` string")
    assert [r[0] for r in df.select(label(df)).collect()] == ["12", "C1", "old"]
    rows = [("SEA_SURFACE", "T", 7, "H", None, None), ("SEA_SURFACE", "T", None, "H", None, None), ("AIR", None, None, None, " ", "B7"), ("GROUND", None, None, "H", None, None), ("SPACE", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "`identity.environment.environment` string, `identity.vesselTypeCode` string, `identity.navalPennant` long, `identity.hullNumber` string, `identity.callsign` string, `identity.airPlatformType` string")
    assert [r[0] for r in df.select(domain_label(df)).collect()] == ["T-7", "T", "B7", "H", "SPACE"]


def test_messages(spark):
    texts = ['{"a": 1}', '[{"a": 2}, {"a": 3}]', "", None, "not json", "[]", '{"a": null}', "3"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = spark.createDataFrame([], "a int").schema
    assert sorted(r["report"]["a"] for r in parse_records(df, schema).collect()) == [1, 2, 3]
    assert sorted(str(r["value"]) for r in bad_messages(df).collect()) == ["", "3", "None", "not json"]


def test_hooks(spark):
    df = spark.createDataFrame([(1_700_000_000_000, 1.5, "2024-01-01T00:00:00Z", 10.0, 90.0, 1.0, None, "FAILED", "hx"), (None, None, "2024-01-02T00:00:00Z", None, None, None, 2.0, "OK", None)],
        "now_ms long, seen_pos double, `header.createdDate` string, gs double, track double, lat double, lon double, `SystemStatus.MessageData.SystemState` string, hex string")
    for name in ("get_observation_time", "get_velocity", "set_measurement_errors", "set_edh", "set_description", "failed_destroyed", "get_velocity_open_sky", "fix_rtd_label", "placeholder_function", "format_header_uuid"):
        df = HOOKS[name](df, None, None)
    a, b = (r.asDict() for r in df.collect())
    assert a["observation_time_iso"] == "2023-11-14T22:13:18.500000Z" and b["observation_time_iso"] == "2024-01-02T00:00:00Z"
    assert a["eastSpeed"] == pytest.approx(10) and a["northSpeed"] == pytest.approx(0, abs=1e-12) and a["position_semiminor"] == 700
    assert a["customStatus"] == "DESTROYED" and b["customStatus"] is None and a["set_description"] == "UNKNOWN UNKNOWN->UNKNOWN (hx)" and a["defaultEDH"] == ["CLS:U"]
    assert HOOKS["drop_NaNs"](df, None, None).count() == 0
    with pytest.raises(KeyError):
        HOOKS["get_observation_time"](spark.range(1), None, None)
    entities = spark.createDataFrame([("S", 1.0), ("T", 2.0)], "`identity.callsign` string, lon double")
    got = insert_values(spark.createDataFrame([("S",), ("Z",)], "name string"), entities, "name", "identity.callsign", {"set_lon": "lon", "set_no": "nope"})
    assert sorted(map(tuple, got.collect())) == [("S", 1.0, None), ("Z", None, None)]


def test_unknown_conversion_and_tracked(spark):
    with pytest.raises(ConfigError):
        convert(frame(spark), feed_spec(FEED | {"unit_conversions": [{"origin_column": "alt", "unit_conversion": "nope"}]}))
    df = spark.createDataFrame([("KINEMATIC_UPDATE", "A"), ("KINEMATIC_UPDATE", "B"), ("KINEMATIC_UPDATE", None), ("STATE_UPDATE", "A"), (None, "A")], "e string, d string")
    assert [r["d"] for r in df.filter(not_tracked(F.col("e"), F.col("d"), ["A"])).collect()] == ["B", None, "A", "A"]
    assert keyed(df, ["nothing"]).filter("key is not null").count() == 0


def test_own_hooks(spark):
    spec = feed_spec(FEED | {"custom_functions": [{"function_name": "double"}, {"function_name": "PLACEHOLDER_x"}], "factor": 3})

    def double(records, options):
        return [r | {"alt": None if r["alt"] is None else r["alt"] * options["factor"]} for r in records if r["hex"] != "b"]

    hooks = {"double": record_hook(double)}
    # a record function keeps the flat columns that it is given
    flat = flatten(frame(spark)).drop("mmsi")
    got = hooks["double"](flat, None, spec)
    assert got.columns == flat.columns and sorted(str(r["alt"]) for r in got.collect()) == ["3.0", "300.0", "None"]
    assert set(r["key"] for r in prepare(frame(spark), spec, "seq", hooks).collect()) == {"identity.callsign-a1"}
    with pytest.raises(ConfigError):
        prepare(frame(spark), spec, "seq")
    with pytest.raises(Exception, match="list of dicts"):
        record_hook(lambda records, options: None)(flat, None, spec).collect()
    assert frame_hook(lambda pdf, options: pdf[["hex"]].head(1), "hex string")(flat.coalesce(1), None, spec).count() == 1
