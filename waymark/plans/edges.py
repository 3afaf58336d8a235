"""Queries on what lies at the edges: feed configuration, functions on raw reports, streams and the keyed sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions import geo, scalars
from waymark.functions.scalars import field
from waymark.operators import hooks, lineage, mapping, matching, merge, retention
from waymark.plans.registry import query
from waymark.plans.upkeep import management_events
from waymark.sources import feeds, tables
from waymark.sources.tables import table

#: A feed for each type of event.
PERSPECTIVE = {"perspective": "LIVE", "create_chunk_size": 500}
FEEDS = [
    {"query": "select * from 'view' where x", "origin_unique_ID_column": "a", "destination_unique_ID_column": "b", "tracker": "CV q=2.5", "update_chunk_size": 70, "state_heartbeat_seconds": 60},
    {"query": "SELECT * FROM click", "origin_unique_ID_column": "a, c", "destination_unique_ID_column": "b, d", "tracker": "Passthrough", "correlation_type": "Dynamic", "update_chunk_size": 70},
    {"query": "select 1 from `error`;", "origin_unique_ID_column": "a", "destination_unique_ID_column": "b", "tracker": " None "},
    {"query": "select 1 from signup", "origin_unique_ID_column": "a", "destination_unique_ID_column": "b", "disabled": "Yes"},
]


@query("SELECT event_id FROM events WHERE ts >= (SELECT ts FROM events WHERE event_id = 300) - INTERVAL 30 MINUTE")
def overlapped_rows(spark, folder):
    """Rows after a cursor and those shortly before it, for reads that lag."""
    e = table(spark, folder, "events")
    cursor = tables.next_cursor(e.filter("event_id = 300"), "ts", "event_id")
    return tables.since(e, "ts", "event_id", cursor, overlap_seconds=1800).select("event_id")


@query("""
SELECT c_custkey, c_name AS callsign, 'x-' || c_custkey AS note, c_acctbal AS speed, 'identity.callsign,identity.note.text,key,kinematics.speed' AS columns FROM customer
""")
def paths(spark, folder):
    """Values at paths read, set (with parents that aren't there) and removed (with parents left empty)."""
    c = table(spark, folder, "customer")
    df = c.select(F.col("c_custkey").alias("key"), F.struct(F.col("c_name").alias("callsign"), F.struct(F.col("c_nationkey").alias("code")).alias("origin")).alias("identity"), F.struct(F.col("c_acctbal").alias("speed")).alias("kinematics"))
    df = mapping.remove_path(mapping.set_path(df, "identity.note.text", F.concat(F.lit("x-"), field("key"))), "identity.origin.code")
    names = ",".join(sorted(mapping.flatten(df).columns))
    get = mapping.get_path
    return df.select(get("key").alias("c_custkey"), get("identity.callsign").alias("callsign"), get("identity.note.text").alias("note"), get("kinematics.speed").alias("speed"), F.lit(names).alias("columns"))


@query("""
SELECT event_id, user_id::VARCHAR AS kept, value AS moved, 'LIVE' AS literal, 'event_id,kinematics.altitude,mode,source.uuid,user_id' AS all_columns, 'kinematics.altitude,mode,source.uuid,user_id' AS configured FROM events
""")
def moved_fields(spark, folder):
    """Second generation of mapping, and its projection to what is configured."""
    e = table(spark, folder, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"), "value", F.lit("s").alias("source.uuid"))
    spec = feeds.feed_spec({"query": "select 1 from D", "origin_unique_ID_column": "user_id", "destination_unique_ID_column": "user_id", "origin_to_destination_mapping": [{"destination_column": "kinematics.altitude", "origin_column": "value"}, {"destination_column": "mode", "literal": "LIVE"}, {"destination_column": "unknown", "origin_column": "not there"}]})
    moved = mapping.move_fields(e, spec)
    configured = mapping.configured_fields(moved, spec)
    said = [F.lit(",".join(sorted(d.columns))) for d in (moved, configured)]
    return moved.select("event_id", field("user_id").alias("kept"), field("kinematics.altitude").alias("moved"), field("mode").alias("literal"), said[0].alias("all_columns"), said[1].alias("configured"))


@query(f"""
WITH e AS (SELECT event_id, radians(event_id % 89) AS lat, radians(user_id % 179) AS lon, coalesce(CASE WHEN event_id % 4 > 0 THEN value END, 0) AS h
  FROM events WHERE event_id % 11 > 0 AND event_id % 7 > 0 AND event_type <> 'error'),
n AS (SELECT *, {geo.A} / sqrt(1 - {geo.E2} * sin(lat) * sin(lat)) AS n FROM e)
SELECT event_id, round((n + h) * cos(lat) * cos(lon), 3) AS x, round((n + h) * cos(lat) * sin(lon), 3) AS y, round((n * (1 - {geo.E2}) + h) * sin(lat), 3) AS z FROM n
""")
def usable_positions(spark, folder):
    """Kinematic rows without a time or a finite position go; a missing altitude is 0."""
    e = table(spark, folder, "events")
    lat = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.radians(F.col("event_id") % 89))
    rows = e.select("event_id", lat.alias(matching.POSITION + "latitude"), F.when(F.col("event_id") % 7 > 0, F.radians(F.col("user_id") % 179)).alias(matching.POSITION + "longitude"),
        F.when(F.col("event_id") % 4 > 0, F.col("value")).alias(matching.POSITION + "altitude"), F.when(F.col("event_type") != "error", F.col("ts").cast("string")).alias(matching.TIME))
    return matching.with_ecef(rows).select("event_id", *[F.round(field(f"ecefPosition.{n}"), 3).alias(n) for n in "xyz"])


@query("""
SELECT * FROM (VALUES ('view', 'tracked', 2.5::DOUBLE, 60::DOUBLE, 1, FALSE, 500, 70, 4), ('click', 'passthrough', NULL, 300::DOUBLE, 2, TRUE, 500, 70, 4), ('error', 'bypass', NULL, 300::DOUBLE, 1, FALSE, 500, 70, 4))
  AS t(name, mode, noise, heartbeat, ids, dynamic, create_chunk, update_chunk, writes)
""")
def resolved_feeds(spark, folder):
    """Feeds as they run: shared values, those of the feeds, ways of their reports; a disabled feed is left out."""
    shared, specs = feeds.resolve(PERSPECTIVE, FEEDS)
    rows = [(s.name, s.mode, s.process_noise, s.heartbeat_seconds, len(s.origin_ids), s.dynamic, *(shared[k] for k in ("create_chunk_size", "update_chunk_size", "max_concurrent_writes"))) for s in specs]
    return spark.createDataFrame(rows, "name string, mode string, noise double, heartbeat double, ids int, dynamic boolean, create_chunk int, update_chunk int, writes int")


@query("SELECT CASE event_type WHEN 'view' THEN 'tracked' WHEN 'click' THEN 'passthrough' WHEN 'error' THEN 'bypass' END AS mode, count(*) AS n FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY 1")
def routed_reports(spark, folder):
    """Reports by the way that their feed's take."""
    _, specs = feeds.resolve(PERSPECTIVE, FEEDS)
    modes = F.create_map(*[F.lit(x) for s in specs for x in (s.name, s.mode)])
    routed = table(spark, folder, "events").withColumn("mode", F.try_element_at(modes, F.col("event_type"))).filter("mode is not null")
    return merge.frequency(routed, "mode")


@query("""
SELECT event_id, CASE event_type WHEN 'view' THEN 150 WHEN 'click' THEN 5400 WHEN 'error' THEN 172800 ELSE 7.5 END::DOUBLE AS seconds, event_type IN ('view', 'error') AS active FROM events
""")
def intervals_and_flags(spark, folder):
    """Intervals and flags of a configuration's text."""
    text = {"view": ("150s", "Yes"), "click": ("1.5h", "no"), "error": (" 2D ", "1"), "signup": ("7.5", "")}
    every = F.create_map(*[F.lit(x) for k, (interval, _) in text.items() for x in (k, scalars.interval_seconds(interval))])
    active = [k for k, (_, flag) in text.items() if scalars.is_true(flag)]
    e = table(spark, folder, "events")
    return e.select("event_id", F.coalesce(F.try_element_at(every, F.col("event_type")), F.lit(7.5)).alias("seconds"), F.col("event_type").isin(*active).alias("active"))


@query("""
SELECT event_id, row_number() OVER (ORDER BY coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, ts + INTERVAL 2 HOUR), event_id) AS place FROM events ORDER BY 2 LIMIT 500
""")
def first_sorted_reports(spark, folder):
    """The first 500 by the first time that a row has, then by arrival."""
    e = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("ts")).alias("observed"), F.expr("ts + interval 2 hours").alias("created"))
    first = merge.stable_sort(e, ["observed", "missing", "created"], "event_id").limit(500)
    # of 500 rows: their places in that order
    order = Window.orderBy(F.coalesce("observed", "created"), "event_id")
    return first.select("event_id", F.row_number().over(order).alias("place"))


@query("SELECT event_id FROM events WHERE event_type = 'view' AND user_id % 9 > 0 AND epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts) > 4 * 3600000000 ORDER BY ts LIMIT 50")
def capped_age_off(spark, folder):
    """The oldest 50 of what is stale: the cap of a cycle."""
    e = table(spark, folder, "events")
    now = F.lit(e.agg(F.max("ts")).first()[0]).cast("timestamp")
    rows = e.filter("event_type = 'view'").select("event_id", F.lit("AIR").alias("environment"), F.col("ts").alias("updated"), F.when(F.col("user_id") % 9 == 0, "CONFIRMED").otherwise("UNKNOWN").alias("entityStatus"))
    return retention.capped(retention.stale_entities(rows, now, "environment", "updated"), 50, F.col("updated")).select("event_id")


@query("""
SELECT event_id, CASE WHEN event_id % 5 > 0 THEN event_id * 1000 - value * 1000 END AS observed_ms,
  CASE WHEN event_id % 5 > 0 THEN strftime(make_timestamp(round((event_id * 1000 - value * 1000) * 1000)::BIGINT), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' ELSE 'created' END AS observed_iso,
  round(value * sin(radians(user_id)), 6) + 0.0 AS east, round(value * cos(radians(user_id)), 6) + 0.0 AS north,
  CASE WHEN event_id % 3 > 0 THEN value ELSE 1000 END AS semimajor, 700.0::DOUBLE AS semiminor, 0.0::DOUBLE AS orientation,
  (CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'UNKNOWN' END || ' UNKNOWN->port ' || user_id || ' (' || event_id || ')')[1:50] AS description,
  user_id || ',b' AS label, CASE WHEN event_type = 'error' THEN 'DESTROYED' END AS status, 'CLS:U' AS control, 'UNKNOWN' AS model, replace('a-' || event_id, '-', '') AS uuid
FROM events WHERE event_id % 7 > 0 AND event_id % 11 > 0
""")
def hooked_reports(spark, folder):
    """The functions that a configuration can name, one after another."""
    e = table(spark, folder, "events")
    k, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    raw = e.select("event_id", F.when(k % 5 > 0, k * 1000).alias("now_ms"), value.alias("seen_pos"), F.lit("created").alias("header.createdDate"), F.concat(F.lit("a-"), k).alias("header.uuid"), value.alias("gs"), user.cast("double").alias("track"),
        F.when(k % 3 > 0, value).when(k % 3 == 0, F.lit(float("nan"))).alias("position_semimajor"), F.when(k % 2 == 0, F.col("event_type")).alias("kinematicallyInferredPlatformType"), F.concat(F.lit("port "), user).alias("kinematicallyInferredDestination"), k.cast("string").alias("hex"),
        F.concat(user, F.lit(" , b,,")).alias("vehicle.vehicle.label"), F.when(F.col("event_type") == "error", "FAILED").otherwise("OK").alias("SystemStatus.MessageData.SystemState"), F.when(k % 7 > 0, 1.0).alias("lat"), F.when(k % 11 > 0, 2.0).otherwise(F.lit(float("inf"))).alias("lon"))
    for name in ("placeholder_function", "get_observation_time", "format_header_uuid", "fix_rtd_label", "get_velocity", "set_measurement_errors", "drop_NaNs", "set_edh", "set_description", "failed_destroyed"):
        raw = hooks.HOOKS[name](raw, None, None)
    named = {"observed_ms": "observation_time_ms", "observed_iso": "observation_time_iso", "semimajor": "position_semimajor", "semiminor": "position_semiminor", "orientation": "position_orientation", "description": "set_description", "label": "intLabel", "status": "customStatus", "model": "aircraft.model", "uuid": "header.uuid"}
    return raw.select("event_id", *[field(c).alias(n) for n, c in named.items()], F.get("defaultEDH", F.lit(0)).alias("control"), *[(F.round(field(c), 6) + 0.0).alias(n) for n, c in (("east", "eastSpeed"), ("north", "northSpeed"))])


@query("""
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN user_id * 2::DOUBLE END AS latitude, CASE WHEN user_id % 2 = 0 THEN user_id * 3::DOUBLE END AS longitude FROM events
""")
def status_positions(spark, folder):
    """A status report gets the position of the entity that it names."""
    e = table(spark, folder, "events").select("event_id", F.concat(F.lit("cs"), "user_id").alias("SystemStatus.MessageData.SystemID.DescriptiveLabel"))
    users = table(spark, folder, "events").select("user_id").distinct().filter("user_id % 2 = 0")
    known = users.select(F.concat(F.lit("cs"), "user_id").alias("identity.callsign"), (F.col("user_id") * 2.0).alias("estimatedKinematics.position.latitude"), (F.col("user_id") * 3.0).alias("estimatedKinematics.position.longitude"))
    got = hooks.HOOKS["set_kinematics_system_status"](e, known, None)
    return got.select("event_id", F.col("set_lat").alias("latitude"), F.col("set_lon").alias("longitude"))


@query("""
WITH r AS (SELECT s_suppkey AS k FROM supplier WHERE NOT (s_suppkey % 4 < 2 OR s_suppkey % 12 = 2))
SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey NOT IN (SELECT k FROM r) THEN 'archived' ELSE 'live' END AS place FROM supplier
""")
def restored_archive(spark, folder):
    """Archived entities that are restored and not superseded since come back."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), (F.col("s_suppkey") % 3 == 0).alias("old"))
    events = management_events(spark, folder)
    live, archived = lineage.restore(s.filter("not old").select("id"), s.filter("old").select("id"), events, lineage.supersede_map(events), "id")
    return live.select("id", F.lit("live").alias("place")).unionByName(archived.select("id", F.lit("archived").alias("place")))


def _folder(spark: SparkSession, tag: str) -> str:
    """A new folder where all executors can write."""
    return f"{tables.shared_dir(spark)}/waymark-{tag}-{uuid.uuid4().hex}"


def _streamed(rows: DataFrame, tag: str, batches: int) -> tuple[DataFrame, str]:
    """The rows, written as that many files of JSON messages, as a stream that reads one file a batch."""
    spark, at = rows.sparkSession, _folder(rows.sparkSession, tag)
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).repartition(batches).write.text(f"{at}/in")
    return feeds.report_stream(spark, f"{at}/in", rows.schema, max_files=1), at


@query("SELECT event_id, user_id, value FROM events WHERE value > 5")
def streamed_reports(spark, folder):
    """Messages of files as a stream of reports, taken in several batches; none is dropped."""
    rows = table(spark, folder, "events").select("event_id", "user_id", "value")
    stream, at = _streamed(rows, "reports", 3)
    feeds.where(stream, "value > 5").writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{at}/out")


@query("SELECT user_id, count(*) FILTER (event_type = 'view') > 0 AS viewed, max(event_id) FILTER (event_type = 'click') AS click FROM events GROUP BY user_id")
def sinked_table(spark, folder):
    """A stream merged into a keyed table: per user the values last seen, whatever batch they came in."""
    e = table(spark, folder, "events")
    rows = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "click", F.col("event_id"))).alias("click")).select("user_id", "click", F.lit(None).cast("boolean").alias("viewed"))
    seen = e.groupBy("user_id").agg(F.max(F.col("event_type") == "view").alias("viewed")).select("user_id", F.lit(None).cast("long").alias("click"), "viewed")
    # two messages a user, in any of the batches
    stream, at = _streamed(rows.unionByName(seen), "sink", 3)
    sink = tables.KeyedSink(f"{at}/table", "user_id", buckets=8)

    def each(batch: DataFrame, number: int) -> None:
        sink(batch.groupBy("user_id").agg(F.max("click").alias("click"), F.max("viewed").alias("viewed")), number)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{at}/check").trigger(availableNow=True).start().awaitTermination()
    return sink.read(spark).select("user_id", "viewed", "click")
