"""Queries that map reports, find their entities and merge them. `events` stands for a report stream: user_id is the entity,
event_type the feed, ts the time, value a coordinate, event_id the order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import scalars
from waymark.functions.scalars import field
from waymark.operators import mapping, matching, merge
from waymark.operators.hooks import insert_values
from waymark.plans.registry import STAMP, query, stamp
from waymark.sources import feeds, tables
from waymark.sources.tables import table

FEED = feeds.feed_spec(
    {
        "query": "select * from Reports where value is not null",
        "origin_unique_ID_column": "user_id,event_type",
        "destination_unique_ID_column": "identity.dynamicIdentifier,identity.feed",
        "correlation_type": "dynamic",
        "unit_conversions": [{"origin_column": "value", "unit_conversion": "ft_to_m"}],
        "origin_to_destination_mapping": [
            {"destination_column": "estimatedKinematics.position.altitude", "origin_column": "value"},
            {"destination_column": "estimatedKinematics.kinematicsTimestamp", "origin_column": "ts"},
            {"destination_column": "identity.environment.environment", "literal": "AIR"},
            {"destination_column": "rank", "literal": "3", "type": "int"},
            {"destination_column": "identity.missing", "origin_column": "no_such_column"},
        ],
    }
)
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def reports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


@query(f"""
WITH e AS (SELECT *, 'identity.dynamicIdentifier-' || user_id || '_identity.feed-' || event_type AS key FROM events)
SELECT key, arg_max(value * 0.3048, event_id) AS altitude, arg_max({ISO.format('ts')}, event_id) AS kinematics_time, max('AIR') AS environment,
  max(3)::BIGINT AS rank, max('Reports') AS dataset, NULL::VARCHAR AS missing FROM e GROUP BY key
""")
def current_state(spark: SparkSession, folder: str) -> DataFrame:
    """Reports mapped by a feed's configuration, keyed, and merged to the last value of each field."""
    rows = mapping.prepare(reports(spark, folder), FEED, "event_id")
    return rows.select(
        "key",
        field("estimatedKinematics.position.altitude").alias("altitude"),
        field("estimatedKinematics.kinematicsTimestamp").alias("kinematics_time"),
        field("identity.environment.environment").alias("environment"),
        F.col("rank").cast("long").alias("rank"),
        field("source.datasetName").alias("dataset"),
        field("identity.missing").alias("missing"),
    )


@query(f"""
SELECT event_id, round(value * 0.3048, 6) AS metres, round(value * 0.514444, 6) AS mps, round(radians(value), 6) AS angle, CASE WHEN value - 10 < 0 THEN 0 ELSE round(value - 10, 6) END AS not_negative,
  {ISO.format('epoch_ms(event_id * 86399000 + 123)')} AS iso, value::VARCHAR AS text,
  CASE event_type WHEN 'view' THEN 'SEA_SURFACE' WHEN 'click' THEN 'SEA_SUBSURFACE' WHEN 'error' THEN 'AIR' ELSE 'UNKNOWN' END AS domain FROM events
""")
def unit_conversions(spark, folder):
    c = scalars.CONVERSIONS
    name = F.when(F.col("event_type") == "view", "surface").when(F.col("event_type") == "click", "Subsurface").when(F.col("event_type") == "error", "air").otherwise(F.col("event_type"))
    v = F.col("value")
    return reports(spark, folder).select(
        "event_id",
        F.round(c["ft_to_m"](v), 6).alias("metres"),
        F.round(c["knots_to_mps"](v), 6).alias("mps"),
        F.round(c["degrees_to_radians"](v), 6).alias("angle"),
        F.round(c["alt_ge_0"](v - 10), 6).alias("not_negative"),
        c["ms_to_ISO8601"](F.col("event_id") * 86399000 + 123).alias("iso"),
        c["convert_to_string"](v).alias("text"),
        c["standardize_domain"](name).alias("domain"),
    )


@query("""
WITH k AS (SELECT event_id, 'event_type-' || event_type || '_user_id-' || user_id AS key FROM events),
h AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(key)) AS d, md5(key) AS m FROM k)
SELECT event_id, key, d[1:12] || '5' || d[14:16] || '89ab'[1 + ('0x' || d[17])::INT % 4] || d[18:32] AS entity_id,
  ((((('0x' || m[1:8])::BIGINT % 12 * 4 + ('0x' || m[9:16])::BIGINT) % 12 * 4 + ('0x' || m[17:24])::BIGINT) % 12 * 4 + ('0x' || m[25:32])::BIGINT) % 12)::BIGINT AS shard FROM h
""")
def entity_ids(spark, folder):
    df = reports(spark, folder)
    kinds = {n: k for n, k in df.dtypes if n in ("event_type", "user_id")}
    keyed = df.select("event_id", scalars.correlation_key(kinds).alias("key"))
    return keyed.select("*", scalars.uuid5_hex(F.col("key")).alias("entity_id"), scalars.md5_shard(F.col("key"), 12).alias("shard"))


@query("""
SELECT event_id, CASE WHEN value = floor(value) THEN value::BIGINT::VARCHAR ELSE value::VARCHAR END AS from_double, event_id::VARCHAR AS from_text,
  CASE WHEN event_type = 'error' THEN NULL ELSE 'event_type:' || event_type || '-' END || 'user_id:' || user_id AS identity,
  event_id + 1 AS whole, replace(trim('  a-' || event_type || '-b '), '-', '') AS uuid FROM events
""")
def canonical_ids(spark, folder):
    df = reports(spark, folder).withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    named = df.withColumnRenamed("event_type", "et").withColumnRenamed("kind", "event_type")
    identity = scalars.identity_key({"event_type": "string", "user_id": "bigint"})
    out = named.select(
        "event_id",
        scalars.id_text(F.col("value"), "double").alias("from_double"),
        scalars.id_text(F.concat(F.col("event_id").cast("string"), F.lit(".0")), "string").alias("from_text"),
        F.when(F.col("event_type").isNotNull(), identity).alias("identity"),
        scalars.exact_long(F.concat((F.col("event_id") + 1).cast("string"), F.lit(".000"))).alias("whole"),
        scalars.normal_uuid(F.concat(F.lit("  a-"), "et", F.lit("-b "))).alias("uuid"),
    )
    return out


@query(f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN {ISO.format('ts')} ELSE NULL END AS normal FROM events
""")
def timestamps(spark, folder):
    third = F.col("event_id") % 3
    text = F.when(third == 0, "1970-01-01T00:00:00Z").when(third == 1, F.col("ts").cast("string")).otherwise("not a time")
    return reports(spark, folder).select("event_id", scalars.normal_timestamp(text).alias("normal"))


def _events_by_user(spark, folder):
    """One event per user, keyed as customers are."""
    last = merge.last_row(reports(spark, folder), ["user_id"], F.col("event_id"))
    flat = last.select(F.col("user_id").cast("string").alias("identity.callsign"), F.col("value").alias("estimatedKinematics.speed"))
    return mapping.keyed(flat, ["identity.callsign"])


def _customers(spark, folder):
    c = table(spark, folder, "customer").filter("c_custkey % 2 = 0")
    return c.select(F.concat(F.lit("cust-"), "c_custkey").alias("objectId.uuid"), F.col("c_custkey").cast("string").alias("identity.callsign"), F.col("c_mktsegment").alias("identity.description"))


_USERS = "u AS (SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id), c AS (SELECT * FROM customer WHERE c_custkey % 2 = 0)"
_UUID5 = "d[1:12] || '5' || d[14:16] || '89ab'[1 + ('0x' || d[17])::INT % 4] || d[18:32]"


@query(f"""
WITH {_USERS}, j AS (SELECT u.*, c.*, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('identity.callsign-' || user_id)) AS d FROM u LEFT JOIN c ON user_id = c_custkey)
SELECT CASE WHEN c_custkey IS NULL THEN {_UUID5} ELSE 'cust-' || c_custkey END AS entity_id, c_custkey IS NULL AS created, value AS speed,
  CASE WHEN c_custkey IS NULL THEN 'LIVE' END AS mode, user_id::VARCHAR AS label FROM j
""")
def match_dynamic(spark, folder):
    """Unknown entities are made, with defaults."""
    got = matching.match(_events_by_user(spark, folder), _customers(spark, folder), FEED_BY_CALLSIGN)
    return got.select(field("objectId.uuid").alias("entity_id"), "created", field("estimatedKinematics.speed").alias("speed"), "mode", field("objectId.descriptiveLabel").alias("label"))


FEED_BY_CALLSIGN = feeds.feed_spec({"origin_unique_ID_column": "user_id", "destination_unique_ID_column": "identity.callsign", "correlation_type": "dynamic", "query": "select * from Reports"})
STATIC_FEED = feeds.feed_spec({"origin_unique_ID_column": "user_id", "destination_unique_ID_column": "identity.callsign", "correlation_type": "static", "query": "select * from Reports"})


@query(f"WITH {_USERS} SELECT 'cust-' || c_custkey AS entity_id, value AS speed FROM u JOIN c ON user_id = c_custkey")
def match_static(spark, folder):
    """Unknown entities are left out."""
    got = matching.match(_events_by_user(spark, folder), _customers(spark, folder), STATIC_FEED)
    return got.select(field("objectId.uuid").alias("entity_id"), field("estimatedKinematics.speed").alias("speed"))


@query(f"WITH {_USERS} SELECT user_id::VARCHAR AS callsign, value AS speed FROM u WHERE user_id NOT IN (SELECT c_custkey FROM c)")
def new_entities(spark, folder):
    known = _customers(spark, folder)
    got = merge.additions(known, _events_by_user(spark, folder), "identity.callsign")
    return got.select(field("identity.callsign").alias("callsign"), field("estimatedKinematics.speed").alias("speed"))


@query(f"""
WITH {_USERS}, n AS (SELECT c_custkey AS k, 'seen in ' || c_mktsegment AS note FROM customer WHERE c_custkey % 3 = 0)
SELECT user_id::VARCHAR AS callsign, CASE WHEN c_custkey IS NULL THEN coalesce(note, 'none') END AS note
FROM u LEFT JOIN c ON user_id = c_custkey LEFT JOIN n ON user_id = k
""")
def enriched(spark, folder):
    """Created entities get fields from a reference table."""
    reference = table(spark, folder, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("identity.callsign-"), "c_custkey").alias("key"), F.concat(F.lit("seen in "), "c_mktsegment").alias("note"))
    matched = matching.match(_events_by_user(spark, folder), _customers(spark, folder), FEED_BY_CALLSIGN)
    with_note = matched.withColumn("note", F.when(F.col("created"), F.lit("none")))
    got = matching.enrich(with_note, lambda created: created.select("key").join(reference, "key"))
    return got.select(field("identity.callsign").alias("callsign"), "note")


@query("""
SELECT user_id, arg_max(value, event_id) FILTER (event_type <> 'error') AS value, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id
""")
def last_values(spark, folder):
    """Of each field the last value that isn't null."""
    df = reports(spark, folder).select("user_id", "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "event_type")
    return merge.last_non_null(df, ["user_id"], "event_id")


@query("""
SELECT user_id AS entity, event_type AS kind, upstream, arg_max(value, event_id) FILTER (value > 10) AS value, count(*) AS n
FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'even' END AS upstream FROM events) GROUP BY ALL
""")
def coalesced_events(spark, folder):
    """Nulls are a group of their own."""
    df = reports(spark, folder).select(F.col("user_id").alias("objectId"), F.col("event_type").alias("eventType"), F.lit("d").alias("datasetName"), F.when(F.col("event_id") % 2 == 0, "even").alias("upstreamSource"), F.lit(None).cast("string").alias("collectionType"), F.when(F.col("value") > 10, F.col("value")).alias("value"), "event_id")
    last = merge.coalesced_events(df, "event_id")
    counts = df.groupBy("objectId", "eventType", "upstreamSource").agg(F.count(F.lit(1)).alias("n"))
    same = (last["objectId"] == counts["objectId"]) & (last["eventType"] == counts["eventType"]) & last["upstreamSource"].eqNullSafe(counts["upstreamSource"])
    return last.join(counts, same).select(last["objectId"].alias("entity"), last["eventType"].alias("kind"), last["upstreamSource"].alias("upstream"), "value", "n")


@query("SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2")
def first_rows(spark, folder):
    return merge.first_row(reports(spark, folder).select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], F.col("event_id"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def last_rows(spark, folder):
    return merge.last_row(reports(spark, folder).select("user_id", "event_id", "value"), ["user_id"], F.col("event_id"))


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN 'patched' END AS note
FROM orders UNION ALL SELECT -1 - c_custkey, 'N', c_acctbal, 'new' FROM customer
""")
def patch_merge(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    third = F.col("o_orderkey") % 3 == 0
    patch = orders.select("o_orderkey", F.lit(None).cast("string").alias("o_orderstatus"), F.when(third, F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(third, "patched").alias("note"))
    new = table(spark, folder, "customer").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.col("c_acctbal").alias("o_totalprice"), F.lit("new").alias("note"))
    return merge.patched(orders, patch.unionByName(new), "o_orderkey")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) THEN 'new' END AS callsign, c_acctbal AS balance FROM customer
""")
def write_once_fields(spark, folder):
    """A field that is set already isn't in the patch; null and blank ones are filled."""
    c = table(spark, folder, "customer")
    quarter = F.col("c_custkey") % 4
    base = c.select("c_custkey", F.when(quarter == 1, F.lit(" ")).when(quarter > 1, F.col("c_name")).alias("callsign"))
    return merge.filled(base, c.select("c_custkey", F.lit("new").alias("callsign"), F.col("c_acctbal").alias("balance")), "c_custkey", ["callsign"])


def _tally_input(spark, folder):
    kind = F.when(F.col("event_type") == "error", "empty").when(F.col("event_type") == "view", "KINEMATIC_UPDATE").otherwise("STATE_UPDATE")
    dataset = F.when(F.col("event_type") != "error", F.concat(F.lit("D"), F.col("event_id") % 3))
    upstream = F.when((F.col("event_type") == "click") & (F.col("event_id") % 2 == 0), "up")
    return reports(spark, folder).select(F.col("user_id").cast("string").alias("objectId"), kind.alias("eventType"), dataset.alias("datasetName"), upstream.alias("upstreamSource"), F.concat(F.lit("c"), F.col("event_id") % 5).alias("collectionType"), F.date_trunc("hour", "ts").alias("updatedDate"), "event_id")


_TALLY = """
t AS (SELECT user_id::VARCHAR AS entity, CASE event_type WHEN 'error' THEN 'TRACKER_KINEMATIC_UPDATE' WHEN 'view' THEN 'PASSTHROUGH_KINEMATIC_UPDATE' ELSE 'STATE_UPDATE' END AS kind,
    CASE WHEN event_type = 'error' THEN 'Tracks' ELSE 'D' || event_id % 3 END AS dataset, CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'up' END AS upstream,
    'c' || event_id % 5 AS collection, date_trunc('hour', ts) AS moment, event_id FROM events WHERE NOT (event_type = 'view' AND event_id % 3 = 1)),
s AS (SELECT entity, dataset, upstream, kind, max(moment) AS moment, arg_max(collection, row(moment, -event_id)) AS collection FROM t GROUP BY 1, 2, 3, 4)
"""


@query(f"WITH {_TALLY} SELECT entity, dataset, upstream, kind, {STAMP.format('moment')} AS at, collection FROM s")
def source_tally(spark, folder):
    got = merge.tally(_tally_input(spark, folder), "event_id", ["D1"], "Tracks")
    return got.select(F.col("objectId").alias("entity"), F.col("datasetName").alias("dataset"), F.col("upstreamSource").alias("upstream"), F.col("eventType").alias("kind"), stamp(F.col("at")).alias("at"), F.col("collectionType").alias("collection"))


@query(f"""
WITH {_TALLY}, r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY dataset, kind, coalesce(upstream, '')) AS n FROM s)
SELECT entity, string_agg(dataset || '/' || kind || '/' || coalesce(upstream, '') || '/' || {ISO.format('moment')} || '/' || collection, ';' ORDER BY n) AS sources FROM r WHERE n <= 4 GROUP BY entity
""")
def source_lists(spark, folder):
    got = merge.sources_array(merge.tally(_tally_input(spark, folder), "event_id", ["D1"], "Tracks"), most=4)
    text = F.transform("sources", lambda s: F.concat_ws("/", s["datasetName"], s["eventType"], s["upstreamSource"], s["latestUpdatedDate"], s["collectionType"]))
    return got.select(F.col("objectId").alias("entity"), F.array_join(text, ";").alias("sources"))


@query("""
SELECT * FROM (SELECT c_custkey AS entity, 'name' AS field FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'balance' FROM customer WHERE c_custkey % 2 = 0)
""")
def identity_presence(spark, folder):
    c = table(spark, folder, "customer")
    df = c.select(F.col("c_custkey").alias("entity"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).otherwise(" ").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).otherwise(F.lit(float("nan"))).alias("balance"))
    return merge.fields_present(df, "entity", ["name", "balance"])


@query("""
SELECT c_custkey, c_mktsegment, c_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_acctbal DESC, c_custkey DESC) AS n FROM customer) WHERE n > 1
""")
def id_duplicates(spark, folder):
    """Of entities with one key all but the one updated last are to be deleted."""
    return merge.id_duplicates(table(spark, folder, "customer"), ["c_mktsegment", "c_nationkey"], "c_acctbal", "c_custkey").select("c_custkey", "c_mktsegment", "c_nationkey")


@query("SELECT event_type, user_id % 10 AS bucket, count(*) AS n FROM events GROUP BY 1, 2")
def frequencies(spark, folder):
    return merge.frequency(reports(spark, folder).withColumn("bucket", F.col("user_id") % 10), "event_type", "bucket")


@query("""
SELECT event_id, user_id, value, NULL::VARCHAR AS event_type FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, NULL, value, event_type FROM events WHERE event_id % 2 = 1
""")
def schema_union(spark, folder):
    e = reports(spark, folder)
    return merge.union_all(e.filter("event_id % 2 = 0").select("event_id", "user_id", "value"), e.filter("event_id % 2 = 1").select("event_id", "value", "event_type"))


@query("""
SELECT c_custkey AS id, CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 'both' ELSE 'customer' END AS side FROM customer
UNION ALL SELECT DISTINCT user_id, 'event' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)
""")
def id_sets(spark, folder):
    """Difference, intersection and union of id sets."""
    a = tables.ids(table(spark, folder, "customer").withColumnRenamed("c_custkey", "id"), "id")
    b = tables.ids(reports(spark, folder).withColumnRenamed("user_id", "id"), "id")
    both = a.join(b, "id", "left_semi").withColumn("side", F.lit("both"))
    return both.unionByName(a.join(b, "id", "left_anti").withColumn("side", F.lit("customer"))).unionByName(b.join(a, "id", "left_anti").withColumn("side", F.lit("event")))


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pass_no FROM events")
def pass_numbers(spark, folder):
    return merge.passes(reports(spark, folder).select("event_id", "user_id"), "user_id", "event_id").select("event_id", F.col("pass_no").cast("long").alias("pass_no"))


@query("""
WITH g AS (SELECT event_id, user_id, epoch_us(ts) / 1e6 AS s, lag(epoch_us(ts) / 1e6) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, round(s - p, 3) AS dt, sum(CASE WHEN s - p > 43200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, event_id)::BIGINT AS segment FROM g
""")
def gap_segments(spark, folder):
    return merge.segments(reports(spark, folder), "user_id", "ts", 43200, "event_id").select("event_id", "user_id", F.round("dt", 3).alias("dt"), "segment")


@query("""
WITH p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events)
SELECT event_id, user_id, event_type FROM p WHERE before IS DISTINCT FROM event_type
""")
def state_changes(spark, folder):
    return merge.first_changes(reports(spark, folder).select("event_id", "user_id", "event_type"), ["user_id"], F.col("event_type"), F.col("event_id"))


@query("""
SELECT event_id, event_type, value FROM events WHERE event_id IN (SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS n
  FROM events, (SELECT max(ts) AS now FROM events) WHERE epoch_us(now) - epoch_us(ts) <= CASE event_type WHEN 'view' THEN 240 WHEN 'click' THEN 24 ELSE 480 END * 3600000000) WHERE n <= 40)
""")
def newest_by_group(spark, folder):
    """The newest rows of each environment within its own look-back."""
    e = reports(spark, folder)
    now = F.lit(e.agg(F.max("ts")).first()[0]).cast("timestamp")
    return tables.top_by_group(e, F.col("event_type"), F.col("ts"), now, {"view": 240, "click": 24}, 480, 40).select("event_id", "event_type", "value")


@query("SELECT event_id, value FROM events ORDER BY ts DESC LIMIT 100")
def freshest(spark, folder):
    return tables.freshest(reports(spark, folder), "ts", 100).select("event_id", "value")


@query("""
SELECT event_id FROM events WHERE (ts, event_id) > (SELECT (ts, event_id) FROM events WHERE event_id = 300)
""")
def rows_since(spark, folder):
    """Rows after a cursor."""
    e = reports(spark, folder)
    cursor = tables.next_cursor(e.filter("event_id = 300"), "ts", "event_id")
    return tables.since(e, "ts", "event_id", cursor).select("event_id")


@query("""
SELECT user_id, k, count(*) AS n FROM (SELECT user_id, (props ->> '$.k')::INT AS k FROM events) GROUP BY ALL
""")
def parsed_reports(spark, folder):
    """Messages of a JSON object or an array of them; broken ones are skipped."""
    e = reports(spark, folder)
    schema = "user_id bigint, k int"
    report = F.to_json(F.struct("user_id", F.get_json_object("props", "$.k").cast("int").alias("k")))
    one = e.filter("event_id % 2 = 0").select(report.alias("value"))
    many = e.filter("event_id % 2 = 1").groupBy("user_id").agg(F.collect_list(report).alias("r")).select(F.concat(F.lit("["), F.array_join("r", ","), F.lit("]")).alias("value"))
    broken = e.select(F.expr("case event_id % 3 when 0 then '{\"user_id\": ' when 1 then '' end").alias("value"))
    rows = feeds.parse_records(one.union(many).union(broken), spark.createDataFrame([], schema).schema)
    return rows.select("report.user_id", "report.k").groupBy("user_id", "k").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id FROM events WHERE NOT (event_type = 'view' AND event_id % 3 = 1) AND value > 10
""")
def untracked_events(spark, folder):
    """A feed's own filter and the exclusion of tracked kinematic events."""
    e = feeds.where(reports(spark, folder), "value > 10")
    kind = F.when(F.col("event_type") == "view", "KINEMATIC_UPDATE").otherwise(F.col("event_type"))
    dataset = F.when(F.col("event_id") % 3 < 2, F.concat(F.lit("D"), F.col("event_id") % 3))
    return e.filter(feeds.not_tracked(kind, dataset, ["D1"])).select("event_id")


@query("""
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'UNKNOWN' END AS environment FROM events
""")
def environments(spark, folder):
    """UNKNOWN is what isn't listed."""
    e = reports(spark, folder)
    known = ["view", "click"]
    return merge.union_all(*[e.filter(mapping.environment_is(F.col("event_type"), n, known)).select("event_id", F.lit(n).alias("environment")) for n in (*known, "UNKNOWN")])


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS label,
  CASE c_custkey % 4 WHEN 0 THEN c_mktsegment || '-' || c_custkey WHEN 1 THEN 'AIR' WHEN 2 THEN c_name ELSE c_mktsegment END AS domain_label FROM customer
""")
def labels(spark, folder):
    c = table(spark, folder, "customer")
    quarter = F.col("c_custkey") % 4
    named = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("identity.callsign"), F.col("c_mktsegment").alias("identity.description"))
    domain = c.select(F.col("c_custkey").alias("k"), F.when(quarter == 0, "SEA_SURFACE").when(quarter == 1, "AIR").otherwise("GROUND").alias("identity.environment.environment"), F.col("c_mktsegment").alias("identity.vesselTypeCode"),
        F.col("c_custkey").alias("identity.navalPennant"), F.when(quarter == 3, F.col("c_mktsegment")).alias("identity.description"), F.when(quarter == 2, F.col("c_name")).alias("identity.callsign"))
    second = domain.select("k", mapping.domain_label(domain).alias("domain_label"))
    return named.select("c_custkey", mapping.label(named).alias("label")).join(second, F.col("c_custkey") == F.col("k")).drop("k")


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN '{"name":"' || n_name || '","region":{"key":' || n_regionkey || '}}' ELSE '{"region":{"key":' || n_regionkey || '}}' END AS record FROM nation
""")
def compact_records(spark, folder):
    n = table(spark, folder, "nation")
    df = n.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(" ").alias("name"), F.lit(float("nan")).alias("score"), F.array().cast("array<int>").alias("list"), F.struct(F.lit("").alias("note"), F.col("n_regionkey").alias("key")).alias("region"))
    flat = mapping.flatten(df).withColumnRenamed("n_nationkey", "k")
    back = mapping.nest(mapping.without_prefixes(flat, ["n_nationkey"]))
    record = mapping.compact_json(back.drop("k"))
    return back.select(F.col("k").alias("n_nationkey"), record.alias("record"))


@query("""
SELECT event_id, (SELECT c_acctbal FROM customer WHERE c_custkey = user_id AND c_custkey % 2 = 0) AS set_balance FROM events
""")
def inserted_values(spark, folder):
    """Values of the entity with a key of another name."""
    known = table(spark, folder, "customer").filter("c_custkey % 2 = 0")
    return insert_values(reports(spark, folder).select("event_id", "user_id"), known, "user_id", "c_custkey", {"set_balance": "c_acctbal"}).select("event_id", "set_balance")
