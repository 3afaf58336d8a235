"""Queries on lineage, retention and the keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import duplicates, lineage, matching, merge, retention
from waymark.plans.registry import query
from waymark.sources import tables
from waymark.sources.tables import table

#: Of supplier k: superseded by 3k + 1 modulo 100 if k % 4 < 2, deleted if k % 12 = 2, restored if k % 12 = 6 (after having been superseded).
_EDGES = """
e AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 < 2 THEN (3 * s_suppkey + 1) % 100 END AS target FROM supplier WHERE s_suppkey % 4 < 2 OR s_suppkey % 12 = 2)
"""


def management_events(spark: SparkSession, folder: str) -> DataFrame:
    """Two rounds of events: all are superseded by 5k, then what holds in the end."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k"))
    last = F.when(F.col("k") % 4 < 2, "SUPERSEDE").when(F.col("k") % 12 == 2, "DELETE").otherwise("RESTORE")
    first = s.select(F.col("k").cast("string").alias("objectId"), F.lit("SUPERSEDE").alias("action"), ((5 * F.col("k")) % 100).cast("string").alias("supersededBy"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("updatedDate"))
    second = s.select(F.col("k").cast("string").alias("objectId"), last.alias("action"), F.when(F.col("k") % 4 < 2, (3 * F.col("k") + 1) % 100).cast("string").alias("supersededBy"), F.lit("2024-01-02 00:00:00").cast("timestamp").alias("updatedDate"))
    return first.unionByName(second)


_ROOTS = f"""
{_EDGES},
w AS (SELECT id, target, [id] AS seen, FALSE AS ended FROM e
  UNION ALL SELECT w.id, CASE WHEN list_contains(w.seen, w.target) THEN w.target ELSE e.target END, list_append(w.seen, w.target), list_contains(w.seen, w.target)
  FROM w JOIN e ON e.id = w.target WHERE NOT w.ended),
r AS (SELECT id, arg_max(target, len(seen)) FILTER (TRUE) AS t, max(len(seen)) AS n FROM w GROUP BY id),
f AS (SELECT w.id, w.target AS root FROM w JOIN r ON w.id = r.id AND len(w.seen) = r.n)
"""


@query(f"WITH RECURSIVE {_ROOTS} SELECT id::VARCHAR AS id, root::VARCHAR AS root FROM f")
def supersede_map(spark, folder):
    """Chains resolved to their ends; cycles end at their entry, deleted ones at null."""
    return lineage.supersede_map(management_events(spark, folder))


@query(f"""
WITH RECURSIVE {_ROOTS}
SELECT event_id, CASE WHEN f.id IS NULL THEN user_id ELSE root END::VARCHAR AS entity, f.id IS NOT NULL AND root <> user_id AS superseded FROM events LEFT JOIN f ON f.id = user_id WHERE f.id IS NULL OR root IS NOT NULL
""")
def events_under_roots(spark, folder):
    e = table(spark, folder, "events").select("event_id", F.col("user_id").cast("string").alias("objectId"))
    got = lineage.apply(e, lineage.supersede_map(management_events(spark, folder)))
    return got.select("event_id", F.col("objectId").alias("entity"), "superseded")


@query("""
WITH c AS (SELECT o_custkey % 50 AS k, o_orderkey, o_orderstatus, o_orderstatus = 'F' AS sup, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS callsign FROM orders)
SELECT k, arg_max(callsign, (sup, o_orderkey)) FILTER (callsign IS NOT NULL) AS callsign, arg_max(o_orderstatus, (sup, o_orderkey)) AS status FROM c GROUP BY k
""")
def fused_identity(spark, folder):
    """A superseded source outranks the survivor, then the later one wins."""
    o = table(spark, folder, "orders").select((F.col("o_custkey") % 50).alias("k"), "o_orderkey", (F.col("o_orderstatus") == "F").alias("sup"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("callsign"), F.col("o_orderstatus").alias("status"))
    return lineage.fused_identity(o, "k", "sup", ["callsign", "status"], F.col("o_orderkey"))


@query(f"""
WITH RECURSIVE {_ROOTS} SELECT DISTINCT id FROM (SELECT id::VARCHAR AS id FROM f UNION ALL SELECT root::VARCHAR FROM f WHERE root IS NOT NULL UNION ALL SELECT s_suppkey::VARCHAR FROM supplier WHERE NOT (s_suppkey % 4 < 2 OR s_suppkey % 12 = 2))
""")
def protected_ids(spark, folder):
    """Superseded, surviving, and lately restored ids."""
    events = management_events(spark, folder)
    now = F.lit("2024-01-02 00:04:00").cast("timestamp")
    return lineage.protected(lineage.supersede_map(events), events, now)


@query(f"""
WITH RECURSIVE {_ROOTS} SELECT s_suppkey::VARCHAR AS id, CASE WHEN f.root <> f.id AND f.root IN (SELECT s_suppkey FROM supplier) AND s_suppkey % 5 <> 0 THEN 'archived' ELSE 'live' END AS place FROM supplier LEFT JOIN f ON f.id = s_suppkey
""")
def archived_entities(spark, folder):
    """Superseded entities move to the archive unless confirmed."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.when(F.col("s_suppkey") % 5 == 0, "CONFIRMED").alias("entityStatus"))
    live, gone = lineage.archive(s, s.limit(0), lineage.supersede_map(management_events(spark, folder)), "id")
    return live.select("id", F.lit("live").alias("place")).unionByName(gone.select("id", F.lit("archived").alias("place")))


@query("""
SELECT a.c_custkey AS a, b.c_custkey AS b, CASE WHEN (a.c_custkey % 7 = 0) <> (b.c_custkey % 7 = 0) THEN CASE WHEN a.c_custkey % 7 = 0 THEN a.c_custkey ELSE b.c_custkey END
  WHEN a.c_nationkey <> b.c_nationkey THEN CASE WHEN a.c_nationkey < b.c_nationkey THEN a.c_custkey ELSE b.c_custkey END ELSE least(a.c_custkey, b.c_custkey) END AS stays
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
""")
def survivors(spark, folder):
    """Confirmed, then older, then the smaller id."""
    c = table(spark, folder, "customer")
    a = c.select(F.col("c_custkey").alias("a"), (F.col("c_custkey") % 7 == 0).alias("ca"), F.col("c_nationkey").alias("ta"), (F.col("c_custkey") + 1).alias("j"))
    b = c.select(F.col("c_custkey").alias("b"), (F.col("c_custkey") % 7 == 0).alias("cb"), F.col("c_nationkey").alias("tb"))
    stays = duplicates.survivor(F.col("a"), F.col("b"), F.col("ca"), F.col("cb"), F.col("ta"), F.col("tb"))
    return a.join(b, F.col("j") == F.col("b")).select("a", "b", stays.alias("stays"))


_AGED = """
a AS (SELECT event_id, event_type, user_id, user_id % 9 = 0 AS confirmed, CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 24 WHEN 'error' THEN 48 WHEN 'signup' THEN 168 END AS hours,
  epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts) AS age FROM events)
"""


def _aged(spark: SparkSession, folder: str) -> tuple[DataFrame, object]:
    e = table(spark, folder, "events")
    env = F.when(F.col("event_type") == "view", "AIR").when(F.col("event_type") == "click", "GROUND").when(F.col("event_type") == "error", "SEA_SURFACE").when(F.col("event_type") == "signup", "SPACE").otherwise("ELSEWHERE")
    df = e.select("event_id", env.alias("environment"), F.col("ts").alias("updated"), F.when(F.col("user_id") % 9 == 0, "CONFIRMED").otherwise("UNKNOWN").alias("entityStatus"))
    return df, F.lit(e.agg(F.max("ts")).first()[0]).cast("timestamp")


@query(f"WITH {_AGED} SELECT event_id FROM a WHERE NOT confirmed AND age > hours * 3600000000")
def aged_off(spark, folder):
    """Stale by their environment's threshold; confirmed ones stay."""
    df, now = _aged(spark, folder)
    return retention.stale_entities(df, now, "environment", "updated").select("event_id")


@query(f"WITH {_AGED} SELECT 'deleted' AS what, count(*) AS n FROM a WHERE NOT confirmed AND age > hours * 3600000000 UNION ALL SELECT 'left', count(*) FROM a WHERE NOT (NOT confirmed AND coalesce(age > hours * 3600000000, FALSE))")
def two_phase_delete(spark, folder):
    """Rows marked, events told, rows left."""
    df, now = _aged(spark, folder)
    stale = retention.is_stale(F.col("environment"), F.col("updated"), now, F.col("entityStatus"))
    marked, left, events = tables.two_phase_delete(df, stale, "event_id", "entityStatus")
    told = events.join(marked.filter("entityStatus = 'DROPPED'").select(F.col("event_id").alias("objectId")), "objectId", "left_semi").filter("action = 'DELETE'")
    return told.select(F.lit("deleted").alias("what")).unionByName(left.select(F.lit("left").alias("what"))).groupBy("what").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id FROM events WHERE value > 40 AND event_type = 'view'")
def custom_deletion(spark, folder):
    """A deletion query's rows, without the limit at its end."""
    sql = "select * from {events} where value > 40 and event_type = 'view' limit 5"
    return retention.query_rows(spark, sql, events=table(spark, folder, "events")).select("event_id")


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer WHERE c_custkey < 1000 AND c_custkey % 10 <> 0
UNION ALL SELECT c_custkey, 'new', NULL FROM customer WHERE c_custkey >= 1000 AND c_custkey % 3 = 0 AND c_custkey % 10 <> 0
""")
def upserts_and_deletes(spark, folder):
    """Whole rows replaced by key, new ones added, some deleted."""
    c = table(spark, folder, "customer")
    base = c.filter("c_custkey < 1000").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    rows = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.lit("new").alias("name"), F.lit(None).cast("double").alias("balance"))
    return tables.delete(tables.upsert(base, rows, "k"), c.filter("c_custkey % 10 = 0").select(F.col("c_custkey").alias("k")), "k")


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS name, c_acctbal AS balance FROM customer WHERE c_custkey < 1000
UNION ALL SELECT c_custkey, 'new', NULL FROM customer WHERE c_custkey >= 1000 AND c_custkey % 3 = 0
""")
def partial_updates(spark, folder):
    """Values that aren't null win; what the table doesn't have is made."""
    c = table(spark, folder, "customer")
    base = c.filter("c_custkey < 1000").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    patch = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.lit("new").alias("name"), F.lit(None).cast("double").alias("balance"))
    return tables.partial_update(base, patch, "k", create_missing=True)


@query("""
SELECT c_custkey::VARCHAR AS id, 'mine' AS origin FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 5 <> 0 UNION ALL SELECT c_custkey::VARCHAR, 'remote' FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 5 <> 0
""")
def synced_cache(spark, folder):
    """Dropped entities go, unknown ones are added, known ones stay as they are."""
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("id"))
    mine = c.filter("k % 2 = 0").select("id", F.lit("mine").alias("origin"), F.lit("UNKNOWN").alias("entityStatus"))
    remote = c.select("id", F.lit("remote").alias("origin"), F.when(F.col("k") % 5 == 0, "DROPPED").otherwise("UNKNOWN").alias("entityStatus"))
    return matching.apply_remote(mine, remote, "id").select("id", "origin")


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def reconciled_cache(spark, folder):
    """Entities that exist elsewhere, or are too fresh to tell."""
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("id"))
    mine = c.select("id", F.when(F.col("k") % 3 == 0, "2024-01-01 00:00:55").otherwise("2024-01-01 00:00:40").alias("updated"))
    return matching.reconcile(mine, c.filter("k % 2 = 0"), F.lit("2024-01-01 00:01:00").cast("timestamp"), "updated", key="id").select("id")


@query("""
WITH b AS (SELECT c_custkey AS k, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0),
e AS (SELECT user_id, max(event_id) FILTER (event_type = 'click') AS click, arg_max(value, event_id) FILTER (event_type = 'view') AS speed FROM events GROUP BY user_id)
SELECT k::VARCHAR AS entity, CASE WHEN k % 3 = 0 THEN c_name ELSE 'cs-' || click END AS callsign, CASE WHEN speed IS NOT NULL THEN speed ELSE c_acctbal END AS speed FROM b LEFT JOIN e ON user_id = k
""")
def updated_state_table(spark, folder):
    """State and untracked kinematic events applied to the current-state table; identity is written once, entities aren't made."""
    c = table(spark, folder, "customer").filter("c_custkey % 2 = 0")
    base = c.select(F.col("c_custkey").cast("string").alias("objectId.uuid"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("identity.callsign"), F.col("c_acctbal").alias("estimatedKinematics.speed"))
    e = table(spark, folder, "events").filter("event_type in ('view', 'click')")
    click = F.col("event_type") == "click"
    events = e.select(F.col("user_id").cast("string").alias("objectId.uuid"), F.when(click, "STATE_UPDATE").otherwise("KINEMATIC_UPDATE").alias("eventType"), F.when(click, F.concat(F.lit("cs-"), "event_id")).alias("identity.callsign"), F.when(~click, F.col("value")).alias("estimatedKinematics.speed"), F.lit("D").alias("source.datasetName"), F.col("event_id").alias("seq"))
    got = matching.current_state(base, events, "seq")
    return got.select(F.col("`objectId.uuid`").alias("entity"), F.col("`identity.callsign`").alias("callsign"), F.col("`estimatedKinematics.speed`").alias("speed"))


@query("SELECT count(*) AS n, count(*) FILTER (value > 20) AS above FROM events")
def counts(spark, folder):
    """Counts with a predicate."""
    e = table(spark, folder, "events")
    return e.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 20).alias("above"))


@query("SELECT user_id, 'PRE' || count(*) AS tally FROM events GROUP BY user_id")
def merged_tallies(spark, folder):
    """Two halves of a tally merged are the whole one."""
    e = table(spark, folder, "events").select(F.col("user_id").cast("string").alias("objectId"), F.lit("STATE_UPDATE").alias("eventType"), F.concat(F.lit("D"), "event_id").alias("datasetName"), F.lit(None).cast("string").alias("upstreamSource"), F.lit(None).cast("string").alias("collectionType"), F.col("ts").alias("updatedDate"), "event_id")
    half = lambda k: merge.tally(e.filter(F.col("event_id") % 2 == k), "event_id")
    return merge.merged_tally(half(0), half(1)).groupBy(F.col("objectId").cast("long").alias("user_id")).agg(F.concat(F.lit("PRE"), F.count(F.lit(1))).alias("tally"))
