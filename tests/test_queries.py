"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from waymark.plans import catalog

PATH = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    found = duckdb.connect()
    found.execute("SET TimeZone='UTC'")
    for t in TABLES:
        found.execute(f"create view {t} as select * from read_parquet('{PATH}/{t}.parquet')")
    return found


def plain(value):
    if value is None or value != value:
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def rows(records, columns):
    return sorted(repr([plain(r[c]) for c in columns]) for r in records)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_agrees_with_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, PATH)
    result = duck.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    expected = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    columns = sorted(names)
    assert rows([r.asDict() for r in got.collect()], columns) == rows(expected, columns)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, PATH).count() >= 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_twins_of_all_users(spark):
    """Duplicates are looked for, decided and restored among all users' tracks, not the first twelve's."""
    counts = spark.read.parquet(f"{PATH}/events.parquet").groupBy("user_id").count().collect()
    users = {r["user_id"] for r in counts if r["count"] >= 5}
    assert max(users) >= 12
    found = {(r["a"], r["b"]) for r in catalog.QUERIES["duplicate_tracks"](spark, PATH).collect()}
    assert {(f"a{u}", f"b{u}") for u in users} <= found
    gone = {r[k] for r in catalog.QUERIES["supersede_actions"](spark, PATH).collect() for k in ("objectId", "supersededBy")}
    assert {f"{side}{u}" for u in users for side in "ab"} <= gone
    back = {r["objectId"] for r in catalog.QUERIES["restored_entities"](spark, PATH).collect()}
    assert {f"b{u}" for u in users if u % 3 == 2 and u - 1 in users} <= back
