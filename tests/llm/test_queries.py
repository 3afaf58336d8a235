"""The registered queries: names, and those with SQL against it."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.test_queries import PATH, TABLES, rows
from waymark.llm import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")


def test_one_query_for_each_operator():
    numbers = [int(m[1]) for n in catalog.QUERIES if (m := re.match(r"op(\d+)_\w+$", n))]
    assert sorted(numbers) == list(range(1, 11))
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry_point.queries()) and set(catalog.SQL) <= set(entry_point.oracle_sql())
    assert set(catalog.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from read_parquet('{PATH}/{t}.parquet')")
    got = catalog.QUERIES[name](spark, PATH)
    result = duck.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    expected = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    assert rows([r.asDict() for r in got.collect()], sorted(names)) == rows(expected, sorted(names))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_a_row_for_each_document(spark, name):
    got = catalog.QUERIES[name](spark, PATH)
    ids = sorted(r["doc_id"] for r in got.select("doc_id").distinct().collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id").collect())
    assert name == "op4_packing" or got.count() == len(ids)
