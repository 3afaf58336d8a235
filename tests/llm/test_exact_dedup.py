from collections import Counter

from waymark.llm.exact_dedup import drop_exact_duplicates, duplicate_groups

LONG = "x" * 100_000
ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (5, LONG + "y"), (6, LONG + "z"), (7, LONG + "y"), (2, "a"), (8, "b"), (None, "c"), (None, "c"), (9, "é"), (10, "É")]


def test_groups_against_brute_force(spark):
    frame = spark.createDataFrame([(*r, 0, "k") for r in ROWS], "doc_id long, text string, kept int, t string")
    for hash_all in (False, True):
        # few bits: bits set by other groups cost work, not results
        for bits in (1 << 26, 8):
            got = duplicate_groups(frame, hash_all=hash_all, bits=bits).collect()
            top, size = {}, Counter(t or "" for _, t in ROWS)
            for i, t in ROWS:
                top[t or ""] = max(top.get(t or ""), i, key=lambda x: -1 if x is None else x) if (t or "") in top else i
            expected = sorted((str(i), str(top[t or ""]), size[t or ""]) for i, t in ROWS)
            assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"]) for r in got) == expected
            assert sum(r["kept"] for r in got) == len(size)
            assert all(r["kept"] <= (r["id"] == r["keep_id"]) for r in got)


def test_one_row_of_each_text_stays(spark):
    frame = spark.createDataFrame([(*r, 0, "k") for r in ROWS], "doc_id long, text string, `__kept` int, `a.b` string")
    for bits in (1 << 26, 8):
        kept = drop_exact_duplicates(frame, bits=bits)
        assert kept.columns == frame.columns
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "4", "7", "6", "8", "None", "9", "10"])
    assert drop_exact_duplicates(frame.limit(0)).count() == 0 and duplicate_groups(frame.limit(0)).count() == 0


def test_any_columns_pass(spark):
    """Maps, and names that the operator might use itself."""
    frame = spark.createDataFrame([(i % 3, "same" if i % 2 else "other", {"k": i}, i, "x", True, b"b") for i in range(12)], "doc_id long, text string, m map<string,int>, __wm_map int, row string, may boolean, bits binary")
    kept = drop_exact_duplicates(frame)
    assert kept.columns == frame.columns and kept.count() == 2
    assert [sorted(map(str, drop_exact_duplicates(frame).collect())) for _ in range(2)] == [sorted(map(str, kept.collect()))] * 2


def test_a_group_of_most_rows_is_divided(spark):
    """Two thirds of the rows have one text: the join deals them over several parts."""
    n = 3000
    frame = spark.range(n).selectExpr("id doc_id", "if(id % 3 = 0, cast(id as string), 'the same') text")
    got = duplicate_groups(frame, hash_all=True)
    rows = got.collect()
    assert sum(r["kept"] for r in rows) == n // 3 + 1 and {(r["keep_id"], r["group_size"]) for r in rows if r["id"] % 3} == {(n - 1, 2 * n // 3)}
    assert "part#" in got._jdf.queryExecution().executedPlan().toString()
