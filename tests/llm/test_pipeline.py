import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_packing import check_pieces
from tests.llm.test_simhash import alike, shingles
from waymark.llm import langid
from waymark.llm.packing import tokenize

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage gave, as rows."""
    if not os.path.isdir(PATH):
        pytest.skip("no test tables")
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    odd = spark.createDataFrame([(900_000, None, "en", "src0", 0), (900_001, "", None, None, None), (900_002, "12 !! 34", "en", "src0", 8)], docs.schema)
    docs = docs.union(odd).union(docs.limit(2))
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, PATH)
        assert name == "packing" or made.columns == docs.columns
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def test_language_stage_drops_what_is_in_no_language(outputs):
    assert {r["doc_id"] for r in outputs[0]} - {r["doc_id"] for r in outputs[1]} == {900_000, 900_001, 900_002}
    assert len(outputs[0]) - len(outputs[1]) == 3


def test_one_of_each_text(outputs):
    top = {}
    for r in outputs[1]:
        top[r["text"]] = max(top.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in outputs[2]) == sorted(top.values())


def test_one_of_each_component(outputs):
    """Of texts whose five-word shingles have a similarity of 0.8 or more, directly or by way of others, the smallest id stays."""
    docs = sorted((r["doc_id"], shingles(r["text"])) for r in outputs[2])
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (d, p) in enumerate(docs):
        for e, q in docs[:k]:
            if alike(p, q):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    expected = {find(d) for d, _ in docs}
    assert sorted(r["doc_id"] for r in outputs[3]) == sorted(expected) and len(expected) < len(docs)


def test_every_document_is_mixed_in(outputs):
    times = Counter(r["doc_id"] for r in outputs[4])
    assert set(times) == {r["doc_id"] for r in outputs[3]} and max(times.values()) <= 3


def test_all_is_packed(outputs):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    times = Counter(r["doc_id"] for r in outputs[4])
    once = {r["doc_id"]: [*tokenize(r["text"], path).tolist(), 1] for r in outputs[4] if times[r["doc_id"]] == 1}
    assert check_pieces([r.asDict() for r in outputs[5]], once, 2048) < 0.01
    total = Counter()
    for r in outputs[5]:
        total[r["doc_id"]] += r["length"]
    assert total == {r["doc_id"]: times[r["doc_id"]] * (len(tokenize(r["text"], path)) + 1) for r in outputs[4]}


def test_run_gives_the_stages_rows(spark):
    if not os.path.isdir(PATH):
        pytest.skip("no test tables")
    assert corpus_pipeline.run(spark, PATH).agg(F.sum("length")).first()[0] > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, PATH)
        assert made.count() == 0
        docs = made if name != "packing" else docs
    assert langid.train(docs).languages == []


def test_stages_begin_with_memory_given_back(spark):
    """Each stage has executors (here the session's own process) collect their garbage: heaps full of what is dead once took a session past its limit."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def full():
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        before = full()
        stage(spark, docs, PATH)
        assert full() > before, name
