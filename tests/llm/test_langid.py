import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymark.llm import bytectx
from waymark.llm.langid import drop_unidentified, fit, identify, score, train

EN = ["the cat sat on the mat and the dog saw it there", "this is the other thing that they had thought of", "when the night is over then the day will start"] * 3
DE = ["der hund und die katze sind nicht in dem haus", "ich habe das buch gelesen und es war sehr schön", "die straße ist lang und der weg ist weit"] * 3


def brute_bits(texts, text, known):
    """PPM with exclusion, one byte at a time, by dictionaries."""
    counts = defaultdict(Counter)
    for t in texts:
        padded = b"\0\0\0" + t
        for i in range(3, len(padded)):
            for order in range(4):
                counts[padded[i - order : i]][padded[i]] += 1
    total, padded = 0.0, b"\0\0\0" + text
    for i in range(3, len(padded)):
        orders = [padded[i - k : i] for k in range(4)]
        longest = 3 if orders[3] in known else 2 if any(c[1:] == orders[2] for c in known) else 1
        gone, p = set(), 1.0
        for order in range(longest, -1, -1):
            left = {b: n for b, n in counts[orders[order]].items() if b not in gone}
            if not left:
                continue
            size = sum(left.values()) + len(left)
            if padded[i] in left:
                p *= left[padded[i]] / size
                break
            p *= len(left) / size
            gone |= set(left)
        else:
            p /= 256 - len(gone)
        total -= math.log2(p)
    return total


def test_code_lengths_against_brute_force(monkeypatch):
    samples = {"en": [t.encode() for t in EN], "de": [t.encode() for t in DE]}
    model = fit(samples, max_contexts=150)
    known = {int(c).to_bytes(3, "big") for c in model.contexts.triples}
    texts = [b"the katze sat in dem haus", b"qqq \xff\x00 zz", b"s", b""]
    for block in (1 << 20, 5):
        monkeypatch.setattr(bytectx, "BLOCK", block)
        got = bytectx.totals(texts, model.contexts, model.costs)
        for k, name in enumerate(model.languages):
            for i, t in enumerate(texts):
                assert got[i, k] == pytest.approx(brute_bits(samples[name], t, known), rel=1e-5)


def test_probabilities_of_a_state_sum_to_one():
    model = fit({"en": [t.encode() for t in EN]})
    assert np.allclose(np.exp2(-model.costs.reshape(-1, 256).astype(float)).sum(axis=1), 1, atol=1e-4)


ROWS = [(i, t, "en") for i, t in enumerate(EN)] + [(100 + i, t, "de") for i, t in enumerate(DE)]
ODD = [(500, None, "en"), (501, "", "de"), (502, "123 --- !!", "en"), (503, "das ist nicht der hund " * 20_000, None), (None, "the thing is there", "en"), (504, "Ж" * 50 + "中" * 200, None)]


def test_rows_and_odd_rows(spark):
    frame = spark.createDataFrame([(*r, 1) for r in ROWS + ODD], "doc_id long, text string, lang string, score int")
    model = train(frame)
    assert model.languages == ["de", "en"]
    got = {r["id"]: r for r in identify(frame, model).collect()}
    assert len(got) == len(ROWS) + len(ODD)
    assert all(got[i]["lang_pred"] == lang for i, _, lang in ROWS)
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503, None)] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[500]["score"] == 0
    kept = drop_unidentified(frame, model)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in ROWS} | {503, None}


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in identify(frame, train(frame)).collect()] == ["und"]
    assert identify(frame.limit(0), train(frame)).count() == 0


def test_held_out_accuracy(spark):
    import os

    from waymark.llm.langid import query

    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in query(spark, path).collect() if r["held_out"]]
    assert len(got) > 100 and sum(lang[r["doc_id"]] == r["lang_pred"] for r in got) / len(got) > 0.98


def test_counts_of_tasks_give_the_same_model(spark):
    """Counted in parts over tasks, with a long text and a language of one text, against all texts at once."""
    rows = ROWS + [(700 + i, t[::-1] * 3, "rev") for i, t in enumerate(EN)] + [(900, "ja nee dank je wel " * 9000, "nl"), (901, None, "nl")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    samples = {}
    for _, t, lang in rows:
        samples.setdefault(lang, []).append((t or "").encode())
    for most in (16384, 200):
        model, whole = train(frame, max_contexts=most), fit(samples, most)
        assert model.languages == whole.languages == ["de", "en", "nl", "rev"]
        assert model.contexts.triples.tolist() == whole.contexts.triples.tolist() and np.allclose(model.costs, whole.costs)


def test_no_language_is_left_out(spark):
    """A hundred languages, each of its own letters; the contexts are bounded, not the languages."""
    rows = [(100 * k + i, " ".join(chr(0x4E00 + 50 * k + j) * 2 for j in range(i, i + 12)), f"l{k:03}") for k in range(100) for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(frame, cells=1 << 22)
    assert len(model.languages) == 100 and len(model.contexts.triples) <= 256
    got = identify(frame, model).collect()
    assert sum(r["lang_pred"] == f"l{r['id'] // 100:03}" for r in got) > 0.9 * len(rows)
