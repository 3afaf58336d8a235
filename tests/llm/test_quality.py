import math
import os

import numpy as np
import pytest
import xxhash

from waymark.llm.quality import DENSE, KINDS, META, WORDS, calibrate, co_train, logistic, meta_cells, query, score_documents, sigmoid, text_features, train


def test_logistic_reaches_the_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = (rng.random(400) < sigmoid(x @ [1, -2, 0, 0.5, 3] + 0.3)).astype(float)
    weight = rng.random(400) + 0.1
    w = logistic(x, y, weight, ridge=1e-3, steps=2000)
    full = np.concatenate([x, np.ones((400, 1))], axis=1)
    gradient = full.T @ (weight / weight.sum() * (sigmoid(full @ w) - y)) + 1e-3 * w
    assert np.abs(gradient).max() < 1e-5


def test_calibration_gives_observed_rates():
    rng = np.random.default_rng(2)
    logit = rng.normal(size=20_000) * 3
    y = (rng.random(20_000) < sigmoid(0.5 * logit - 1)).astype(float)
    slope, constant = calibrate(logit, y)
    assert slope == pytest.approx(0.5, abs=0.05) and constant == pytest.approx(-1, abs=0.05)


def test_views_teach_each_other():
    """One view sees the class in labelled rows only weakly; what the other view teaches makes it good."""
    rng = np.random.default_rng(4)
    n = 3000
    y = (rng.random(n) < 0.5).astype(float)
    text = np.zeros((n, text_features(b"x").size), np.float32)
    text[:, :20] = rng.normal(size=(n, 20)) + (y[:, None] - 0.5) * 2.5
    meta = np.zeros((n, META), np.float32)
    meta[np.arange(n), (y * 20 + rng.integers(0, 20, n)).astype(int)] = 1
    given = np.full(n, np.nan)
    given[:60] = y[:60]
    held = np.zeros(n, bool)
    held[30:60] = True
    alone, taught = co_train(text, meta, given, held, rounds=0), co_train(text, meta, given, held, rounds=6)
    assert taught.history[-1][0] > 100 and taught.history[-1][1] > 100

    def right(model, k):
        raw = (((text - model.shift) / model.scale) @ model.text[:-1] + model.text[-1], meta @ model.meta[:-1] + model.meta[-1])[k]
        return ((raw > 0) == (y == 1))[60:].mean()

    assert right(taught, 1) > right(alone, 1) + 0.03 and right(taught, 0) > 0.95


def test_cells_of_odd_values():
    for source, lang, size in [(None, None, None), ("", "", float("nan")), ("s" * 999, "é", -5), ("s", "l", 1e300)]:
        cells = meta_cells(source, lang, size)
        assert len(set(cells)) == 6 and all(0 <= c < META for c in cells)
    assert meta_cells(None, None, None)[2] == meta_cells("a", "b", None)[2] != meta_cells(None, None, 3)[2]


def loop_features(text):
    """The text view's numbers, one at a time."""
    out, words = [0.0] * (WORDS + DENSE), text.lower().split()
    if not words:
        return out
    for w in words:
        out[xxhash.xxh32_intdigest(w) % WORDS] += 16 / len(words)
    for k, members in enumerate(KINDS):
        out[WORDS + k] = sum(text.count(bytes([c])) for c in members) / len(text) * 4
    lines = text.split(b"\n")
    out[WORDS + len(KINDS) :] = math.log(len(text) / len(words)), len(set(words)) / len(words), len(set(lines)) / len(lines), math.log(len(words)) / 8, math.log(len(lines)) / 8, math.log(1 + len(text) / len(lines)) / 8
    return out


def test_features_against_a_loop():
    for text in (b"", b" \n ", b"One two, TWO!\nthree\n\n", "Größe & <b>中文</b> 12 34".encode(), b"same line\n" * 500):
        np.testing.assert_allclose(text_features(text), loop_features(text), rtol=1e-4, atol=1e-6)


def loop_training(views, y, held, rounds, share, sure):
    """Co-training by lists: each round each view's surest pool rows are taught to the other view."""
    known = [v == v for v in y]
    fit = [k and not h for k, h in zip(known, held, strict=True)]
    base = sum(v for v, k in zip(y, known, strict=True) if k) / sum(known)
    labels = [{i: (y[i], 1.0) for i in range(len(y)) if fit[i]} for _ in views]
    pool = [i for i in range(len(y)) if not known[i]]
    for k in range(rounds + 1):
        weights = []
        for x, mine in zip(views, labels, strict=True):
            rows = sorted(mine)
            weights.append(logistic(x[rows], np.array([mine[i][0] for i in rows], np.float32), np.array([mine[i][1] for i in rows])))
        if k == rounds:
            return weights, [len([i for i in mine if i in set(pool)]) for mine in labels]
        lessons = []
        for own in (0, 1):
            p = {i: float(sigmoid(views[own][i] @ weights[own][:-1] + weights[own][-1])) for i in pool if i not in labels[1 - own]}
            n = max(2, int(share * len(pool)))
            up = max(1, round(n * base))
            lessons.append((1 - own, [i for i in sorted(p, key=lambda i: (-p[i], i))[:up] if p[i] >= sure], [i for i in sorted(p, key=lambda i: (p[i], i))[: max(1, n - up)] if p[i] <= 1 - sure]))
        for other, good, bad in lessons:
            labels[other] |= {i: (1.0, 0.3) for i in good} | {i: (0.0, 0.3) for i in bad}


def test_training_against_a_loop():
    rng = np.random.default_rng(6)
    n = 900
    y = (rng.random(n) < 0.4).astype(float)
    text = np.zeros((n, WORDS + DENSE), np.float32)
    text[:, :6] = rng.normal(size=(n, 6)) + y[:, None]
    meta = np.zeros((n, META), np.float32)
    meta[np.arange(n), (y * 8 + rng.integers(0, 12, n)).astype(int)] = 1
    given, held = np.where(np.arange(n) < 200, y, np.nan), (np.arange(n) < 200) & (np.arange(n) % 4 == 0)
    model = co_train(text, meta, given, held, rounds=3, share=0.1, sure=0.8)
    views = ((text - model.shift) / model.scale, meta)
    weights, taught = loop_training(views, given.tolist(), held.tolist(), 3, 0.1, 0.8)
    assert model.history[-1] == taught and min(taught) > 20
    np.testing.assert_allclose(model.text, weights[0], rtol=1e-3, atol=1e-4)
    np.testing.assert_allclose(model.meta, weights[1], rtol=1e-3, atol=1e-4)
    for k in range(0, n, 90):
        logits = [a * (float(v[k] @ w[:-1]) + float(w[-1])) + b for (a, b), v, w in zip(model.platt, views, weights, strict=True)]
        expected = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(model.joint[:-1], logits, strict=True)) + model.joint[-1])))
        assert model.score(text[k : k + 1], meta[k : k + 1])[0] == pytest.approx(expected, abs=2e-3)


def test_rows_and_odd_rows(spark):
    good = [(i, f"the plain words of text {i} are here", "s", "en", 30) for i in range(200)]
    bad = [(1000 + i, f"BUY!! NOW!! {i} ###", "s", "en", 20) for i in range(200)]
    odd = [(5000, None, None, None, None), (5001, "", "s", "en", 0), (None, "BUY!! NOW!!", "s", "en", 9), (5002, "the plain words " * 30_000, "s", "en", 9), (5002, "the plain words " * 30_000, "s", "en", 9)]
    frame = spark.createDataFrame([(*r, 1.0) for r in good + bad + odd], "doc_id long, text string, source string, lang string, n_chars long, score double")
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000)) for r in good + bad if r[0] % 2] + [(None, 1), (7, None), (9, 1), (77777, 0)], "doc_id long, quality int")
    model = train(frame, labels)
    got = score_documents(frame, model).collect()
    assert len(got) == 405 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["id"]: r["score"] for r in got}
    assert all(score[r[0]] > 0.5 for r in good) and all(score[r[0]] < 0.5 for r in bad) and score[5002] > 0.5 > score[None]
    assert score_documents(frame.limit(0), model).count() == 0


def test_without_labels(spark):
    frame = spark.createDataFrame([(1, "a", "s", "en", 1)], "doc_id long, text string, source string, lang string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert [r["score"] for r in score_documents(frame, train(frame, none)).collect()] == [0.5]
    assert [r["score"] for r in score_documents(frame, train(frame, one)).collect()] == [1.0]


def test_accuracy(spark):
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    got = [r for r in query(spark, path).collect() if r["doc_id"] in label]
    assert sum(r["keep"] == bool(label[r["doc_id"]]) for r in got) / len(got) > 0.97
