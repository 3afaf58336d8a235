"""Quality classifier by co-training.

Two classifiers see different views of a document. The text view has hashed words (as shares of all words) and shares of
kinds of bytes, word and line lengths and repetition. The metadata view has source, language and recorded size and their pairs, all
as buckets, and nothing of the text. Both are logistic regressions, first fitted on labelled documents. In each
round each view labels those documents of an unlabelled pool that it is most sure of, in the proportion of the labels,
and gives them to the other view, which is fitted anew. At the end each view is calibrated (Platt scaling) on labelled
documents that no fit has seen, and the calibrated log-odds are combined by a third fit there, which gives a view that
says nothing no weight. All documents are scored in one pass.

Bounds of the sample that is fitted: `labelled` documents with a label and `pool` without, by hash of their ids, none
longer than `longest` bytes. Their features, not their texts, go to the driver.

Null texts count as empty; a null source, language or size is a bucket of its own. A null id is not trained on. A
document with several labels counts once with their mean, rounded up at one half. Ties in confidence go to the smaller id. With no labels of one of the classes
the score is the share of good labels (0.5 without any). Repeated rows each get their row. Very long texts are scored
whole. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import documents, mapped, remember

WORDS = 512
#: Kinds of bytes whose shares are features.
KINDS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".,;:", b"!?", b"|", b"#$%&*@^~", b"()[]{}<>", b"\"'`", b"=+-_/\\", bytes(range(128, 256)))
DENSE = len(KINDS) + 6
SOURCES, LANGUAGES, STEPS, PAIRS = 64, 32, 24, 256
META = SOURCES + LANGUAGES + STEPS + 3 * PAIRS


def _kind_table() -> np.ndarray:
    table = np.zeros((256, len(KINDS)), np.float32)
    for k, members in enumerate(KINDS):
        table[list(members), k] = 1
    return table


_BYTES = _kind_table()


class _Buckets(dict):
    """Bucket of a word; short words are remembered, a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh32_intdigest(word) % WORDS
        if not self:
            remember("quality", self.clear)
        if len(word) <= 24 and len(self) < 400_000:
            self[word] = found
        return found


_BUCKETS = _Buckets()


def text_features(text: bytes) -> np.ndarray:
    out = np.zeros(WORDS + DENSE, np.float32)
    words = text.lower().split()
    if not words:
        return out
    at = np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words))
    out[:WORDS] = np.bincount(at, minlength=WORDS) * (16 / len(words))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    out[WORDS : WORDS + len(KINDS)] = counts @ _BYTES / len(text) * 4
    lines = text.split(b"\n")
    out[-6:] = np.log(len(text) / len(words)), len(set(words)) / len(words), len(set(lines)) / len(lines), np.log(len(words)) / 8, np.log(len(lines)) / 8, np.log(1 + len(text) / len(lines)) / 8
    return out


def _step(x: float) -> int:
    return min(STEPS - 2, int(2 * np.log2(1 + max(0.0, x))) // 2)


def meta_cells(source: str | None, lang: str | None, size: float | None) -> list[int]:
    """The metadata view's buckets that are set: one of each value, and one of each pair of values."""

    def hashed(value: str | None, n: int) -> int:
        return n - 1 if value is None else xxhash.xxh32_intdigest(value.encode()) % (n - 1)

    step = STEPS - 1 if size is None or size != size else _step(size)
    out = [hashed(source, SOURCES), SOURCES + hashed(lang, LANGUAGES), SOURCES + LANGUAGES + step]
    for k, pair in enumerate(((source, lang), (source, step), (lang, step))):
        out.append(SOURCES + LANGUAGES + STEPS + k * PAIRS + hashed(repr(pair), PAIRS + 1))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights (the last one is the constant) by accelerated gradient descent on the mean loss."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    share = (weight / weight.sum()).astype(x.dtype)
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(12):  # largest eigenvalue of the curvature
        v = x.T @ (share * (x @ v))
        norm = np.linalg.norm(v)
        v /= norm
    rate = 4 / (norm + 4 * ridge)
    w, ahead = np.zeros(x.shape[1], x.dtype), np.zeros(x.shape[1], x.dtype)
    for k in range(steps):
        new = ahead - rate * (x.T @ (share * (sigmoid(x @ ahead) - y)) + ridge * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's slope and constant; the slope is not below 0. Newton's method with targets drawn in from 0 and 1."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([logit, np.ones_like(logit)], axis=1).astype(float)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target) + 1e-6 * w)
        w -= step / max(1.0, float(np.abs(step).max()))
    return max(0.0, float(w[0])), float(w[1])


@dataclass
class Model:
    base: float = 0.5  # the score where there is nothing to fit
    text: np.ndarray | None = None
    meta: np.ndarray | None = None
    platt: tuple = ((1.0, 0.0), (1.0, 0.0))
    joint: np.ndarray | None = None
    shift: np.ndarray = field(default_factory=lambda: np.zeros(WORDS + DENSE, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(WORDS + DENSE, np.float32))
    history: list = field(default_factory=list)

    def views(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views, a column each."""
        raw = ((text - self.shift) / self.scale) @ self.text[:-1] + self.text[-1], meta @ self.meta[:-1] + self.meta[-1]
        return np.stack([a * x + b for (a, b), x in zip(self.platt, raw, strict=True)], axis=1)

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.text is None:
            return np.full(len(text), self.base)
        return sigmoid(self.views(text, meta) @ self.joint[:-1] + self.joint[-1])


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = 4, share: float = 0.05, sure: float = 0.9) -> Model:
    """y: 1, 0, or nan for the pool; held: labelled rows kept for calibration."""
    known = ~np.isnan(y)
    fit = known & ~held
    model = Model(base=float(y[known].mean()) if known.any() else 0.5)
    if any(len(set(y[m].tolist())) < 2 for m in (fit, known & held)):
        return model
    model.shift = np.where(np.arange(text.shape[1]) >= WORDS, text[fit].mean(axis=0), 0).astype(np.float32)
    model.scale = np.where(np.arange(text.shape[1]) >= WORDS, text[fit].std(axis=0) + 0.05, 1).astype(np.float32)
    views = ((text - model.shift) / model.scale, meta)
    given = [np.where(fit, y, np.nan) for _ in views]  # what each view is taught
    pool = np.flatnonzero(~known)
    best: list[np.ndarray] = []
    for k in range(rounds + 1):
        best = []
        for x, labels in zip(views, given, strict=True):
            use = ~np.isnan(labels)
            best.append(logistic(x[use], labels[use].astype(np.float32), np.where(fit[use], 1.0, 0.3)))
        if k == rounds or not len(pool):
            break
        taught = []
        for own, (x, w) in enumerate(zip(views, best, strict=True)):
            other = 1 - own
            free = pool[np.isnan(given[other][pool])]
            p = sigmoid(x[free] @ w[:-1] + w[-1])
            n = max(2, int(share * len(pool)))
            up = max(1, round(n * model.base))
            for label, order, limit in ((1.0, np.argsort(-p, kind="stable"), up), (0.0, np.argsort(p, kind="stable"), max(1, n - up))):
                some = order[:limit]
                some = some[(p[some] >= sure) if label else (p[some] <= 1 - sure)]
                taught.append((other, free[some], label))
        for other, rows, label in taught:
            given[other][rows] = label
        model.history.append([int((~np.isnan(g[pool])).sum()) for g in given])
    model.text, model.meta = best
    check = known & held
    raw = model.views(text[check], meta[check])
    model.platt = tuple(calibrate(raw[:, k], y[check]) for k in range(2))
    model.joint = logistic(model.views(text[check], meta[check]).astype(np.float64), y[check], np.ones(int(check.sum())), ridge=1e-3, steps=500)
    model.joint[:-1] = np.maximum(model.joint[:-1], 0)
    return model


def _features(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[int]]]:
    """(text, set buckets) for each row of columns text, source, lang, size after the first."""
    texts = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(1).cast(pa.binary()))
    for text, source, lang, size in zip(texts, *(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
        yield text, meta_cells(source, lang, size)


def _rows(df: DataFrame, text: str, source: str, lang: str, size: str, id_col: str) -> DataFrame:
    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text", f"cast(`{source}` as string) source", f"cast(`{lang}` as string) lang", f"cast(`{size}` as double) size")


def _dense(cells: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(cells), META), np.float32)
    for k, c in enumerate(cells):
        out[k, c] = 1
    return out


def train(df: DataFrame, labels: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", size: str = "n_chars", id_col: str = "doc_id", label: str = "quality", labelled: int = 6000, pool: int = 6000, longest: int = 65536, rounds: int = 4) -> Model:
    """Fits on samples of labelled and of other documents."""
    mixed = F.xxhash64("id", F.lit("quality"))
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("double").alias("y")).filter("id is not null and y is not null")
    marks = marks.groupBy("id").agg(F.when(F.avg("y") >= 0.5, 1.0).otherwise(0.0).alias("y")).orderBy(mixed, "id").limit(labelled)
    rows = _rows(df, text, source, lang, size, id_col).filter((F.coalesce(F.octet_length("text"), F.lit(0)) <= longest) & F.col("id").isNotNull())
    total = df.count()
    drawn = F.pmod(mixed, F.lit(1_000_003)) < min(1.0, pool / max(1, total)) * 1_000_003
    # marks are at most `labelled` rows, the bound of what is broadcast
    sample = rows.join(F.broadcast(marks), "id", "left").filter(F.col("y").isNotNull() | drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values, cells = [], [], []
            for body, c in _features(batch):
                x = text_features(body)
                some = np.flatnonzero(x)
                at.append(some.astype(np.int32))
                values.append(x[some])
                cells.append(c)
            columns = [batch.column(0), batch.column(5), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32())), pa.array(cells, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "y", "at", "values", "cells"])

    found = sample.select("id", "text", "source", "lang", "size", "y").transform(mapped, run, "id long, y double, at array<int>, values array<float>, cells array<int>", "quality")
    table = found.limit(2 * (labelled + pool)).toArrow().sort_by("id")
    n = len(table)
    if not n:
        return Model()
    dense = np.zeros((n, WORDS + DENSE), np.float32)
    for k, (at, values) in enumerate(zip(table["at"], table["values"], strict=True)):
        dense[k, at.values.to_numpy()] = values.values.to_numpy()
    y = table["y"].to_numpy(zero_copy_only=False).astype(float)
    held = np.array([xxhash.xxh32_intdigest(str(i)) % 4 == 0 for i in table["id"].to_pylist()])
    return co_train(dense, _dense(table["cells"].to_pylist()), y, held, rounds)


def score_documents(df: DataFrame, model: Model, text: str = "text", source: str = "source", lang: str = "lang", size: str = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """(id, score, text_score, meta_score) for every row: the combined probability of good quality, and each view's own."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = sent.value
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.slice(at, 2000)
                found = [(text_features(body), cells) for body, cells in _features(some)]
                x, m = np.stack([f for f, _ in found]), _dense([c for _, c in found])
                both = sigmoid(ours.views(x, m)) if ours.text is not None else np.full((len(x), 2), ours.base)
                columns = [some.column(0), *(pa.array(np.asarray(c, float)) for c in (ours.score(x, m), both[:, 0], both[:, 1]))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "text_score", "meta_score"])

    return _rows(df, text, source, lang, size, id_col).transform(mapped, run, "id long, score double, text_score double, meta_score double", "quality")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every document's quality score, and whether it is kept."""
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = score_documents(docs, model)
    return found.select(F.col("id").alias("doc_id"), "score", "text_score", "meta_score", (F.col("score") >= 0.5).alias("keep"))
