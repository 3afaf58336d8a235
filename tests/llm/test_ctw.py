import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from waymark.llm import bytectx, contexttree, ctw
from waymark.llm.ctw import _HALF, _WHOLE, DEPTH, _log_gamma, corpus_counts, fit, score_texts

TEXTS = ["the cat sat on the mat", "the dog ate the cat", "", None, "Über\tdie Straße", "a a a b", "THE END of the line " * 4]


def test_log_gamma():
    n = np.array([[0, 1, 2, 7, 8191, 8192, 100_000, 10**9]])
    assert np.allclose(_log_gamma(_HALF, 0.5, n), [[math.lgamma(v + 0.5) for v in n[0].tolist()]], rtol=1e-12, atol=1e-11)
    assert np.allclose(_log_gamma(_WHOLE, 1.0, n), [[math.lgamma(v + 1) for v in n[0].tolist()]], rtol=1e-12, atol=1e-11)


def padded(text):
    return bytes(DEPTH) + text + b"\0"


class Brute:
    """CTW node by node: counts of (context, leading bits) in dictionaries, probabilities by recursion."""

    def __init__(self, texts, known):
        """known(context): whether a context of two bytes or more is a node."""
        self.counts, self.children, self.known = defaultdict(lambda: [0, 0]), defaultdict(set), known
        self.alphabet = sorted({b for t in texts for b in padded(t)[DEPTH:]})
        for t in texts:
            p = padded(t)
            for i in range(DEPTH, len(p)):
                path = self.path(p[i - DEPTH : i])
                for a, b in zip(path, path[1:], strict=False):
                    self.children[a].add(b)
                for s in path:
                    for node, bit in self.bits(p[i]):
                        self.counts[s, node][bit] += 1

    def bits(self, byte):
        symbol = self.alphabet.index(byte) + 1 if byte in self.alphabet else 0
        return [(symbol >> (7 - k) | 1 << k, symbol >> (6 - k) & 1) for k in range(7)]

    def path(self, before):
        """Contexts from the empty one on; where the tree ends there is the rest of the last one, if that has longer ones."""
        out = [b""]
        for k in range(1, DEPTH + 1):
            if not self.known(before[-k:]):
                return [*out, b"rest" + out[-1]] if any(self.known(bytes([b]) + out[-1]) for b in range(256)) else out
            out.append(before[-k:])
        return out

    def kt(self, s, node):
        a, b = self.counts.get((s, node), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, s, node):
        if not self.children[s]:
            return self.kt(s, node)
        return np.logaddexp(self.kt(s, node), sum(self.weighted(c, node) for c in self.children[s])) - math.log(2)

    def one(self, path, node):
        a, b = self.counts.get((path[0], node), (0, 0))
        own = (b + 0.5) / (a + b + 1)
        if len(path) == 1:
            return own
        w = math.exp(self.kt(path[0], node) - math.log(2) - self.weighted(path[0], node))
        return w * own + (1 - w) * self.one(path[1:], node)

    def score(self, text):
        p, total = padded(text), 0.0
        for i in range(DEPTH, len(p)):
            path = self.path(p[i - DEPTH : i])
            for node, bit in self.bits(p[i]):
                q = self.one(path, node)
                total += math.log10(q if bit else 1 - q)
            if p[i] not in self.alphabet:
                total -= math.log10(256 - len(self.alphabet))
        return total


@pytest.mark.parametrize("most", [0, 40, 10**6])
def test_scores_against_brute_force(spark, monkeypatch, most):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tree = fit(corpus_counts(frame), max_contexts=most)
    lowered = [(t or "").encode().lower() for t in TEXTS]
    seen = Counter(padded(t)[i - k : i] for t in lowered for i in range(DEPTH, len(padded(t))) for k in range(1, DEPTH + 1))
    size = Counter(math.floor(math.log2(n) * 8) for c, n in seen.items() if len(c) > 1)
    kept, least = 0, math.inf
    for s in sorted(size, reverse=True):
        kept += size[s]
        if kept > most:
            break
        least = s
    brute = Brute(lowered, lambda c: c in seen and (len(c) == 1 or math.floor(math.log2(seen[c]) * 8) >= least))
    texts = [b"the cat ate", b"", b"\xffqq\0zz", "straße".encode(), b"the end of the line"]
    for block in (1 << 20, 4):
        monkeypatch.setattr(bytectx, "BLOCK", block)
        assert tree.score(texts).tolist() == pytest.approx([brute.score(t) for t in texts], rel=1e-5)
    costs = tree.table.reshape(-1, tree.width).astype(float)
    costs[:, 0] += math.log10(256 - len(brute.alphabet))
    assert np.allclose(np.power(10, costs).sum(axis=1), 1, atol=1e-4)


def test_base_score_with_few_hot_words(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "the unknown cat", 2), (90, "word " * 100_000, 3), (90, "word " * 100_000, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    train = frame.filter("doc_id < 5")
    counts = Counter(w for _, t, _ in rows[:5] for w in (*(t or "").lower().split(), None))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t, _ in rows:
        tokens = [*(t or "").lower().split(), None]
        known = sum(counts[w] > 0 for w in tokens)
        expected[i, len(tokens), known, n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 4)] += 1
    for hot in (1, 3, 1000):
        got = score_texts(frame, train, hot_words=hot).collect()
        assert Counter((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
        assert all(r["score"] < 0 for r in got)


def test_empty(spark):
    frame = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    assert score_texts(frame.limit(0), frame).count() == 0
    r = score_texts(frame, frame.limit(0)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (2, 0, 0, 0.0)
    assert r["score"] == pytest.approx(-3 * math.log10(256), rel=1e-4)


@pytest.mark.parametrize(("flush", "size"), [(1_500_000, 1 << 23), (20, 16)])
def test_scores_of_the_whole_tree(spark, monkeypatch, flush, size):
    monkeypatch.setattr(contexttree, "FLUSH_CODES", flush)
    monkeypatch.setattr(ctw, "PART_BYTES", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        asked = ["the cat ate", "", None, "\u00ffqq\0zz", "straße", "The end of the line", "the cat ate"]
        frame = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
        train = spark.createDataFrame([(t,) for t in TEXTS], "text string")
        found = {r["id"]: r["score"] for r in score_texts(frame, train).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    lowered = [(t or "").encode().lower() for t in TEXTS]
    seen = {padded(t)[i - k : i] for t in lowered for i in range(DEPTH, len(padded(t))) for k in range(1, DEPTH + 1)}
    brute = Brute(lowered, seen.__contains__)
    assert [found[i] for i in range(len(asked))] == pytest.approx([brute.score((t or "").encode().lower()) for t in asked], rel=1e-5)


def test_no_bound_on_contexts(spark):
    rng = np.random.default_rng(5)
    text = "".join(map(chr, rng.integers(97, 123, 64_000) - rng.integers(0, 60, 64_000)))
    texts = [text[i : i + 1000] for i in range(0, len(text), 1000)]
    lowered = [t.encode().lower() for t in texts]
    contexts = {padded(t)[i - k : i] for t in lowered for i in range(DEPTH, len(padded(t))) for k in range(2, DEPTH + 1)}
    assert len(contexts) > 131_072
    train = spark.createDataFrame([(t,) for t in texts * 4], "text string")
    asked = [*texts[:3], text[500:1500], "some other text"]
    counts = corpus_counts(train)
    expected, bounded = (fit(counts, max_contexts=n).score([t.encode().lower() for t in asked]) for n in (10**9, 131_072))
    assert expected[0] > 0.9 * bounded[0]
    found = {r["id"]: r["score"] for r in score_texts(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), train).collect()}
    assert [found[i] for i in range(len(asked))] == pytest.approx(expected.tolist(), rel=1e-5)


def test_all_bytes(spark):
    rng = np.random.default_rng(6)
    train = spark.createDataFrame([(bytearray(range(256)),), (bytearray(rng.integers(0, 256, 2000).astype(np.uint8)),)], "text binary")
    asked = [bytes(range(20, 60)), bytes(rng.integers(0, 256, 50).astype(np.uint8))]
    frame = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(asked)], "doc_id long, text binary")
    found = {r["id"]: r["score"] for r in score_texts(frame, train).collect()}
    expected = fit(corpus_counts(train), max_contexts=10**9).score([t.lower() for t in asked])
    assert [found[i] for i in range(2)] == pytest.approx(expected.tolist(), rel=1e-5)
