import hashlib
import math
from collections import Counter, defaultdict

import pytest

from waymark.llm.mixing import blocks, mix, weights

ROWS = [(i, "w " * (i % 7), ["a", "a", "a", "a", "b", "c", None][i % 7]) for i in range(400)] + [(500, None, "d"), (501, "", "d"), (502, "x\x1cy z\n", "d"), (7, "w " * 3, "a"), (7, "w " * 3, "a"), (None, "one", "b")]


def exponent(shares, entropy, repeats):
    def weights_of(a):
        z = sum(p**a for p in shares)
        return [p**a / z for p in shares]

    def h(a):
        return -sum(w * math.log(w) for w in weights_of(a))

    def search(up):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if up(mid) else (lo, mid)
        return lo

    goal = entropy * math.log(len(shares))
    one = 1.0 if len(shares) == 1 or h(1.0) >= goal else search(lambda a: h(a) >= goal)
    ratio = max(shares) / min(shares)
    return max(one, 0.0 if ratio <= repeats else search(lambda a: ratio ** (1 - a) > repeats))


@pytest.mark.parametrize(("entropy", "repeats"), [(0.97, 2.0), (0.6, 50.0), (1.0, 3.5), (0.999, 1000.0)])
def test_weights_against_brute_force(spark, entropy, repeats):
    tokens = [5000, 900, 800, 40, 41]
    frame = spark.createDataFrame([(str(i), t, 1) for i, t in enumerate(tokens)], "skey string, tokens long, docs long")
    got = {r["skey"]: r for r in weights(frame, entropy, repeats).collect()}
    shares = [t / sum(tokens) for t in tokens]
    a = exponent(shares, entropy, repeats)
    z = sum(p**a for p in shares)
    for i, p in enumerate(shares):
        r = got[str(i)]
        assert r["weight"] == pytest.approx(p**a / z, rel=1e-6) and r["exponent"] == pytest.approx(a, abs=1e-8)
        assert tokens[i] <= r["quota"] <= repeats * tokens[i] + 1
        assert r["full"] * tokens[i] + r["rest"] == r["quota"]


def size(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return 1 + len([w for w in text.split(" ") if w])


@pytest.mark.parametrize("per_range", [3, 10**6])
def test_blocks_against_brute_force(spark, per_range):
    frame = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, tokens int")
    got = blocks(frame, block_tokens=100, per_range=per_range, max_repeats=3.0).collect()
    total = Counter()
    for _, t, s in ROWS:
        total[s] += size(t)
    a = exponent([n / sum(total.values()) for n in total.values()], 0.97, 3.0)
    quota = {s: max(n, round(n**a * max(total.values()) ** (1 - a))) for s, n in total.items()}
    n_blocks = math.ceil(sum(quota.values()) / 100)
    expected = Counter()
    for s, n in total.items():
        for k in range(quota[s] // n + 1):
            at, first = 0, {}
            order = sorted((hashlib.md5(f"17|{k}|{'null' if i is None else i}".encode()).hexdigest(), size(t), str(i)) for i, t, src in ROWS if src == s)
            for h, m, i in order:
                if k < quota[s] // n or first.setdefault(h, at) < quota[s] % n:
                    expected[i, s, k, m, min(n_blocks - 1, (k * n + at) * n_blocks // quota[s])] += 1
                at += m
    assert Counter((str(r["id"]), r["source"], r["pass"], r["tokens"], r["block"]) for r in got) == expected
    shares = defaultdict(Counter)
    for r in got:
        shares[r["block"]][r["source"]] += r["tokens"]
    assert set(shares) == set(range(n_blocks))


@pytest.mark.parametrize("per_range", [3, 10**6])
def test_mix_takes_what_blocks_take(spark, per_range):
    frame = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, `__wm` int")
    mixed = mix(frame, per_range=per_range, max_repeats=3.0)
    assert mixed.columns == frame.columns
    got = Counter((r["doc_id"], r["source"]) for r in mixed.collect())
    expected = Counter((r["id"], r["source"]) for r in blocks(frame, per_range=per_range, max_repeats=3.0).collect())
    assert got == expected
    assert set(got) >= {(i, s) for i, _, s in ROWS}


def test_fixed_budget_and_odd_tables(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    taken = blocks(frame, budget=300).collect()
    assert 300 <= sum(r["tokens"] for r in taken) < 300 + 7 * 5
    assert blocks(frame.limit(0)).count() == 0 and mix(frame.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a b", "s"), (2, "c", "s")], "doc_id long, text string, source string")
    assert sorted(r["id"] for r in blocks(one).collect()) == [1, 2] and mix(one).count() == 2
