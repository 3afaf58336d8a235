import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from waymark.llm import simhash
from waymark.llm.simhash import drop_near_duplicates, drop_similar, fingerprint, indices, keys, links, near_duplicates, similar_documents


def brute_print(text):
    words, low = [], "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aAÉé \n\x1c\x85b.", max_size=60))
@settings(max_examples=150, deadline=None)
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_print(text)


def test_long_text_in_blocks():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert fingerprint(text.encode()) == brute_print(text)


def test_vectors_within_two_bits_share_an_index():
    """By linearity one vector of each coset stands for all."""
    table, count = simhash._patterns()
    assert set(count.tolist()) == {1, 6}
    vectors = table[:, 0]
    own, n = indices(vectors)
    held = [set(r[:k].tolist()) for r, k in zip(own, n, strict=True)]
    flips = [1 << a for a in range(23)] + [1 << a | 1 << b for a in range(23) for b in range(a)]
    for flip in flips:
        theirs, m = indices(vectors ^ flip)
        assert all(h & set(r[:k].tolist()) for h, r, k in zip(held, theirs, m, strict=True))


def components(prints, distance=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(p)
    return sorted(map(sorted, groups.values()))


def ball(rng, centre, n, radius):
    out = {centre}
    while len(out) < n:
        p = centre
        for b in rng.integers(0, 64, radius):
            p ^= 1 << int(b)
        out.add(p)
    return out


def test_keys_and_links_find_all_components():
    rng = np.random.default_rng(5)
    prints = set(map(int, rng.integers(0, 2**64, 300, dtype=np.uint64)))
    for c in list(prints)[:20]:
        prints |= ball(rng, c, 6, 4)
    prints |= ball(rng, 0, 60, 3)
    prints = sorted(prints)
    a = np.array(prints, np.uint64)
    row, key = keys(a)
    order = np.argsort(key, kind="stable")
    u, v = links(key[order], a[row][order], 4)
    assert (np.bitwise_count(u ^ v) <= 4).all()
    linked = {p: {p} for p in prints}
    for x, y in zip(u.tolist(), v.tolist(), strict=True):
        if linked[x] is not linked[y]:
            both = linked[x] | linked[y]
            for p in both:
                linked[p] = both
    assert sorted({tuple(sorted(x)) for x in linked.values()}) == list(map(tuple, components(prints)))


TEXTS = [None, "", " \n", "one two", "one  TWO", " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(399)) + " end", "alone in the world of words", "alone in the world of words"]


def test_whole_operator_against_brute_force(spark):
    rows = [(i if i != 6 else None, t, "x") for i, t in enumerate(TEXTS)] + [(3, "one two", "again"), (50, " ".join(f"w{i}" for i in range(398)) + " the end", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, print string")
    prints = [brute_print(t) for _, t, _ in rows]
    smallest = {}
    for group in components(sorted(set(prints))):
        ids = [r[0] for r, p in zip(rows, prints, strict=True) if p in group and r[0] is not None]
        smallest |= {p: min(ids, default=None) for p in group}
    got = sorted(((r["id"], r["print"] % 2**64, r["component"]) for r in near_duplicates(frame).collect()), key=str)
    assert got == sorted(((r[0], p, smallest[p]) for r, p in zip(rows, prints, strict=True)), key=str)
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({smallest[p] for p in prints})
    assert near_duplicates(frame.limit(0)).count() == 0 and drop_near_duplicates(frame.limit(0)).count() == 0


def test_a_component_without_ids(spark):
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "other words here now")], "doc_id long, text string")
    assert [r["component"] for r in near_duplicates(frame).collect()] == [None] * 3
    assert drop_near_duplicates(frame).count() == 2


def test_groups_of_most_rows(spark):
    """Copies of one text, and texts that differ from it a little, are two thirds of the rows; further columns may have any name and type."""
    n, base = 1800, [f"w{i}" for i in range(3000)]
    same, close = " ".join(base), [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in range(0, 3000, 10)]
    rows = [(i, same if i % 3 else close[i // 3 % len(close)] if i % 6 else f"alone {i} " * 5) for i in range(n)]
    frame = spark.createDataFrame([(*r, {"k": 1}, 0, "x") for r in rows], "doc_id long, text string, m map<string,int>, may int, row string")
    smallest, prints = {}, {t: brute_print(t) for _, t in rows}
    for group in components(sorted(set(prints.values()))):
        smallest |= dict.fromkeys(group, min(i for i, t in rows if prints[t] in group))
    found = near_duplicates(frame)
    assert {r["id"]: r["component"] for r in found.collect()} == {i: smallest[prints[t]] for i, t in rows}
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(smallest.values()))
    assert "part#" in found._jdf.queryExecution().executedPlan().toString()


def shingles(text, words=5):
    parts = (text or "").lower().split()
    return {" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def test_share_of_similar_pairs_that_have_a_common_key():
    """At a Jaccard similarity s two sets' cosine is 2s / (1 + s), and a bit differs with its angle's share of half a turn."""
    rng = np.random.default_rng(9)
    for similarity, least in ((0.8, 0.9), (0.85, 0.955), (0.9, 0.985)):
        odds = np.arccos(2 * similarity / (1 + similarity)) / np.pi
        n, met = 2000, np.zeros(2000, bool)
        for _ in range(2):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            b = a ^ np.packbits(rng.random((n, 64)) < odds, axis=1, bitorder="little").view("<u8")[:, 0]
            (ra, ka), (rb, kb) = keys(a), keys(b)
            common = set(zip(ra.tolist(), ka.tolist(), strict=True)) & set(zip(rb.tolist(), kb.tolist(), strict=True))
            met[[r for r, _ in common]] = True
        assert met.mean() > least


def test_similar_documents_against_all_pairs(spark):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(5000)]
    rows, number = [], 0
    for group in range(60):
        base = list(rng.choice(words, int(rng.integers(60, 600))))
        for _ in range(6):
            text = list(base)
            for at in rng.integers(0, len(text), int(rng.integers(0, max(1, len(text) // 60) + 1))):
                text[at] = str(rng.choice(words))
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "one two"), (9004, "One  TWO"), (9005, "one two three"), (None, "alone here"), (None, "alone here"), (3, rows[3][1])]
    frame = spark.createDataFrame([(*r, {"k": 1}, "x") for r in rows], "doc_id long, text string, m map<string,int>, row string")
    sets = [shingles(t) for _, t in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in linked:
        root[find(i)] = find(j)
    truth = [find(i) for i in range(len(rows))]
    found = {}
    for r in similar_documents(frame).collect():
        found[r["id"], r["body"] % 2**64] = r["root"], r["component"]
    key = [found[i, xxhash.xxh64_intdigest((t or "").encode(), 42)] for i, t in rows]
    # nothing is linked that isn't by all pairs, and nearly all that is
    by_root = {}
    for k, t in zip(key, truth, strict=True):
        assert by_root.setdefault(k[0], t) == t
    hit = sum(key[i] == key[j] for i, j in linked)
    assert hit > 0.95 * len(linked) and len(linked) > 300
    for k in set(key):
        ids = [r[0] for r, x in zip(rows, key, strict=True) if x == k and r[0] is not None]
        assert k[1] == min(ids, default=None)
    kept = drop_similar(frame)
    assert kept.columns == frame.columns and kept.count() == len({k[0] for k in key})
    assert similar_documents(frame.limit(0)).count() == 0 and drop_similar(frame.limit(0)).count() == 0


def test_a_large_group_of_similar_texts(spark):
    """A text with hundreds of variants: keys with more members than are compared in all pairs, and a hub in several parts."""
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(400)]
    variants = [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in rng.permutation(400)[:350]] + [" ".join(base)]
    rows = [(i, t) for i, t in enumerate(variants)] + [(1000 + i, " ".join(f"{i}-{k}" for k in range(50))) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["component"] for r in similar_documents(frame).collect()}
    assert got == {i: 0 if i < 1000 else i for i, _ in rows}


def test_verification_by_parts(spark, monkeypatch):
    """A hub's edges dealt over several parts give the same edges."""
    from waymark.llm import simhash

    from waymark.llm import common

    monkeypatch.setattr(simhash, "HUB", 3)
    monkeypatch.setattr(common, "LIGHT", 2)
    monkeypatch.setattr(common, "FEW", 20)
    rng = np.random.default_rng(13)
    sets = {p: np.unique(rng.integers(0, 40, 30).astype("<u4")) for p in range(-5, 30)}
    frame = spark.createDataFrame([(p, s.tobytes()) for p, s in sets.items()], "print long, shingles binary")
    edges = {(max(a, b), min(a, b)) for a, b in rng.integers(-5, 30, (150, 2)).tolist() if a != b} | {(k, -5) for k in range(30)}
    got = simhash.verified(spark.createDataFrame(list(edges), "u long, v long"), frame, 0.35)
    assert sorted(map(tuple, got.collect())) == sorted((u, v) for u, v in edges if simhash.jaccard(sets[u], sets[v]) >= 0.35)


def test_similar_documents_lose_no_link(spark):
    """Pairs at the threshold, and a group of variants under shingles that more texts have than are compared in all pairs at once."""
    rng = np.random.default_rng(21)
    words, texts = [f"w{i}" for i in range(5000)], []
    for _ in range(200):  # 9 of 81 shingles differ on either side: 72 of 90 in common; or 10 of them
        base = list(rng.choice(words, 85, replace=False))
        texts += [" ".join(base), " ".join([*base[: -9 - int(rng.integers(0, 2))], *(f"x{rng.integers(10**6)}" for _ in range(9))])]
    base = list(rng.choice(words, 300, replace=False))
    for _ in range(3 * simhash.BULK):
        text = list(base)
        for at in rng.integers(5, 290, int(rng.integers(1, 12))):
            text[at] = f"y{rng.integers(10**6)}"
        texts.append(" ".join(text))
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = 0
    for i in range(len(texts)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                linked += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    truth = {i: find(i) for i in range(len(texts))}
    assert linked > 500 and 100 < len(set(truth.values())) < len(texts) - 100
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["id"]: r["component"] for r in similar_documents(frame).collect()} == truth


def test_folded_bitmaps_never_differ_by_more_than_the_sets():
    rng = np.random.default_rng(22)
    for n, m in ((3, 5), (700, 900), (40, 5000)):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**64, m, dtype=np.uint64)]))
        x, y = simhash.parity(a), simhash.parity(b)
        assert len(x) * 8 >= max(1024, 2 * len(a)) and np.array_equal(simhash.folded(y, 128), np.packbits(np.bincount(b & np.uint64(1023), minlength=1024).astype(np.uint8) & 1))
        size = min(len(x), len(y))
        assert np.bitwise_count(simhash.folded(x, size) ^ simhash.folded(y, size)).sum() <= len(np.setxor1d(a, b))
