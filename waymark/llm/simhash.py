"""Near duplicates: SimHash fingerprints linked through Golay-code keys.

A fingerprint has 64 bits, cut into segments of 21, 21 and 22. The binary Golay code has 4096 words of 23 bits, any
vector being within 3 bits of exactly one. A segment (padded with zeros) gets the indices of all code words within
distance 4: one if it lies within 2 of a code word, else six. Two vectors that differ in at most 2 bits always share
an index (checked for all cosets in the tests). By the pigeonhole principle, of at most 4 differing bits at most 2 fall
in the two best of three segments, so two linked fingerprints share a pair of indices for one of the three pairs of
segments. Such pairs (24 bits) are the keys; members of a key are verified on all 64 bits.

Distinct fingerprints only are keyed, so copies cost nothing. A key's members are read in sorted order by one task in
batches; small keys are compared pairwise in bulk, and large ones are searched breadth first: each step compares one
fingerprint with those not yet reached, and stops when all are. That gives a spanning forest (no more links than
members) of the same components as all pairs, so neither dense groups nor common keys multiply the output. A key's
members take 8 bytes each in the task.

`similar_documents` is for whole similarities: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, without
exception. Shingles are put in one order for all texts, rare ones first: a set of n of which another has so many in common shares one of its
first n - ceil(0.8 n) + 1 with the other's first ones (its prefix), whatever the order. So texts meet at the shingles of their prefixes, and
pairs whose sizes and places allow the similarity are verified on the whole sets of 64-bit hashes. Under a shingle of up to `BULK` texts
all pairs are candidates. Under a more frequent one the texts first meet around hubs; then all pairs that aren't in one component yet are
candidates. No pair is verified whose parity bitmaps differ in more bits than such sets can. So a large group of near copies costs few pairs, and no
link is lost but between texts that others link already. Which shingles count as frequent comes from a sample; that decides the cost only.

Null and empty texts, and texts of white space, have fingerprint zero and link like any other. Fewer words than a shingle count as
one shingle. Ties between the counts of ones and zeros give zero. Repeated rows each get their row. A null id is never
the smallest unless a component has no other. An empty table gives an empty result. Only the named columns are read by
`near_duplicates`; `drop_near_duplicates` passes all columns on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import bitmap, columns_of, documents, even_join, give_back, mapped, marked, slot, stored
from waymark.llm.components import connected_components

SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
POLYNOMIAL = 0b101011100011
SMALL = 8
#: Under a shingle of up to so many texts all pairs are candidates at once.
BULK = 32
#: Texts of the sample that tells frequent shingles, in how many of these such a shingle is, and the most that are kept (8 bytes each).
SAMPLE, OFTEN, FREQUENT = 5000, 3, 1 << 17
#: Least bits of a set's parity bitmap: each shingle flips one, so two sets differ in at least as many shingles as their bitmaps in bits.
#: A bitmap has at least two bits a shingle; folded (halves added up bit by bit) it is the bitmap of half the size.
PARITY = 1024


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, repeats included, in blocks. ASCII letters are lower-cased; words end at ASCII white space."""
    parts = (text or b"").lower().split()
    if not parts:
        return
    joined, sizes = b" ".join(parts), np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(parts) - words + 1)
    first = (ends - sizes)[:n].tolist()
    last = ends[words - 1 :].tolist() if len(parts) >= words else [len(joined)]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        yield np.array([digest(joined[a:b], seed) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)], strict=True)], "<u8")


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the shingles' hashes; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words, seed):
        ones += _ones(hashes)
        n += len(hashes)
    return _majority(ones, n)


def shingle_set(text: bytes | None, words: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    return np.unique(np.concatenate([np.empty(0, "<u8"), *shingle_hashes(text, words)]))


def _remainder(vectors: np.ndarray) -> np.ndarray:
    """Of 23-bit vectors as polynomials, divided by the code's: the syndrome."""
    out = vectors.copy()
    for bit in range(22, 10, -1):
        out ^= ((out >> bit) & 1) * (POLYNOMIAL << (bit - 11))
    return out


@cache
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the six (or one) error patterns of weight 4 or less, and how many."""
    table, count = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for error, at in zip(errors.tolist(), _remainder(errors).tolist(), strict=True):
            table[at, count[at]] = error
            count[at] += 1
    return table, count


def indices(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 12-bit indices of the code words within distance 4 of each 23-bit vector: an array of six columns, and how many hold."""
    table, count = _patterns()
    at = _remainder(segment)
    return (segment[:, None] ^ table[at]) >> 11, count[at]


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every key of the fingerprints: pair of segments and the two indices, in 26 bits."""
    found = [indices(((prints >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64)) for lo, n in SEGMENTS]
    rows, out = [], []
    for k, ((a, na), (b, nb)) in enumerate(combinations(found, 2)):
        for i in range(6):
            for j in range(6):
                hit = np.flatnonzero((na > i) & (nb > j))
                rows.append(hit)
                out.append((k << 24) | (a[hit, i] << 12) | b[hit, j])
    return np.concatenate(rows), np.concatenate(out)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of rows of fingerprints."""
    counts = np.bitwise_count(a ^ b)
    return counts[..., 0] if counts.shape[-1] == 1 else counts.sum(axis=-1)


def _search(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest of the graph of all pairs within the distance."""
    left = prints
    while len(left) > 1:
        frontier, left = [left[:1]], left[1:]
        while frontier and len(left):
            block = frontier.pop()
            for at in block:
                near = _apart(left, at) <= distance
                if near.any():
                    new = left[near]
                    yield np.repeat(at[None], len(new), axis=0), new
                    frontier.append(new)
                    left = left[~near]
                    if not len(left):
                        break


def links(key: np.ndarray, prints: np.ndarray, distance: int, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key: links that connect what is within the distance under one key; all of them for keys of up to `small` rows.

    prints: a column, or columns, of 64 bits; links are given by the first."""
    prints = prints.reshape(len(prints), -1)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([start, [len(key)]]))
    few = np.repeat(size <= small, size)
    some, theirs = prints[few], key[few]
    us, vs = [], []
    for step in range(1, small):
        same = np.flatnonzero(theirs[step:] == theirs[:-step])
        if not len(same):
            break
        near = same[_apart(some[same], some[same + step]) <= distance]
        us.append(some[near, 0])
        vs.append(some[near + step, 0])
    for at, n in zip(start[size > small].tolist(), size[size > small].tolist(), strict=True):
        for a, b in _search(prints[at : at + n], distance):
            us.append(a[:, 0])
            vs.append(b[:, 0])
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    u, v = np.concatenate(us), np.concatenate(vs)
    pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def fingerprints(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 4) -> DataFrame:
    """(id, print, body): a row per row; `body` is the text's own hash, to tell rows with one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(1).cast(pa.binary())]
            prints = np.array([fingerprint(x, words) for x in texts], np.uint64).view(np.int64)
            bodies = np.array([xxhash.xxh64_intdigest(x, 42) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), pa.array(bodies)], names=["id", "print", "body"])

    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text").transform(mapped, run, "id long, print long, body long")


def near_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (u > v, as unsigned) between distinct fingerprints (column print) that give the components of all links."""
    if distance > 4:
        raise ValueError("the keys of one fingerprint hold for at most 4 differing bits")
    return _links(prints, ["print"], distance, SMALL)


def _links(prints: DataFrame, columns: list[str], distance: int, small: int) -> DataFrame:
    """Edges between rows of fingerprints under one key of any of them, within the distance over all columns."""
    width = len(columns)
    rest = columns[1:]

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = np.stack([batch.column(k).to_numpy() for k in range(width)], axis=1).view(np.uint64)
            for at in range(0, len(whole), 8192):
                some = whole[at : at + 8192]
                for k in range(width):
                    row, key = keys(some[:, k])
                    held = [pa.array(some[row, c].view(np.int64)) for c in range(width)]
                    yield pa.RecordBatch.from_arrays([pa.array((key | (k << 26)).astype(np.int32)), *held], names=["key", *columns])

    def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(key: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            u, v = links(key, prints, distance, small)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            key, prints = batch.column(0).to_numpy(), np.stack([batch.column(1 + k).to_numpy() for k in range(width)], axis=1).view(np.uint64)
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if cut:
                held.append((key[:cut], prints[:cut]))
                yield from out(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            held.append((key[cut:], prints[cut:]))
        if held:
            yield from out(*map(np.concatenate, zip(*held, strict=True)))

    # a row becomes 85 for each fingerprint: rows are spread first, as a table of few bytes is read by few tasks
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.select(*columns).repartition(parts, columns[0]).transform(mapped, key_rows, "key int, " + ", ".join(f"{c} long" for c in [columns[0], *rest]))
    found = keyed.repartition("key").sortWithinPartitions("key").transform(mapped, link_rows, "u long, v long")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def frequent_shingles(df: DataFrame, text: str, words: int) -> np.ndarray:
    """Sorted hashes of shingles that several texts of a sample by hash have; at most `FREQUENT`, the most frequent ones."""
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    share = min(1.0, SAMPLE / max(1, df.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0).cast(pa.binary()):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(x.as_buffer().to_pybytes() if x.is_valid else b"", words).view(np.int64))], names=["token"])

    drawn = df.filter(F.pmod(body, F.lit(1_000_003)) < share * 1_000_003).select(F.col(text).alias("text")).distinct()
    counted = drawn.transform(mapped, run, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= OFTEN)
    found = counted.orderBy(F.desc("c"), "token").limit(FREQUENT).select("token").toArrow()["token"].to_numpy()
    return np.sort(found.view(np.uint64))


def prefix_size(n: np.ndarray | int, similarity: float):
    """So many first shingles of a set of n hold one of those that it has in common with any set of that similarity."""
    return np.where(np.asarray(n) > 0, n - np.ceil(similarity * np.asarray(n) - 1e-9) + 1, 0).astype(np.int64)


def _may(n: np.ndarray, pos: np.ndarray, m: np.ndarray, at: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles that meet first at these places of theirs can be so similar."""
    most = 1 + np.minimum(n - pos, m - at) - 1
    return most * (1 + similarity) >= similarity * (n + m) - 1e-6


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set, as bytes."""
    bits = max(PARITY, 1 << (2 * len(hashes)).bit_length())
    return np.packbits(np.bincount(hashes & np.uint64(bits - 1), minlength=bits).astype(np.uint8) & 1)


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """A parity bitmap with `size` bytes."""
    while len(bitmap) > size:
        bitmap = bitmap[: len(bitmap) // 2] ^ bitmap[len(bitmap) // 2 :]
    return bitmap


def shingled(df: DataFrame, text: str, id_col: str, words: int, similarity: float) -> DataFrame:
    """(id, print, body, size, parity, brief, prefix) for every row; print: the hash of the shingle set, parity: its bitmap, brief: that folded to the least
    size, prefix: its first shingles, rare ones before others."""
    often = frequent_shingles(df, text, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 500):
                some = batch.slice(start, 500)
                prints, bodies, sizes, parities, briefs, prefixes = [], [], [], [], [], []
                for x in some.column(1).cast(pa.binary()):
                    body = x.as_buffer().to_pybytes() if x.is_valid else b""
                    found = shingle_set(body, words)
                    prints.append(xxhash.xxh64_intdigest(found.tobytes(), 42))
                    bodies.append(xxhash.xxh64_intdigest(body, 42))
                    sizes.append(len(found))
                    bits = parity(found)
                    parities.append(bits.tobytes())
                    briefs.append(folded(bits, PARITY // 8).tobytes())
                    if len(often):
                        common = often[np.minimum(np.searchsorted(often, found), len(often) - 1)] == found
                        found = np.concatenate([found[~common], found[common]])
                    prefixes.append(found[: int(prefix_size(len(found), similarity))].view(np.int64))
                offsets = pa.array(np.cumsum([0, *map(len, prefixes)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(prefixes)))
                held = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (prints, bodies)]
                yield pa.RecordBatch.from_arrays([some.column(0), *held, pa.array(sizes, pa.int32()), pa.array(parities, pa.binary()), pa.array(briefs, pa.binary()), lists], names=["id", "print", "body", "size", "parity", "brief", "prefix"])

    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text").transform(mapped, run, "id long, print long, body long, size int, parity binary, brief binary, prefix array<long>")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of rows sorted by their first column, in parts that end where a key does."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        part = {n: np.array(c.to_pylist(), object) if pa.types.is_binary(c.type) else c.to_numpy() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        key = part[batch.schema.names[0]]
        if not len(key):
            continue
        first = int(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[-1])  # the last key may go on in the next batch
        if held and (first or held[-1][batch.schema.names[0]][-1] != key[0]):
            held.append({n: v[:first] for n, v in part.items()})
            yield {n: np.concatenate([h[n] for h in held]) for n in part}
            held = []
        elif first:
            yield {n: v[:first] for n, v in part.items()}
        held.append({n: v[first:] for n, v in part.items()})
    if held:
        yield {n: np.concatenate([h[n] for h in held]) for n in held[0]}


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, size) of runs of one key."""
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return start, np.diff(np.append(start, len(key)))


def _edges(us: list[np.ndarray], vs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, the larger end first."""
    u, v = (np.concatenate([np.empty(0, np.int64), *x]) for x in (us, vs))
    pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def meetings(reps: DataFrame, similarity: float) -> DataFrame:
    """Of distinct sets (print, size, prefix): rows (u, v, null..) of candidates under shingles of few sets, and (u, null, token, size, pos) of the
    members of each frequent one. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_key(batches):
            token, own, n, pos = (part[c] for c in ("token", "print", "size", "pos"))
            start, size = _groups(token)
            few = np.repeat((size > 1) & (size <= BULK), size)
            t, o, m, p = token[few], own[few], n[few].astype(np.int64), pos[few].astype(np.int64)
            us, vs = [], []
            for step in range(1, BULK):
                same = np.flatnonzero(t[step:] == t[:-step])
                if not len(same):
                    break
                same = same[_may(m[same], p[same], m[same + step], p[same + step], similarity)]
                us.append(o[same])
                vs.append(o[same + step])
            u, v = _edges(us, vs)
            many = np.repeat(size > BULK, size)
            k = int(many.sum())
            empty = lambda c, kind: pa.nulls(c, kind)
            for at in range(0, len(u), 100_000):
                some = slice(at, at + 100_000)
                c = len(u[some])
                yield pa.RecordBatch.from_arrays([pa.array(u[some]), pa.array(v[some]), empty(c, pa.int64()), empty(c, pa.int32()), empty(c, pa.int32())], names=["u", "v", "token", "size", "pos"])
            if k:
                yield pa.RecordBatch.from_arrays([pa.array(own[many]), empty(k, pa.int64()), pa.array(token[many]), pa.array(n[many]), pa.array(pos[many])], names=["u", "v", "token", "size", "pos"])

    rows = reps.select("print", "size", F.posexplode("prefix").alias("pos", "token")).select("token", "print", "size", "pos")
    found = rows.repartition("token").sortWithinPartitions("token").transform(mapped, run, "u long, v long, token long, size int, pos int")
    return stored(found, "meetings")


def crowded(members: DataFrame, sets: DataFrame, similarity: float, roots: DataFrame | None = None) -> DataFrame:
    """Candidates (u, v) under frequent shingles; members: (u, token, size, pos), sets: (print, brief).

    Without roots: each member with a hub that it may be similar to, if there is any. With roots (node, root): every pair in different
    components that may be similar."""
    whole = roots is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_key(batches):
            us, vs = [], []
            own, n, pos, root = part["u"], part["size"].astype(np.int64), part["pos"].astype(np.int64), part["root"]
            bits = np.frombuffer(b"".join(part["brief"]), np.uint64).reshape(len(own), -1)
            most = (1 - similarity) / (1 + similarity)

            def may(i: int, js: np.ndarray) -> np.ndarray:
                js = js[_may(n[i], pos[i], n[js], pos[js], similarity)]
                return js[np.bitwise_count(bits[js] ^ bits[i]).sum(axis=1, dtype=np.int64) <= most * (n[i] + n[js]) + 1e-6]

            for at, size in zip(*(x.tolist() for x in _groups(part["token"])), strict=True):
                left = np.arange(at, at + size)
                if not whole:
                    while len(left) > 1:
                        near = may(left[0], left[1:])
                        us.append(np.full(len(near), own[left[0]]))
                        vs.append(own[near])
                        left = np.setdiff1d(left[1:], near, assume_unique=True)
                    continue
                # the members of the largest component need not be compared with each other
                kinds, which, counts = np.unique(root[left], return_inverse=True, return_counts=True)
                largest = int(counts.argmax())
                if len(kinds) == 1:
                    continue
                rest, top = left[which != largest], left[which == largest]
                for i, r in enumerate(rest.tolist()):
                    others = np.concatenate([top, rest[i + 1 :]])
                    near = may(r, others[root[others] != root[r]])
                    us.append(np.full(len(near), own[r]))
                    vs.append(own[near])
            u, v = _edges(us, vs)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    rows = members.join(sets.select("print", "brief"), members["u"] == sets["print"])
    rows = rows.join(roots, rows["u"] == roots["node"], "left").withColumn("root", F.coalesce("root", "u")) if whole else rows.withColumn("root", F.col("u"))
    rows = rows.select("token", "u", "size", "pos", "brief", "root").repartition("token").sortWithinPartitions("token", "u")
    return rows.transform(mapped, run, "u long, v long").distinct()


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(print, shingles): the sorted hashes of each text's distinct shingles, as bytes; texts: (print, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.slice(at, 500)
                found = [shingle_set(x.as_buffer().to_pybytes() if x.is_valid else b"", words).tobytes() for x in some.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found, pa.binary())], names=["print", "shingles"])

    return texts.select("print", "text").transform(mapped, run, "print long, shingles binary")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


#: Candidates of one hub are dealt over parts of so many, each with the hub's set.
HUB = 500


def verified(edges: DataFrame, sets: DataFrame, similarity: float, kind: str = "<u4") -> DataFrame:
    """The edges (u, v) whose texts' shingle sets (print, shingles; numbers of that kind) are similar enough.

    An edge goes to its end with more edges, the hub, whose set is copied once for `HUB` of them and held while the sets of the other
    ends pass by; a set is sent once for each of its edges."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("o")).union(edges.select("v", "u"))
    degree = stored(both.groupBy("n").agg(F.count(F.lit(1)).alias("c")), "degrees")
    d = lambda name: degree.select(F.col("n").alias(name), F.col("c").alias(f"c_{name}"))
    larger = F.struct("c_u", "u") >= F.struct(F.col("c_v").alias("c_u"), F.col("v").alias("u"))
    known = even_join(even_join(edges, d("u"), "u", degree.select(F.col("n").alias("u"), F.col("c").alias("n")), F.col("v")), d("v"), "v", degree.select(F.col("n").alias("v"), F.col("c").alias("n")), F.col("u"))
    turned = known.select(F.when(larger, F.col("u")).otherwise(F.col("v")).alias("hub"), F.when(larger, F.col("v")).otherwise(F.col("u")).alias("leaf"))
    turned = stored(turned, "hubs")
    parts = turned.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("parts"))
    hubs = sets.join(parts, sets["print"] == parts["hub"]).select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("leaf"), "shingles")
    counts = turned.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    placed = even_join(turned, parts, "hub", turned.groupBy("hub").agg(F.count(F.lit(1)).alias("n")), F.col("leaf"), "inner")
    leaves = even_join(placed, sets.withColumnRenamed("print", "leaf"), "leaf", counts, F.col("hub"), "inner").select("hub", F.pmod(F.xxhash64("leaf"), F.col("parts")).cast("int").alias("part"), "leaf", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.empty(0, kind)
        for batch in batches:
            us, vs = [], []
            for hub, part, leaf, shingles in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if leaf is None:
                    at, own = (hub, part), np.frombuffer(shingles, kind)
                elif (hub, part) == at and jaccard(own, np.frombuffer(shingles, kind)) >= similarity:
                    us.append(hub)
                    vs.append(leaf)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    ordered = hubs.unionByName(leaves).repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("leaf").asc_nulls_first())
    found = ordered.transform(mapped, run, "u long, v long")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def plausible(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The edges (u, v) whose sets (print, size, parity) don't differ in too many bits of their bitmaps. Edges are stored."""
    known = edges
    for end, other in (("u", "v"), ("v", "u")):
        counts = edges.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
        known = even_join(known, sets.select(F.col("print").alias(end), F.col("size").alias(f"size_{end}"), F.col("parity").alias(f"parity_{end}")), end, counts, F.col(other), "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = (1 - similarity) / (1 + similarity) * (batch.column(2).to_numpy() + batch.column(4).to_numpy().astype(np.int64)) + 1e-6
            keep = np.zeros(len(batch), bool)
            for k, (a, b) in enumerate(zip(batch.column(3), batch.column(5), strict=True)):
                x, y = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                size = min(len(x), len(y))
                keep[k] = np.bitwise_count((folded(x, size) ^ folded(y, size)).view(np.uint64)).sum() <= most[k]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in (0, 1)], names=["u", "v"])

    return known.select("u", "v", "size_u", "parity_u", "size_v", "parity_v").transform(mapped, run, "u long, v long")


def similar_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """A row per row: id, print, body, component (the smallest id reachable by links) and root.

    Texts with one shingle set (which `print` is the hash of) are taken as one; the first by id stands for them."""
    prints = stored(shingled(df, text, id_col, words, similarity), "prints")
    give_back(df.sparkSession)
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "body")
    one = F.min(order).alias("one")
    least = stored(prints.groupBy("print").agg(F.min("id").alias("least"), one, F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("size", "parity", "brief", "prefix")]), "distinct")
    least = least.select("print", "least", F.col("one.id").alias("one_id"), F.col("one.body").alias("one_body"), "n", "size", "parity", "brief", "prefix")
    give_back(df.sparkSession)
    met = meetings(least, similarity)
    give_back(df.sparkSession)
    members = met.filter("v is null").drop("v")
    hubs = stored(crowded(members, least, similarity), "hubs")
    edges = stored(met.filter("v is not null").select("u", "v").union(hubs).distinct(), "candidates")
    keyed = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"))

    def similar(edges: DataFrame) -> DataFrame:
        # the texts of candidates only: marked in a bitmap of fixed size, then looked up
        ends = stored(edges.select(F.col("u").alias("print")).union(edges.select("v")).distinct().join(least, "print").select("print", F.col("one_id").alias("known_id"), F.col("one_body").alias("known_body")), "ends")
        may = marked(keyed, bitmap(ends.select(slot(F.col("known_id"), F.col("known_body")).alias("s"))), slot(F.col("id"), F.col("body"))).filter("may")
        texts = may.join(ends, F.col("id").eqNullSafe(F.col("known_id")) & (F.col("body") == F.col("known_body"))).groupBy("print").agg(F.first("text").alias("text"))
        sets = stored(_sets(texts, words), "sets")
        give_back(df.sparkSession)
        return verified(edges, sets, similarity, "<u8")

    give_back(df.sparkSession)
    sure = stored(similar(stored(plausible(edges, least, similarity), "plausible")), "similar")
    give_back(df.sparkSession)
    if not members.isEmpty():
        # what frequent shingles have in different components, but for pairs that were verified
        more = stored(crowded(members, least, similarity, connected_components(sure)).join(edges, ["u", "v"], "left_anti"), "candidates")
        if not more.isEmpty():
            give_back(df.sparkSession)
            sure = sure.union(stored(similar(stored(plausible(more, least, similarity), "plausible")), "similar"))
            give_back(df.sparkSession)
    return _named(prints, least, connected_components(sure))


def near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 4, distance: int = 4) -> DataFrame:
    """A row per row: id, print, body and component, the smallest id reachable by links."""
    prints = stored(fingerprints(df, text, id_col, words), "prints")
    least = stored(prints.groupBy("print").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    return _named(prints, least, connected_components(near_links(least, distance)))


def _named(prints: DataFrame, least: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (id, print, body) with the component and root of their fingerprint; least: (print, least, n); roots: (node, root)."""
    rooted = stored(least.join(roots, least["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")
    # fingerprints linked to others; each of the rest is a component
    linked = stored(rooted.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "roots")
    named = even_join(rooted, linked.select("root", "component"), "root", linked, F.col("print")).select("print", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"), "root")
    return even_join(prints.select("id", "print", "body"), named, "print", least, F.struct("id", "body"), "inner").select("id", "print", "body", "component", "root")


def drop_near_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 4, distance: int = 4) -> DataFrame:
    """The rows that stay, one of each component of `near_duplicates`, with all columns."""
    return keep_one(df, near_duplicates(df, text, id_col, words, distance), text, id_col)


def drop_similar(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows that stay, one of each component of `similar_documents`, with all columns."""
    return keep_one(df, similar_documents(df, text, id_col, words, similarity), text, id_col)


def keep_one(df: DataFrame, components: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of df that stay, one of each component (the smallest id, then the smallest hash of its text), with all columns.

    Rows to drop are marked in a bitmap of fixed size; only rows that it may mean are shuffled and looked up."""
    found = stored(components, "near")
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "body")
    one = stored(found.groupBy("root").agg(F.min(order).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "tops")
    rows = even_join(found, one.select("root", "top"), "root", one, F.struct("id", "body"), "inner").select("id", "body", ((F.col("top.id").eqNullSafe(F.col("id"))) & (F.col("top.body") == F.col("body"))).alias("stays"))
    # rows that go, and those that stay but are repeated
    listed = rows.groupBy("id", "body").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")).filter("not stays or n > 1")
    listed = stored(listed.select(F.col("id").alias("known_id"), F.col("body").alias("known_body"), "stays"), "drop")
    keyed = df.select(F.struct(*columns_of(df)).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"))
    may = marked(keyed, bitmap(listed.select(slot(F.col("known_id"), F.col("known_body")).alias("s"))), slot(F.col("id"), F.col("body")))
    joined = may.filter("may").join(listed, F.col("id").eqNullSafe(F.col("known_id")) & (F.col("body") == F.col("known_body")), "left")
    once = joined.filter("stays").groupBy("id", "body").agg(F.first("row").alias("row"))
    return may.filter("not may").select("row.*").unionByName(joined.filter("stays is null").select("row.*")).unionByName(once.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document with its fingerprint and the smallest doc_id of its component."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
