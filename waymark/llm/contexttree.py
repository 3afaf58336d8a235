"""The whole context tree of a corpus, computed in parts, and the costs of all (context, byte) that occur.

No context is left out and no task or broadcast holds the tree. Texts are gathered in chunks. A chunk hands over its distinct
numbers of (`DEPTH` bytes before, byte), with how often training texts of the chunk have them (zero: only asked for); these
go to parts by the last three bytes of the context. A part adds up the counts of its numbers over all chunks and has whole subtrees from contexts of
three bytes on; contexts of up to two bytes, which the alphabet bounds, are done in the driver from the parts' sums. So each part has
the costs of its numbers, which go back to the chunks that asked, and a chunk's texts are scored from them.

A number that only texts to score have adds nodes without counts: their estimates are one half and their weighted
probabilities are one, so they change nothing elsewhere.

What travels is a row for each (chunk, part) with the chunk's distinct numbers, not one for each byte and depth. A task holds
one chunk's numbers (about `FLUSH_CODES`, of some 64 MiB of text at most or of one longer text) or one part's (chunks' numbers of some
8 MiB of text; a context of three bytes is not divided). The driver and the broadcast hold nodes of contexts of two bytes: at most
65 536 x 255 of 12 bytes (200 MB), whatever the rows; 0.3 MB at sf0.1.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.bytectx import SCORED, blocks, grams, inside, merged
from waymark.llm.common import mapped, stored

END = b"\0"
DEPTH = 5
#: Contexts up to so many bytes are done in the driver.
TOP = 2
#: A task hands over its counts when it holds so many words, or codes.
FLUSH_WORDS, FLUSH_CODES = 300_000, 1_500_000
#: Bytes of text in a chunk, and for each part of the tree.
CHUNK_BYTES, PART_BYTES = 1 << 26, 1 << 23
#: What a row of gathered texts holds.
CODES, TEXT, WORD, BYTE = range(4)
#: Logarithms of the gamma function at n + 1/2 and n + 1 for small n.
_HALF = np.array([math.lgamma(n + 0.5) for n in range(8192)])
_WHOLE = np.array([math.lgamma(n + 1.0) for n in range(8192)])


def _log_gamma(table: np.ndarray, plus: float, n: np.ndarray) -> np.ndarray:
    """Log of gamma(n + plus) for counts n: the table, or Stirling's series beyond it."""
    out = table[np.minimum(n, len(table) - 1)]
    rows = np.nonzero(n >= len(table))
    if len(rows[0]):
        y = n[rows] + plus
        z = 1 / (y * y)
        out[rows] = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z / 1260)) / y
    return out


def kt(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log KT probability, estimate of a one) of a zeros and b ones."""
    log = _log_gamma(_HALF, 0.5, a) + _log_gamma(_HALF, 0.5, b) - _log_gamma(_WHOLE, 1.0, a + b) - 1.1447298858494002
    return log, (b + 0.5) / (a + b + 1)


def pack(numbers: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of numbers, all lowest ones first: they compress better so."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def turned(codes: np.ndarray) -> np.ndarray:
    """Numbers of (oldest to newest byte of the context, byte) as numbers of (newest to oldest, byte), whose order is the tree's."""
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, [0, 5, 4, 3, 2, 1, 6, 7]]).view("<u8").ravel()


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """By the last three bytes of the context; contexts with the same last two bytes are in at most 16 parts."""
    last, third = keys >> np.uint64(32), (keys >> np.uint64(24)) & np.uint64(15)
    return (((last * np.uint64(2654435761) >> np.uint64(8)) + third * np.uint64(40503)) % np.uint64(parts)).astype(np.int64)


class Alphabet:
    """The symbols of bytes: those of the training texts from 1 on, any other is 0 (a full alphabet of 256 has no other)."""

    def __init__(self, found: list[int]) -> None:
        self.bits = 7 if len(found) < 128 else 8
        self.others = 256 - len(found)
        self.symbol = np.zeros(256, np.uint64)
        self.symbol[found] = np.arange(1, len(found) + 1) if self.others else np.arange(256)


class Subtrees:
    """Nodes of contexts of `least` to `most` bytes, sparse: those of leading bits of symbols that occur after the context.

    numbers: context of `most` bytes, newest first, and symbol of `bits` bits; any order, may repeat. counts: theirs."""

    def __init__(self, numbers: np.ndarray, counts: np.ndarray, bits: int, least: int, most: int) -> None:
        self.bits, self.least, self.most = bits, least, most
        self.codes, self.at, self.start, self.node, self.log, self.one = {}, {}, {}, {}, {}, {}
        low = np.uint64((1 << bits) - 1)
        for d in range(most, least - 1, -1):
            if d < most:
                numbers = numbers >> np.uint64(bits + 8) << np.uint64(bits) | numbers & low
            numbers, self.at[d] = np.unique(numbers, return_inverse=True)
            counts = np.bincount(self.at[d], counts, len(numbers)).astype(np.int64)
            self.codes[d], self.counts = numbers, counts
            for k in range(bits):
                lead = numbers >> np.uint64(bits - k)
                new = np.ones(len(lead), bool)
                new[1:] = lead[1:] != lead[:-1]
                start = np.flatnonzero(new)
                ones = np.add.reduceat(counts * (numbers >> np.uint64(bits - 1 - k) & np.uint64(1)).astype(np.int64), start)
                self.start[d, k], self.node[d, k] = start, np.cumsum(new, dtype=np.int32) - 1
                self.log[d, k], self.one[d, k] = kt(np.add.reduceat(counts, start) - ones, ones)

    def leads(self, d: int, k: int) -> np.ndarray:
        """The nodes' numbers: context and k leading bits."""
        return self.codes[d][self.start[d, k]] >> np.uint64(self.bits - k)

    def up(self, d: int, k: int) -> np.ndarray:
        """For each node of depth d the place of that of the next shorter context."""
        return self.node[d - 1, k][self.at[d - 1][self.start[d, k]]]

    def weigh(self, below: list[np.ndarray] | None = None) -> list[np.ndarray]:
        """Log weighted probabilities of the shortest contexts' nodes, by k. below: sums over longer contexts for the longest here, which
        have none if it isn't given."""
        self.own, out = {}, []
        for k in range(self.bits):
            for d in range(self.most, self.least - 1, -1):
                log = self.log[d, k]
                if d < self.most:
                    more = np.bincount(self.up(d + 1, k), whole, len(log))
                elif below is not None:
                    more = below[k]
                else:
                    whole, self.own[d, k] = log, np.ones(len(log))
                    continue
                whole = math.log(0.5) + np.logaddexp(log, more)
                self.own[d, k] = np.exp(math.log(0.5) + log - whole)
            out.append(whole)
        return out

    def mix(self, given: list[np.ndarray], left: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """From what shorter contexts give a one and the weight they leave, for each of the shortest contexts' nodes: the same after the
        longest contexts here."""
        out = [], []
        for k in range(self.bits):
            for d in range(self.least, self.most + 1):
                g, r = (given[k], left[k]) if d == self.least else (g[self.up(d, k)], r[self.up(d, k)])
                w = self.own[d, k]
                g, r = g + r * w * self.one[d, k], r * (1 - w)
            out[0].append(g)
            out[1].append(r)
        return out

    def costs(self, given: list[np.ndarray]) -> np.ndarray:
        """log10 probability for each number that was given, from the longest contexts' probabilities of a one."""
        codes, out = self.codes[self.most], 0.0
        for k in range(self.bits):
            one = given[k][self.node[self.most, k]]
            out = out + np.log10(np.where(codes >> np.uint64(self.bits - 1 - k) & np.uint64(1), one, 1 - one))
        return out[self.at[self.most]]


def gathered(rows: DataFrame, parts: int) -> DataFrame:
    """Chunks of rows (id, text, learn, scored), stored: lower-cased texts to score; numbers by part; counts of training words (the empty
    one: ends), a part of them from each task; bytes of training texts."""

    def batch(kind: int, size: int, **columns) -> pa.RecordBatch:
        types = dict(chunk=pa.int64(), part=pa.int32(), codes=pa.binary(), n=pa.binary(), row=pa.int64(), id=pa.int64(), text=pa.binary(), word=pa.binary(), count=pa.int64())
        arrays = [pa.nulls(size, t) if (x := columns.get(c)) is None else x if isinstance(x, pa.Array) else pa.array(x, t) for c, t in types.items()]
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *arrays], names=["kind", *types])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        chunk = row = TaskContext.get().partitionId() << 33
        codes, counts, size = np.empty(0, np.uint64), np.empty(0, np.int64), 0

        def word_rows() -> Iterator[pa.RecordBatch]:
            keys = list(words)
            for at in range(0, len(keys), 100_000):
                some = keys[at : at + 100_000]
                yield batch(WORD, len(some), word=some, count=[words[w] for w in some])

        def code_rows() -> Iterator[pa.RecordBatch]:
            found = np.unique(codes[counts > 0] & np.uint64(255))
            yield batch(BYTE, len(found), part=found.astype(np.int32))
            keys = turned(codes)
            part = part_of(keys, parts)
            order = np.argsort(part.astype(np.uint16) if parts <= 65536 else part, kind="stable")
            keys, n, part = keys[order], counts[order], part[order]
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            for at in range(0, len(edges) - 1, 1000):
                some = list(zip(edges[at:-1][:1000], edges[at + 1 :][:1000], strict=True))
                packed = dict(codes=[pack(keys[a:b], 6) for a, b in some], n=[pack(n[a:b], 5) for a, b in some])
                yield batch(CODES, len(some), chunk=[chunk] * len(some), part=part[[a for a, _ in some]].astype(np.int32), **packed)

        for b in batches:
            texts = [x.as_buffer().to_pybytes().lower() if x.is_valid else b"" for x in b.column(1).cast(pa.binary())]
            learn, scored = (np.array(b.column(c).to_pylist(), bool) for c in (2, 3))
            learnt = [t for t, yes in zip(texts, learn, strict=True) if yes]
            for t in learnt:
                words.update(t.split())
            if learnt:
                words[b""] += len(learnt)
            asked = [t for t, yes in zip(texts, learn, strict=True) if not yes]
            (found, n), (others, zero) = grams(learnt, END, DEPTH), grams(asked, END, DEPTH)
            codes, counts = merged([codes, found.astype(np.uint64), others.astype(np.uint64)], [counts, n, zero * 0])
            which = np.flatnonzero(scored)
            if len(which):
                yield batch(TEXT, len(which), chunk=[chunk] * len(which), row=np.arange(row, row + len(which)), id=b.column(0).take(which), text=[texts[i] for i in which])
                row += len(which)
            if len(words) > FLUSH_WORDS:
                yield from word_rows()
                words.clear()
            size += sum(map(len, texts))
            if len(codes) > FLUSH_CODES or size > CHUNK_BYTES:
                yield from code_rows()
                codes, counts, size, chunk = codes[:0], counts[:0], 0, chunk + 1
        yield from word_rows()
        if len(codes):
            yield from code_rows()

    schema = "kind int, chunk long, part int, codes binary, n binary, row long, id long, text binary, word binary, count long"
    return stored(rows.select("id", "text", "learn", "scored").transform(mapped, run, schema), "chunks")


def _numbers(keys: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    return keys >> np.uint64(8) << np.uint64(alphabet.bits) | alphabet.symbol[(keys & np.uint64(255)).astype(np.int64)]


def _node(lead: np.ndarray, k: int, drop: int, bits: int) -> np.ndarray:
    """Nodes of contexts without their last `drop` bits, from numbers of (context, k leading bits)."""
    return (lead >> np.uint64(k + drop) << np.uint64(bits) | np.uint64(1 << k) | lead & np.uint64((1 << k) - 1)).astype(np.int64)


def summed(chunks: DataFrame, parts: int, alphabet: Alphabet) -> DataFrame:
    """For each part its numbers with their counts, and the places of each chunk's numbers among them (part not null); and what it adds to contexts
    of two bytes: (number, n) counts of (context, symbol), and (number, log) at (context, node), negative. Stored."""

    def of_part(part: int, chunk: list[int], codes: list[np.ndarray], n: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, at = np.unique(np.concatenate(codes), return_inverse=True)
        counts = np.bincount(at, np.concatenate(n).astype(np.float64), len(keys)).astype(np.int64)
        width = 1 + (max(len(keys) - 1, 1).bit_length() - 1) // 8
        held = [[part], [pack(keys, 6)], [pack(counts, 8)], [np.array(chunk, np.int64).tobytes()], [np.array([len(c) for c in codes], np.int64).tobytes()], [pack(at, width)]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(held, types, strict=False)] + [pa.nulls(1, t) for t in types[6:]], names=names)
        tree = Subtrees(_numbers(keys, alphabet), counts, alphabet.bits, TOP + 1, DEPTH)
        code, bits = tree.codes[TOP + 1], np.uint64(alphabet.bits)
        code, up = np.unique(code >> bits + np.uint64(8) << bits | code & np.uint64((1 << alphabet.bits) - 1), return_inverse=True)
        sums = [(code.astype(np.int64), np.bincount(up, tree.counts, len(code)).astype(np.int64), np.zeros(len(code)))]
        for k, log in enumerate(tree.weigh()):
            node, up = np.unique(_node(tree.leads(TOP + 1, k), k, 8, alphabet.bits), return_inverse=True)
            sums.append((-1 - node, np.zeros(len(node), np.int64), np.bincount(up, log, len(node))))
        for columns in sums:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(columns[0]), t) for t in types[:6]] + [pa.array(c) for c in columns], names=names)

    names = ["part", "codes", "n", "chunks", "sizes", "places", "number", "count", "log"]
    types = [pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunk, codes, n = None, [], [], []
        for b in batches:
            for part, c, keys, counts in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if part != now and codes:
                    yield from of_part(now, chunk, codes, n)
                    chunk, codes, n = [], [], []
                now = part
                chunk.append(c)
                codes.append(unpack(keys, 6))
                n.append(unpack(counts, 5))
        if codes:
            yield from of_part(now, chunk, codes, n)

    rows = chunks.filter(F.col("kind") == CODES).select("part", "chunk", "codes", "n").repartition(parts, "part").sortWithinPartitions("part", "chunk")
    return stored(rows.transform(mapped, run, "part int, codes binary, n binary, chunks binary, sizes binary, places binary, number long, count long, log double"), "parts")


def top(sums: DataFrame, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By k: numbers of (two bytes, k leading bits), sorted, what contexts up to these give a one, and the weight they leave."""
    found = sums.filter("part is null").groupBy("number").agg(F.sum("count").alias("n"), F.sum("log").alias("log")).toArrow().sort_by("number")
    number, n, log = (found[c].to_numpy() for c in ("number", "n", "log"))
    codes, nodes, logs = number[number >= 0].astype(np.uint64), (-1 - number[number < 0])[::-1], log[number < 0][::-1]
    tree = Subtrees(codes, n[number >= 0], bits, 0, TOP)
    leads = [tree.leads(TOP, k) for k in range(bits)]
    tree.weigh([logs[np.searchsorted(nodes, _node(lead, k, 0, bits))] for k, lead in enumerate(leads)])
    given, left = tree.mix(*([make(len(tree.start[0, k])) for k in range(bits)] for make in (np.zeros, np.ones)))
    return [(lead.astype(np.uint32), g.astype(np.float32), r.astype(np.float32)) for lead, g, r in zip(leads, given, left, strict=True)]


def costs(sums: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(chunk, codes, costs): the numbers of each chunk with their log10 probabilities, a row from each part."""
    sent = sums.sparkSession.sparkContext.broadcast(top(sums, alphabet.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                codes, n, chunks, sizes, places = (b.column(c)[i].as_py() for c in range(5))
                keys = unpack(codes, 6)
                tree = Subtrees(_numbers(keys, alphabet), unpack(n, 8).astype(np.int64), alphabet.bits, TOP + 1, DEPTH)
                tree.weigh()
                given, left = [], []
                for k, (lead, g, r) in enumerate(sent.value):
                    own = tree.leads(TOP + 1, k)
                    at = np.searchsorted(lead, (own >> np.uint64(k + 8) << np.uint64(k) | own & np.uint64((1 << k) - 1)).astype(np.uint32))
                    given.append(g[at].astype(np.float64))
                    left.append(r[at].astype(np.float64))
                cost = tree.costs(tree.mix(given, left)[0])
                if alphabet.others:
                    cost = cost - np.where(alphabet.symbol[(keys & np.uint64(255)).astype(np.int64)] == 0, np.log10(alphabet.others), 0)
                cost = cost.astype(np.float32).view(np.uint32)
                chunk, ends = np.frombuffer(chunks, np.int64), np.cumsum(np.frombuffer(sizes, np.int64))
                place = unpack(places, len(places) // int(ends[-1])).astype(np.int64)
                for at in range(0, len(chunk), 100):
                    some = [place[e - s : e] for s, e in zip(np.frombuffer(sizes, np.int64)[at : at + 100], ends[at : at + 100], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(chunk[at : at + 100]), pa.array([pack(keys[p], 6) for p in some], pa.binary()), pa.array([pack(cost[p], 4) for p in some], pa.binary())], names=["chunk", "codes", "costs"])

    return sums.filter("part is not null").select("codes", "n", "chunks", "sizes", "places").transform(mapped, run, "chunk long, codes binary, costs binary")


class Costs:
    """A chunk's numbers and costs."""

    def __init__(self, codes: list[bytes], found: list[bytes]) -> None:
        keys = np.concatenate([unpack(c, 6) for c in codes])
        order = np.argsort(keys)
        self.keys, self.cost = keys[order], np.concatenate([unpack(c, 4) for c in found]).astype(np.uint32).view(np.float32)[order]

    def score(self, texts: list[bytes]) -> np.ndarray:
        """For each text, all of whose numbers are here, the sum of its costs."""
        out = np.zeros(len(texts))
        for data, spans in blocks(texts, END, DEPTH, SCORED):
            size = len(data) - DEPTH
            key = np.zeros(size, np.uint64)
            for k in (*range(DEPTH - 1, -1, -1), DEPTH):
                key = key << np.uint64(8) | data[k : size + k]
            own = inside(spans, size)
            some, at = np.unique(key[own], return_inverse=True)
            values = np.zeros(size)
            values[own] = self.cost[np.searchsorted(self.keys, some)][at]
            bounds = np.array([s[1:] for s in spans]).ravel()
            if bounds[-1] == size:
                bounds = bounds[:-1]
            np.add.at(out, [s[0] for s in spans], np.add.reduceat(values, bounds)[::2])
        return out


def chunk_rows(chunks: DataFrame, parts: int) -> tuple[DataFrame, list[DataFrame]]:
    """(chunk, kind, codes, costs, row, id, text) for `by_chunk`: of each chunk its costs, then its texts, in a task for each chunk; and what was
    stored for it."""
    spark = chunks.sparkSession
    found = sorted(r["part"] for r in chunks.filter(F.col("kind") == BYTE).select("part").distinct().collect())
    ids = sorted(r["chunk"] for r in chunks.filter(F.col("kind") == CODES).select("chunk").distinct().collect())
    places = spark.createDataFrame(list(zip(ids, range(len(ids)), strict=True)), "chunk long, place int")
    rows = chunks.filter(F.col("kind") == TEXT).selectExpr("chunk", "kind", "cast(null as binary) codes", "cast(null as binary) costs", "row", "id", "text")
    tables = []
    if found:
        alphabet = Alphabet(found)
        tables = [summed(chunks, parts, alphabet)]
        known = costs(tables[0], alphabet)
        rows = rows.unionByName(known.selectExpr("chunk", f"{CODES} kind", "codes", "costs", "cast(null as long) row", "cast(null as long) id", "cast(null as binary) text"))
    dealt = rows.join(F.broadcast(places), "chunk").repartitionById(max(1, len(ids)), "place").drop("place")
    return dealt.sortWithinPartitions("chunk", "kind"), tables


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, list[bytes], np.ndarray]]:
    """(rows, ids, texts, scores) of rows of `chunk_rows`; without training texts every byte has equal shares."""
    now, codes, found, known = None, [], [], None
    for b in batches:
        chunk, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1).tolist(), b.num_rows]
        for a, e in zip(edges, edges[1:], strict=False):
            if a == e:
                continue
            if chunk[a] != now:
                now, codes, found, known = chunk[a], [], [], None
            if kind[a] == CODES:
                codes += b.column(2)[a:e].to_pylist()
                found += b.column(3)[a:e].to_pylist()
                continue
            if codes:
                known, codes, found = Costs(codes, found), [], []
            texts = b.column(6)[a:e].to_pylist()
            scores = known.score(texts) if known is not None else np.array([len(t) + 1 for t in texts]) * -np.log10(256)
            yield b.column(4)[a:e], b.column(5)[a:e], texts, scores
