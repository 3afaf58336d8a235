"""Byte contexts of up to three bytes as numbered states, so that a model becomes a table of states by next byte.

The state of a position is its longest known context: the three bytes before it if that triple is known, else the last
two, else the last one. Before a text stand three zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DEPTH = 3
#: Texts are laid end to end in blocks of about so many bytes; a longer text goes through several blocks.
BLOCK = 1 << 20
#: The same when texts are scored, where a position takes some 50 bytes and more with many languages.
SCORED = 1 << 18


class Contexts:
    """States: of known pairs (the rest of the pair's contexts), then of the 256 last bytes, then of known triples.

    pairs: sorted codes (second last << 8 | last); triples: sorted codes (third last << 16 | pair), whose pairs are known."""

    depth = DEPTH

    def __init__(self, pairs: np.ndarray, triples: np.ndarray) -> None:
        self.pairs, self.triples = np.asarray(pairs, np.int64), np.asarray(triples, np.int64)
        n = len(self.pairs)
        self.second = (n + (np.arange(65536) & 255)).astype(np.int32)
        self.second[self.pairs] = np.arange(n)
        self.third = np.repeat(np.arange(n + 256, dtype=np.int32), 256)
        self.third[self.second[self.triples & 0xFFFF].astype(np.int64) * 256 + (self.triples >> 16)] = n + 256 + np.arange(len(self.triples))
        self.states = n + 256 + len(self.triples)

    def cells(self, data: np.ndarray) -> np.ndarray:
        """state * 256 + byte for each byte from the fourth on."""
        pair = data[1:-2].astype(np.int32) << 8 | data[2:-1]
        state = self.third[(self.second[pair] << 8) | data[:-3]]
        return (state << 8) | data[3:]


def blocks(texts: list[bytes], tail: bytes = b"", depth: int = DEPTH, size_limit: int | None = None) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """(data, spans): bytes with `depth` before each part, and (text, from, to) of the parts in terms of data[depth:]."""
    held, spans, size, limit = [], [], 0, size_limit or BLOCK
    for k, text in enumerate(texts):
        text += tail
        for at in range(0, len(text), limit):
            part = text[at : at + limit]
            held += [text[max(0, at - depth) : at].rjust(depth, b"\0"), part]
            spans.append((k, size, size + len(part)))
            size += depth + len(part)
            if size >= limit:
                yield np.frombuffer(b"".join(held), np.uint8), spans
                held, spans, size = [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), spans


def inside(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which positions belong to a text, not to what is put before it."""
    edge = np.zeros(n + 1, np.int8)
    starts, ends = np.array([s[1] for s in spans]), np.array([s[2] for s in spans])
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


def totals(texts: list[bytes], contexts, table: np.ndarray, tail: bytes = b"") -> np.ndarray:
    """For each text the sum of the table's rows at contexts.cells of its bytes."""
    out = np.zeros((len(texts), table.shape[1]))
    for data, spans in blocks(texts, tail, contexts.depth, min(BLOCK, SCORED)):
        values = table[contexts.cells(data)]
        bounds = np.array([s[1:] for s in spans]).ravel()
        if bounds[-1] == len(values):
            bounds = bounds[:-1]
        sums = np.add.reduceat(values, bounds, axis=0, dtype=np.float64)[::2]
        np.add.at(out, [s[0] for s in spans], sums)
    return out


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with their counts added up."""
    if not codes:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def grams(texts: list[bytes], tail: bytes = b"", depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (`depth` bytes before, byte) as numbers of depth + 1 bytes, and their counts. Blocks are reduced one by one."""
    kind = np.uint32 if depth <= 3 else np.uint64
    codes, counts, held = [], [], 0
    for data, spans in blocks(texts, tail, depth):
        code = np.zeros(len(data) - depth, kind)
        for k in range(depth + 1):
            code = code << kind(8) | data[k : len(data) - depth + k]
        some, n = np.unique(code[inside(spans, len(code))], return_counts=True)
        codes.append(some)
        counts.append(n)
        held += len(some)
        if held > 2 * BLOCK:
            some, n = merged(codes, counts)
            codes, counts, held = [some], [n], 0
    return merged(codes, counts)
