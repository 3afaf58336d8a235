"""Sum-of-squares online packing of token sequences into windows.

Every document is its ids and one end id. Whole windows are cut from a long document first; the rest is placed online:
into the fill level for which the sum of squared counts of partially filled windows grows least, counts being kept in
an array with an entry for each level. Ties go to the fullest level. That sum stays small only where levels are
balanced, which is what keeps windows from ending nearly full but not quite.

Windows are packed within the input's partitions, with no shuffle: a task holds at most `max_open` open windows
(documented bound: max_open * window ids). When there would be more, and at the end, the open windows are joined end to
end and cut anew into full ones; what is left of a partition, less than one window, is cut at powers of two, which need
no padding. A task that is run again packs the same rows alike, as its rows come in the same order from storage.

Null and empty texts are a document of the end id alone. Repeated rows are packed once each. Very long texts become
many whole windows. Null ids stay null. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from waymark.llm.common import documents, mapped, remember

WINDOW = 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: The ids of so many chunks, and of so many words, are remembered by a worker (about 200 bytes each); longer ones seldom recur.
CHUNKS, WORDS, SHORT = 250_000, 400_000, 12
#: Fixed value: the tokenizer's own pattern for words.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable in Latin-1, else the next above 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in own)}
    return [other.get(b, chr(b)) for b in range(256)]


class _Memory(dict):
    """Remembers the first so many short keys, frequent ones being among them; starts anew when too often of no help."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.missed = most, 0

    def remember(self, key: str, value: bytes) -> None:
        if len(key) > SHORT:
            return
        if len(self) >= self.most:
            self.missed += 1
            if self.missed < 8 * self.most:
                return
            self.clear()
            self.missed = 0
        self[key] = value


class _Words(_Memory):
    """Ids of a word (one match of the pattern) as bytes of unsigned 32-bit numbers."""

    def __init__(self, tokenizer) -> None:
        super().__init__(WORDS)
        self.model, self.letters = tokenizer.model, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() and word.isprintable() else "".join([self.letters[b] for b in word.encode()])
        found = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        self.remember(word, found)
        return found


class _Chunks(_Memory):
    """The same for chunks without white space, by way of their words.

    Below U+0300 there is nothing to compose and lower-casing looks at one character only, so that a chunk's ids are
    its lower-case words' ids; other chunks, and those that may hold a special token, are given to the tokenizer whole."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__(CHUNKS)
        self[""] = b""
        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        words, low = self.words, chunk.lower()
        if not (chunk.isascii() or max(chunk) < "\u0300"):
            found = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        elif low.isalpha():  # one word
            found = words[low]
        elif low[-1] in ".,;:!?|" and low[:-1].isalpha():  # one word and one sign
            found = words[low[:-1]] + words[low[-1]]
        elif "<" not in chunk:
            found = b"".join(map(words.__getitem__, _WORD.findall(low)))
        else:
            found = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        self.remember(chunk, found)
        return found


@cache
def _chunks(path: str) -> _Chunks:
    remember("packing", _chunks.cache_clear)
    return _Chunks(path)


def tokenize(text: str | None, path: str) -> np.ndarray:
    """The tokenizer's ids. Its pattern never matches across white space, so chunks can be looked up one by one."""
    if not text:
        return np.empty(0, "<u4")
    return np.frombuffer(b"".join(map(_chunks(path).__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))), "<u4")


class SumOfSquares:
    """Places pieces; gives rows (doc, start, length, crc, total, sequence, offset) for each window that is closed.

    A piece is (doc, total, start, ids)."""

    def __init__(self, window: int = WINDOW, max_open: int = 1024, first_sequence: int = 0) -> None:
        self.window, self.max_open, self.next = window, max_open, first_sequence
        self.counts = np.zeros(window + 1, np.int64)  # open windows by level
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level to place a piece in, 0 for a new window."""
        room = self.window - size
        best, gain = 0, 2 * self.counts[size] + 1
        if room:
            here, there = self.counts[1 : room + 1], self.counts[size + 1 : self.window + 1]
            change = 2 * (there - here) + 2
            change[-1] = 1 - 2 * here[-1]  # fills the window, which then counts no more
            change[here == 0] = np.iinfo(np.int64).max
            at = room - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
            if change[at] < gain or change[at] == gain and here[at]:
                best = at + 1
        return best

    def close(self, pieces: list) -> list[tuple]:
        rows, offset = [], 0
        for doc, total, start, ids in pieces:
            rows.append((doc, start, len(ids), zlib.crc32(ids), total, self.next, offset))
            offset += len(ids)
        self.next += 1
        return rows

    def add(self, doc, ids: np.ndarray) -> list[tuple]:
        rows, whole = [], len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            rows += self.close([(doc, len(ids), start, ids[start : start + self.window])])
        if size := len(ids) - whole:
            level = self.level_for(size)
            if level:
                pieces = self.open[level].pop()
                self.counts[level] -= 1
                self.n_open -= 1
            else:
                pieces = []
            pieces.append((doc, len(ids), whole, ids[whole:]))
            if level + size == self.window:
                rows += self.close(pieces)
            else:
                self._keep(level + size, pieces)
                if self.n_open > self.max_open:
                    rows += self.settle()
        return rows

    def _keep(self, level: int, pieces: list) -> None:
        self.open[level].append(pieces)
        self.counts[level] += 1
        self.n_open += 1

    def settle(self, last: bool = False) -> list[tuple]:
        """Joins the open windows, fullest first, and cuts full ones; the rest stays open, or at last is cut at powers of two."""
        rows, held, size = [], [], 0
        queue = [p for level in range(self.window - 1, 0, -1) for pieces in self.open[level] for p in pieces]
        left = sum(len(p[3]) for p in queue)
        self.open, self.n_open = [[] for _ in range(self.window)], 0
        self.counts[:] = 0
        goal = self.window
        for doc, total, start, ids in queue:
            while len(ids):
                if size == 0:
                    goal = self.window if left >= self.window or not last else 1 << (left.bit_length() - 1)
                take = min(goal - size, len(ids))
                held.append((doc, total, start, ids[:take]))
                start, ids, size, left = start + take, ids[take:], size + take, left - take
                if size == goal:
                    rows += self.close(held)
                    held, size = [], 0
        if held:
            self._keep(size, held)
        return rows


def pack(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None, window: int = WINDOW, end_id: int = 1, max_open: int = 1024) -> DataFrame:
    """A row per piece: where each run of a document's ids lies. `path`: the tokenizer's file on every worker."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(window, max_open, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], "<u4")

        def out(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

        rows: list[tuple] = []
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows += packer.add(doc, np.concatenate([tokenize(body.as_py(), path), end]))
            if len(rows) > 5000:
                yield out(rows)
                rows = []
        if rows := rows + packer.settle(last=True):
            yield out(rows)

    return df.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text}` text").transform(mapped, run, SCHEMA, "packing")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all documents packed into sequences of at most 2048 ids."""
    return pack(documents(spark, sf_dir))
