import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from waymark.llm.packing import SumOfSquares, pack, tokenize

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
TEXTS = ["", None, "Hello, World's  it'll\nbe\t fine 123", "É́à ΣΑΣ x y <|endoftext|> z", "a\x1cb\x85c", "don't!'s ''re '<< I'LL x²½ ªº İI ß_a-b 12a3", "word " * 5000, "x" * 3000, "the the", "the the"]


@pytest.mark.parametrize("text", TEXTS)
def test_chunks_give_the_tokenizers_ids(text):
    expected = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids
    assert tokenize(text, PATH).tolist() == expected


@given(st.text(alphabet="aB's'trem²½ªİßé́Σ<|_-1.,!ö \n\x1c\x85\u2003中", max_size=30))
@settings(max_examples=600, deadline=None)
def test_any_text_gives_the_tokenizers_ids(text):
    assert tokenize(text, PATH).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def brute_level(counts, size, window):
    """The level that leaves the least sum of squares, by trying all."""
    best = None
    for level in [0, *range(1, window - size + 1)]:
        if level and not counts[level]:
            continue
        after = counts.copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        key = (int((after[1:window] ** 2).sum()), -level)
        if best is None or key < best[0]:
            best = (key, level)
    return best[1]


def test_places_where_squares_are_least():
    rng = np.random.default_rng(3)
    packer = SumOfSquares(window=32, max_open=10**6)
    for doc in range(600):
        size = int(rng.integers(1, 32))
        assert packer.level_for(size) == brute_level(packer.counts, size, 32)
        packer.add(doc, np.arange(size, dtype="<u4"))
        assert packer.counts.tolist()[1:32] == [len(x) for x in packer.open][1:]


def check_pieces(rows, docs, window):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window
    for doc, ids in docs.items():
        end = 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert start == end and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            end += length
        assert end == len(ids)
    filled = [sum(n for _, n in parts) for parts in sequences.values()]
    return sum(0 if n & (n - 1) == 0 else window - n for n in filled) / sum(filled)


def test_pack_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(900 + i, "some words here " * (i % 97)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as offset")
    tokenizer = Tokenizer.from_file(PATH)
    docs = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    assert check_pieces([r.asDict() for r in pack(frame).collect()], docs, 2048) == 0
    assert check_pieces([r.asDict() for r in pack(frame, window=256, max_open=2).collect()], docs, 256) == 0
    assert pack(frame.limit(0)).count() == 0


def test_open_windows_stay_bounded_when_no_two_pieces_fit():
    packer, n = SumOfSquares(window=64, max_open=8), 0
    for doc in range(1000):
        n += len(packer.add(doc, np.full(40, doc, "<u4")))
        assert packer.n_open <= 8
    assert n
