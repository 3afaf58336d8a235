"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts (up to three bytes). A byte costs -log2 of its probability in
the longest context known to the tree: of T occurrences and q different bytes seen there, a seen byte has n / (T + q),
and an escape q / (T + q) leads to the next shorter context, where the bytes already ruled out are excluded from the
counts; the last resort is equal shares of the bytes left. Statistics are frozen after training, so that the cost of a
byte is a function of its context and can be tabled: a text's code length is the exact sum over its whole length. The
language with the shortest code wins; the score is its share of the languages' probabilities.

Training: of the texts with a language, about `per_language` for each language, by hash of their ids (the bound of a sample
of rows; drawn texts are counted whole, however long, and every text is scored whole). Tasks count their texts and hand over counts, so no
text goes to the driver. Contexts of three bytes that are seen once in every language are dropped and `max_contexts` are kept at most; where
there are so many languages that the model would have more than `cells` probabilities, fewer are. So the model that is broadcast is bounded
per language (about 512 KiB beyond its contexts), and no language is left out.

Null texts and texts without a letter give `und` with score 0. Ties go to the alphabetically first language. Repeated
rows each get their row. A null id is held out and not trained on. Without any labelled text all rows are `und`. Only
the named columns are read by `identify`; `drop_unidentified` passes all columns on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.bytectx import Contexts, grams, merged, totals
from waymark.llm.common import documents, in_small_batches, mapped, small, stored, tidy

#: Contexts of three bytes at most, and probabilities (4 bytes each) that they may take.
MAX_CONTEXTS, CELLS = 16384, 1 << 26
#: A task hands over its counts when it holds so many.
FLUSH = 1_500_000
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    contexts: Contexts
    costs: np.ndarray  # bits by (state * 256 + byte, language)


def _tally(codes: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """counts by (context, byte) for the sorted contexts in `rows`."""
    out = np.zeros((len(rows), 256))
    context = codes >> 8
    at = np.minimum(np.searchsorted(rows, context), max(0, len(rows) - 1))
    hit = rows[at] == context if len(rows) else np.zeros(len(codes), bool)
    np.add.at(out, (at[hit], (codes & 255)[hit].astype(np.int64)), counts[hit])
    return out


def _bits(orders: list[np.ndarray]) -> np.ndarray:
    """Bits of each byte for contexts given by their counts, longest order first; a context without counts is unknown there."""
    n = len(orders[0])
    cost, done, escape = np.zeros((n, 256)), np.zeros((n, 256), bool), np.zeros((n, 1))
    for counts in orders:
        left = np.where(done, 0, counts)
        total, kinds = left.sum(axis=1, keepdims=True), (left > 0).sum(axis=1, keepdims=True)
        seen = left > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            own = escape - np.log2(left / (total + kinds))
            escape = escape + np.where(total > 0, -np.log2(kinds / (total + kinds)), 0)
        cost = np.where(seen, own, cost)
        done |= seen
    rest = (~done).sum(axis=1, keepdims=True)
    return np.where(done, cost, escape + np.log2(np.maximum(rest, 1)))


#: Sorted codes and their counts.
Counts = tuple[np.ndarray, np.ndarray]


def contexts_kept(seen: dict[int, int], languages: int, max_contexts: int, cells: int) -> list[int]:
    """Of contexts of three bytes and the most that a language has seen them: those that the model keeps, sorted."""
    most = min(max_contexts, max(256, cells // (256 * max(1, languages))))
    return sorted(sorted((c for c, n in seen.items() if n > 1), key=lambda c: (-seen[c], c))[:most])


def fit(samples: dict[str, list[bytes]], max_contexts: int = MAX_CONTEXTS, cells: int = CELLS) -> Model:
    """The model of texts by language."""
    counted = {k: tuple(x.astype(np.int64) for x in grams(v)) for k, v in samples.items()}
    seen: dict[int, int] = {}
    for codes, counts in counted.values():
        context, at = np.unique(codes >> 8, return_inverse=True)
        for c, n in zip(context.tolist(), np.bincount(at, counts, len(context)).tolist(), strict=True):
            seen[c] = max(seen.get(c, 0), n)
    return of_counts({k: (c, (c[0] & 0xFFFFFF, c[1]), (c[0] & 0xFFFF, c[1])) for k, c in counted.items()}, contexts_kept(seen, len(samples), max_contexts, cells))


def of_counts(counts: dict[str, tuple[Counts, Counts, Counts]], kept: list[int]) -> Model:
    """The model of counts of (context, byte) with contexts of three, two and one byte by language; counts of contexts of three and of two
    bytes are needed for those kept only, and may come in parts."""
    languages = sorted(counts)
    pairs = sorted({c & 0xFFFF for c in kept})
    contexts = Contexts(np.array(pairs, np.int64), np.array(kept, np.int64))
    costs = np.zeros((contexts.states * 256, len(languages)), np.float32)
    one = np.arange(256)
    for k, name in enumerate(languages):
        three, two, last_one = counts[name]
        n3, n2, n1 = _tally(*three, contexts.triples), _tally(*two, contexts.pairs), _tally(*last_one, one)
        n0 = n1.sum(axis=0, keepdims=True)
        last = contexts.pairs & 255
        costs[: len(pairs) * 256, k] = _bits([n2, n1[last], np.repeat(n0, len(pairs), 0)]).ravel()
        costs[len(pairs) * 256 : (len(pairs) + 256) * 256, k] = _bits([n1, np.repeat(n0, 256, 0)]).ravel()
        base = len(pairs) + 256
        for at in range(0, len(kept), 4096):
            some = contexts.triples[at : at + 4096]
            pair = np.searchsorted(contexts.pairs, some & 0xFFFF)
            bits = _bits([n3[at : at + 4096], n2[pair], n1[some & 255], np.repeat(n0, len(some), 0)])
            costs[(base + at) * 256 : (base + at + len(some)) * 256, k] = bits.ravel()
    return Model(languages, contexts, costs)


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, share of the probability, bits per byte) for each text."""
    has = [bool(model.languages) and t is not None and _LETTER.search(t) is not None for t in texts]
    bodies = [t.encode().lower() if h else b"" for t, h in zip(texts, has, strict=True)]
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = totals(bodies, model.contexts, model.costs)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(texts)), best]
    share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
    size = np.array([max(1, len(b)) for b in bodies])
    return [model.languages[k] if h else "und" for k, h in zip(best, has, strict=True)], np.where(has, share, 0.0), np.where(has, least / size, 0.0)


def remainder(id_col: Column, modulus: int) -> Column:
    return F.crc32(id_col.cast("string")) % modulus


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, code, n): counts of (three bytes before, byte) of texts (lang, t), a part from each task. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counts] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)], names=["lang", "code", "n"])

        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                texts.setdefault(name, []).append(body.as_buffer().to_pybytes().lower() if body.is_valid else b"")
            for name, some in texts.items():
                found = grams(some)
                before = held.get(name)
                held[name] = found if before is None else merged([before[0], found[0]], [before[1], found[1]])
            if sum(len(c) for c, _ in held.values()) > FLUSH:
                yield from out()
                held.clear()
        yield from out()

    parts = rows.transform(mapped, run, "lang string, code long, n long", "langid")
    return stored(parts.groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")


def train(df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", held_out: Column | None = None, per_language: int = 400, max_contexts: int = MAX_CONTEXTS, cells: int = CELLS) -> Model:
    """Fits on the rows not held out; null in `held_out` counts as held out."""
    ours = df.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"), F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(True)).alias("out"))
    ours = ours.filter("not out and lang is not null")
    sizes = stored(ours.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    names = sorted(r["lang"] for r in sizes.select("lang").collect())  # the classes, of which the model has a column each
    if not names:
        return Model([], Contexts(np.empty(0), np.empty(0)), np.zeros((0, 0), np.float32))
    # a share of each language's ids by hash: no shuffle of texts, and the same rows wherever they lie
    drawn = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1_000_003)) < F.least(F.lit(1.0), F.lit(per_language) / F.col("n")) * 1_000_003
    rows = ours.join(small(sizes), "lang").filter(drawn).select("lang", "t")
    whole = _counted(rows)
    context, pair = F.shiftright("code", 8), F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF))
    seen = whole.groupBy("lang", context.alias("c")).agg(F.sum("n").alias("n")).groupBy("c").agg(F.max("n").alias("n")).filter("n > 1")
    kept = contexts_kept({r["c"]: r["n"] for r in seen.orderBy(F.desc("n"), "c").limit(max_contexts).collect()}, len(names), max_contexts, cells)

    def collected(rows: DataFrame, bytes_: int, known: list[int] | None = None, of: Column | None = None) -> dict[str, Counts]:
        """Counts by language of the last `bytes_` bytes, for known contexts (at most `max_contexts`, the bound of what is broadcast)."""
        if known is not None:
            frame = df.sparkSession.createDataFrame([(c,) for c in known], "known long")
            rows = rows.join(F.broadcast(frame), of == F.col("known"), "left_semi")
        found = rows.groupBy("lang", F.col("code").bitwiseAND(F.lit((1 << 8 * bytes_) - 1)).alias("code")).agg(F.sum("n").alias("n")).toArrow().sort_by([("lang", "ascending"), ("code", "ascending")])
        lang_, codes, counts = found["lang"].to_numpy(zero_copy_only=False), found["code"].to_numpy(), found["n"].to_numpy()
        edges = [*(np.searchsorted(lang_.astype(str), names).tolist() if len(found) else [0] * len(names)), len(found)]
        return {name: (codes[a:b], counts[a:b]) for name, a, b in zip(names, edges, edges[1:], strict=False)}

    three = collected(whole, 4, kept, context)
    two = collected(whole, 3, sorted({c & 0xFFFF for c in kept}), pair)
    one = collected(whole, 2)
    return of_counts({n: (three[n], two[n], one[n]) for n in names}, kept)


def identify(df: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, bits_per_byte) for every row."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, share, bits = score(sent.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name, pa.string()), pa.array(share), pa.array(bits)], names=["id", "lang_pred", "score", "bits_per_byte"])

    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text").transform(mapped, run, "id long, lang_pred string, score double, bits_per_byte double")


def drop_unidentified(df: DataFrame, model: Model, text: str = "text", min_score: float = 0.5, max_bits: float = 6.5) -> DataFrame:
    """The rows whose text is in one of the model's languages: not `und`, no score below `min_score` (no language has half of the
    probability), and no more than `max_bits` a byte (text of a language takes about 2 to 4, random bytes 8)."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @tidy
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = score(sent.value, [None if pd.isna(t) else t for t in texts])
            yield pd.Series([n != "und" and s >= min_score and b <= max_bits for n, s, b in zip(*found, strict=True)], dtype=bool)

    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return judged(batches)

    known = F.pandas_udf(known, "boolean")
    return in_small_batches(df).filter(known(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the predicted language of every document, learnt from those whose crc32(doc_id) mod 5 is not 0."""
    docs = documents(spark, sf_dir)
    out = remainder(F.col("doc_id"), 5) == 0
    found = identify(docs, train(docs, held_out=out))
    return found.select(F.col("id").alias("doc_id"), F.coalesce(remainder(F.col("id"), 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score", "bits_per_byte")
