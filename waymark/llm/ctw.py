"""Language-model scores by context-tree weighting (CTW).

The alphabet is the bytes of the training texts; any other byte is one symbol more, and then one of the rest with equal
shares. The next symbol is decomposed into seven or eight binary decisions, each a node of the tree of a symbol's leading bits.
For each of these nodes there is a tree of byte contexts, up to `DEPTH` bytes deep. A context with a zeros and b ones has the
Krichevsky-Trofimov estimate KT(a, b); its weighted probability is half KT and half the product of its longer contexts'
weighted probabilities, or KT where the tree ends. With statistics frozen after training the probability of a bit is

    p(s) = w KT'(s) + (1 - w) p(next longer context),   w = KT / (2 * weighted probability of s),

which mixes the estimates of all depths. A text's score is the exact sum over all its bytes and an end byte (zero).

All training texts are counted, whole, and every context that occurs in them is a node: no number bounds the tree, and no machine holds
it. `contexttree` computes it in parts and hands each chunk of texts the probabilities of the bytes and contexts it has. (`Tree` is the same model
in one process, for few texts, with a bound on its contexts; scoring doesn't use it.)

The base score is a unigram model of words with additive smoothing. Frequent words (`hot_words`, a bound of the
broadcast) are looked up in the scoring pass; all other words are joined with the full word counts, so none is left out.

Null counts as the empty text, which has its end only. Repeated rows each get their row; a null id isn't held out and
isn't trained on (its remainder is null). Without training texts counts are zero: base scores are those of N = V = 0, and
every byte has equal shares. Very long texts go through in blocks. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.bytectx import grams, merged, totals
from waymark.llm.common import discard, documents, mapped, stored
from waymark.llm.contexttree import _HALF, _WHOLE, DEPTH, END, FLUSH_CODES, FLUSH_WORDS, PART_BYTES, WORD, _log_gamma, by_chunk, chunk_rows, gathered, kt  # noqa: F401
from waymark.llm.langid import remainder


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) at the nodes of the symbols' leading bits, for rows of counts by symbol; node 2**k - 1 + i: k leading bits that make i."""
    zeros, ones, width = [], [], counts.shape[1]
    for k in range(width.bit_length() - 1):
        parts = counts.reshape(len(counts), 2 << k, width >> (k + 1)).sum(axis=2)
        zeros.append(parts[:, 0::2])
        ones.append(parts[:, 1::2])
    return np.concatenate(zeros, axis=1), np.concatenate(ones, axis=1)


def _kt(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log KT probability, estimate of a one) at the nodes."""
    return kt(*bit_counts(counts))


def _symbol_costs(one: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol from the nodes' probabilities of a one."""
    yes, no = np.log10(one), np.log10(1 - one)
    out = np.zeros((len(one), 1))
    for k in range((one.shape[1] + 1).bit_length() - 1):
        at = slice((1 << k) - 1, (2 << k) - 1)
        out = np.stack([out + no[:, at], out + yes[:, at]], axis=2).reshape(len(one), -1)
    return out


class Tree:
    """The frozen model in one process: nodes of contexts, and log10 probabilities by node and symbol.

    A node's row holds for positions whose context ends at it: for a node without longer ones its own mixture, else that of
    the rest, the longer contexts that are no nodes."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """counts[d]: sorted numbers of d context bytes and the next one, and their counts; d = 0 is the empty context.

        Contexts of one byte need not be known; of longer ones all shorter must be."""
        self.depth, step = max(1, len(counts) - 1), 2048
        alphabet = counts[0][0]
        width = 128 if len(alphabet) < 128 else 256
        # the last symbol of a full alphabet of 256 is no other's
        self.symbol = np.zeros(256, np.uint8)
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1) if len(alphabet) < 256 else np.arange(256)
        others, self.width = 256 - len(alphabet), width
        contexts = [np.unique(codes >> np.uint64(8)) for codes, _ in counts]
        first = np.cumsum([0, *[len(c) for c in contexts]])
        parent = [np.zeros(len(contexts[0]), np.int64)] + [np.searchsorted(contexts[d - 1], contexts[d] & np.uint64((1 << 8 * (d - 1)) - 1)) for d in range(1, len(contexts))]
        inner = [np.zeros(len(c), bool) for c in contexts]
        for d in range(1, len(contexts)):
            inner[d - 1][parent[d]] = True

        def rows(d: int, at: int) -> np.ndarray:
            """Counts by symbol of `step` contexts of depth d from the one at `at` on."""
            codes, n = counts[d]
            context = contexts[d][at : at + step]
            some = slice(*np.searchsorted(codes, [context[0] << np.uint64(8), (context[-1] + np.uint64(1)) << np.uint64(8)]))
            out = np.zeros((len(context), width), np.int64)
            out[np.searchsorted(context, codes[some] >> np.uint64(8)), self.symbol[(codes[some] & np.uint64(255)).astype(np.int64)]] = n[some]
            return out

        # from the longest contexts up: log weighted probabilities add up to their shorter context's
        rest: list[np.ndarray | None] = [None] * len(contexts)
        below, weight = None, list[np.ndarray | None]([None] * len(contexts))
        for d in range(len(contexts) - 1, -1, -1):
            n = len(contexts[d])
            up = np.zeros((len(contexts[d - 1]), width - 1)) if d else None
            if inner[d].any():  # where no context has longer ones there is nothing to keep
                weight[d], rest[d] = np.ones((n, width - 1), np.float32), np.zeros((n, width), np.int64)
            longer = rest[d]
            for at in range(0, len(contexts[d + 1]) if d + 1 < len(contexts) else 0, step):
                np.add.at(longer, parent[d + 1][at : at + step], rows(d + 1, at))
            for at in range(0, n, step):
                own, s = rows(d, at), slice(at, at + step)
                log, _ = _kt(own)
                some = inner[d][s]
                if some.any():
                    longer[s] = own - longer[s]
                    more = below[s] + _kt(longer[s])[0]
                    whole = np.where(some[:, None], np.log(0.5) + np.logaddexp(log, more), log)
                    weight[d][s] = np.where(some[:, None], np.exp(np.log(0.5) + log - whole), 1)
                    log = whole
                if d:
                    np.add.at(up, parent[d][s], log)
            below = up
        # from the empty context down: what shorter contexts give, and the weight left to the longer one
        self.table = np.zeros((max(1, first[-1]) * width, 1), np.float32)
        given, left = np.zeros((1, width - 1)), np.ones((1, width - 1))
        for d in range(len(contexts)):
            n = len(contexts[d])
            more = weight[d] is not None
            next_given, next_left = (np.empty((n if more else 0, width - 1), np.float32) for _ in range(2))
            for at in range(0, n, step):
                s = slice(at, at + step)
                g, r = given[parent[d][s]].astype(np.float64), left[parent[d][s]].astype(np.float64)
                w = weight[d][s].astype(np.float64) if more else 1.0
                g, r = g + r * w * _kt(rows(d, at))[1], r * (1 - w)
                if more:
                    next_given[s], next_left[s] = g, r
                    g = np.where(inner[d][s][:, None], g + r * _kt(rest[d][s])[1], g)
                cost = _symbol_costs(g)
                if others:
                    cost[:, 0] -= np.log10(others)
                self.table[(first[d] + at) * width : (first[d] + at + len(cost)) * width, 0] = cost.ravel()
            given, left = next_given, next_left
        if not first[-1]:  # nothing was learnt
            self.table[:] = -np.log10(256)
        # the way to longer contexts: a row of the next node by symbol for each node that has any; 0 ends
        self.row = np.zeros(max(1, first[-1]), np.int32)
        inside_ = np.flatnonzero(np.concatenate(inner))
        self.row[inside_] = np.arange(1, len(inside_) + 1)
        self.child = np.zeros((len(inside_) + 1) * width, np.int32)
        for d in range(1, len(contexts)):
            byte = (contexts[d] >> np.uint64(8 * (d - 1))).astype(np.int64)
            self.child[self.row[first[d - 1] + parent[d]].astype(np.int64) * width + self.symbol[byte]] = first[d] + np.arange(len(contexts[d]))

    def cells(self, data: np.ndarray) -> np.ndarray:
        """node * width + symbol for each byte after the first `depth`."""
        symbols = self.symbol[data]
        n = len(data) - self.depth
        node, row = np.zeros(n, np.int32), np.full(n, self.row[0], np.int32)
        for d in range(1, self.depth + 1):
            found = self.child[row * self.width + symbols[self.depth - d : self.depth - d + n]]
            node = np.where(found > 0, found, node)
            row = np.where(found > 0, self.row[found], 0)
        return node * self.width + symbols[self.depth :]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return totals(texts, self, self.table, END)[:, 0]


def corpus_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, code, n): counts of words (the empty one: ends) and of (`DEPTH` bytes before, byte), a part from each task. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            names, keys = ["word", "code", "n"], list(words)
            for at in range(0, len(keys), 100_000):
                some = keys[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.nulls(len(some), pa.int64()), pa.array([words[w] for w in some], pa.int64())], names=names)
            for at in range(0, len(codes), 100_000):
                some = pa.array(codes[at : at + 100_000].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.binary()), some, pa.array(counts[at : at + 100_000])], names=names)

        for batch in batches:
            texts = [x.as_buffer().to_pybytes().lower() if x.is_valid else b"" for x in batch.column(0).cast(pa.binary())]
            for t in texts:
                words.update(t.split())
            words[b""] += len(texts)
            found, n = grams(texts, END, DEPTH)
            codes, counts = merged([codes, found], [counts, n])
            if len(words) > FLUSH_WORDS or len(codes) > FLUSH_CODES:
                yield from out()
                words.clear()
                codes, counts = codes[:0], counts[:0]
        yield from out()

    parts = df.selectExpr(f"`{text}` text").transform(mapped, run, "word binary, code long, n long")
    return stored(parts, "counts")


def fit(parts: DataFrame, max_contexts: int = 131072) -> Tree:
    """The tree of the counts of `corpus_counts`, of the most frequent contexts, in the driver's memory (1 to 2 KiB each)."""
    whole = stored(parts.filter("code is not null").groupBy("code").agg(F.sum("n").alias("n")), "grams")
    by_depth = [whole.groupBy(F.lit(d).alias("d"), F.col("code").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n")) for d in range(DEPTH + 1)]
    grams_ = stored(reduce(DataFrame.unionByName, by_depth), "depths")
    contexts = stored(grams_.groupBy("d", F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("c")), "contexts")
    # the contexts of up to one byte are at most 257; longer ones by frequency. At most max_contexts rows are broadcast
    known = frequent(contexts.filter("d > 1"), max_contexts).unionByName(contexts.filter("d <= 1")).select("d", "context")
    kept = grams_.withColumn("context", F.shiftright("code", 8)).join(F.broadcast(known), ["d", "context"]).select("d", "code", "n").toArrow().sort_by([("d", "ascending"), ("code", "ascending")])
    depth, codes, counts = (kept[c].to_numpy() for c in ("d", "code", "n"))
    edges = np.searchsorted(depth, np.arange(DEPTH + 2))
    levels = [(codes[a:b].astype(np.uint64), counts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    while len(levels) > 1 and not len(levels[-1][0]):
        levels.pop()
    return Tree(levels)


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The rows with a count c of at least a size for which there are no more than `most`, found by counting rows by eighths of a power of two."""
    size = F.floor(F.log2("c") * 8).cast("int")
    of_size = words.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    least, total = None, 0
    for r in of_size:
        total += r["n"]
        if total > most:
            break
        least = r["size"]
    return words.filter(size >= least) if least is not None else words.limit(0)


def score_texts(df: DataFrame, train: DataFrame, text: str = "text", id_col: str = "doc_id", hot_words: int = 1 << 17) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of `df`, learnt from the texts of `train`."""
    asked = df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text", "false learn", "true scored")
    return _scored(asked.unionByName(train.selectExpr("cast(null as long) id", f"`{text}` text", "true learn", "false scored")), hot_words)


def _scored(rows: DataFrame, hot_words: int = 1 << 17) -> DataFrame:
    """The columns of `score_texts` for rows (id, text, learn, scored) with `scored`, learnt from those with `learn`; a row may be both."""
    spark = rows.sparkSession
    parts = 8 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES
    chunks = gathered(rows, parts)
    words = stored(chunks.filter(F.col("kind") == WORD).groupBy("word").agg(F.sum("count").alias("c")), "words")
    size = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    hot = frequent(words, hot_words).toArrow()
    sent = spark.sparkContext.broadcast(dict(zip(hot["word"].to_pylist(), np.log10(hot["c"].to_numpy() + 1.0).tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for rows_, ids, texts, scores in by_chunk(batches):
            n, found, logs, rest_words, rest_counts = [], [], [], [], []
            for t in texts:
                tokens = t.split() + [b""]
                values = np.fromiter(map(get, tokens, repeat(np.nan)), np.float64, len(tokens))
                rare = np.flatnonzero(np.isnan(values))
                rest = Counter([tokens[i] for i in rare.tolist()])
                n.append(len(tokens))
                found.append(len(tokens) - len(rare))
                logs.append(float(np.nansum(values)))
                rest_words.append(list(rest))
                rest_counts.append(list(rest.values()))
            bits = scores / np.array([len(t) + 1 for t in texts]) * -np.log2(10)
            columns = [ids, rows_, pa.array(n, pa.int64()), pa.array(found, pa.int64()), pa.array(logs, pa.float64()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64()), pa.array(rest_words, pa.list_(pa.binary())), pa.array(rest_counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "n_tokens", "hot", "logs", "score", "bits_per_byte", "rest", "counts"])

    schema = "id long, row long, n_tokens long, hot long, logs double, score double, bits_per_byte double, rest array<binary>, counts array<long>"
    dealt, tables = chunk_rows(chunks, parts)
    scored = stored(dealt.transform(mapped, run, schema), "scored")
    for table in (chunks, *tables):
        discard(table)
    pairs = scored.select("row", F.explode(F.arrays_zip("rest", "counts")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.counts").alias("k"))
    rare = pairs.join(words, "word").groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("sum"))
    unit = F.log10(F.lit(float(size["n"] + size["v"] + 1)))
    return scored.drop("rest", "counts").join(rare, "row", "left").select(
        "id",
        "n_tokens",
        (F.col("hot") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("sum", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
        "score",
        "bits_per_byte",
    )


def _held_out(id_col: Column) -> Column:
    return F.coalesce(remainder(id_col, 7) == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: code lengths of all documents, learnt from those whose crc32(doc_id) mod 7 is not 2."""
    docs = documents(spark, sf_dir)
    learn = F.coalesce(remainder(F.col("doc_id"), 7) != 2, F.lit(False))
    found = _scored(docs.select(F.col("doc_id").cast("long").alias("id"), "text", learn.alias("learn"), F.lit(True).alias("scored")))
    return found.select(F.col("id").alias("doc_id"), _held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
