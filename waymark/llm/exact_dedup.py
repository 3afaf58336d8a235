"""Exact duplicates by progressive refinement: length, then a prefix hash, then the full hash of what is left.

The first pass reads lengths and short prefixes and counts (length, prefix hash) groups; a text alone in its group has
no copy. Groups of two or more set bits in a bitmap of a fixed size (`bits`), so what is broadcast is bounded whatever
the corpus; the second pass hashes the full content of those rows only whose bit is set. A bit set by another group
costs a needless hash and changes no result: full hashes decide.

Nulls count as the empty text. Ties: of rows with equal text and equal largest id, one stays. A null id is smaller than
any other. Repeated rows count in the group's size. An empty table gives an empty result. Very long texts are hashed
whole. `duplicate_groups` reads the named columns only; `drop_exact_duplicates` passes all columns on, whatever their names
and types (rows with one id and text are told apart by a hash of all columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import BITS, bitmap, columns_of, documents, even_join, hashable, marked, slot, stored

PREFIX_CHARS = 64


def _group_slot(text: Column, prefix_chars: int, bits: int) -> Column:
    return slot(F.octet_length(text), F.substring(text, 1, prefix_chars), bits=bits)


def candidate_bitmap(texts: DataFrame, prefix_chars: int = PREFIX_CHARS, bits: int = BITS) -> DataFrame:
    """The bitmap of all (length, prefix hash) groups with two rows or more; `texts` has column t."""
    groups = (
        texts.groupBy(F.octet_length("t").alias("n"), F.xxhash64(F.substring("t", 1, prefix_chars)).alias("p"))
        .agg(F.count(F.lit(1)).alias("c"), F.first(_group_slot(F.col("t"), prefix_chars, bits)).alias("s"))
        .filter("c > 1")
    )
    return bitmap(groups)


def duplicate_groups(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", hash_all: bool = False, prefix_chars: int = PREFIX_CHARS, bits: int = BITS
) -> DataFrame:
    """A row per input row: id, keep_id, group_size, kept, and full_hash where the full content was hashed (`hash_all`:
    for every row, when the caller wants the digests as such).

    `df` must be read from storage (its rows in the same order each time), as rows with equal id and text are told
    apart by their place.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    may = marked(rows, candidate_bitmap(rows, prefix_chars, bits), _group_slot(F.col("t"), prefix_chars, bits))
    full = F.sha2("t", 256)
    hashed = may.select(
        "id",
        F.monotonically_increasing_id().alias("place"),
        "may",
        (full if hash_all else F.when(F.col("may"), full)).alias("full_hash"),
        # a row without a copy needs no partner: a key of its own spreads such rows over all tasks
        (F.lit("") if hash_all else F.concat(F.lit("-"), F.xxhash64("t").cast("string"))).alias("own"),
    ).withColumn("key", F.coalesce("full_hash", "own"))
    rank = F.struct(F.col("id").isNotNull().alias("known"), "id", "place")
    groups = stored(hashed.filter("may").groupBy(F.col("full_hash").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max(rank).alias("top")).filter("n > 1"), "groups")
    # a group may have any share of the rows
    return even_join(hashed, groups, "key", groups, F.struct("id", "place")).select(
        "id",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("place") == F.col("top.place"))).alias("kept"),
        "full_hash",
    )


def drop_exact_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", prefix_chars: int = PREFIX_CHARS, bits: int = BITS) -> DataFrame:
    """The rows that stay, with all their columns. Rows that can have no copy aren't shuffled; of the others one row a
    text is kept by an aggregate that combines before the shuffle, so a group of any size costs a row for each task."""
    rank = F.struct(F.col(id_col).isNotNull(), F.col(id_col), F.xxhash64(*hashable(df)))
    rows = df.select(F.struct(*columns_of(df)).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"), rank.alias("rank"))
    may = marked(rows, candidate_bitmap(df.select(F.coalesce(F.col(text), F.lit("")).alias("t")), prefix_chars, bits), _group_slot(F.col("t"), prefix_chars, bits))
    one = may.filter("may").groupBy(F.sha2("t", 256).alias("key")).agg(F.max_by("row", "rank").alias("row"))
    return may.filter("not may").select("row.*").unionByName(one.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document with the document that stays for it. The result asks for each text's digest, so all are hashed."""
    return duplicate_groups(documents(spark, sf_dir), hash_all=True).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("full_hash").alias("text_sha256")
    )


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(coalesce(text, '')) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY h)
SELECT d.doc_id, g.keep_id, g.n AS group_size, d.doc_id = g.keep_id AS kept, d.h AS text_sha256
FROM d JOIN g USING (h)
"""
