"""Mixing sources to target weights by temperature, in DataFrame functions only.

A source with share p of all tokens gets weight p**a / sum(p**a). With a = 1 shares stay, with a = 0 all sources are
equal. The exponent is bisected twice: for the largest a whose weights reach the target entropy (a part of the most that
the number of sources allows), and for the smallest a at which no source is repeated more than `max_repeats` times. The
larger of the two holds: the limit on repeats wins over the entropy.

Weights are realised as a budget of tokens for each source and a permutation of its documents for each pass over them:
whole passes, then a prefix of one more. A permutation is the order of md5(seed, pass, id), so a prefix is all documents
up to one hash, and needs no sorted source in one task: tokens are summed by hash range, ranges are accumulated, and only
within a range (about `per_range` documents) rows are put in order. The tokens before a document, as a part of its source's
budget, give its block; every block of `block_tokens` tokens therefore holds all sources by weight.

The default budget ("whole") makes the least total that gives each source at least one whole pass: no document is
dropped. With a number of tokens, sources may get less than a pass.

The sources' token counts are gathered as one array (8 bytes a source) for the bisection; nothing else depends on the
number of sources. Null texts count as empty; tokens are words and one end, so each document has at least one. A null
source is a source. Rows with one hash (the same id again, or null) are taken together or not at all; within, they are ordered by
size. A single source has a = 1. An empty table gives an empty result. `blocks` reads the
named columns only; `mix` passes all columns on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import columns_of, documents, small, stored

ENTROPY, MAX_REPEATS, BLOCK_TOKENS, PER_RANGE, SEED, STEPS = 0.97, 2.0, 65536, 2000, 17, 50


def tokens_of(text: Column) -> Column:
    """Words and one end; words end at ASCII white space."""
    body = F.coalesce(text, F.lit(""))
    words = F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "w"))
    return (F.when(F.rlike(body, F.lit(r"[^\x20\x09-\x0D]")), words).otherwise(0) + 1).cast("long")


def _hash(pass_: Column, id_col: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), pass_.cast("string"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def _range(hash_: Column, ranges: Column) -> Column:
    """Number of the hash range, of `ranges` equal ones."""
    return F.floor(F.conv(F.substring(hash_, 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long")


def weights(sources: DataFrame, entropy: float = ENTROPY, max_repeats: float = MAX_REPEATS, budget: int | str = "whole") -> DataFrame:
    """Of sources (source, tokens, docs): adds weight, quota, full, rest and exponent: the tokens to take, whole passes and what remains."""
    whole = budget == "whole"
    gathered = sources.agg(F.sum("tokens").alias("total"), F.collect_list("tokens").alias("all"))
    one = gathered.select("total", F.transform(F.array_sort("all"), lambda t: t.cast("double") / F.col("total")).alias("p"))
    p = F.col("p")

    def z(a: Column) -> Column:
        return F.aggregate(p, F.lit(0.0), lambda s, x: s + F.pow(x, a))

    def h(a: Column) -> Column:
        return F.log(z(a)) - a * F.aggregate(p, F.lit(0.0), lambda s, x: s + F.pow(x, a) * F.log(x)) / z(a)

    def repeats(a: Column) -> Column:
        most = F.pow(F.array_min(p), a - 1)
        return most * F.pow(F.array_max(p), 1 - a) if whole else most / z(a) * (F.lit(float(budget)) / F.col("total"))

    def bisect(low_side) -> Column:
        """Halves [0, 1] `STEPS` times, keeping the side that `low_side(middle)` says."""

        def step(s: Column, _: Column) -> Column:
            mid = (s["lo"] + s["hi"]) / 2
            up = low_side(mid)
            return F.struct(F.when(up, mid).otherwise(s["lo"]).alias("lo"), F.when(up, s["hi"]).otherwise(mid).alias("hi"))

        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)

    goal = F.lit(entropy) * F.log(F.size(p).cast("double"))
    by_entropy = F.when((F.size(p) == 1) | (h(F.lit(1.0)) >= goal), F.lit(1.0)).otherwise(bisect(lambda a: h(a) >= goal)["lo"])
    by_repeats = F.when(repeats(F.lit(0.0)) <= max_repeats, F.lit(0.0)).otherwise(bisect(lambda a: repeats(a) > max_repeats)["hi"])
    found = one.select("total", "p", F.round(F.greatest(by_entropy, by_repeats), 9).alias("exponent"))
    scale = z(F.col("exponent")) * F.pow(F.array_max(p), 1 - F.col("exponent")) if whole else F.lit(float(budget)) / F.col("total")
    one = found.select("total", "exponent", z(F.col("exponent")).alias("z"), scale.alias("scale")).first()
    total, exponent, sum_, scale = ((one[c] or 0) for c in ("total", "exponent", "z", "scale"))  # without sources there is no row to weigh
    share = F.pow(F.col("tokens").cast("double") / F.lit(total), F.lit(exponent)) / F.lit(sum_)
    quota = F.round(F.lit(total) * F.lit(scale) * share).cast("long")
    weighed = sources.withColumn("weight", share).withColumn("exponent", F.lit(exponent))
    weighed = weighed.withColumn("quota", F.greatest(quota, F.col("tokens")) if whole else quota)
    return weighed.withColumn("full", F.floor(F.col("quota") / F.col("tokens"))).withColumn("rest", F.expr("quota % tokens"))


def _rows(df: DataFrame, text: str, source: str, id_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.to_json(F.struct(F.col(source).alias("s"))).alias("skey"), tokens_of(F.col(text)).alias("n"))


def _plan(rows: DataFrame, per_range: int, **how) -> DataFrame:
    sources = rows.groupBy("skey").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    return weights(sources, **how).withColumn("ranges", F.ceil(F.col("docs") / per_range))


def blocks(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", block_tokens: int = BLOCK_TOKENS, per_range: int = PER_RANGE, **how) -> DataFrame:
    """(id, source, pass, tokens, before, block, weight, repeats): a row for each time that a document is taken.

    before: tokens of its source before it, over all passes."""
    rows = stored(_rows(df, text, source, id_col), "tokens")
    plan = _plan(rows, per_range, **how)
    plan = stored(plan, "weights")
    n_blocks = max(1, -(-(plan.agg(F.sum("quota")).first()[0] or 0) // block_tokens))
    taken = rows.join(small(plan), "skey").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
    taken = taken.filter("pass < full or rest > 0").withColumn("hash", _hash(F.col("pass"), F.col("id"))).withColumn("range", _range(F.col("hash"), F.col("ranges")))
    sums = taken.groupBy("skey", "pass", "range").agg(F.sum("n").alias("sum"))
    ahead = Window.partitionBy("skey", "pass").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select("skey", "pass", "range", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy("skey", "pass", "range").orderBy("hash", "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = taken.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    placed = placed.withColumn("first", F.min("within").over(Window.partitionBy("skey", "pass", "range", "hash"))).join(start, ["skey", "pass", "range"])
    placed = placed.withColumn("at", F.col("start") + F.col("within")).filter("pass < full or start + first < rest")
    before = F.col("pass") * F.col("tokens") + F.col("at")
    return placed.select(
        "id",
        "source",
        "pass",
        F.col("n").alias("tokens"),
        before.alias("before"),
        F.least(F.expr(f"(pass * tokens + at) * {n_blocks} div quota"), F.lit(n_blocks - 1)).alias("block"),
        "weight",
        (F.col("quota") / F.col("tokens")).alias("repeats"),
    )


def mix(df: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", per_range: int = PER_RANGE, **how) -> DataFrame:
    """The documents, each as often as it is taken, with all columns. Sources' cut hashes are found on small rows; the
    texts are neither shuffled nor sorted for it, unless there are more sources than are broadcast (`FEW`)."""
    rows = stored(_rows(df, text, source, id_col), "tokens")
    plan = stored(_plan(rows, per_range, **how), "weights")
    last = rows.join(small(plan).filter("rest > 0"), "skey").withColumn("hash", _hash(F.col("full"), F.col("id"))).withColumn("range", _range(F.col("hash"), F.col("ranges")))
    sums = last.groupBy("skey", "range").agg(F.sum("n").alias("sum"))
    ahead = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.withColumn("start", F.coalesce(F.sum("sum").over(ahead), F.lit(0)))
    edge = start.join(plan, "skey").filter("start < rest and start + sum >= rest").select("skey", "range", "start")
    inside = Window.partitionBy("skey").orderBy("hash", "n").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = last.join(edge, ["skey", "range"]).withColumn("at", F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    cuts = at_edge.filter("at < rest").groupBy("skey").agg(F.max("hash").alias("cut"))
    per_source = stored(plan.select("skey", "full").join(cuts, "skey", "left").select(F.col("skey").alias("__wm_key"), F.col("full").alias("__wm_full"), F.col("cut").alias("__wm_cut")), "cuts")
    key = F.to_json(F.struct(F.col(source).alias("s")))
    joined = df.withColumn("__wm_source", key).join(small(per_source), F.col("__wm_source") == F.col("__wm_key"))
    extra = F.when(_hash(F.col("__wm_full"), F.col(id_col)) <= F.col("__wm_cut"), 1).otherwise(0)
    times = joined.withColumn("__wm_times", (F.col("__wm_full") + extra).cast("int")).filter("__wm_times > 0")
    return times.withColumn("__wm_copy", F.explode(F.array_repeat(F.lit(1), F.col("__wm_times")))).select(*columns_of(df))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: each time that a document is taken, its source's weight, and its block."""
    return blocks(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "source", F.col("pass").alias("pass_no"), F.col("tokens").alias("n_tokens"), "before", "block", F.round("weight", 6).alias("weight"), F.round("repeats", 6).alias("repeats")
    )


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, 1 + length(regexp_replace(coalesce(regexp_replace(text, '^[\\x20\\x09-\\x0D]+$', ''), ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*', 'w', 'g')) AS n FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS tokens FROM d GROUP BY source),
t AS (SELECT sum(tokens)::BIGINT AS total FROM s),
p AS (SELECT list(tokens::DOUBLE / total ORDER BY tokens) AS p, count(*) AS k FROM s, t),
b AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN mid ELSE lo END, CASE WHEN up THEN hi ELSE mid END, CASE WHEN up2 THEN mid2 ELSE lo2 END, CASE WHEN up2 THEN hi2 ELSE mid2 END
  FROM (SELECT b.*, (lo + hi) / 2 AS mid, (lo2 + hi2) / 2 AS mid2,
      ln(list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2)))) - (lo + hi) / 2 * list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2) * ln(x)))
        / list_sum(list_transform(p, lambda x: pow(x, (lo + hi) / 2))) >= {ENTROPY} * ln(k) AS up,
      pow(list_min(p), (lo2 + hi2) / 2 - 1) * pow(list_max(p), 1 - (lo2 + hi2) / 2) > {MAX_REPEATS} AS up2
    FROM b, p WHERE i < {STEPS})),
a AS (SELECT round(greatest(
    CASE WHEN k = 1 OR -list_sum(list_transform(p, lambda x: x * ln(x))) >= {ENTROPY} * ln(k) THEN 1.0 ELSE lo END,
    CASE WHEN list_max(p) / list_min(p) <= {MAX_REPEATS} THEN 0.0 ELSE hi2 END), 9) AS exponent, p FROM b, p WHERE i = {STEPS}),
w AS (SELECT source, tokens, pow(tokens::DOUBLE / total, exponent) / list_sum(list_transform(p, lambda x: pow(x, exponent))) AS weight,
    list_sum(list_transform(p, lambda x: pow(x, exponent))) * pow(list_max(p), 1 - exponent) * total AS budget FROM s, t, a),
q AS (SELECT *, greatest(round(budget * weight)::BIGINT, tokens) AS quota FROM w),
r AS (SELECT *, quota // tokens AS full_passes, quota % tokens AS rest, greatest(ceil((SELECT sum(quota) FROM q) / {BLOCK_TOKENS})::BIGINT, 1) AS blocks FROM q),
e AS (SELECT *, md5('{SEED}|' || pass_no || '|' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM (SELECT d.doc_id, d.source, d.n, r.* EXCLUDE (source), unnest(range(0, full_passes + 1)) AS pass_no FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source, pass_no ORDER BY h, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_it FROM e),
f AS (SELECT *, min(before_it) OVER (PARTITION BY source, pass_no, h) AS first_it FROM o)
SELECT doc_id, source, pass_no, n AS n_tokens, pass_no * tokens + before_it AS before, least((pass_no * tokens + before_it) * blocks // quota, blocks - 1) AS block,
  round(weight, 6) AS weight, round(quota / tokens, 6) AS repeats
FROM f WHERE pass_no < full_passes OR first_it < rest
"""
