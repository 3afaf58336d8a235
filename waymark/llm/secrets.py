"""Secret scan with multipart credential linking, in DataFrame functions only.

Three kinds are found for themselves: assignments of a password or token, access-key ids, long hexadecimal runs. Three
weak kinds are candidates only: identifiers (client_id=..., user: ...), opaque runs of 40 or more mixed characters, and
endpoints (addresses of hosts). A credential that works has parts: an access identifier, a secret and an endpoint. So each
weak candidate's scope, its own interval widened by `SCOPE` code points at either end, is joined with the intervals of
identifiers and of secrets; the candidate is reported only where its scope touches one of each (it may be one of them).

The interval join is a sweep over a text's sorted spans: the furthest end of those that start no later, and the nearest
start of those that start no earlier, say whether any interval touches a scope, at whatever offset and of whatever length.
Both are running extremes of arrays (`running`), so many spans in one text cost no pairs, and nothing is shuffled.

Positions are code points, ends exclusive. Functions give matches and the pieces between them; running sums of their lengths
are the positions. One pass reads the texts.

Null counts as the empty text: no span. Repeated rows each get their row, null ids are kept: all is decided row by row. Ties:
spans of one kind never overlap; equal intervals of two kinds are two spans, in order of kind. Very long texts are scanned
whole, in time that grows with their length and matches (times the logarithm of the matches). An empty table gives an empty
result. Only the named columns are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import documents, running

SCOPE = 400
SPANS = "array<struct<start:int,kind:int,end:int>>"
KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")
#: The base patterns, then the weak ones. Matches that fail KEEP are dropped after matching.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "ident": r"""(?i:client_?id|access_?key_?id|user_?name|user_?id|account_?id|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]+""",
    "opaque": r"[A-Za-z0-9+/_=-]{40,}",
    "endpoint": r"""https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?""",
}
#: Identifiers and secrets, by number of kind; endpoints complete neither.
IDENTIFIERS, SECRETS = (1, 3), (0, 2, 4)
STRONG = 3


def match_spans(text: Column, pattern: str | Column, kind: int | Column, keep: Column | None = None) -> Column:
    """array<struct<start, kind, end>> of the leftmost non-overlapping matches; `keep`: array of whether each one stays."""
    rx = F.lit(pattern) if isinstance(pattern, str) else pattern
    number = F.lit(kind) if isinstance(kind, int) else kind
    empty = F.array().cast(SPANS)
    pieces = F.arrays_zip(F.transform(F.split(text, rx, -1), F.length).alias("gap"), F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.length).alias("hit"))
    # after the last match comes a gap only
    steps = F.transform(F.filter(pieces, lambda x: x["hit"].isNotNull()), lambda x: F.struct((x["gap"] + x["hit"]).alias("end"), x["hit"].alias("size")))
    summed = running(steps, lambda a, b: F.struct((a["end"] + b["end"]).alias("end"), b["size"].alias("size")))
    spans = F.transform(summed, lambda x: F.struct((x["end"] - x["size"]).alias("start"), number.alias("kind"), x["end"].alias("end")))
    if keep is not None:
        spans = F.transform(F.filter(F.arrays_zip(spans.alias("span"), keep.alias("keep")), lambda x: x["keep"]), lambda x: x["span"])
    found = F.rlike(text, rx)
    return F.when(found, spans).otherwise(empty)


def _spans(text: Column) -> Column:
    def all_of(pattern: str, group: int, test) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), test)

    keep = {
        "assign": all_of(PATTERNS["assign"], 1, lambda v: F.length(v) >= 8),
        "opaque": all_of(PATTERNS["opaque"], 0, lambda v: F.rlike(v, F.lit("[0-9]")) & F.rlike(v, F.lit("[A-Z]")) & F.rlike(v, F.lit("[a-z]"))),
    }
    return F.concat(*[match_spans(text, PATTERNS[k], n, keep.get(k)) for n, k in enumerate(KINDS)])


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def linked(spans: Column, scope: int = SCOPE) -> Column:
    """The weak spans whose scope touches an identifier and a secret, of all spans (start, kind, end) of a text, in order of start."""
    far = 2**30

    def reach(s: Column, kinds: tuple[int, ...]) -> tuple[Column, Column]:
        return F.when(s["kind"].isin(*kinds), s["end"]).otherwise(-far), F.when(s["kind"].isin(*kinds), s["start"]).otherwise(far)

    def ends(s: Column) -> Column:
        (id_end, id_start), (secret_end, secret_start) = reach(s, IDENTIFIERS), reach(s, SECRETS)
        return F.struct(id_end.alias("id_end"), secret_end.alias("secret_end"), id_start.alias("id_start"), secret_start.alias("secret_start"))

    def join(combine, *names: str):
        return lambda a, b: F.struct(*[combine(a[n], b[n]).alias(n) for n in names])

    bounds = F.transform(spans, ends)
    before = running(F.transform(bounds, lambda x: F.struct(x["id_end"], x["secret_end"])), join(F.greatest, "id_end", "secret_end"))
    after = F.reverse(running(F.reverse(F.transform(bounds, lambda x: F.struct(x["id_start"], x["secret_start"]))), join(F.least, "id_start", "secret_start")))
    rows = F.arrays_zip(spans.alias("span"), before.alias("before"), after.alias("after"))

    def touched(x: Column, name: str) -> Column:
        return (x["before"][f"{name}_end"] >= x["span"]["start"] - scope) | (x["after"][f"{name}_start"] <= x["span"]["end"] + scope)

    return F.transform(F.filter(rows, lambda x: (x["span"]["kind"] >= STRONG) & touched(x, "id") & touched(x, "secret")), lambda x: x["span"])


def find_secrets(df: DataFrame, text: str = "text", id_col: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """(id, base, linked) for every row: the spans that stand for themselves, and the weak ones with complementary parts."""
    found = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).select("id", F.array_sort(_spans(F.col("t"))).alias("spans"))
    weak = F.exists("spans", lambda s: s["kind"] >= STRONG)
    links = F.when(weak, linked(F.col("spans"), scope)).otherwise(F.array().cast(SPANS))
    return found.select("id", F.filter("spans", lambda s: s["kind"] < STRONG).alias("base"), links.alias("linked"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all documents' spans, as counts and digests."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return find_secrets(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "linked")).alias("spans"),
    )


def _sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def either_case(x: str) -> str:
        """Without the flag, which also takes letters beyond ASCII there."""
        return re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]) + ")", x)

    pattern = {k: quoted(either_case(v)) for k, v in PATTERNS.items()}
    tests = {"assign": "len(g) >= 8", "opaque": "regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Z]') AND regexp_matches(h, '[a-z]')"}
    found = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS kind, string_split_regex(t, {pattern[k]}) AS gaps, regexp_extract_all(t, {pattern[k]}, 0) AS hits,"
        f" regexp_extract_all(t, {pattern[k]}, {1 if k == 'assign' else 0}) AS groups FROM d WHERE regexp_matches(t, {pattern[k]})"
        for n, k in enumerate(KINDS)
    )
    kept = " AND ".join(f"(kind <> {n} OR ({tests[k]}))" for n, k in enumerate(KINDS) if k in tests)
    names = "CASE kind " + " ".join(f"WHEN {n} THEN '{k}'" for n, k in enumerate(KINDS)) + " END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({found}),
e AS (SELECT doc_id, kind, i, hits[i] AS h, groups[i] AS g,
        list_sum(list_transform(gaps[1:i], lambda x: len(x)))::BIGINT + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: len(x))), 0)::BIGINT AS s
      FROM m, LATERAL (SELECT unnest(range(1, len(hits) + 1)) AS i)),
p AS (SELECT doc_id, kind, s, s + len(h) AS e FROM e WHERE {kept}),
w AS (SELECT *, row_number() OVER () AS k FROM p WHERE kind >= {STRONG}),
n AS (SELECT w.k FROM w JOIN p USING (doc_id) WHERE p.s <= w.e + {SCOPE} AND p.e >= w.s - {SCOPE}
      GROUP BY w.k HAVING bool_or(p.kind IN {IDENTIFIERS}) AND bool_or(p.kind IN {SECRETS})),
r AS (SELECT doc_id, kind, s, e FROM p WHERE kind < {STRONG} UNION ALL SELECT doc_id, kind, s, e FROM w JOIN n USING (k)),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
        string_agg({names} || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < {STRONG}) AS base,
        string_agg({names} || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
      FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


SQL = _sql()
