import hashlib
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from waymark.llm.media import SEGMENT, assembled, decode, encode, illustrated, parse, query, resolve, segments, sequences


@given(st.binary(max_size=400))
def test_round_trip(payload):
    samples, n = decode(encode(payload))
    assert n == len(payload) and samples.tobytes() == payload.ljust(max(1, -(-len(payload) // 64)) * 64, b"\0")


def test_damage_is_found():
    media = bytearray(encode(b"some payload"))
    media[60] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        decode(bytes(media))


PAGE = """<!DOCTYPE html><head><title>T</title><style>p{}</style></head><body><p>One <b>bold</b> word<p>two &amp; <img src="sha256:aa" alt=" first  picture ">
tail<figure><img src="sha256:bb" alt="x"><video src="http://v"></video><figcaption>The <i>caption</i></figcaption></figure>
<script>var t="<p>no</p>";</script><object data="sha256:aa"></object><img alt="no source"><div>end"""


def test_parse():
    got = [(x["pos"], x["kind"], x["text"] or x["ref"], x["caption"]) for x in parse(PAGE)]
    assert got == [
        (0, "text", "T", None),
        (1, "text", "One bold word", None),
        (2, "text", "two &", None),
        (3, "media", "sha256:aa", "first picture"),
        (4, "text", "tail", None),
        (5, "media", "sha256:bb", "The caption"),
        (6, "media", "http://v", "The caption"),
        (7, "media", "sha256:aa", None),
        (8, "text", "end", None),
    ]
    assert parse(None) == [] and parse("<figure><figcaption>alone") == [{"pos": 0, "kind": "text", "text": "alone", "ref": None, "caption": None}]


def test_resolve_keeps_positions_and_captions(spark):
    frame = spark.createDataFrame([(1, PAGE, "k"), (2, None, "k"), (3, "<p>only text", "k"), (None, '<img src="sha256:bb">', "k")], "page_id long, html string, pos string")
    a, b = "aa" * 32, "bb" * 32
    pages = sequences(frame.selectExpr("page_id", "replace(replace(html, 'sha256:aa', 'sha256:" + a + "'), 'sha256:bb', 'sha256:" + b + "') html", "pos"))
    media = spark.createDataFrame([(a, b"payload a"), ("cc" * 32, b"other")], "digest string, media binary")
    got = {r["id"]: r["items"] for r in resolve(pages, media).collect()}
    assert [x["pos"] for x in got[1]] == list(range(9))
    assert [bytes(x["media"]) if x["media"] else None for x in got[1]] == [None, None, None, b"payload a", None, None, None, b"payload a", None]
    assert [x["caption"] for x in got[1]][3:7] == ["first picture", None, "The caption", "The caption"]
    assert got[2] == [] and len(got[3]) == 1 and got[None][0]["media"] is None


TEXTS = ["", None, "a", "a\0", "é" * 32, "é" * 33, "x" * 64, "long " * 60_000, "a"]


def test_repeated_pages_and_media(spark):
    """Rows with one id, and media with one digest, each count once."""
    a = "aa" * 32
    html = f'<p>first</p><img src="sha256:{a}" alt="one"><img src="sha256:{a}" alt="two">'
    pages = sequences(spark.createDataFrame([(1, html), (1, html), (None, html), (None, html)], "page_id long, html string"))
    media = spark.createDataFrame([(a, b"x", 5), (a, b"x", 5)], "digest string, media binary, size int")
    got = resolve(pages, media).collect()
    assert sorted(str(r["id"]) for r in got) == ["1", "1", "None", "None"]
    assert all([(x["pos"], x["caption"], x["media"] and bytes(x["media"]), x["size"]) for x in r["items"]] == [(0, None, None, None), (1, "one", b"x", 5), (2, "two", b"x", 5)] for r in got)


def test_a_digest_of_most_references(spark):
    """Two thirds of all references have one digest: they are dealt over several parts."""
    a, n = "aa" * 32, 1500
    pages = sequences(spark.range(n).selectExpr("id page_id", f"concat('<img src=\"sha256:', if(id % 3 = 0, sha2(cast(id as string), 256), '{a}'), '\">') html"))
    media = spark.createDataFrame([(a, b"x")], "digest string, media binary").union(spark.range(0, n, 3).selectExpr("sha2(cast(id as string), 256)", "cast(cast(id as string) as binary)"))
    got = resolve(pages, media)
    assert {r["id"]: bytes(r["items"][0]["media"]) for r in got.collect()} == {i: b"x" if i % 3 else str(i).encode() for i in range(n)}
    assert "part" in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("most", [4, 5, 64, 1000])
def test_segments(most):
    for text in ("", "a", "é" * 50, "🙂a" * 30, "x" * 129):
        parts = segments(text.encode(), most)
        assert b"".join(parts) == text.encode() and all(len(x) <= most for x in parts) and "".join(x.decode() for x in parts) == text


@pytest.mark.parametrize("segment", [SEGMENT, 64])
def test_query_against_brute_force(spark, tmp_path, segment):
    rows = list(enumerate(TEXTS)) + [(2, "a"), (None, "b"), (None, "é" * 33), (6, "x" * 64), (9, "<p>one</p> & <img src=x> two\n" * 9)]
    texts = TEXTS if segment > 64 else [t and t[:3000] for t in TEXTS]
    rows = [(i, t and t[: 10**9 if segment > 64 else 3000]) for i, t in rows]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, media int").write.parquet(f"{tmp_path}/documents.parquet")
    got = query(spark, str(tmp_path), segment).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    by_value = {}
    for _, t in rows:
        body = (t or "").encode()
        payload = body.ljust(max(1, -(-len(body) // 64)) * 64, b"\0")
        forms = [encode(x) for x in segments(body, segment)]
        by_value[hashlib.sha256(payload).hexdigest(), len(body)] = (len(payload), zlib.crc32(payload[-64:]), sum(map(len, forms)), hashlib.sha256(b"".join(forms)).hexdigest(), len(forms), ", ".join(f"part {k + 1} of {len(forms)}" for k in range(len(forms))))
    features = {}
    for r in got:
        key = r["payload_sha256"], r["n_bytes"]
        assert by_value[key] == tuple(r[c] for c in ("payload_bytes", "tail_crc32", "media_bytes", "media_sha256", "parts", "captions"))
        assert features.setdefault(key, r["feature"]) == r["feature"]
        if r["doc_id"] is not None and r["doc_id"] < len(texts):
            assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())
    assert segment > 64 or max(r["parts"] for r in got) > 20
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert query(spark, f"{tmp_path}/none", segment).count() == 0


def test_pages_hold_texts_and_media_in_order(spark):
    """Each text of a page stands before the figure that holds it."""
    body = "".join(f"word{i} <b>&amp;</b>\n" for i in range(50))
    page = sequences(illustrated(spark.createDataFrame([(1, body)], "doc_id long, text string"), segment=100), id_col="id").first()["items"]
    parts = segments(body.encode(), 100)
    assert [x["kind"] for x in page] == ["text", "media"] * len(parts) and [x["pos"] for x in page] == list(range(2 * len(parts)))
    for k, part in enumerate(parts):
        assert page[2 * k]["text"] == " ".join(part.decode().split())
        assert page[2 * k + 1]["ref"] == f"sha256:{hashlib.sha256(encode(part)).hexdigest()}" and page[2 * k + 1]["caption"] == f"part {k + 1} of {len(parts)}"


def test_a_missing_medium_gives_no_facts(spark):
    pages = sequences(spark.createDataFrame([(1, f'<img src="sha256:{"ab" * 32}">')], "page_id long, html string"))
    media = spark.createDataFrame([], "digest string, media binary")
    assert assembled(resolve(pages, media)).first()["payload_sha256"] is None
