"""Interleaved document sequences: HTML as ordered text and media, payloads resolved by digest.

`sequences` parses each page into an array of items: runs of text between block elements, and references to media
(img, video, audio, source, embed, object). An item has its position; a reference also its caption, the figcaption of its
figure or else its alt or title text. `resolve` joins references of the form sha256:<digest> with a media table on the
digest and puts what it finds, payloads or other columns, in the item's place; captions stay with their references.

`media_store` cuts a document's bytes into segments (between characters, of at most `segment` bytes) and writes each as an
8-bit greyscale PNG, 64 samples a row, without loss: a segment is padded with zero bytes to a positive multiple of 64, and its
unpadded length stands in a text chunk. The digest is that of the stored form. `illustrated` gives the document's page: for each
segment its text and a figure that refers to the stored form. `read_back` decodes stored forms (checksums are verified) and
gives their facts; `assembled` does so for the media of a page, put together in the order of its items.

A document of one segment needs no more than its medium's facts, which are read where the medium lies: then only facts
are joined with references by digest. Of longer documents the payloads themselves are joined, each medium once for each
reference, and brought together by page. One digest may be referred to from any share of the pages (`even_join`).

Null text or HTML counts as empty: an empty payload is one row of zeros, an empty page has no items. Broken or nested
markup is read as far as it goes; scripts and styles are no text. Unknown digests resolve to null. Pages are told apart by row, so
repeated rows each get their row and ids may be null or repeated; equal texts have equal values. Of media with one digest any one is
taken, as they are equal. Very long texts become many images. Empty tables give empty results. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import html as markup
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import columns_of, documents, even_join, mapped, stored

ROW = 64
#: Bytes of a segment at most.
SEGMENT = 65536
SIGNATURE = b"\x89PNG\r\n\x1a\n"
ITEM = "struct<pos:int,kind:string,text:string,ref:string,caption:string>"
MEDIA = {"img", "video", "audio", "source", "embed", "object"}
INLINE = {"a", "abbr", "b", "bdi", "cite", "code", "em", "i", "kbd", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "u", "time"}


def encode(payload: bytes) -> bytes:
    """The payload, padded, as a PNG image of 8-bit samples."""
    rows = max(1, -(-len(payload) // ROW))
    samples = np.zeros((rows, ROW + 1), np.uint8)  # each row begins with its filter's number, 0
    samples[:, 1:] = np.frombuffer(payload.ljust(rows * ROW, b"\0"), np.uint8).reshape(rows, ROW)

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    header = struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", header) + chunk(b"tEXt", b"n_bytes\0%d" % len(payload)) + chunk(b"IDAT", zlib.compress(samples.tobytes(), 1)) + chunk(b"IEND", b"")


def decode(media: bytes) -> tuple[np.ndarray, int]:
    """(samples, unpadded length) of what `encode` made; raises an error for anything damaged."""
    if not media.startswith(SIGNATURE):
        raise ValueError("no PNG image")
    at, chunks = len(SIGNATURE), {}
    while at < len(media):
        (size,), name = struct.unpack_from(">I", media, at), media[at + 4 : at + 8]
        data = media[at + 8 : at + 8 + size]
        if struct.pack(">I", zlib.crc32(name + data)) != media[at + 8 + size : at + 12 + size]:
            raise ValueError(f"checksum of {name!r}")
        chunks[name] = data
        at += 12 + size
    width, rows = struct.unpack_from(">II", chunks[b"IHDR"])
    samples = np.frombuffer(zlib.decompress(chunks[b"IDAT"]), np.uint8).reshape(rows, width + 1)
    if samples[:, 0].any():
        raise ValueError("filtered rows")
    return samples[:, 1:].ravel(), int(chunks[b"tEXt"].partition(b"\0")[2])


def segments(payload: bytes, most: int = SEGMENT) -> list[bytes]:
    """UTF-8 bytes in pieces of at most `most` bytes (4 at least), cut between characters; the empty payload is one piece."""
    out, at = [], 0
    while len(payload) - at > most:
        end = at + most
        while payload[end] & 0xC0 == 0x80 and end > at + most - 4:
            end -= 1
        out.append(payload[at:end])
        at = end
    return [*out, payload[at:]]


def _bodies(batch: pa.RecordBatch) -> Iterator[bytes]:
    for x in batch.column(batch.num_columns - 1).cast(pa.binary()):
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def media_store(df: DataFrame, text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """(digest, media) for every segment of every row, stored in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                media = [encode(part) for body in _bodies(batch.slice(at, 1000)) for part in segments(body, segment)]
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(m).hexdigest() for m in media]), pa.array(media, pa.binary())], names=["digest", "media"])

    return stored(df.selectExpr(f"`{text}` text").transform(mapped, run, "digest string, media binary"), "media")


def illustrated(df: DataFrame, text: str = "text", id_col: str = "doc_id", segment: int = SEGMENT) -> DataFrame:
    """(id, html): every row as a page of its segments, each as text and as a figure of its stored form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                some = batch.slice(at, 1000)
                pages = []
                for body in _bodies(some):
                    parts = segments(body, segment)
                    shown = [f'<p>{markup.escape(x.decode(errors='replace'), quote=False)}</p><figure><img src="sha256:{hashlib.sha256(encode(x)).hexdigest()}"><figcaption>part {k + 1} of {len(parts)}</figcaption></figure>' for k, x in enumerate(parts)]
                    pages.append("<article>" + "".join(shown) + "</article>")
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(pages, pa.string())], names=["id", "html"])

    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{text}` text").transform(mapped, run, "id long, html string")


def feature(samples: np.ndarray) -> str:
    """Mean, standard deviation, entropy in bits and eight-bin histogram of the samples."""
    counts = np.bincount(samples, minlength=256)
    share = counts[counts > 0] / len(samples)
    entropy = -(share * np.log2(share)).sum() + 0.0
    bins = ",".join(map(str, counts.reshape(8, 32).sum(axis=1).tolist()))
    mean = float(counts @ np.arange(256)) / len(samples)
    spread = float(counts @ (np.arange(256) - mean) ** 2) / len(samples)
    return f"{mean:.4f}|{spread**0.5:.4f}|{entropy:.4f}|{bins}"


FACTS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _facts(forms: list[bytes]) -> tuple:
    """What the stored forms of one payload hold, read back in order."""
    read = [decode(f) for f in forms]
    payload = b"".join(samples[:n].tobytes() for samples, n in read)
    size = len(payload)
    payload = payload.ljust(max(1, -(-size // ROW)) * ROW, b"\0")
    whole = hashlib.sha256(b"".join(forms)).hexdigest()
    return size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ROW:]), sum(map(len, forms)), whole, feature(np.frombuffer(payload, np.uint8))


def _fact_arrays(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]


_FACT_NAMES = [f.split()[0] for f in FACTS.split(", ")]


def read_back(media: DataFrame) -> DataFrame:
    """(digest, and FACTS) of each stored form (digest, media), read where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_facts([m.as_buffer().to_pybytes()]) for m in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_fact_arrays(rows)], names=["digest", *_FACT_NAMES])

    return media.select("digest", "media").transform(mapped, run, f"digest string, {FACTS}")


def assembled(resolved: DataFrame) -> DataFrame:
    """(id, and FACTS) of each page of (id, items with media): its media, in the order of its items, as one payload. Null facts
    where a medium is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):  # a page may be long
                forms = batch.column(1)[at].values
                facts = _facts([m.as_buffer().to_pybytes() for m in forms]) if not forms.null_count else (None,) * len(_FACT_NAMES)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), *_fact_arrays([facts])], names=["id", *_FACT_NAMES])

    ordered = F.array_sort(F.transform(F.filter("items", lambda x: x["kind"] == "media"), lambda x: F.struct(x["pos"].alias("pos"), x["media"].alias("media"))))
    return resolved.select("id", F.transform(ordered, lambda x: x["media"]).alias("media")).transform(mapped, run, f"id long, {FACTS}")


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.run: list[str] = []
        self.skip = 0
        self.figure: int | None = None  # first item of the open figure
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.items.append({"pos": len(self.items), "kind": "text", "text": text, "ref": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("script", "style", "template"):
            self.skip += 1
        elif tag in MEDIA:
            given = dict(attrs)
            ref = given.get("src") or given.get("data")
            if ref:
                self.flush()
                caption = " ".join((given.get("alt") or given.get("title") or "").split())
                self.items.append({"pos": len(self.items), "kind": "media", "text": None, "ref": ref, "caption": caption or None})
        elif tag == "figure":
            self.flush()
            self.figure = len(self.items)
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag not in INLINE:
            self.flush()

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "template"):
            self.skip = max(0, self.skip - 1)
        elif tag == "figcaption" and self.caption is not None:
            text = " ".join("".join(self.caption).split())
            self.caption = None
            mine = [x for x in self.items[self.figure or 0 :] if x["kind"] == "media"] if self.figure is not None else []
            for x in mine:
                x["caption"] = text or x["caption"]
            if not mine:  # a caption of nothing, or ahead of its medium, is text
                self.run = [text]
                self.flush()
        elif tag == "figure":
            self.flush()
            self.figure = None
        elif tag not in INLINE and tag not in MEDIA:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            (self.run if self.caption is None else self.caption).append(data)


def parse(html: str | None) -> list[dict]:
    """Items in order: {pos, kind, text, ref, caption}."""
    page = _Page()
    page.feed(html or "")
    page.close()
    if page.caption is not None:
        page.handle_endtag("figcaption")
    page.flush()
    return page.items


def sequences(df: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """(id, items) for every page."""
    item = pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("caption", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = pa.array([parse(x) for x in batch.column(1).to_pylist()], pa.list_(item))
            yield pa.RecordBatch.from_arrays([batch.column(0), items], names=["id", "items"])

    return df.selectExpr(f"cast(`{id_col}` as long) id", f"`{html}` html").transform(mapped, run, f"id long, items array<{ITEM}>")


def digest_of(ref: Column) -> Column:
    return F.when(F.startswith(ref, F.lit("sha256:")), F.substring(ref, 8, 64))


def references(pages: DataFrame) -> DataFrame:
    """(row, id, pos, ref, caption, digest): a row for each media item of (row, id, items); digest is null where the reference has none."""
    items = pages.select("row", "id", F.explode("items").alias("x")).filter("x.kind = 'media'")
    return items.select("row", "id", F.col("x.pos").alias("pos"), F.col("x.ref").alias("ref"), F.col("x.caption").alias("caption"), digest_of(F.col("x.ref")).alias("digest"))


def resolved_references(refs: DataFrame, media: DataFrame) -> DataFrame:
    """The stored references with the media table's columns (one row a digest), null where there is none."""
    counts = refs.filter("digest is not null").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    # references without a digest find nothing: a key of their own spreads them
    keyed = refs.withColumn("digest", F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("row", "pos").cast("string"))))
    found = even_join(keyed, media, "digest", counts, F.struct("row", "pos"))
    return found.withColumn("digest", F.when(~F.startswith("digest", F.lit("-")), F.col("digest")))


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a number of their own (`row`). df is read from storage, with Python at most, so its rows have the same number each time."""
    return df.select(F.monotonically_increasing_id().alias("row"), *columns_of(df))


def resolve(pages: DataFrame, media: DataFrame) -> DataFrame:
    """(id, items) with the media table's columns other than digest in each item (null where there are none), in the order of the page."""
    known = media.dropDuplicates(["digest"])
    extra = [c for c in media.columns if c != "digest"]
    rows = stored(numbered(pages.select("id", "items")), "pages")
    found = resolved_references(stored(references(rows), "references"), known)
    by_page = found.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.struct(*extra)))).alias("found"))

    def with_found(x: Column) -> Column:
        at = F.try_element_at("found", x["pos"])
        for c in extra:
            x = x.withField(c, at[c])
        return x

    return rows.join(by_page, "row", "left").select("id", F.transform("items", with_found).alias("items"))


def query(spark: SparkSession, sf_dir: str, segment: int = SEGMENT) -> DataFrame:
    """op3: every document as a page of its segments, with what is read back from the media that the page's references resolve to."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > segment

    def pages(rows: DataFrame) -> DataFrame:
        return sequences(illustrated(rows, segment=segment), id_col="id")

    short = docs.filter(~long)
    facts = read_back(media_store(short, segment=segment)).dropDuplicates(["digest"])
    refs = stored(references(numbered(pages(short))), "references")
    one = resolved_references(refs, facts).select("id", *_FACT_NAMES, F.lit(1).alias("parts"), F.col("caption").alias("captions"))
    # only longer documents need their payloads in one place
    longer = resolve(pages(docs.filter(long)), media_store(docs.filter(long), segment=segment))
    longer = stored(longer.select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("doc"), "items"), "resolved")
    captions = F.transform(F.filter("items", lambda x: x["kind"] == "media"), lambda x: x["caption"])
    named = longer.select("id", "doc", F.size(captions).alias("parts"), F.array_join(captions, ", ").alias("captions"))
    several = assembled(longer).join(named, "id").select(F.col("doc").alias("id"), *_FACT_NAMES, "parts", "captions")
    return one.unionByName(several).withColumnRenamed("id", "doc_id")
