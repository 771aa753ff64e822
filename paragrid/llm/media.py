"""Interleaved document sequences: text and media references in order, payloads joined by digest.

``parse_interleaved`` turns HTML into ordered items.  A media item keeps its
position, its digest and its figure's caption; a text item keeps its block.
Media are stored once for each digest and task as 8-bit greyscale PNG.  The
digest join attaches what is computed from a stored payload, so payload bytes
are not shuffled unless a caller asks for them.

Edge cases: a null or empty HTML gives no items; a reference without a digest
keeps a null digest; an unknown digest resolves to nulls and loses nothing; a
null text is an empty payload padded to one row; repeated rows and equal texts
resolve to the same medium; unclosed tags end with the document; scripts, styles
and comments give no text; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

ROW = 576  # samples in a row
PNG_HEAD = b"\x89PNG\r\n\x1a\n"  # fixed value of the format
DIGEST_SCHEME = "sha256:"
ITEM = "position:int,kind:string,text:string,source:string,digest:string,caption:string"
BLOCKS = frozenset("p div li ul ol table tr td th h1 h2 h3 h4 h5 h6 article section header footer figure blockquote pre br hr nav".split())
SILENT = frozenset(("script", "style", "template", "noscript"))
MEDIA = frozenset(("img", "video", "audio", "source", "embed"))


class _Interleaver(HTMLParser):
    """Collects items; a figure's caption goes to the media of that figure."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.silent = 0
        self.figures: list[tuple[list[dict], list[str]]] = []
        self.in_caption = 0

    def _flush(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words.clear()
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "source": None, "digest": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
        elif tag == "figcaption" and self.figures:
            self._flush()
            self.in_caption += 1
        elif tag in MEDIA:
            own = dict(attrs)
            source = own.get("src")
            if source is None:
                return
            self._flush()
            digest = source[len(DIGEST_SCHEME) :] if source.startswith(DIGEST_SCHEME) else own.get("data-digest")
            item = {"position": len(self.items), "kind": "media", "text": None, "source": source, "digest": digest, "caption": own.get("alt")}
            self.items.append(item)
            if self.figures:
                self.figures[-1][0].append(item)
        elif tag in BLOCKS:
            self._flush()
            if tag == "figure":
                self.figures.append(([], []))

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "figcaption":
            self.in_caption = max(0, self.in_caption - 1)
        elif tag in BLOCKS:
            self._flush()
            if tag == "figure" and self.figures:
                self._close_figure()

    def _close_figure(self) -> None:
        media, words = self.figures.pop()
        caption = " ".join("".join(words).split())
        for item in media if caption else ():
            item["caption"] = caption

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        (self.figures[-1][1] if self.in_caption and self.figures else self.words).append(data)

    def finish(self) -> list[dict]:
        self.close()
        self._flush()
        while self.figures:
            self._close_figure()
        return self.items


def parse_interleaved(html: str | None) -> list[dict]:
    """Ordered items of a page."""
    parser = _Interleaver()
    parser.feed(html or "")
    return parser.finish()


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: bytes, width: int = ROW, level: int = 4) -> bytes:
    """8-bit greyscale PNG of whole rows."""
    rows = np.frombuffer(samples, dtype=np.uint8).reshape(-1, width)
    lines = np.zeros((len(rows), width + 1), dtype=np.uint8)  # filter 0 before each row
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return PNG_HEAD + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """(rows, width) samples of an 8-bit greyscale PNG without interlacing; checks every chunk."""
    if not data.startswith(PNG_HEAD):
        raise ValueError("not a PNG")
    at, head, body = len(PNG_HEAD), None, []
    while True:
        if at + 12 > len(data):
            raise ValueError("PNG is cut short")
        (size,) = struct.unpack_from(">I", data, at)
        kind, own = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + own):
            raise ValueError("PNG chunk checksum differs")
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", own)
        elif kind == b"IDAT":
            body.append(own)
        elif kind == b"IEND":
            break
    if head is None or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit greyscale PNG")
    width, height = head[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(body)), dtype=np.uint8).reshape(height, width + 1)
    if not lines[:, 0].any():
        return lines[:, 1:]
    return _unfilter(lines)


def _unfilter(lines: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lines) + 1, lines.shape[1]), dtype=np.int64)  # a row above and a column left of zeros
    for y, line in enumerate(lines, 1):
        kind, raw, up = int(line[0]), line[1:].astype(np.int64), out[y - 1]
        if kind == 0:
            out[y, 1:] = raw
        elif kind == 1:
            out[y, 1:] = np.cumsum(raw) & 255
        elif kind == 2:
            out[y, 1:] = (raw + up[1:]) & 255
        elif kind in (3, 4):
            for x in range(1, lines.shape[1]):
                a, b, c = int(out[y, x - 1]), int(up[x]), int(up[x - 1])
                guess = (a + b) // 2 if kind == 3 else min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                out[y, x] = (int(raw[x - 1]) + guess) & 255
        else:
            raise ValueError("unknown PNG filter")
    return out[1:, 1:].astype(np.uint8)


def feature_of(samples: np.ndarray) -> str:
    """64-bit average hash over an 8 by 8 grid of means, and the overall mean in hundredths."""
    rows = (np.arange(9) * len(samples)) // 8
    cols = (np.arange(9) * samples.shape[1]) // 8
    by_col = np.add.reduceat(samples.astype(np.uint64), cols[:-1], axis=1)
    sums = np.concatenate((np.zeros((1, 8), dtype=np.uint64), np.cumsum(by_col, axis=0)))
    low, high = rows[:-1], np.minimum(np.maximum(rows[1:], rows[:-1] + 1), len(samples))
    means = (sums[high] - sums[low]) / ((high - low)[:, None] * np.diff(cols)[None, :])
    bits = np.packbits((means > means.mean()).ravel()).tobytes().hex()
    return f"{bits}-{int(sums[-1].sum()) * 100 // samples.size}"


def payload_of(text: str | None) -> bytes:
    """UTF-8 of the text and bytes 255 up to a positive multiple of a row."""
    data = (text or "").encode()
    return data + b"\xff" * (max(ROW, -(-len(data) // ROW) * ROW) - len(data))


STORE = "row long, doc_id long, html string, digest string, media binary"


def _figure(digest: str, caption: str) -> str:
    return f'<figure><img src="{DIGEST_SCHEME}{digest}"><figcaption>{escape(caption)}</figcaption></figure>'


def store_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", origin_col: str | None = None) -> DataFrame:
    """One page for each document, and each medium it refers to once for each digest and task.

    A page has a line of text, a figure with the document's text as a picture,
    and, with ``origin_col``, another line and a figure with the picture of the
    document's origin, which very many pages share.  ``row`` tells rows apart.
    """
    shared.bound_batches(docs.sparkSession)
    origin = F.col(origin_col).cast("string") if origin_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), origin.alias("origin"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
        number = TaskContext.get().partitionId() << 40

        def stored(payload: bytes) -> tuple[str, bytes | None]:
            digest, media = hashlib.sha256(payload), None
            if digest.digest() not in seen:
                if len(seen) > 200_000:  # forgetting only stores a medium again
                    seen.clear()
                seen.add(digest.digest())
                media = encode_png(payload)
            return digest.hexdigest(), media

        for batch in batches:
            out = []
            for doc_id, text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                name, media = stored(payload_of(text.as_py()))
                caption = f"document {doc_id}"
                html = f"<article><p>{escape(caption)}</p>{_figure(name, caption)}"
                if origin_col:
                    badge, picture = stored(payload_of(own))
                    html += f"<p>from {escape(own or '')}</p>{_figure(badge, f'origin {own}')}"
                    if picture is not None:
                        out.append((None, None, None, badge, picture))
                out.append((number, doc_id, html + "</article>", name, media))
                number += 1
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["row", "doc_id", "html", "digest", "media"])

    return shared.materialize(rows.mapInArrow(run, STORE), "media-store")


def interleave(pages: DataFrame, *, id_col: str, html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the longs ``keep`` and ``items``, the ordered text and media-reference structs of each page."""
    shared.bound_batches(pages.sparkSession)
    kind = pa.list_(pa.struct([(f.split(":")[0], pa.int32() if f.endswith(":int") else pa.string()) for f in ITEM.split(",")]))
    own = (id_col, *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [parse_interleaved(h) for h in batch.column(len(own)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(own))), pa.array(items, kind)], [*own, "items"])

    longs = [F.col(c).cast("long").alias(c) for c in own]
    return pages.select(*longs, F.col(html_col)).mapInArrow(run, f"{', '.join(f'{c} long' for c in own)}, items array<struct<{ITEM}>>")


FEATURES = "digest string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_features(store: DataFrame) -> DataFrame:
    """What the stored bytes say, one row for each digest."""
    names = [x.strip().split(" ")[0] for x in FEATURES.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string() if x.strip().endswith("string") else pa.int64() for x in FEATURES.split(",")]
        for batch in batches:
            out = []
            for digest, media in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = media.as_py()
                samples = decode_png(data)
                payload = samples.tobytes()
                out.append((
                    digest,
                    len(payload.rstrip(b"\xff")),
                    len(payload),
                    hashlib.sha256(payload).hexdigest(),
                    zlib.crc32(payload[-32:]),
                    len(data),
                    hashlib.sha256(data).hexdigest(),
                    feature_of(samples),
                ))
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    made = store.where("media is not null").select("digest", "media").mapInArrow(run, FEATURES)
    return made.dropDuplicates(["digest"])


def resolve(items: DataFrame, media: DataFrame, *, id_col: str, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Items with ``media``, a struct of the joined columns, positions and captions as they were.

    ``id_col`` tells pages apart.  Only references meet the join; adaptive
    execution splits a digest that very many references share.  The sequence of a
    document is put together again by its own items.
    """
    flat = items.select(id_col, *keep, F.explode_outer("items").alias("item"))
    known = media.select(F.col("digest").alias("_digest"), F.struct(*columns).alias("media"))
    texts = flat.where(F.col("item.digest").isNull()).withColumn("media", F.lit(None).cast(known.schema["media"].dataType))
    references = flat.where(F.col("item.digest").isNotNull()).join(known, F.col("item.digest") == F.col("_digest"), "left").drop("_digest")
    part = F.when(F.col("item").isNotNull(), F.struct("item.position", "item", "media"))
    parts = texts.unionByName(references).groupBy(id_col, *keep).agg(F.collect_list(part).alias("parts"))
    return parts.select(id_col, *keep, F.transform(F.array_sort("parts"), lambda p: F.struct(p["item"].alias("item"), p["media"].alias("media"))).alias("sequence"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document as a page with its text and its origin stored as pictures, resolved to its sequence again."""
    store = store_texts(spread(spark.read.parquet(f"{sf_dir}/documents.parquet")), origin_col="source")
    items = shared.materialize(interleave(store.where("html is not null"), id_col="row", keep=("doc_id",)), "media-items")
    columns = [x.strip().split(" ")[0] for x in FEATURES.split(",")][1:]
    sequences = resolve(items, shared.materialize(media_features(store), "media-features"), id_col="row", columns=columns, keep=("doc_id",))
    pictures = F.filter("sequence", lambda s: s["item"]["kind"] == "media")
    own, origin = F.get(pictures, F.lit(0)), F.get(pictures, F.lit(1))
    return sequences.select(
        "doc_id", *(own["media"][c].alias(c) for c in columns), own["item"]["position"].alias("position"), own["item"]["caption"].alias("caption"),
        F.size("sequence").alias("n_items"), origin["item"]["position"].alias("origin_position"), origin["item"]["caption"].alias("origin_caption"), origin["media"]["payload_sha256"].alias("origin_sha256"),
    )


QUERIES = {"op3_media_columns": op3_media_columns}
ORACLE_SQL: dict[str, str] = {}
