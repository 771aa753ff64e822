"""Zstandard WARC archives: writer, streaming reader, and the page round trip.

Archive layout: a skippable frame (magic 0x184D2A5D) that holds the dictionary,
then one Zstandard frame for each record.  Each frame therefore can be decoded
alone once the dictionary is loaded.

Edge cases: a null payload is written as zero bytes; a null or blank URL becomes
``urn:page:<id>``; control characters in header values are percent-encoded; a
record that fails validation comes back as a row with ``error`` set and never
stops the job; a damaged frame ends its archive with one error row.  Rows that
repeat both payload and id are each a response.  An empty table yields no archive
and no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from . import shared

DICT_MAGIC = 0x184D2A5D  # fixed value of the archive format
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")  # fixed values
NAMESPACE = uuid.UUID("6f3f0c52-6a53-5f0e-9f4e-2a8c5a3f7b11")

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "archive string, frame_offset long, record_type string, record_id string, page_id long, target_uri string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary, error string"
)


def sha1_base32(data: bytes) -> str:
    """Upper-case base32 of the SHA-1, as WARC digests are written."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_safe(value: str) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, responder: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves the payload out."""
    digest = sha1_base32(payload)
    revisit = responder is not None and responder != page_id
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if not revisit:
        block += payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header_safe(url) if url and url.strip() else f'urn:page:{page_id}'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {_record_id(responder, digest)}",
            f"WARC-Refers-To-Page-ID: {responder}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Validate one decoded record: version, headers, lengths, digests."""
    cut = raw.find(b"\r\n\r\n")
    if cut < 0:
        raise ValueError("no end of headers")
    lines = raw[:cut].decode("utf-8", "strict").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    head: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header {line[:40]!r}")
        head[name] = value.strip()
    missing = [h for h in REQUIRED if h not in head]
    if missing:
        raise ValueError("missing header " + ", ".join(missing))
    if not head["Content-Length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length = int(head["Content-Length"])
    block, tail = raw[cut + 4 : cut + 4 + length], raw[cut + 4 + length :]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ValueError(f"block of {len(raw) - cut - 8} bytes, header says {length}")
    if "WARC-Block-Digest" in head and head["WARC-Block-Digest"] != "sha1:" + sha1_base32(block):
        raise ValueError("block digest differs")
    payload, declared = block, length
    if block.startswith(b"HTTP/"):
        http, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise ValueError("no end of HTTP headers")
        sizes = [x.split(b":", 1)[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        declared = int(sizes[0]) if sizes else len(payload)
    digest = head.get("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)).removeprefix("sha1:")
    if head["WARC-Type"] != "revisit":
        if declared != len(payload):
            raise ValueError(f"payload of {len(payload)} bytes, HTTP header says {declared}")
        if digest != sha1_base32(payload):
            raise ValueError("payload digest differs")
    page, refers = head.get("WARC-Page-ID", ""), head.get("WARC-Refers-To-Page-ID", "")
    return {
        "record_type": head["WARC-Type"],
        "record_id": head["WARC-Record-ID"],
        "page_id": int(page) if page else None,
        "target_uri": head.get("WARC-Target-URI"),
        "payload_bytes": declared,
        "payload_digest": digest,
        "refers_to": int(refers) if refers else None,
        "payload": payload,
    }


def make_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; too few samples give an empty one (plain frames)."""
    if len(samples) < 16 or sum(map(len, samples)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dict_of(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_archive(records: Iterable[bytes], out, *, dict_bytes: int = 32768, dict_samples: int = 128, sample_bytes: int = 16384, held_bytes: int = 32 << 20, level: int = 3) -> tuple[int, int]:
    """Stream records to ``out``; the first ``dict_samples`` (cut to ``sample_bytes``) train the dictionary.

    These are held until then, so fewer train it where they reach ``held_bytes``;
    a dictionary changes sizes only.
    """
    held: list[bytes] = []
    count = size = weight = 0
    packer: zstandard.ZstdCompressor | None = None

    def begin() -> None:
        nonlocal packer, size
        data = make_dictionary([r[:sample_bytes] for r in held], dict_bytes)
        out.write(struct.pack("<II", DICT_MAGIC, len(data)) + data)
        size += 8 + len(data)
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dict_of(data), write_checksum=True)

    def put(record: bytes) -> None:
        nonlocal count, size
        frame = packer.compress(record)
        out.write(frame)
        count, size = count + 1, size + len(frame)

    for record in records:
        if packer is None:
            held.append(record)
            weight += len(record)
            if len(held) < dict_samples and weight < held_bytes:
                continue
            begin()
            for x in held:
                put(x)
            held.clear()
        else:
            put(record)
    if packer is None:
        begin()
        for x in held:
            put(x)
    return count, size


def read_frames(source, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame, holding one record at a time."""
    head = source.read(8)
    if len(head) < 8:
        raise ValueError("no dictionary frame")
    magic, length = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("archive does not begin with a dictionary frame")
    data = source.read(length)
    if len(data) != length:
        raise ValueError("dictionary frame is cut short")
    if data[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
        data = zstandard.ZstdDecompressor().decompress(data)
    unpacker = zstandard.ZstdDecompressor(dict_data=_dict_of(data))
    offset, pending = 8 + length, source.read(chunk)
    while pending:
        frame, parts, used = unpacker.decompressobj(), [], 0
        while True:
            parts.append(frame.decompress(pending))
            used += len(pending)
            if frame.eof:
                break
            pending = source.read(chunk)
            if not pending:
                raise ValueError("last frame is cut short")
        rest = frame.unused_data
        used -= len(rest)
        yield offset, b"".join(parts)
        offset += used
        pending = rest or source.read(chunk)


def read_archive(source, name: str) -> Iterator[dict]:
    """Rows of ``RECORDS``; a bad record or frame is a row with ``error``."""
    frames = read_frames(source)
    blank = dict.fromkeys(x.strip().split(" ")[0] for x in RECORDS.split(","))
    at = 0
    while True:
        try:
            at, raw = next(frames)
        except StopIteration:
            return
        except (ValueError, zstandard.ZstdError) as e:
            yield blank | {"archive": name, "frame_offset": at, "error": str(e)}
            return
        try:
            yield blank | {"archive": name, "frame_offset": at} | parse_record(raw)
        except (ValueError, UnicodeDecodeError) as e:
            yield blank | {"archive": name, "frame_offset": at, "error": str(e)}


def write_warc(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_payload_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", folder: str | None = None, dict_bytes: int = 32768) -> DataFrame:
    """Write every row to archives in the shared folder; returns the manifest of files.

    Of equal payloads of at least ``min_payload_bytes`` the largest id is the
    response and the others revisit it.  The responder of a payload is found by
    a pre-aggregated maximum for each digest, and the join back is one that
    adaptive execution can split, so a payload shared by a third of all rows
    stays spread out.  Files get a unique name per task attempt; only those in
    the manifest, which Spark commits, are ever read, so a lost executor or a
    repeated task leaves no wrong data.
    """
    spark = pages.sparkSession
    folder = folder or shared.scratch_path(spark, "warc")
    shared.make_dir(folder)
    shared.bound_batches(spark)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.encode(F.col(payload_col), "UTF-8"), F.lit("").cast("binary")).alias("payload"),
    )
    keyed = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    responders = (
        keyed.where(F.length("payload") >= min_payload_bytes).groupBy("digest").agg(F.max("page_id").alias("responder"))
    )
    routed = keyed.join(responders, "digest", "left").select("page_id", "url", "payload", "responder")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for i, u, p, r in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    yield build_record(i, u, p, r, date)

        stream = records()
        first = next(stream, None)
        if first is None:
            return
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        filesystem, path = shared.open_fs(name)

        def chained() -> Iterator[bytes]:
            yield first
            yield from stream

        with filesystem.open_output_stream(path, compression=None) as out:  # the name ends in .zst, which would be taken for a wish
            count, size = write_archive(chained(), out, dict_bytes=dict_bytes)
        yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [count], "n_bytes": [size]})

    return shared.materialize(routed.mapInArrow(write, MANIFEST), "warc-manifest")


def read_warc(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in ``manifest.path``; one task reads one archive as a stream."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(RECORDS)
    schema = to_arrow_schema(kind)
    spark = manifest.sparkSession
    shared.bound_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                filesystem, path = shared.open_fs(name)
                held: list[dict] = []
                weight = 0
                with filesystem.open_input_stream(path, compression=None) as source:
                    for row in read_archive(source, name):
                        if not with_payload:
                            row["payload"] = None
                        held.append(row)
                        weight += len(row["payload"] or b"")
                        if len(held) >= shared.ARROW_ROWS or weight > 16 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.select("path").repartitionByRange(max(1, manifest.count()), "path").mapInArrow(read, kind)  # a row a file, a file a task


def op1_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every page through archives and back."""
    manifest = write_warc(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return read_warc(manifest, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"
    )


QUERIES = {"op1_warc_zstd": op1_warc_zstd}
ORACLE_SQL: dict[str, str] = {}
