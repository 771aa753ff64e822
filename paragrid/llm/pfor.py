"""Token files of patched frame-of-reference blocks.

File: ``PFR1``, blocks, block index, document table, footer.  A block holds
``BLOCK`` ids (the last may hold fewer): its minimum is subtracted, the
differences are packed at the bit width that covers ``percentile`` of them, and
those that do not fit stand in the block's exception list.  The block index
holds the start of every block, so a reader can seek to any id.

Edge cases: a null text counts as empty and has the end id alone; equal doc_ids
keep their texts' order; a null doc_id sorts first; an empty table gives no
file and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, shared

MAGIC = b"PFR1"
BLOCK = 512  # ids in a block: 16 lanes of 32
FILE_BLOCK = 4096  # files whose starts are summed in one task
LANES, LANE = 16, 32
HEAD = struct.Struct("<HBBHI")  # ids, width, unused, exceptions, minimum
FOOT = struct.Struct("<QQQQ4s")  # offset of index, blocks, offset of documents, documents
MANIFEST = "file_no int, path string, n_docs long, n_ids long"
DECODED = "file_no int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def pack_lanes(values: np.ndarray, width: int) -> np.ndarray:
    """(m, 512) differences to (m, 16 * width) words; 32 values of a lane share ``width`` words."""
    lanes = values.reshape(-1, LANES, LANE)
    out = np.zeros((lanes.shape[0], LANES, width), dtype=np.uint64)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 32)
        v = lanes[:, :, i].astype(np.uint64) << np.uint64(shift)
        out[:, :, word] |= v & np.uint64(0xFFFFFFFF)
        if shift + width > 32:
            out[:, :, word + 1] |= v >> np.uint64(32)
    return out.astype("<u4").reshape(len(lanes), LANES * width)


def unpack_lanes(words: np.ndarray, width: int) -> np.ndarray:
    """Inverse of ``pack_lanes``."""
    lanes = words.reshape(-1, LANES, width).astype(np.uint64)
    out = np.zeros((lanes.shape[0], LANES, LANE), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(LANE if width else 0):
        word, shift = divmod(i * width, 32)
        v = lanes[:, :, word] >> np.uint64(shift)
        if shift + width > 32:
            v = v | (lanes[:, :, word + 1] << np.uint64(32 - shift))
        out[:, :, i] = v & mask
    return out.reshape(-1, BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = 0.9) -> list[bytes]:
    """Blocks of a run of ids; only the last may be partial."""
    n = len(ids)
    if not n:
        return []
    count = -(-n // BLOCK)
    grid = np.full(count * BLOCK, ids[-1], dtype=np.uint32)
    grid[:n] = ids
    grid = grid.reshape(count, BLOCK)
    low = grid.min(axis=1)
    diff = grid - low[:, None]
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    chosen = np.partition(diff, at, axis=1)[:, at].astype(np.uint64)
    widths = np.zeros(count, dtype=np.int64)
    for bit in range(32):
        widths[chosen >> np.uint64(bit) > 0] = bit + 1
    blocks: list[bytes] = [b""] * count
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        own = diff[rows]
        over = own >> np.uint32(width) > 0 if width < 32 else np.zeros_like(own, dtype=bool)
        packed = pack_lanes(np.where(over, 0, own), int(width))
        at_row, at_col = np.nonzero(over)
        bounds = np.searchsorted(at_row, np.arange(len(rows) + 1))
        extra = own[at_row, at_col].astype("<u4")
        for k, row in enumerate(rows):
            a, b = bounds[k], bounds[k + 1]
            size = min(BLOCK, n - int(row) * BLOCK)
            blocks[row] = b"".join((
                HEAD.pack(size, int(width), 0, b - a, int(low[row])),
                packed[k].tobytes(),
                at_col[a:b].astype("<u2").tobytes(),
                extra[a:b].tobytes(),
            ))
    return blocks


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks at ``starts`` in ``data``, in order."""
    heads = [HEAD.unpack_from(data, s) for s in starts]
    out = np.zeros((len(starts), BLOCK), dtype=np.uint32)
    widths = np.array([h[1] for h in heads], dtype=np.int64)
    for width in np.unique(widths):
        rows, size = np.flatnonzero(widths == width), LANES * int(width) * 4
        joined = b"".join(data[starts[r] + HEAD.size : starts[r] + HEAD.size + size] for r in rows)
        if width:
            out[rows] = unpack_lanes(np.frombuffer(joined, dtype="<u4").reshape(len(rows), -1), int(width))
    for r, (_, width, _, exceptions, _) in enumerate(heads):
        if exceptions:
            at = int(starts[r]) + HEAD.size + LANES * width * 4
            where = np.frombuffer(data, dtype="<u2", count=exceptions, offset=at)
            out[r, where] = np.frombuffer(data, dtype="<u4", count=exceptions, offset=at + 2 * exceptions)
    out += np.array([h[4] for h in heads], dtype=np.uint32)[:, None]
    sizes = np.array([h[0] for h in heads])
    if len(sizes) and (sizes[:-1] == BLOCK).all():
        return out.reshape(-1)[: (len(sizes) - 1) * BLOCK + sizes[-1]]
    return np.concatenate([row[:s] for row, s in zip(out, sizes, strict=True)]) if len(sizes) else out.reshape(-1)


class TokenFileWriter:
    """Streams documents' ids into one file; holds at most ``flush_ids`` ids."""

    def __init__(self, out, *, percentile: float = 0.9, flush_ids: int = 1 << 20):
        self.out, self.percentile, self.flush_ids = out, percentile, flush_ids - flush_ids % BLOCK
        self.at, self.held, self.waiting = len(MAGIC), [], 0
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.n_ids = 0
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.flush_ids:
            joined = np.concatenate(self.held)
            full = len(joined) - len(joined) % BLOCK
            self._put(joined[:full])
            self.held, self.waiting = [joined[full:]], len(joined) - full

    def _put(self, ids: np.ndarray) -> None:
        for begin in range(0, len(ids), self.flush_ids):
            for block in encode_blocks(ids[begin : begin + self.flush_ids], self.percentile):
                self.starts.append(self.at)
                self.out.write(block)
                self.at += len(block)

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.held))
        index = np.asarray(self.starts, dtype="<u8").tobytes()
        ids = np.array([0 if d is None else d for d, _ in self.docs], dtype="<i8")
        sizes = np.array([n for _, n in self.docs], dtype="<u8")
        known = np.array([d is not None for d, _ in self.docs], dtype="u1")
        table = ids.tobytes() + sizes.tobytes() + known.tobytes()
        self.out.write(index + table + FOOT.pack(self.at, len(self.starts), self.at + len(index), len(self.docs), MAGIC))


def read_documents(source, size: int, *, step_blocks: int = 2048) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of a file's documents; ``source`` can seek."""
    source.seek(size - FOOT.size)
    index_at, blocks, docs_at, docs, magic = FOOT.unpack(source.read(FOOT.size))
    source.seek(0)
    if magic != MAGIC or source.read(4) != MAGIC:
        raise ValueError("not a token file")
    source.seek(index_at)
    starts = np.frombuffer(source.read(8 * blocks), dtype="<u8").astype(np.int64)
    source.seek(docs_at)
    names = np.frombuffer(source.read(8 * docs), dtype="<i8")
    sizes = np.frombuffer(source.read(8 * docs), dtype="<u8").astype(np.int64)
    known = np.frombuffer(source.read(docs), dtype="u1")
    ends = np.append(starts[1:], index_at)
    held, next_block, at = np.empty(0, dtype=np.uint32), 0, 0
    for name, n, has in zip(names.tolist(), sizes.tolist(), known.tolist(), strict=True):
        parts, have = [held], len(held)
        while have < n:
            if next_block >= blocks:
                raise ValueError("file holds fewer ids than its document table says")
            last = min(blocks, next_block + step_blocks)
            source.seek(int(starts[next_block]))
            data = source.read(int(ends[last - 1] - starts[next_block]))
            parts.append(decode_blocks(data, starts[next_block:last] - starts[next_block]))
            have, next_block = have + len(parts[-1]), last
        joined = np.concatenate(parts) if len(parts) > 1 else held
        yield (name if has else None), at, joined[:n]
        held, at = joined[n:], at + n


def write_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, percentile: float = 0.9, folder: str | None = None) -> DataFrame:
    """Token files in ascending document order; returns the manifest with each file's first position.

    Documents are range-partitioned by id, so file ``k`` ends where ``k + 1``
    begins; a file's place in the stream is a running sum over the manifest,
    one row for each file.  The manifest is what Spark commits: files of failed
    attempts are in no manifest and are never read.
    """
    spark = docs.sparkSession
    folder = folder or shared.scratch_path(spark, "tokens")
    shared.make_dir(folder)
    shared.bound_batches(spark, bpe.ROWS)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange(shared.shuffle_parts(docs), F.col("doc_id"), F.left("text", F.lit(32)))  # an id of very many rows is dealt out by text
        .sortWithinPartitions("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = stream = None
        number = TaskContext.get().partitionId()
        name = f"{folder}/tokens-{number:06d}-{uuid.uuid4().hex}.pfor"
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            if writer is None:
                filesystem, path = shared.open_fs(name)
                stream = filesystem.open_output_stream(path)
                writer = TokenFileWriter(stream, percentile=percentile)
            coded = bpe.encoder(tokenizer_path).encode_batch(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), coded, strict=True):
                writer.add(doc_id, np.frombuffer(ids + end, dtype="<u4"))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"file_no": pa.array([number], pa.int32()), "path": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]}
            )

    manifest = shared.materialize(ordered.mapInArrow(write, MANIFEST), "tokens-manifest")
    return with_starts(manifest)


def with_starts(manifest: DataFrame, block: int = FILE_BLOCK) -> DataFrame:
    """Adds ``first``, the ids of all files before: summed within blocks of files, and over the blocks, a row for each ``block`` files."""
    blocked = manifest.withColumn("block", F.expr(f"file_no div {block}"))
    above = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy("block").agg(F.sum("n_ids").alias("ids")).select("block", F.coalesce(F.sum("ids").over(above), F.lit(0)).alias("base"))
    before = Window.partitionBy("block").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocked.join(sums, "block").withColumn("first", F.col("base") + F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return placed.select(*manifest.columns, F.col("first").cast("long").alias("first"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document: its place in the whole stream, its number of ids and their checksum."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark = manifest.sparkSession
    kind = _parse_datatype_string("doc_id long, start long, n_tokens long, ids_crc32 long")
    schema = to_arrow_schema(kind)

    def rows_of(path: str, first: int) -> Iterable[dict]:
        filesystem, local = shared.open_fs(path)
        with filesystem.open_input_file(local) as source:
            for doc_id, at, ids in read_documents(source, source.size()):
                yield {"doc_id": doc_id, "start": first + at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held: list[dict] = []
                for row in rows_of(path, first):
                    held.append(row)
                    if len(held) >= 8192:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = manifest.select("path", "first").repartitionByRange(max(1, manifest.count()), "first", "path")  # a row a file, a file a task
    return files.mapInArrow(read, kind)


def op2_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents through token files and back."""
    import public_tokenizers

    manifest = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(manifest)


QUERIES = {"op2_pfor_tokens": op2_pfor_tokens}
ORACLE_SQL: dict[str, str] = {}
