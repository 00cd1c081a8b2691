"""Token ids in bit planes: blocks of ids are transposed, each plane is compressed by itself, and a chunk index says where it lies.

A chunk holds whole documents: a head (magic, documents, ids, ids per block, planes), a bitmap of the documents without an id, the documents' ids and lengths, the compressed size of every
plane of every block (0: a plane of zeros, not stored), then the planes. Chunks are rows of a table in the shared folder, in document order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .pretokens import piece_table
from ..shared import materialise
from .words import text_slices, tidy

MAGIC = b"TPL2"
BLOCK, LEVEL = 1 << 14, 3
#: A chunk is closed at the first document that brings it to this many ids.
CHUNK = 1 << 18
#: Bytes of text that are encoded at a time: pieces and ids take some thirty times as much.
ENCODED_BYTES = 3 << 19
_HEAD = struct.Struct("<4sIQII")


def planes_of(ids: np.ndarray, planes: int) -> list[bytes]:
    """Bit k of every id, packed, for k from 0."""
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(bits[:, k]), bitorder="little").tobytes() for k in range(planes)]


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    for k, raw in enumerate(planes):
        if raw:
            bits[:, k] = np.unpackbits(np.frombuffer(raw, np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def pack_chunk(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    planes = max(1, int(flat.max()).bit_length()) if len(flat) else 1
    press, sizes, body = zstandard.ZstdCompressor(level=LEVEL), [], []
    for lo in range(0, len(flat), BLOCK):
        for raw in planes_of(flat[lo : lo + BLOCK], planes):
            out = press.compress(raw) if any(raw) else b""
            sizes.append(len(out))
            body.append(out)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(flat), BLOCK, planes)
    none = np.packbits(np.array([i is None for i in doc_ids], bool), bitorder="little").tobytes()
    return b"".join([head, none, np.array([i or 0 for i in doc_ids], "<i8").tobytes(), np.array([len(x) for x in ids], "<u4").tobytes(), np.array(sizes, "<u4").tobytes(), *body])


def unpack_chunk(raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(document ids, null for none, lengths, all ids in order)."""
    magic, docs, n, block, planes = _HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a chunk of token planes")
    at = _HEAD.size
    none, at = np.unpackbits(np.frombuffer(raw, np.uint8, -(-docs // 8), at), count=docs, bitorder="little").astype(bool), at + -(-docs // 8)
    doc_ids, at = np.frombuffer(raw, "<i8", docs, at), at + 8 * docs
    lengths, at = np.frombuffer(raw, "<u4", docs, at), at + 4 * docs
    blocks = -(-n // block)
    sizes, at = np.frombuffer(raw, "<u4", blocks * planes, at), at + 4 * blocks * planes
    ends = at + np.cumsum(sizes)
    press, out = zstandard.ZstdDecompressor(), []
    for b in range(blocks):
        each = range(b * planes, (b + 1) * planes)
        out.append(ids_of([press.decompress(raw[ends[k] - sizes[k] : ends[k]]) if sizes[k] else b"" for k in each], min(block, n - b * block)))
    return pa.array(doc_ids.astype(np.int64), mask=none), lengths, np.concatenate(out) if out else np.empty(0, np.uint32)


def encode_texts(docs: DataFrame, tokenizer: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, ids): every text's ids and ``end_id``, as little-endian unsigned 16-bit numbers (32-bit where an id needs them; n tells which)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(tokenizer, keep_ids=True)
        for batch in batches:
            for part in text_slices(batch, "text", ENCODED_BYTES):
                offsets, flat = table.encode(part.column("text"))
                rows = part.num_rows
                flat = np.insert(flat, offsets[1:], end_id)
                offsets = offsets + np.arange(rows + 1)
                wide = len(flat) and int(flat.max()) >= 1 << 16
                width = 4 if wide else 2
                at = (offsets * width).astype(np.int32)
                data = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(at), pa.py_buffer(flat.astype("<u4" if wide else "<u2"))])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(offsets)), data], names=["id", "n", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "id long, n long, ids binary")


def numbers(raw: bytes, n: int) -> np.ndarray:
    """The ids of an ``encode_texts`` row."""
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32)


def _write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, doc_ids, held, n, start = TaskContext.get().partitionId(), [], [], 0, 0

    def chunk() -> pa.RecordBatch:
        raw = pack_chunk(doc_ids, held)
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, start, n, len(doc_ids))] + [pa.array([raw], pa.binary())], names=["part", "start", "n_ids", "n_docs", "chunk"])

    for batch in batches:
        for i, size, raw in zip(batch.column("id"), batch.column("n"), batch.column("ids"), strict=True):
            doc_ids.append(i.as_py())
            held.append(numbers(raw.as_py(), size.as_py()))
            n += size.as_py()
            if n >= CHUNK:
                yield chunk()
                doc_ids, held, n, start = [], [], 0, start + n
    if doc_ids:
        yield chunk()


def write_planes(encoded: DataFrame, *, parts: int | None = None) -> DataFrame:
    """Lays ``encode_texts`` rows down as chunks, in ascending id order (null first, ties by a hash of their ids, so that they may be many tasks), and returns the written table.

    Rows: part and ``start`` (ids before the chunk in its part), n_ids, n_docs, chunk. The parts follow each other in document order.
    """
    kept = materialise(encoded, "token-ids")
    parts = parts or max(1, int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = F.col("id").asc_nulls_first(), F.xxhash64("ids").asc()
    ordered = kept.repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids")
    return materialise(ordered.mapInArrow(tidy(_write_batches), "part long, start long, n_ids long, n_docs long, chunk binary"), "token-planes", codec="none")


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, raw in zip(batch.column("start"), batch.column("chunk"), strict=True):
            doc_ids, lengths, flat = unpack_chunk(raw.as_py())
            ends = np.cumsum(lengths, dtype=np.int64)
            data = memoryview(flat.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(base.as_py() + ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])


def read_planes(written: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in a written table; ``start`` counts the ids of all documents before it."""
    parts = written.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = parts.select("part", before.alias("base"))  # one row a part
    placed = written.join(F.broadcast(bases), "part").select((F.col("start") + F.col("base")).alias("start"), "chunk")
    return placed.mapInArrow(tidy(_read_batches), "id long, start long, n_tokens long, ids_crc32 long")


def token_planes(docs: DataFrame, tokenizer: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes, writes and reads back; one row for each row of ``docs``. A null or empty text is just ``end_id``; an empty table gives no rows."""
    return read_planes(write_planes(encode_texts(docs, tokenizer, end_id=end_id, id_col=id_col, text_col=text_col))).withColumnRenamed("id", id_col)
