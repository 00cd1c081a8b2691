"""Media columns: Matroska files of 8-bit samples, and packet tables parsed from any Matroska bytes.

The parser reads variable-length EBML elements, clusters (of known or unknown size), simple blocks and block groups with every kind of
lacing, and cues. The writer lays a payload down as one PCM track: frames of FRAME bytes, LACED to a block, BLOCKS blocks to a cluster.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialise
from .words import tidy

FRAME, LACED, BLOCKS = 576, 64, 32
# Element ids of the format.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID = 0x2AD7B1, 0xAE, 0xD7, 0x73C5, 0x83, 0x86
AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0xE7, 0xA3, 0xA0, 0xA1
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
DOC_TYPE, DOC_VERSION, DOC_READ_VERSION = 0x4282, 0x4287, 0x4285
_TOP = {CLUSTER, CUES, INFO, TRACKS, 0x114D9B74, 0x1254C367, 0x1941A469, 0x1043A770}


def _id(x: int) -> bytes:
    return x.to_bytes((x.bit_length() + 7) // 8, "big")


def _size(n: int) -> bytes:
    for width in range(1, 9):
        if n < (1 << 7 * width) - 1:
            return (n | 1 << 7 * width).to_bytes(width, "big")
    raise ValueError("an element is too long")


def _element(tag: int, body: bytes) -> bytes:
    return _id(tag) + _size(len(body)) + body


def _uint(tag: int, n: int) -> bytes:
    return _element(tag, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


_HEAD = _element(EBML, _element(DOC_TYPE, b"matroska") + _uint(DOC_VERSION, 4) + _uint(DOC_READ_VERSION, 2))
_INFO = _element(INFO, _uint(TIMESTAMP_SCALE, 1_000_000))
_AUDIO = _element(AUDIO, _element(SAMPLING, struct.pack(">d", FRAME * 1000.0)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8))
_TRACKS = _element(TRACKS, _element(TRACK_ENTRY, _uint(TRACK_NUMBER, 1) + _uint(TRACK_UID, 1) + _uint(TRACK_TYPE, 2) + _element(CODEC_ID, b"A_PCM/INT/LIT") + _AUDIO))


def mux(payload: bytes) -> bytes:
    """A Matroska file with the payload (a multiple of FRAME bytes) as 8-bit PCM; one frame lasts one millisecond."""
    frames = len(payload) // FRAME
    if frames * FRAME != len(payload):
        raise ValueError(f"the payload must be a multiple of {FRAME} bytes")
    body, cues = [_INFO, _TRACKS], []
    at = len(_INFO) + len(_TRACKS)
    for start in range(0, frames, LACED * BLOCKS):
        parts = [_uint(TIMESTAMP, start)]
        for first in range(start, min(frames, start + LACED * BLOCKS), LACED):
            n = min(LACED, frames - first)
            head = b"\x81" + struct.pack(">hB", first - start, 0x84 if n > 1 else 0x80) + (bytes([n - 1]) if n > 1 else b"")
            parts.append(_id(SIMPLE_BLOCK) + _size(len(head) + n * FRAME) + head)
            parts.append(payload[first * FRAME : (first + n) * FRAME])
        cluster = _element(CLUSTER, b"".join(parts))
        cues.append(_element(CUE_POINT, _uint(CUE_TIME, start) + _element(CUE_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(_element(CUES, b"".join(cues)))
    return _HEAD + _element(SEGMENT, b"".join(body))


@dataclass
class Media:
    """Parsed packets, in file order. Times count in ``scale`` nanoseconds; starts are offsets into the bytes."""

    scale: int = 1_000_000
    tracks: list[tuple[int, int, str]] = field(default_factory=list)  # number, type, codec
    clusters: int = 0
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time, track, offset of the cluster in the bytes
    track: list[np.ndarray] = field(default_factory=list)
    time: list[np.ndarray] = field(default_factory=list)
    start: list[np.ndarray] = field(default_factory=list)
    length: list[np.ndarray] = field(default_factory=list)

    def table(self) -> dict[str, np.ndarray]:
        return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in (("track", self.track), ("time", self.time), ("start", self.start), ("length", self.length))}


def _number(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int, bool]:
    """A variable-length number -> (value, where it ends, whether it says 'unknown')."""
    first = data[at] if at < len(data) else 0
    if not first:
        raise ValueError(f"no element at byte {at}")
    width = 9 - first.bit_length()
    if at + width > len(data):
        raise ValueError(f"the bytes end inside a number at {at}")
    raw = int.from_bytes(data[at : at + width], "big")
    value = raw & ((1 << 7 * width) - 1)
    return (raw if keep_marker else value), at + width, value == (1 << 7 * width) - 1


def _elements(data: bytes, at: int, end: int, stop: set[int] = frozenset()) -> Iterator[tuple[int, int, int, bool]]:
    """(id, body start, body end, size unknown) of each element; a body cut short by the end of the bytes is an error."""
    while at < end:
        tag, body, _ = _number(data, at, keep_marker=True)
        if tag in stop:
            return
        n, body, unknown = _number(data, body)
        close = end if unknown else body + n
        if close > end:
            raise ValueError(f"element {tag:#x} at byte {at} runs past its parent")
        if unknown and tag == CLUSTER:
            close = body
            for *_, close, _ in _elements(data, body, end, _TOP):
                pass
        yield tag, body, close, unknown
        at = close


def _laces(data: bytes, at: int, end: int, kind: int) -> tuple[int, list[int] | np.ndarray]:
    if kind == 0:
        return at, [end - at]
    if at >= end:
        raise ValueError("a block ends before its lace")
    n, at = data[at] + 1, at + 1
    if kind == 2:
        each, over = divmod(end - at, n)
        if over:
            raise ValueError("a fixed lace doesn't divide its block")
        return at, np.full(n, each)
    sizes = []
    for k in range(n - 1):
        if kind == 1:
            total = 0
            while True:
                if at >= end:
                    raise ValueError("a lace runs past its block")
                total, at = total + data[at], at + 1
                if data[at - 1] != 255:
                    break
            sizes.append(total)
        else:
            value, after, _ = _number(data, at)
            width, at = after - at, after
            sizes.append(value if k == 0 else sizes[-1] + value - ((1 << 7 * width - 1) - 1))
    sizes.append(end - at - sum(sizes))
    if at > end or min(sizes) < 0:
        raise ValueError("a lace is longer than its block")
    return at, sizes


def _block(data: bytes, at: int, end: int, base: int, out: Media) -> None:
    track, at, _ = _number(data, at)
    if at + 3 > end:
        raise ValueError("a block is shorter than its head")
    relative, flags = struct.unpack_from(">hB", data, at)
    start, sizes = _laces(data, at + 3, end, flags >> 1 & 3)
    length = np.asarray(sizes, np.int64)
    n = len(length)
    out.track.append(np.full(n, track))
    out.time.append(base + relative + np.arange(n))  # laced frames follow at the track's frame duration, one unit here
    out.start.append(start + np.cumsum(length) - length)
    out.length.append(length)


def _value(data: bytes, a: int, b: int) -> int:
    return int.from_bytes(data[a:b], "big")


def demux(data: bytes) -> Media:
    """Parses Matroska bytes; malformed bytes raise ValueError."""
    out = Media()
    for tag, a, b, _ in _elements(data, 0, len(data)):
        if tag != SEGMENT:
            continue
        segment = a
        for top, c, d, _ in _elements(data, a, b):
            if top == INFO:
                out.scale = next((_value(data, x, y) for t, x, y, _ in _elements(data, c, d) if t == TIMESTAMP_SCALE), out.scale)
            elif top == TRACKS:
                for t, x, y, _ in _elements(data, c, d):
                    if t == TRACK_ENTRY:
                        got = {u: data[p:q] for u, p, q, _ in _elements(data, x, y)}
                        out.tracks.append((int.from_bytes(got.get(TRACK_NUMBER, b""), "big"), int.from_bytes(got.get(TRACK_TYPE, b""), "big"), got.get(CODEC_ID, b"").decode("ascii", "replace")))
            elif top == CLUSTER:
                out.clusters += 1
                base = 0
                for t, x, y, _ in _elements(data, c, d):
                    if t == TIMESTAMP:
                        base = _value(data, x, y)
                    elif t == SIMPLE_BLOCK:
                        _block(data, x, y, base, out)
                    elif t == BLOCK_GROUP:
                        for u, p, q, _ in _elements(data, x, y):
                            if u == BLOCK:
                                _block(data, p, q, base, out)
            elif top == CUES:
                for t, x, y, _ in _elements(data, c, d):
                    if t == CUE_POINT:
                        time, track, where = 0, 0, 0
                        for u, p, q, _ in _elements(data, x, y):
                            if u == CUE_TIME:
                                time = _value(data, p, q)
                            elif u == CUE_POSITIONS:
                                for v, r, s, _ in _elements(data, p, q):
                                    track = _value(data, r, s) if v == CUE_TRACK else track
                                    where = _value(data, r, s) if v == CUE_CLUSTER else where
                        out.cues.append((time, track, segment + where))
    return out


def _mux_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            media, sizes = [], []
            for text in part.column("text"):
                raw = (text.as_py() or "").encode()
                sizes.append(len(raw))
                media.append(mux(raw + b"\xff" * ((-len(raw)) % FRAME if raw else FRAME)))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["id", "n_bytes", "media"])


def to_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text as UTF-8, padded with byte 255 to a positive multiple of FRAME, in a Matroska file of its own.

    A null text counts as empty and gives one frame of padding. Null and repeated ids stay; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_mux_batches), "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


def packets(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row a packet: id, packet (from 0), track, time_ns, start and length (byte range in the media). Null media has no packets.

    Malformed media gives one row that has only its id and, in ``error``, what is wrong; the job goes on.
    """
    names = ["id", "packet", "track", "time_ns", "start", "length", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column("id"), batch.column("media"), strict=True):
                if not raw.is_valid:
                    continue
                try:
                    parsed = demux(raw.as_py())
                except ValueError as e:
                    yield pa.RecordBatch.from_arrays([pa.array([i.as_py()], pa.int64()), *[pa.nulls(1, pa.int64())] * 5, pa.array([str(e)])], names=names)
                    continue
                t = parsed.table()
                n = len(t["track"])
                numbers = [np.arange(n), t["track"], t["time"] * parsed.scale, t["start"], t["length"]]
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * n, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers), pa.nulls(n, pa.string())], names=names)

    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media"))
    return rows.mapInArrow(tidy(run), "id long, packet long, track long, time_ns long, start long, length long, error string").withColumnRenamed("id", id_col)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, n, raw in zip(batch.column("id"), batch.column("n_bytes"), batch.column("media"), strict=True):
            data = raw.as_py()
            parsed = demux(data)
            t = parsed.table()
            runs = np.flatnonzero(np.concatenate([[True], t["start"][1:] != t["start"][:-1] + t["length"][:-1]]))
            ends = t["start"] + t["length"]
            payload = b"".join(data[t["start"][a] : ends[b]] for a, b in zip(runs, np.append(runs[1:], len(ends)) - 1, strict=True))
            samples = np.frombuffer(payload, np.uint8)
            feature = f"packets={len(ends)};clusters={parsed.clusters};cues={len(parsed.cues)};ms={int(t['time'][-1]) + 1};sum={int(samples.sum(dtype=np.int64))};peak={int(samples.max())};turns={int(np.count_nonzero((samples[1:] > 127) != (samples[:-1] > 127)))}"
            rows.append((i.as_py(), n.as_py(), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature))
        names = ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(types)], names=names)


def media_features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as a Matroska column in the shared folder, reads it back and describes each row by its packets and samples.

    One row for each row of ``docs``; equal texts give equal values. See ``to_media`` for null and empty texts.
    """
    stored = materialise(to_media(docs, id_col=id_col, text_col=text_col).withColumnRenamed(id_col, "id"), "media")
    out = stored.mapInArrow(tidy(_feature_batches), "id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return out.withColumnRenamed("id", id_col)
