"""A committed log as a data source of its own: ``spark.read.format("streamlog")`` with one task a split, ``readStream`` with exact record budgets.

Offsets of a stream query are ``{stream: next offset}``, taken from the commits, so a batch ends where the budget says and not where a file does. Rows come as Arrow batches from
the Parquet files that hold a split's offsets; their row groups are pruned by offset.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.limits import grants
from ..options import LimitOptions, seconds

#: Columns that a row's place in the log gives; its files don't hold them.
_PLACED = ("stream", "batch_id")


@dataclass
class Split(InputPartition):
    """Offsets ``[lo, hi)`` of a stream, and the folders of the batches that hold them."""

    stream: str
    lo: int
    hi: int
    folders: list[tuple[str, str]]  # (batch, folder)

    def __init__(self, stream: str, lo: int, hi: int, folders: list[tuple[str, str]]):
        super().__init__(None)
        self.stream, self.lo, self.hi, self.folders = stream, lo, hi, folders


class Commits:
    """The commits of a log, read with the store's own client. Each record is read once, those of before a checkpoint from it; a batch's latest attempt counts."""

    def __init__(self, path: str):
        self.store, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.version = -1
        self.batches: dict[str, tuple[str, dict[str, tuple[int, int]]]] = {}

    def _versions(self, folder: str) -> dict[int, str]:
        found = self.store.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return {int(f.base_name[:20]): f.path for f in found if re.fullmatch(r"\d{20}\.json", f.base_name)}

    def _lines(self, path: str) -> list[dict]:
        return [json.loads(x) for x in self.store.open_input_stream(path).read().decode().splitlines()]

    def refresh(self) -> Commits:
        checked = None
        while True:
            covered = self._versions("_checkpoints")
            newest = max(covered, default=-1)
            if newest > self.version:
                folder = self._lines(covered[newest])[0]["folder"]
                files = [f.path for f in self.store.get_file_info(fs.FileSelector(f"{self.root}/_checkpoints/{folder}")) if f.base_name.endswith(".parquet")]
                self.batches, self.version = {}, newest
                self._apply(ds.dataset(files, filesystem=self.store, format="parquet").to_table().to_pylist())
            later = sorted((v, p) for v, p in self._versions("_commits").items() if v > self.version)
            if later and later[0][0] != self.version + 1 and checked != newest:  # records may have gone to a checkpoint meanwhile
                checked = newest
                continue
            for version, path in later:
                self._apply(self._lines(path))
                self.version = version
            return self

    def _apply(self, lines: list[dict]) -> None:
        by_batch: dict[tuple[str, str], list[dict]] = {}
        for x in lines:
            by_batch.setdefault((x["batch_id"], x["attempt"]), []).append(x)
        for (batch, attempt), rows in by_batch.items():
            ranges: dict[str, tuple[int, int]] = {}
            for x in rows:
                if x["kind"] == "range":
                    lo, hi = ranges.get(x["stream"], (x["start_offset"], 0))
                    ranges[x["stream"]] = (min(lo, x["start_offset"]), max(hi, x["start_offset"] + x["n"]))
            if ranges:
                self.batches[batch] = (attempt, ranges)
            else:  # merged into another
                self.batches.pop(batch, None)

    def bounds(self) -> dict[str, tuple[int, int]]:
        """Each stream's first offset and its tail."""
        out: dict[str, tuple[int, int]] = {}
        for _, ranges in self.batches.values():
            for stream, (lo, hi) in ranges.items():
                known = out.get(stream, (lo, hi))
                out[stream] = (min(known[0], lo), max(known[1], hi))
        return out

    def split(self, stream: str, lo: int, hi: int) -> Split:
        held = [(b, f"{self.root}/batch_id={b}/attempt={a}") for b, (a, ranges) in self.batches.items() if stream in ranges and ranges[stream][0] < hi and ranges[stream][1] > lo]
        return Split(stream, lo, hi, sorted(held))


def cut(lo: int, hi: int, most: int | None) -> list[tuple[int, int]]:
    """``[lo, hi)`` in even parts of at most ``most`` offsets, the first ones longer by one."""
    n = max(1, -(-(hi - lo) // most)) if most else 1
    ends = [lo + (hi - lo) // n * k + min(k, (hi - lo) % n) for k in range(n + 1)]
    return list(zip(ends, ends[1:], strict=False))


@dataclass
class Options:
    """Options of the source, as Spark hands them over: texts by case-insensitive names."""

    path: str
    streams: list[str] | None = None
    superstream: str | None = None
    topology: str | None = None
    starts: dict[str, int] = field(default_factory=dict)
    latest: bool = False
    frozen: bool = False
    limits: LimitOptions = field(default_factory=LimitOptions)
    split_records: int | None = None

    @staticmethod
    def of(o: dict[str, str]) -> Options:
        number = lambda k: int(o[k]) if o.get(k) else None
        if bool(o.get("superstream")) != bool(o.get("topology")):
            raise ValueError("superstream goes with topology, a folder of (superstream, stream)")
        if o.get("superstream") and o.get("streams"):
            raise ValueError("give streams or a superstream, not both")
        limits = LimitOptions(max_records=number("max_records"), min_records=number("min_records"), max_delay=o.get("max_delay") or "15m")
        return Options(
            o["path"], json.loads(o["streams"]) if o.get("streams") else None, o.get("superstream"), o.get("topology"), json.loads(o.get("starts") or "{}"),
            o.get("start") == "latest", o.get("until") == "now", limits, number("split_records"),
        )

    def members(self, bounds: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
        """The bounds of the streams that are asked for. A superstream's members are looked up each time: partitions come and go."""
        wanted = self.streams
        if self.superstream is not None:
            store, root = fs.FileSystem.from_uri(self.topology) if "://" in self.topology or self.topology.startswith("file:") else (fs.LocalFileSystem(), self.topology)
            table = ds.dataset(root, filesystem=store, format="parquet").to_table(columns=["stream"], filter=pc.field("superstream") == self.superstream)
            wanted = table["stream"].to_pylist()
        return bounds if wanted is None else {k: v for k, v in bounds.items() if k in set(wanted)}


def _read(root: Options, schema: StructType, part: Split) -> Iterator[pa.RecordBatch]:
    store = Commits(root.path).store
    want = to_arrow_schema(schema)
    stored = [f.name for f in want if f.name not in _PLACED]
    for batch, folder in part.folders:
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.type != fs.FileType.Directory or unquote(info.base_name) != f"stream={part.stream}":
                continue
            form = ds.ParquetFileFormat(read_options=ds.ParquetReadOptions(coerce_int96_timestamp_unit="us"))
            files = [f.path for f in store.get_file_info(fs.FileSelector(info.path)) if f.base_name.endswith(".parquet")]
            found = ds.dataset(files, filesystem=store, format=form)
            missing = [c for c in stored if c not in found.schema.names]
            inside = (pc.field("offset") >= part.lo) & (pc.field("offset") < part.hi)
            for rows in found.to_batches(columns=[c for c in stored if c not in missing], filter=inside):
                if not rows.num_rows:
                    continue
                placed = {"stream": part.stream, "batch_id": batch}
                columns = [pa.repeat(pa.scalar(placed.get(f.name), f.type), rows.num_rows) if f.name in _PLACED or f.name in missing else rows.column(f.name).cast(f.type, safe=False) for f in want]
                yield pa.RecordBatch.from_arrays(columns, schema=want)


class LogReader(DataSourceReader):
    """A bounded read: each split of ``split_records`` offsets is a task."""

    def __init__(self, options: Options, schema: StructType):
        self.options, self.schema = options, schema
        self.streams: set[str] | None = None
        self.lo, self.hi = 0, 2**63 - 1

    def partitions(self) -> Sequence[InputPartition]:
        log = Commits(self.options.path).refresh()
        out = []
        for stream, (first, tail) in sorted(self.options.members(log.bounds()).items()):
            lo, hi = max(first, self.lo, self.options.starts.get(stream, 0)), min(tail, self.hi)
            if lo < hi and (self.streams is None or stream in self.streams):
                out += [log.split(stream, a, b) for a, b in cut(lo, hi, self.options.split_records)]
        return out or [Split("", 0, 0, [])]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.options, self.schema, partition)


class FilteredLogReader(LogReader):
    """The same, for sessions that push filters: those on ``stream`` and ``offset`` choose splits before any file is opened, the others are left to Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = getattr(f, "attribute", None)
            if name == ("stream",) and isinstance(f, (EqualTo, In)):
                named = set(f.value if isinstance(f, In) else [f.value])
                self.streams = named if self.streams is None else self.streams & named
            elif name == ("offset",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.lo = max(self.lo, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.hi = min(self.hi, f.value + (not isinstance(f, LessThan)))
            else:
                yield f


class LogStreamReader(DataSourceStreamReader):
    """A stream over the log. A batch takes ``max_records`` at most, shared over the streams as ``limits.grants`` shares them, and waits for ``min_records`` up to ``max_delay``.

    Spark's checkpoint holds the position; after a restart it comes back with the first call. Streams that turn up later start at their first offset.
    """

    def __init__(self, options: Options, schema: StructType):
        self.options, self.schema, self.log = options, schema, Commits(options.path)
        self.at: dict[str, int] | None = None
        self.end: dict[str, tuple[int, int]] | None = None
        self.turn, self.since = 0, time.monotonic()

    def _bounds(self) -> dict[str, tuple[int, int]]:
        found = self.options.members(self.log.refresh().bounds())
        if self.options.frozen:
            self.end = self.end or found
            return self.end
        return found

    def initialOffset(self) -> dict:
        if self.at is None or not self.turn:
            self.at = self._first()
        return self.first

    def _first(self) -> dict[str, int]:
        bounds = self._bounds()
        self.first = {s: self.options.starts.get(s, tail if self.options.latest else first) for s, (first, tail) in bounds.items()}
        return dict(self.first)

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._first()
        bounds = self._bounds()
        for stream, (first, _) in bounds.items():
            self.at.setdefault(stream, self.options.starts.get(stream, first))
        names = sorted(s for s in bounds if bounds[s][1] > self.at[s])
        span = np.array([bounds[s][1] - self.at[s] for s in names], np.int64)
        limits, waited = self.options.limits, time.monotonic() - self.since
        if not names or (limits.min_records and span.sum() < limits.min_records and waited < seconds(limits.max_delay)):
            return dict(self.at)
        given = span if limits.max_records is None else grants(span, limits.max_records, self.turn)
        for s, n in zip(names, given.tolist(), strict=True):
            self.at[s] += n
        self.turn, self.since = self.turn + 1, time.monotonic()
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if self.at is None:  # the query was restarted: this is how far it got
            self.at, self.turn = dict(end), 1
        log, out = self.log.refresh(), []
        known = log.bounds()
        for stream, hi in sorted(end.items()):
            lo = start.get(stream, self.options.starts.get(stream, known.get(stream, (0, 0))[0]))
            if lo < hi:
                out += [log.split(stream, a, b) for a, b in cut(lo, hi, self.options.split_records)]
        return out

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        return _read(self.options, self.schema, partition)


class LogSource(DataSource):
    """The format ``streamlog``; the schema is given by the reader."""

    @classmethod
    def name(cls) -> str:
        return "streamlog"

    def reader(self, schema: StructType) -> LogReader:
        return (FilteredLogReader if self.options.get("pushed") else LogReader)(Options.of(self.options), schema)

    def streamReader(self, schema: StructType) -> LogStreamReader:
        return LogStreamReader(Options.of(self.options), schema)
