"""Reading a log: by resolved ranges, by superstream, from files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import recorded_bounds
from ..operators.integrity import checked
from ..operators.ranges import LITERAL_RANGES, DataLossError, resolve_ranges, time_bounds, within_ranges
from ..options import RangeOptions, one_target
from ..schema import project_metadata
from ..shared import settle
from .commits import boundary_offsets, committed_rows, ranges_of, snapshot

def open_log(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of the log that ``append_log`` writes: partitioned by batch and stream, sorted by offset inside files. Stream and batch names are texts, whatever they look like."""
    return committed_rows(spark, path)


def indexed_bounds(spark: SparkSession, path: str, options: RangeOptions) -> DataFrame | None:
    """What ``resolve_ranges`` needs to know of the log at ``path``, without reading it: bounds by its commits, and for timestamps the offsets that its time index leads to. None where it has
    no commits, or no index for a timestamp."""
    start, end = time_bounds(options)
    return recorded_bounds(spark, path) if start is None and end is None else boundary_offsets(spark, path, start_ts=start, end_ts=end)


def read_log(log: DataFrame, ranges: DataFrame, *, start_ts: int | None = None) -> DataFrame:
    """The rows of a bounded read: each stream's ``[start_offset, end_offset)``, fixed before the scan is built.

    ``ranges`` has one row a stream. A read that starts by timestamp gives ``start_ts`` (micros): rows of an earlier chunk are dropped.
    """
    if start_ts is not None:
        log = log.where(F.unix_micros("chunk_timestamp") >= start_ts)
    return within_ranges(log, ranges)


def from_starts(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows at or after their stream's start; streams without one are whole. ``starts`` is (stream, start_offset), one row a stream."""
    few = starts.limit(LITERAL_RANGES + 1).collect()
    if len(few) <= LITERAL_RANGES:
        before = [(F.col("stream") == r["stream"]) & (F.col("offset") < r["start_offset"]) for r in few]
        return log.where(~reduce(Column.__or__, before)) if before else log
    s = starts.select(F.col("stream").alias("s"), "start_offset")
    return log.join(s, F.col("stream") == F.col("s"), "left").where("start_offset is null or offset >= start_offset").drop("s", "start_offset")


def read_superstream(log: DataFrame, topology: DataFrame, superstream: str, *, fail_if_empty: bool = True) -> DataFrame:
    """The rows of all partition streams of a superstream; each keeps its stream. The topology is read when the query is built."""
    members = topology.where(F.col("superstream") == superstream).select("stream")
    if fail_if_empty and not members.take(1):
        raise ValueError(f"superstream {superstream!r} has no partitions")
    return log.join(members.distinct(), "stream", "left_semi")


def _covered(spark: SparkSession, path: str, ranges: DataFrame) -> None:
    """Fails where the commits don't hold every offset of the ranges; one row a (batch, stream) is read."""
    held = ranges_of(snapshot(spark, path)[1]).select("stream", F.col("start_offset").alias("lo"), (F.col("start_offset") + F.col("n")).alias("hi"))
    inside = F.greatest(F.lit(0), F.least("hi", "end_offset") - F.greatest("lo", "start_offset"))
    short = ranges.join(held, "stream", "left").groupBy("stream", "start_offset", "end_offset").agg(F.coalesce(F.sum(inside), F.lit(0)).alias("held")).where("held < end_offset - start_offset").take(1)
    if short:
        r = short[0]
        raise DataLossError(f"stream {r['stream']!r}: commits hold {r['held']} of the offsets [{r['start_offset']}, {r['end_offset']})")


def read(spark: SparkSession, path: str, *, stream: str | None = None, superstream: str | None = None, topology: DataFrame | None = None, metadata: Sequence[str] | None = None, check_rows: bool = False, **options) -> DataFrame:
    """A bounded read of one stream or one superstream of the log at ``path``, in one call; ``options`` are those of ``RangeOptions``.

    ``metadata`` names the optional columns to return; all columns without it. The bounds are those of the log's commits, timestamps are found by its time index. Where the commits
    don't cover the ranges (an end beyond the tail, a batch that is gone) the read fails, or gives what there is without ``fail_on_data_loss``. With ``check_rows`` it also counts the offsets
    that it reads, and fails while running where files have lost or repeated some (``integrity.checked``).
    """
    one_target(stream, superstream)
    if superstream is not None and topology is None:
        raise ValueError("a superstream needs its topology")
    log = open_log(spark, path)
    rows = log.where(F.col("stream") == stream) if superstream is None else read_superstream(log, topology, superstream)
    wanted = spark.createDataFrame([(stream,)], "stream string") if superstream is None else topology.where(F.col("superstream") == superstream).select("stream")
    bounds = indexed_bounds(spark, path, RangeOptions(**options))
    if bounds is not None:
        bounds = bounds.join(wanted.distinct(), "stream", "left_semi")
    wanted_ranges = settle(resolve_ranges(rows, streams=wanted, bounds=bounds, **options), "read-ranges")
    strict = options.get("fail_on_data_loss", True)
    if bounds is not None and strict:
        _covered(spark, path, wanted_ranges)
    found = within_ranges(rows, wanted_ranges)
    found = checked(found, wanted_ranges) if check_rows and strict else found
    if options.get("start_ts") is not None and not options.get("start_ts_by_stream"):
        found = found.where(F.unix_micros("chunk_timestamp") >= options["start_ts"])
    return found if metadata is None else project_metadata(found, metadata)
