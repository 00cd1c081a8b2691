"""Which offsets a read covers: small range frames (stream, start_offset, end_offset) from one aggregate over the log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import RangeOptions
from ..shared import settle

#: Up to so many ranges become one predicate.
LITERAL_RANGES = 200
#: Offsets of a block, by which rows meet the ranges of their stream.
BLOCK = 50_000


class DataLossError(RuntimeError):
    """Asked-for offsets are gone, or a stream is."""


class NoMatchError(RuntimeError):
    """No message at or after a start timestamp."""


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def _by_stream(default: int | None, by: dict[str, int]) -> Column:
    """The stream's own bound, else the global one."""
    out = F.lit(default).cast("long")
    for stream, ts in by.items():
        out = F.when(F.col("stream") == stream, F.lit(ts).cast("long")).otherwise(out)
    return out


def stream_bounds(log: DataFrame) -> DataFrame:
    """(stream, first_offset, tail): the first offset there is and one past the last. Only these two columns are read."""
    return log.groupBy("stream").agg(F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("tail"))


def resolve_ranges(log: DataFrame, options: RangeOptions | None = None, *, streams: DataFrame | None = None, bounds: DataFrame | None = None, **given) -> DataFrame:
    """(stream, start_offset, end_offset) of a bounded read, by ``RangeOptions``; ends are exclusive.

    A start timestamp counts by chunk time, an end timestamp by creation time where it is set: the end is the first offset at or after it, the tail if there is
    none. An end offset stays as it was asked for, also beyond the tail, so that ``detect_short_ranges`` can tell what a read missed. A start below what is there
    fails, or moves up without ``fail_on_data_loss``. Empty ranges are left out. ``streams`` names streams that must exist; a missing one fails, or is skipped without
    ``fail_on_data_loss``. The log is read once, here, or not at all where ``bounds`` are given, as ``recorded_bounds`` has them, or ``indexed_bounds`` for timestamps:
    later appends don't move the ranges, and the checks look at one row a stream.
    """
    resolved = _resolve(log, options or RangeOptions(**given), streams, bounds)
    return resolved.where("start_offset < end_offset").select("stream", "start_offset", "end_offset")


def time_bounds(options: RangeOptions) -> tuple[Column | None, Column | None]:
    """Each stream's start and end timestamp in micros, as columns of a frame with ``stream``; None where none is asked for."""
    start = _by_stream(options.start_ts, options.start_ts_by_stream) if options.start == "timestamp" else None
    return start, _by_stream(options.end_ts, options.end_ts_by_stream) if options.end == "timestamp" else None


def start_positions(log: DataFrame, options: RangeOptions, bounds: DataFrame | None = None) -> DataFrame:
    """(stream, start_offset) of every stream that there is, the tail where nothing is left to read."""
    return _resolve(log, options, None, bounds).select("stream", "start_offset")


def _resolve(log: DataFrame, o: RangeOptions, streams: DataFrame | None, bounds: DataFrame | None) -> DataFrame:
    start_ts, end_ts = _by_stream(o.start_ts, o.start_ts_by_stream), _by_stream(o.end_ts, o.end_ts_by_stream)
    at_or_after = lambda ts, bound: F.min(F.when(_micros(ts) >= bound, F.col("offset")))
    extra = []
    if o.start == "timestamp":
        extra.append(at_or_after(F.col("chunk_timestamp"), start_ts).alias("anchor"))
    if o.end == "timestamp":
        extra.append(at_or_after(F.coalesce("creation_time", "chunk_timestamp"), end_ts).alias("bound"))
    known = set(bounds.columns) if bounds is not None else set()
    if bounds is None or (o.start == "timestamp" and "anchor" not in known) or (o.end == "timestamp" and "bound" not in known):
        bounds = log.groupBy("stream").agg(F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("tail"), *extra)
    b = settle(bounds, "bounds")  # the snapshot that the whole read goes by
    if o.start == "timestamp":
        b = b.withColumn("anchor", F.when(start_ts.isNull(), F.col("first_offset")).otherwise(F.col("anchor")))
    start = {"earliest": F.col("first_offset"), "latest": F.col("tail"), "offset": F.lit(o.start_offset).cast("long"), "timestamp": F.coalesce("anchor", "tail") if o.start == "timestamp" else None}[o.start]
    end = {"latest": F.col("tail"), "offset": F.lit(o.end_offset).cast("long"), "timestamp": F.coalesce("bound", "tail") if o.end == "timestamp" else None}[o.end]
    ranges = b.withColumn("start_offset", start).withColumn("end_offset", end)
    if o.start == "timestamp" and o.on_no_match == "error":
        missing = ranges.where("anchor is null").select("stream").take(1)
        if missing:
            raise NoMatchError(f"stream {missing[0][0]!r} has no message at or after the start timestamp")
    if streams is not None and o.fail_on_data_loss:
        gone = streams.join(ranges, "stream", "left_anti").take(1)
        if gone:
            raise DataLossError(f"stream {gone[0]['stream']!r} has no messages")
    if streams is not None:
        ranges = ranges.join(streams.select("stream").distinct(), "stream", "left_semi")
    if o.start == "offset":
        if o.fail_on_data_loss:
            lost = ranges.where("start_offset < first_offset").take(1)
            if lost:
                raise DataLossError(f"stream {lost[0]['stream']!r} starts at {lost[0]['first_offset']}, after {o.start_offset}")
        ranges = ranges.withColumn("start_offset", F.greatest("start_offset", "first_offset"))
    return ranges


def within_ranges(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows inside their stream's range; ``ranges`` has one row a stream. Few ranges become one predicate, which prunes partitions and row groups; more are joined."""
    few = ranges.limit(LITERAL_RANGES + 1).collect()
    if len(few) <= LITERAL_RANGES:
        if not few:
            return log.where(F.lit(False))
        each = [(F.col("stream") == r["stream"]) & (F.col("offset") >= r["start_offset"]) & (F.col("offset") < r["end_offset"]) for r in few]
        return log.where(reduce(Column.__or__, each))
    r = ranges.select(F.col("stream").alias("s"), "start_offset", "end_offset")
    inside = (F.col("stream") == F.col("s")) & (F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
    return log.join(r, inside, "left_semi")


def locate(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each row of the log with every range of its stream that holds it; a stream may have any number of ranges.

    The join goes by (stream, block of BLOCK offsets), so a row meets the ranges of its block only and a stream is many tasks.
    """
    block = lambda c: F.floor(c / F.lit(BLOCK))
    r = ranges.where("start_offset < end_offset").withColumnsRenamed({"stream": "_s", "start_offset": "_from", "end_offset": "_to"})
    r = r.withColumn("_block", F.explode(F.sequence(block(F.col("_from")), block(F.col("_to") - 1))))
    inside = (F.col("stream") == F.col("_s")) & (block(F.col("offset")) == F.col("_block")) & (F.col("offset") >= F.col("_from")) & (F.col("offset") < F.col("_to"))
    return log.join(r, inside).drop("_s", "_block", "_to").withColumnRenamed("_from", "range_start")


def fill_missing_starts(starts: DataFrame, tails: DataFrame, *, initial: DataFrame | None = None, checkpoint: DataFrame | None = None, configured: DataFrame | None = None, superstream: bool = True) -> DataFrame:
    """(stream, start_offset) for every stream of ``tails``: its start, else its initial offset, its checkpoint, and then - only in a superstream, whose
    partitions may turn up later - its first available offset or the configured start. A single stream without any is left out.

    ``starts``, ``initial``, ``checkpoint`` and ``configured`` are (stream, offset) frames; ``tails`` is ``stream_bounds`` output.
    """
    out = tails
    names = []
    for name, frame in (("s", starts), ("i", initial), ("c", checkpoint), ("d", configured)):
        if frame is not None:
            out = out.join(frame.select("stream", F.col("offset").alias(name)), "stream", "left")
            names.append(name)
    known = [F.col(n) for n in names if n != "d"]
    if superstream:
        known += [F.col("first_offset")] + ([F.col("d")] if "d" in names else [])
    return out.select("stream", F.coalesce(*known).alias("start_offset")).where("start_offset is not null")


def detect_truncation(ranges: DataFrame, bounds: DataFrame) -> DataFrame:
    """(stream, start_offset, first_offset, lost): ranges that start below what retention has left."""
    return ranges.join(bounds, "stream").where("start_offset < first_offset").select("stream", "start_offset", "first_offset", (F.col("first_offset") - F.col("start_offset")).alias("lost"))


def detect_regression(starts: DataFrame, bounds: DataFrame, *, fail_on_data_loss: bool = False) -> DataFrame:
    """(stream, start_offset, tail, clamped): streams whose tail fell below the start, as when one was made anew. Clamped reads go on at the tail."""
    back = starts.join(bounds, "stream").where("tail < start_offset").select("stream", "start_offset", "tail", F.col("tail").alias("clamped"))
    if fail_on_data_loss and (lost := back.take(1)):
        raise DataLossError(f"stream {lost[0]['stream']!r} ends at {lost[0]['tail']}, before {lost[0]['start_offset']}")
    return back
