"""Gaps, repeats, short ranges, and what a read's outcome is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Offsets of one window; gaps inside are found there, gaps between by the blocks' ends.
BLOCK = 100_000


def detect_gaps(log: DataFrame, *, start: str = "gap_start", end: str = "gap_end") -> DataFrame:
    """(stream, gap_start, gap_end) of offsets that are missing between two that are there; the end is exclusive.

    Windows run over blocks of offsets and over the blocks' first and last offsets, so a stream isn't one task.
    """
    cut = log.select("stream", "offset", F.floor(F.col("offset") / BLOCK).alias("block"))
    within = cut.select("stream", (F.lag("offset").over(W.partitionBy("stream", "block").orderBy("offset")) + 1).alias(start), F.col("offset").alias(end))
    ends = cut.groupBy("stream", "block").agg(F.min("offset").alias("low"), F.max("offset").alias("high"))
    between = ends.select("stream", (F.lag("high").over(W.partitionBy("stream").orderBy("block")) + 1).alias(start), F.col("low").alias(end))
    return within.union(between).where(f"{start} < {end}")


def check_integrity(log: DataFrame) -> DataFrame:
    """(stream, rows, distinct_offsets, span, whole): whole if offsets are unique and without a gap."""
    each = log.groupBy("stream", "offset").agg(F.count("*").alias("n")).groupBy("stream")
    out = each.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_offsets"), (F.max("offset") - F.min("offset") + 1).alias("span"))
    return out.withColumn("whole", (F.col("rows") == F.col("distinct_offsets")) & (F.col("rows") == F.col("span")))


def checked(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows of a bounded read, which fails by itself where offsets of its ranges are missing or there twice; ``ranges`` has one row a stream.

    Beside the rows runs a count of their offsets, from the stream and offset columns alone; it gives no rows, only the error. A filtered read skips offsets, so check before filtering.
    """
    seen = rows.groupBy("stream").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("offset").alias("_offsets"))
    wanted = F.greatest(F.col("end_offset") - F.col("start_offset"), F.lit(0))
    found = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    wrong = ranges.select("stream", "start_offset", "end_offset").join(seen, "stream", "left").where((F.coalesce("_n", F.lit(0)) != wanted) | (F.coalesce("_offsets", F.lit(0)) != wanted))
    told = F.concat(F.lit("data loss: stream "), F.col("stream"), F.lit(" has "), found("_offsets"), F.lit(" offsets in "), found("_n"), F.lit(" rows of ["), found("start_offset"), F.lit(", "), found("end_offset"), F.lit(")"))
    none = wrong.where(F.raise_error(told).isNull()).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields))
    return rows.unionAll(none)


def detect_short_ranges(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """(stream, end_offset, reached): ranges whose last offsets the log doesn't have."""
    seen = log.groupBy("stream").agg((F.max("offset") + 1).alias("tail"))
    reached = F.greatest("start_offset", F.least("end_offset", F.coalesce("tail", F.col("start_offset"))))
    return ranges.join(seen, "stream", "left").withColumn("reached", reached).where("reached < end_offset").select("stream", "end_offset", "reached")


def range_outcome(log: DataFrame, ranges: DataFrame, *, fail_on_data_loss: bool = True, filtered: bool = False) -> DataFrame:
    """(stream, outcome): ``complete`` at the end, ``data_loss`` (or complete, if tolerated) where offsets are proven gone, else ``timeout``.

    A filtered read may skip offsets, so gaps prove nothing there.
    """
    r = ranges.select(F.col("stream").alias("s"), "start_offset", "end_offset")
    inside = (F.col("stream") == F.col("s")) & (F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
    got = log.join(r, inside).groupBy("stream").agg(F.count("*").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high"))
    tails = log.groupBy("stream").agg((F.max("offset") + 1).alias("tail"), F.min("offset").alias("first"))
    facts = ranges.join(got, "stream", "left").join(tails, "stream", "left")
    lost = (F.col("first") > F.col("start_offset")) | (F.lit(not filtered) & (F.col("high") - F.greatest("start_offset", "first") + 1 > F.col("n")))
    ended = F.col("tail") >= F.col("end_offset")
    ladder = F.when(F.coalesce(lost, F.lit(False)), F.lit("data_loss" if fail_on_data_loss else "complete")).when(F.coalesce(ended, F.lit(False)), F.lit("complete")).otherwise(F.lit("timeout"))
    return facts.select("stream", ladder.alias("outcome"))
