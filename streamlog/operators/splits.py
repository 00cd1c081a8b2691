"""Cutting ranges into splits, reading by split, and merging what was committed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranges import locate


def split_ranges(ranges: DataFrame, *, max_records: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """(stream, split_id, start_offset, end_offset): one split a range, more by ``max_records`` in a split or ``min_partitions`` in all.

    Extra splits go evenly over the streams, by name, the remainder to the first ones. A range of n records cut into k takes n/k each, the first n mod k
    one more; no split is empty and a range of one record is never cut. Windows run over the range frame, one row a stream.
    """
    span = F.col("end_offset") - F.col("start_offset")
    floor = F.greatest(F.lit(1), F.ceil(span / max_records)) if max_records else F.lit(1)
    every, order = W.partitionBy(F.lit(1)), W.orderBy("stream")
    r = ranges.where("start_offset < end_offset").withColumn("span", span).withColumn("n", floor.cast("long"))
    if min_partitions:
        r = r.withColumn("extra", F.greatest(F.lit(0), min_partitions - F.sum("n").over(every))).withColumn("streams", F.count("*").over(every)).withColumn("at", F.row_number().over(order) - 1)
        r = r.withColumn("n", F.col("n") + F.floor(F.col("extra") / F.col("streams")) + (F.col("at") < F.col("extra") % F.col("streams")).cast("long"))
    q, rest, i = F.floor(F.col("span") / F.col("n")), F.col("span") % F.col("n"), F.col("i")
    cut = r.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", "span") - 1)).alias("i"))
    start = F.col("start_offset") + i * q + F.least(i, rest)
    return cut.select("stream", i.cast("int").alias("split_id"), start.alias("start_offset"), (start + q + (i < rest).cast("long")).alias("end_offset"))


def read_splits(log: DataFrame, splits: DataFrame) -> DataFrame:
    """The log's rows with the split that covers each."""
    return locate(log, splits.select("stream", "split_id", "start_offset", "end_offset")).drop("range_start")


def merge_splits(splits: DataFrame, bases: DataFrame) -> DataFrame:
    """(stream, next_offset): how far each stream is committed without a hole, from its base on.

    ``splits`` is (stream, start_offset, end_offset, committed) - reports of a split may repeat, the furthest counts - and ``bases`` (stream, base).
    """
    best = splits.groupBy("stream", "start_offset", "end_offset").agg(F.max("committed").alias("committed"))
    order = W.partitionBy("stream").orderBy("start_offset")
    joined = bases.join(best, "stream", "left")
    previous = F.coalesce(F.lag("end_offset").over(order), F.col("base"))
    fits = (F.col("start_offset") == previous) & (F.col("committed") >= F.col("end_offset"))
    flagged = joined.withColumn("fits", F.coalesce(fits, F.lit(False)))
    prefix = flagged.withColumn("whole", F.min(F.col("fits").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    # a split that was only begun counts up to where it got, if all before it is whole
    begun = (F.col("start_offset") == previous) & (F.col("committed") > F.col("start_offset"))
    before = F.coalesce(F.min(F.col("fits").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(1))
    reached = F.when(F.col("whole") == 1, F.col("end_offset")).when((before == 1) & begun, F.least("committed", "end_offset"))
    return prefix.withColumn("reached", reached).groupBy("stream").agg(F.coalesce(F.max("reached"), F.first("base")).alias("next_offset"))
