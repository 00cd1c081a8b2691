"""How far a query over ``follow_log`` has come, by Spark's own checkpoint: positions by batch, lag behind the log, progress tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.progress import lag_metrics, offsets_from_json
from ..operators.publish import recorded_bounds
from ..shared import exists

_PROGRESS = "stream string, last_processed long, query string, batch long"


def positions(spark: SparkSession, checkpoint: str, *, source: int = 0) -> DataFrame:
    """(query, batch, stream, next_offset, done) of each batch that the checkpoint holds: where the batch ends in each stream, and whether it has been committed.

    ``source`` counts the query's sources from 0. Only sources whose offsets are ``{stream: next offset}`` have positions: over ``stream_log``, which counts files, it is a ValueError.
    Spark keeps the last hundred batches (``spark.sql.streaming.minBatchesToRetain``). A checkpoint that no query has used yet gives no rows.
    """
    base = checkpoint.rstrip("/")
    if exists(spark, f"{base}/sources/{source}/0"):
        raise ValueError("the query reads files; its checkpoint holds no offsets of streams")
    if not exists(spark, f"{base}/metadata"):
        return spark.createDataFrame([], "query string, batch long, stream string, next_offset long, done boolean")
    query = spark.read.text(f"{base}/metadata", wholetext=True).select(F.get_json_object("value", "$.id")).first()[0]
    number = F.col("_metadata.file_name").cast("long")
    whole = lambda name: spark.read.text(f"{base}/{name}", wholetext=True) if exists(spark, f"{base}/{name}") else spark.createDataFrame([], "value string, _metadata struct<file_name: string>")
    lines = F.split(F.rtrim(F.col("value"), F.lit("\n")), "\n")
    ends = whole("offsets").select(number.alias("batch"), F.get(lines, F.lit(2 + source)).alias("offsets")).where("offsets is not null and offsets <> '-'")
    done = whole("commits").select(number.alias("batch")).distinct().withColumn("done", F.lit(True))
    each = offsets_from_json(ends.select("batch", "offsets"), keep=["batch"]).join(done, "batch", "left")
    return each.select(F.lit(query).alias("query"), "batch", "stream", "next_offset", F.coalesce("done", F.lit(False)).alias("done"))


def reached(spark: SparkSession, checkpoint: str, *, source: int = 0) -> DataFrame:
    """(stream, next_offset) after the last committed batch: what the query is through with."""
    done = positions(spark, checkpoint, source=source).where("done")
    last = done.agg(F.max("batch")).first()[0]
    return done.where(F.col("batch") == F.lit(last)).select("stream", "next_offset")


def starts_of(spark: SparkSession, checkpoint: str, *, source: int = 0) -> dict[str, int]:
    """``reached`` as the ``starts`` of another query, which then goes on where this one is; one entry a stream."""
    return {r["stream"]: r["next_offset"] for r in reached(spark, checkpoint, source=source).collect()}


def query_lag(spark: SparkSession, path: str, checkpoint: str, *, source: int = 0) -> DataFrame:
    """(stream, next_offset, tail, lag) of the query with this checkpoint over the log at ``path``; streams that it hasn't met are behind by all that is there."""
    bounds = recorded_bounds(spark, path)
    if bounds is None:
        raise ValueError(f"{path} has no commits")
    at = F.coalesce("next_offset", "first_offset")
    return bounds.join(reached(spark, checkpoint, source=source), "stream", "left").select("stream", at.alias("next_offset"), "tail", F.greatest(F.lit(0), F.col("tail") - at).alias("lag"))


def lag_summary(spark: SparkSession, path: str, checkpoint: str, *, source: int = 0) -> DataFrame:
    """``progress.lag_metrics`` of a query: one row."""
    lag = query_lag(spark, path, checkpoint, source=source)
    return lag_metrics(lag.select("stream", "tail"), lag.select("stream", "next_offset"))


def keep_progress(spark: SparkSession, checkpoint: str, table: str, *, source: int = 0) -> None:
    """Writes (stream, last_processed) of every committed batch to the Parquet table at ``table``, under the folder of its query and batch: a row where the stream moved in that batch.

    A batch's folder replaces itself, so batches are there once however often this runs and from wherever; batches that are there are not written again. Run it at least once in the
    hundred batches that Spark keeps. The table is a report: no start is read from it.
    """
    found = positions(spark, checkpoint, source=source).where("done")
    before = F.lag("next_offset").over(W.partitionBy("stream").orderBy("batch"))  # as many rows a stream as the checkpoint has batches
    moved = found.withColumn("before", before).where("next_offset > 1 and (before is null or before <> next_offset)")  # as record_progress has it
    known = progress_table(spark, table)
    fresh = moved if known is None else moved.join(known.select("query", "batch").distinct(), ["query", "batch"], "left_anti")
    out = fresh.select("stream", (F.col("next_offset") - 1).alias("last_processed"), "query", "batch").coalesce(1)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query", "batch").parquet(table)


def progress_table(spark: SparkSession, table: str) -> DataFrame | None:
    """(stream, last_processed, query, batch) as ``keep_progress`` wrote them; None where nothing is there."""
    return spark.read.schema(_PROGRESS).parquet(table) if exists(spark, table) else None
