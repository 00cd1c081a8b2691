"""Structured Streaming over logs: reading, appending, windows and state."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.publish import append_log
from ..operators.ranges import start_positions
from ..options import LimitOptions, RangeOptions
from ..shared import exists, is_local
from ..sources.datasource import LogSource
from ..sources.log import from_starts, indexed_bounds, open_log

#: Spark's settings for checkpoints on a local disk: written by Hadoop's ``FileSystem``, and a file source's old records, beyond the last 100 batches, deleted after seconds instead of ten minutes.
_LOCAL = {
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "spark.sql.streaming.fileSource.log.cleanupDelay": "10s",
}
_ENDS = ("end", "end_offset", "end_ts", "end_ts_by_stream")


def stream_log(
    spark: SparkSession, path: str, schema: T.StructType, *, checkpoint: str | None = None, start: str = "earliest", start_offset: int | None = None, start_ts: int | None = None,
    start_ts_by_stream: dict[str, int] | None = None, on_no_match: str = "error", fail_on_data_loss: bool = True, max_files: int | None = None, max_bytes: int | None = None,
    max_records: int | None = None, file_records: int | None = None, **unknown,
) -> DataFrame:
    """The log at ``path`` as a stream; progress is Spark's checkpoint.

    ``start`` and what goes with it are those of a bounded read (``RangeOptions``), for a query that has no ``checkpoint`` yet: they are resolved once and
    kept beside its checkpoint, so a restart goes on where it was, whatever start is given. Streams that turn up later are read from their beginning.

    Budgets of a batch count files or bytes; ``max_records`` is exact from above where files hold ``file_records`` rows at most, as ``append_log`` writes them.
    A stream has no end, so end options are refused. Draining what is there now is ``trigger(availableNow=True)`` on the writer: later files stay out.
    """
    if refused := [k for k in unknown if k in _ENDS]:
        raise ValueError(f"a stream takes no end options: {refused}")
    if unknown:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    wanted = RangeOptions(start=start, start_offset=start_offset, start_ts=start_ts, start_ts_by_stream=start_ts_by_stream or {}, on_no_match=on_no_match, fail_on_data_loss=fail_on_data_loss)
    limits = LimitOptions(max_records=max_records, max_bytes=max_bytes)
    if limits.max_records:
        if not file_records or file_records > limits.max_records:
            raise ValueError("max_records needs file_records, the most rows of a file, and no more than it")
        most = limits.max_records // file_records
        max_files = most if max_files is None else min(most, max_files)
    if start != "earliest" and checkpoint is None:
        raise ValueError("a start position needs the checkpoint that it is kept beside")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if limits.max_bytes:
        reader = reader.option("maxBytesPerTrigger", limits.max_bytes)
    rows = reader.parquet(path)
    starts = _kept_starts(spark, path, checkpoint, wanted) if checkpoint is not None else None
    return rows if starts is None else from_starts(rows, starts)


def _source(reader, spark: SparkSession, path: str, schema: T.StructType | None, streams: Sequence[str] | None, superstream: str | None, topology: str | None, **options):
    spark.dataSource.register(LogSource)
    schema = open_log(spark, path).schema if schema is None else schema
    given = {"path": path, "superstream": superstream, "topology": topology, "streams": None if streams is None else json.dumps(list(streams)), **options}
    return reader.format("streamlog").schema(schema).options(**{k: v for k, v in given.items() if v is not None}).load()


def split_log(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None, streams: Sequence[str] | None = None, superstream: str | None = None, topology: str | None = None, split_records: int | None = None
) -> DataFrame:
    """A bounded read of a committed log in which every split of ``split_records`` offsets is a task; conditions on ``stream`` and ``offset`` choose splits where the session has
    ``spark.sql.python.filterPushdown.enabled``. The splits are those of the commits at planning."""
    pushed = "yes" if spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true" else None
    return _source(spark.read, spark, path, schema, streams, superstream, topology, split_records=split_records, pushed=pushed)


def follow_log(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None, streams: Sequence[str] | None = None, superstream: str | None = None, topology: str | None = None,
    starts: dict[str, int] | None = None, latest: bool = False, max_records: int | None = None, min_records: int | None = None, max_delay: str = "15m", split_records: int | None = None, until_now: bool = False,
) -> DataFrame:
    """The committed rows of a log as a stream with exact budgets: a batch has ``max_records`` at most over all its streams, and waits for ``min_records`` until ``max_delay`` has passed.

    A superstream's members are read from ``topology``, a Parquet folder of (superstream, stream), at every trigger; streams that turn up later start at their first offset.
    ``starts`` are first offsets by stream (else the first there is, the tail with ``latest``) and count for a query without a checkpoint. With ``until_now`` later commits stay out, so that
    ``drain`` ends. Budgets need a processing-time trigger: a source of this kind gives one batch to ``availableNow``.
    """
    limits = LimitOptions(max_records=max_records, min_records=min_records, max_delay=max_delay)
    return _source(
        spark.readStream, spark, path, schema, streams, superstream, topology, starts=json.dumps(starts) if starts else None, start="latest" if latest else None, max_records=limits.max_records,
        min_records=limits.min_records, max_delay=max_delay, split_records=split_records, until="now" if until_now else None,
    )


def drain(writer: DataStreamWriter) -> None:
    """Runs a query over ``follow_log(until_now=True)``, batch after batch, until it has all that was there, and stops it."""
    running = writer.trigger(processingTime="0 seconds").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()


@contextmanager
def local_checkpoints(spark: SparkSession, checkpoint: str) -> Iterator[None]:
    """For many small batches: settings of the session for queries that start and run in here, where their checkpoint is on a local disk.

    Spark's own choice there, ``FileContext``, starts ten processes a file for rights and links, and a batch has three files; both it and ``FileSystem`` write a file beside its place and rename it. And a
    file source lists its records at every batch; they are kept long for stores that show files late, which a local disk doesn't. What the session sets itself stays, as do queries on other stores.
    """
    given = {k: v for k, v in _LOCAL.items() if spark.conf.get(k, None) is None} if is_local(spark, checkpoint) else {}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in given:
            spark.conf.unset(k)


def _kept_starts(spark: SparkSession, path: str, checkpoint: str, wanted: RangeOptions) -> DataFrame | None:
    """Where a query started: what it resolved when it was new. A checkpoint without it started at the beginning."""
    kept = f"{checkpoint.rstrip('/')}/start_positions"
    if not exists(spark, kept):
        if wanted.start == "earliest" or exists(spark, f"{checkpoint.rstrip('/')}/offsets") or not exists(spark, path):
            return None
        start_positions(open_log(spark, path), wanted, indexed_bounds(spark, path, wanted)).coalesce(1).write.parquet(kept)
    return spark.read.schema("stream string, start_offset long").parquet(kept)


def windowed_counts(rows: DataFrame, *, width: str, late: str, ts: str = "chunk_timestamp") -> DataFrame:
    """Rows in tumbling windows of event time; a window is final once the watermark has passed it."""
    return rows.withWatermark(ts, late).groupBy(F.window(ts, width)).agg(F.count("*").alias("n"))


def stateful_counts(rows: DataFrame, key: Column) -> DataFrame:
    """Running counts by key, for ``update`` mode: each change is a row."""
    return rows.groupBy(key.alias("key")).agg(F.count("*").alias("n"))


def _highest():
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The rows of one (producer, stream) whose ids are above all before; the state is the highest id."""
        reached = state.get[0] if state.exists else -1
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["publishing_id"], kind="stable")
        rows = rows[rows.publishing_id > reached].drop_duplicates("publishing_id")
        if len(rows):
            state.update((int(rows.publishing_id.max()),))
        yield rows

    return run


def dedup_stream(rows: DataFrame, *, producer: str = "producer") -> DataFrame:
    """Rows of a stream whose ``publishing_id`` is above every id of their (producer, stream) in the batches before, each id once; a negative or null id is none and fails the job.

    The state is one number a (producer, stream), kept with the query's checkpoint, so repeats are found over batches and restarts. A producer's stream is one task a batch, of as
    many rows as the batch's budget lets in. For a batch read, or repeats against what is stored with a log, there is ``publish.dedup_publish``.
    """
    wrong = F.col("publishing_id").isNull() | (F.col("publishing_id") < 0)
    checked = rows.withColumn("publishing_id", F.when(wrong, F.raise_error(F.lit("a publishing id must be set and not negative")).cast("long")).otherwise(F.col("publishing_id")))
    return checked.groupBy(producer, "stream").applyInPandasWithState(_highest(), checked.schema, "max_id long", "append", GroupStateTimeout.NoTimeout)


def stream_append(
    rows: DataFrame, path: str, checkpoint: str, *, order: Sequence[str], bucket: Callable[[], Column], mode: str = "append", available_now: bool = False, sink: Callable = append_log, **options
) -> DataStreamWriter:
    """A writer that appends every micro-batch to a log; with ``update`` every changed row becomes a message.

    The query's id and the batch's number are where it lands, so a batch that is run again replaces itself, and queries that write to one log don't
    touch each other's. ``sink`` is ``append_log`` or ``publish_rows``, which takes rows of the sink schema; ``options`` go to it. Trigger: the default one, with the lowest latency,
    or what is there now.
    """

    def put(df: DataFrame, n: int) -> None:
        query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the streaming query has no id")
        sink(df, path, order=order, bucket=bucket(), batch_id=n, writer=query, **options)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put)
    return writer.trigger(availableNow=True) if available_now else writer
