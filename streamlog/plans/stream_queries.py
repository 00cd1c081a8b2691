"""Queries that write a log and read it back: batch appends, and streams drained to the end of what is there."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming
from ..operators import compact, filters, progress, publish, ranges, route
from ..options import RangeOptions, micros
from ..shared import shared_dir
from ..sources.fixture import as_messages, bindings, events_log, topology, utc
from ..sources.commits import checkpoint_commits
from ..sources.log import indexed_bounds, open_log, read, read_log
from ..streaming import positions
from .registry import query

ORDER = ["ts", "event_id"]


def _fresh(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


def _rows(s: SparkSession, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", "event_type", utc(F.col("ts")).alias("ts"), F.concat(F.lit("events-"), (F.col("user_id") % 3).cast("string")).alias("stream"), F.concat_ws("-", "event_type", "event_id").alias("body"))


def _bucket():
    return F.date_trunc("day", "ts")


def _files(s: SparkSession, d: str) -> str:
    """The rows as a few files, as writers of small files leave them."""
    path = _fresh(s, "arrivals")
    _rows(s, d).repartition(4, "event_id").write.parquet(path)
    return path


@query('SELECT stream, "offset", body FROM l')
def append_log_rows(s: SparkSession, d: str) -> DataFrame:
    path, rows, cut = _fresh(s, "log"), _rows(s, d), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    early = F.col("ts") < utc(cut)
    for n, part in enumerate((rows.where(early), rows.where(~early), rows.where(~early))):  # the last is a retry
        publish.append_log(part, path, order=ORDER, bucket=_bucket(), batch_id=min(n, 1), compression="zstd")
    return open_log(s, path).select("stream", "offset", "body")


@query('SELECT stream, count(*) AS n, min("offset") AS lo, max("offset") AS hi FROM l WHERE "offset" >= 10 GROUP BY stream')
def read_written_log(s: SparkSession, d: str) -> DataFrame:
    path = _fresh(s, "log")
    publish.append_log(_rows(s, d), path, order=ORDER, bucket=_bucket())
    log = open_log(s, path)
    rows = read_log(log, ranges.resolve_ranges(log, start="offset", start_offset=10, bounds=publish.recorded_bounds(s, path)))
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))


@query("SELECT stream, count(*) AS n, count(*) AS tail, true AS whole FROM l GROUP BY stream")
def stream_append(s: SparkSession, d: str) -> DataFrame:
    source, path = _files(s, d), _fresh(s, "log")
    rows = streaming.stream_log(s, source, _rows(s, d).schema, max_files=1)
    running = streaming.stream_append(rows, path, _fresh(s, "checkpoint"), order=ORDER, bucket=_bucket, available_now=True).start()
    running.awaitTermination()
    counted = open_log(s, path).groupBy("stream").agg(F.count("*").alias("n"), (F.max("offset") + 1).alias("tail"), F.count_distinct("offset").alias("offsets"))
    return counted.select("stream", "n", "tail", ((F.col("n") == F.col("tail")) & (F.col("n") == F.col("offsets"))).alias("whole"))


@query("SELECT event_type AS key, count(*) AS n FROM events GROUP BY event_type")
def stateful_updates(s: SparkSession, d: str) -> DataFrame:
    """Running counts in update mode, each change written back as a message; the last of each key stands."""
    source, path = _files(s, d), _fresh(s, "log")
    counts = streaming.stateful_counts(streaming.stream_log(s, source, _rows(s, d).schema, max_files=1), F.col("event_type")).withColumn("stream", F.lit("counts"))
    streaming.stream_append(counts, path, _fresh(s, "checkpoint"), order=["key"], bucket=lambda: F.lit(0), mode="update", available_now=True).start().awaitTermination()
    return open_log(s, path).groupBy("key").agg(F.max("n").alias("n"))


@query("SELECT stream, tail AS next_offset FROM b")
def stream_progress(s: SparkSession, d: str) -> DataFrame:
    """Next offsets after a drained stream, merged over its batches."""
    source, path = _files(s, d), _fresh(s, "log")
    rows = streaming.stream_log(s, source, _rows(s, d).schema, max_files=2)
    streaming.stream_append(rows, path, _fresh(s, "checkpoint"), order=ORDER, bucket=_bucket, available_now=True).start().awaitTermination()
    reports = open_log(s, path).groupBy("stream", "batch_id").agg((F.max("offset") + 1).alias("next_offset"))
    return progress.merge_progress(reports)


def _sink_rows(s: SparkSession, d: str) -> DataFrame:
    """Rows of the sink schema; their ids rise by producer, here one a file of arrivals."""
    time = utc(F.col("ts"))
    return s.read.parquet(f"{d}/events.parquet").select(
        F.encode(F.concat_ws("-", "event_type", "event_id"), "UTF-8").alias("value"), F.col("event_id").cast("long").alias("publishing_id"), F.col("event_type").alias("routing_key"),
        F.create_map(F.lit("id"), F.col("event_id").cast("string")).alias("application_properties"), time.alias("creation_time"),
    )


def _message_order() -> dict:
    return {"order": ["properties.creation_time", "publishing_id"], "bucket": F.date_trunc("day", F.col("properties.creation_time")), "chunk_timestamp": F.col("properties.creation_time")}


_BOUND = "VALUES ('click', 'events-0'), ('purchase', 'events-1'), ('signup', 'events-2'), ('error', 'events-0'), ('error', 'events-1')"


@query(f"""k AS (SELECT * FROM ({_BOUND}) t(key, target)), m AS (SELECT event_id, event_type, target AS stream, ts FROM events JOIN k ON event_type = key)
SELECT event_id, stream, row_number() OVER (PARTITION BY stream ORDER BY ts, event_id) - 1 AS "offset", event_type AS routing_key FROM m""")
def publish_rows(s: SparkSession, d: str) -> DataFrame:
    """The whole sink, by binding keys. The rows are published twice: the second time adds nothing, by the ids stored with the log."""
    path, rows = _fresh(s, "log"), _sink_rows(s, d)
    for _ in range(2):
        publish.publish_rows(rows, path, route=lambda m: route.route_key(m, bindings(s), key=F.col("application_properties")["routing_key"]), producer="p", **_message_order())
    ap = F.col("application_properties")
    return open_log(s, path).select(ap["id"].cast("long").alias("event_id"), "stream", "offset", ap["routing_key"].alias("routing_key"))


@query("SELECT 'events-' || (user_id % 3)::VARCHAR AS stream, 2 * count(*) AS n, 2 * count(*) AS tail, 2 AS writers, true AS whole FROM events GROUP BY 1")
def two_stream_writers(s: SparkSession, d: str) -> DataFrame:
    """Two queries append the same arrivals to one log; the first runs again from its checkpoint, and finds nothing new."""
    source, path, checkpoints = _files(s, d), _fresh(s, "log"), [_fresh(s, "checkpoint") for _ in range(2)]
    for checkpoint in (*checkpoints, checkpoints[0]):
        rows = streaming.stream_log(s, source, _rows(s, d).schema, max_files=2)
        streaming.stream_append(rows, path, checkpoint, order=ORDER, bucket=_bucket, available_now=True).start().awaitTermination()
    writer = F.regexp_extract("batch_id", "^q(.*)-b[0-9]+$", 1)
    out = open_log(s, path).groupBy("stream").agg(F.count("*").alias("n"), (F.max("offset") + 1).alias("tail"), F.count_distinct(writer).alias("writers"), F.count_distinct("offset").alias("offsets"))
    return out.select("stream", "n", "tail", "writers", ((F.col("n") == F.col("tail")) & (F.col("n") == F.col("offsets"))).alias("whole"))


@query("""SELECT stream, count(*) AS n, min("offset") AS lo FROM l WHERE "offset" >= 100 GROUP BY stream""")
def stream_from_offset(s: SparkSession, d: str) -> DataFrame:
    """A stream that starts at offset 100 of a log, drained in batches of a few thousand records."""
    path, out, checkpoint = _fresh(s, "log"), _fresh(s, "log"), _fresh(s, "checkpoint")
    publish.append_log(_rows(s, d), path, order=ORDER, bucket=_bucket(), batch_id=0, file_records=2000)
    rows = streaming.stream_log(s, path, open_log(s, path).schema, checkpoint=checkpoint, start="offset", start_offset=100, max_records=4000, file_records=2000)
    moved = rows.select(F.col("stream").alias("source"), F.col("offset").alias("source_offset"), F.lit("copy").alias("stream"))
    with streaming.local_checkpoints(s, checkpoint):
        streaming.stream_append(moved, out, checkpoint, order=["source", "source_offset"], bucket=lambda: F.col("source"), available_now=True).start().awaitTermination()
    return open_log(s, out).groupBy(F.col("source").alias("stream")).agg(F.count("*").alias("n"), F.min("source_offset").alias("lo"))


@query("SELECT stream, tail AS next_offset, first_offset FROM b")
def recorded_bounds(s: SparkSession, d: str) -> DataFrame:
    """Bounds as appends record them, of a log in three batches of which one was written again."""
    path, rows = _fresh(s, "log"), _rows(s, d)
    cuts = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-10 00:00:00", "2024-01-20 00:00:00")]
    parts = [rows.where(F.col("ts") < utc(cuts[0])), rows.where((F.col("ts") >= utc(cuts[0])) & (F.col("ts") < utc(cuts[1]))), rows.where(F.col("ts") >= utc(cuts[1]))]
    for n in (0, 1, 2, 1):
        publish.append_log(parts[n], path, order=ORDER, bucket=_bucket(), batch_id=n)
    found, seen = publish.recorded_bounds(s, path), ranges.stream_bounds(open_log(s, path))
    return found.join(seen, ["stream", "first_offset", "tail"]).select("stream", F.col("tail").alias("next_offset"), "first_offset")


@query("""SELECT stream, "offset", body FROM l WHERE stream IN ('events-0', 'events-2') AND "offset" >= 5""")
def read_superstream_of_file(s: SparkSession, d: str) -> DataFrame:
    """A bounded read in one call, by the bounds that appends recorded."""
    path = _fresh(s, "log")
    publish.append_log(_rows(s, d), path, order=ORDER, bucket=_bucket())
    return read(s, path, superstream="events", topology=topology(s).where("ordinal <> 1"), start="offset", start_offset=5).select("stream", "offset", "body")


@query("""n AS (SELECT event_id, '00' || (user_id % 3)::VARCHAR AS stream, ts FROM events)
SELECT stream, event_id, row_number() OVER (PARTITION BY stream ORDER BY ts, event_id) - 1 AS "offset" FROM n""")
def odd_stream_names(s: SparkSession, d: str) -> DataFrame:
    """Streams whose names look like numbers, written in two batches and read one by one."""
    path = _fresh(s, "log")
    rows = _rows(s, d).withColumn("stream", F.regexp_replace("stream", "events-", "00"))
    cut = utc(F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    for n, part in enumerate((rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut))):
        publish.append_log(part, path, order=ORDER, bucket=_bucket(), batch_id=n)
    parts = [read(s, path, stream=f"00{k}").select("stream", "event_id", "offset") for k in range(3)]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT 'events-' || (user_id % 3)::VARCHAR AS stream, count(*) AS n, count(*) AS tail, true AS whole FROM events GROUP BY 1")
def concurrent_appends(s: SparkSession, d: str) -> DataFrame:
    """Three appenders at once to the same streams, and an append that fails: the offsets have no gap, and the failed one isn't seen."""
    path, rows = _fresh(s, "log"), _rows(s, d)
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(publish.append_log, rows.where(F.col("event_id") % 3 == k), path, order=ORDER, bucket=_bucket(), batch_id=0, writer=f"w{k}") for k in range(3)]
        for job in jobs:
            job.result()
    broken = rows.withColumn("body", F.raise_error(F.lit("this append fails")).cast("string"))
    try:
        publish.append_log(broken, path, order=ORDER, bucket=_bucket(), batch_id=1)
    except PySparkException:
        pass
    counted = open_log(s, path).groupBy("stream").agg(F.count("*").alias("n"), F.count_distinct("offset").alias("offsets"), F.max("offset").alias("last"))
    known = publish.recorded_bounds(s, path)
    whole = (F.col("n") == F.col("tail")) & (F.col("n") == F.col("offsets")) & (F.col("last") + 1 == F.col("n"))
    return counted.join(known, "stream").select("stream", "n", "tail", whole.alias("whole"))


@query("""SELECT stream, min("offset") FILTER (WHERE chunk_timestamp >= TIMESTAMP '2024-01-10') AS start_offset,
       coalesce(min("offset") FILTER (WHERE coalesce(creation_time, chunk_timestamp) >= TIMESTAMP '2024-01-15'), max("offset") + 1) AS end_offset FROM l GROUP BY stream""")
def indexed_timestamps(s: SparkSession, d: str) -> DataFrame:
    """Ranges by time of a stored log, from its time index and one block of rows a bound."""
    path = _fresh(s, "log")
    publish.append_log(events_log(s, d).withColumnRenamed("offset", "place"), path, order=["place"], bucket=F.floor(F.col("place") / 1000))
    options = RangeOptions(start="timestamp", start_ts=micros("2024-01-10 00:00:00"), end="timestamp", end_ts=micros("2024-01-15 00:00:00"))
    return ranges.resolve_ranges(open_log(s, path), options, bounds=indexed_bounds(s, path, options))


def _written(s: SparkSession, d: str, parts: int = 3, of: int | None = None) -> str:
    """The events as a log in several batches, or the first ``parts`` of ``of``."""
    path, rows = _fresh(s, "log"), _rows(s, d)
    for n in range(parts):
        publish.append_log(rows.where(F.col("event_id") % (of or parts) == n), path, order=ORDER, bucket=_bucket(), batch_id=n)
    return path


@query("SELECT 0::BIGINT AS odd_batches, count(*) AS n, 'events-' || (user_id % 3)::VARCHAR AS stream FROM events GROUP BY 3")
def follow_with_budget(s: SparkSession, d: str) -> DataFrame:
    """A stream over a log, drained in batches of exactly an eighth of it: each stream's rows, and how many batches were not of their size."""
    path, out = _written(s, d), _fresh(s, "log")
    total = publish.recorded_bounds(s, path).agg(F.sum("tail")).first()[0]
    budget = max(1, -(-total // 8))
    rows = streaming.follow_log(s, path, max_records=budget, until_now=True).select("event_id", "stream", "ts")
    streaming.drain(streaming.stream_append(rows, out, _fresh(s, "checkpoint"), order=ORDER, bucket=_bucket))
    log = open_log(s, out)
    odd = log.groupBy("batch_id").count().agg(F.greatest(F.lit(0), F.count_if(F.col("count") != budget) - 1).cast("long").alias("odd_batches"))  # the last batch has the rest
    return log.groupBy("stream").agg(F.count("*").alias("n")).crossJoin(F.broadcast(odd))  # one row


@query("SELECT 'events-' || (user_id % 3)::VARCHAR AS stream, count(*) AS n FROM events WHERE user_id % 3 <> 1 GROUP BY 1")
def follow_superstream(s: SparkSession, d: str) -> DataFrame:
    """A superstream as a stream; a second member turns up after the first run, and the query goes on from its checkpoint."""
    path, out, members, checkpoint = _written(s, d, 2), _fresh(s, "log"), _fresh(s, "topology"), _fresh(s, "checkpoint")
    for upto in (1, 3):
        topology(s).where((F.col("ordinal") < upto) & (F.col("ordinal") != 1)).write.mode("overwrite").parquet(members)
        rows = streaming.follow_log(s, path, superstream="events", topology=members, until_now=True).select("event_id", "stream", "ts")
        streaming.drain(streaming.stream_append(rows, out, checkpoint, order=ORDER, bucket=_bucket))
    return open_log(s, out).groupBy("stream").agg(F.count("*").alias("n"))


@query("""SELECT stream, event_id, row_number() OVER (PARTITION BY stream ORDER BY event_id % 3, ts, event_id) - 1 AS "offset" FROM (SELECT *, 'events-' || (user_id % 3)::VARCHAR AS stream FROM events)""")
def splits_as_tasks(s: SparkSession, d: str) -> DataFrame:
    """A bounded read in which each split of a thousand offsets is a task."""
    return streaming.split_log(s, _written(s, d), split_records=1000).select("stream", "event_id", "offset")


@query("SELECT event_id, stream FROM l WHERE coalesce(region IN ('click', 'error'), true)")
def stored_filter_values(s: SparkSession, d: str) -> DataFrame:
    """Rows by a filter value that the sink stored, with those that have none; the predicate reaches the scan."""
    path = _fresh(s, "log")
    messages = as_messages(events_log(s, d)).withColumnRenamed("offset", "place")
    publish.append_log(messages, path, order=["place"], bucket=F.floor(F.col("place") / 1000), filter_path="application_properties.region")
    return filters.stored_values(open_log(s, path), ["click", "error"], match_unfiltered=True).select("event_id", "stream")


@query("SELECT event_type AS producer, count(*) AS n, max(event_id) AS last FROM events GROUP BY event_type")
def dedup_stream_rows(s: SparkSession, d: str) -> DataFrame:
    """The events arrive twice, in files by time and again as a whole, through a query that stops in between: each id of a producer comes out once."""
    source, out, checkpoint = _fresh(s, "arrivals"), _fresh(s, "log"), _fresh(s, "checkpoint")
    rows = _rows(s, d).select(F.col("event_type").alias("producer"), F.lit("s").alias("stream"), F.col("event_id").alias("publishing_id"))
    half = rows.agg(F.max("publishing_id")).first()[0] // 2
    for part in (rows.where(F.col("publishing_id") <= half), rows):
        part.coalesce(1).write.mode("append").parquet(source)
        fresh = streaming.dedup_stream(s.readStream.schema(part.schema).parquet(source))
        fresh.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return s.read.parquet(out).groupBy("producer").agg(F.count("*").alias("n"), F.max("publishing_id").alias("last"))


@query("SELECT stream, count(*) AS records, count(*) FILTER (WHERE \"offset\" >= 50) AS later FROM l GROUP BY stream")
def read_stored_batches(s: SparkSession, d: str) -> DataFrame:
    """A log in six batches, read from an offset on by its commits; each batch is appended by itself."""
    path = _written(s, d, 6)
    later = read_log(open_log(s, path), ranges.resolve_ranges(open_log(s, path), start="offset", start_offset=50, bounds=publish.recorded_bounds(s, path))).groupBy("stream").agg(F.count("*").alias("later"))
    return open_log(s, path).groupBy("stream").agg(F.count("*").alias("records")).join(later, "stream")


@query("SELECT stream, count(*) AS n FROM l GROUP BY stream")
def checked_read(s: SparkSession, d: str) -> DataFrame:
    """A read of whole streams that counts the offsets that it sees, and would fail where some are gone."""
    path = _written(s, d)
    parts = [read(s, path, stream=f"events-{k}", check_rows=True) for k in range(3)]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("stream").agg(F.count("*").alias("n"))


@query("""n AS (SELECT event_id, 'events-' || (user_id % 3)::VARCHAR AS stream, ts FROM events)
SELECT stream, event_id, row_number() OVER (PARTITION BY stream ORDER BY event_id % 6, ts, event_id) - 1 AS "offset" FROM n""")
def compacted_log(s: SparkSession, d: str) -> DataFrame:
    """A log in six batches: the first four are merged and their commits checkpointed, the last two follow, one batch is written again, and what was replaced is deleted."""
    path, rows = _fresh(s, "log"), _rows(s, d)
    put = lambda n: publish.append_log(rows.where(F.col("event_id") % 6 == n), path, order=ORDER, bucket=_bucket(), batch_id=n)
    for n in range(5):
        put(n)
    compact.compact_log(s, path)
    checkpoint_commits(s, path)
    put(1)  # merged already: it stays as it is
    put(5)
    publish.vacuum(s, path)
    return open_log(s, path).select("stream", "event_id", "offset")


@query("""SELECT 'events-' || (user_id % 3)::VARCHAR AS stream, count(*) FILTER (WHERE event_id % 3 < 2) AS next_offset, count(*) AS tail, count(*) FILTER (WHERE event_id % 3 = 2) AS lag
FROM events GROUP BY 1""")
def lag_of_query(s: SparkSession, d: str) -> DataFrame:
    """A query drains two batches of a log, a third arrives: how far it is behind, by its checkpoint and the log's commits."""
    path, checkpoint = _written(s, d, 2, of=3), _fresh(s, "checkpoint")
    rows = streaming.follow_log(s, path, max_records=max(1, publish.recorded_bounds(s, path).agg(F.sum("tail")).first()[0] // 3), until_now=True).select("event_id", "stream", "ts")
    streaming.drain(streaming.stream_append(rows, _fresh(s, "log"), checkpoint, order=ORDER, bucket=_bucket))
    publish.append_log(_rows(s, d).where(F.col("event_id") % 3 == 2), path, order=ORDER, bucket=_bucket(), batch_id=2)
    return positions.query_lag(s, path, checkpoint)


@query("SELECT 'events-' || (user_id % 3)::VARCHAR AS stream, count(*) - 1 AS last_processed, 0::BIGINT AS repeats FROM events GROUP BY 1")
def kept_progress(s: SparkSession, d: str) -> DataFrame:
    """The progress table of a query that runs, stops, and goes on from its checkpoint; progress is kept after each run and once more."""
    checkpoint, table, out, path = (_fresh(s, x) for x in ("checkpoint", "progress", "log", "log"))
    for n in range(2):
        publish.append_log(_rows(s, d).where(F.col("event_id") % 2 == n), path, order=ORDER, bucket=_bucket(), batch_id=n)
        budget = max(1, publish.recorded_bounds(s, path).agg(F.sum("tail")).first()[0] // 3)
        rows = streaming.follow_log(s, path, max_records=budget, until_now=True).select("event_id", "stream", "ts")
        streaming.drain(streaming.stream_append(rows, out, checkpoint, order=ORDER, bucket=_bucket))
        positions.keep_progress(s, checkpoint, table)
    positions.keep_progress(s, checkpoint, table)
    return positions.progress_table(s, table).groupBy("stream").agg(F.max("last_processed").alias("last_processed"), (F.count("*") - F.count_distinct("last_processed")).alias("repeats"))
