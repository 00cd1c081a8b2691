"""Queries over the events log: one for each operator, over all of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert as C
from ..operators import filters, integrity, limits, progress, publish, ranges, route, splits
from ..options import RangeOptions, micros
from ..schema import PROPERTY_TYPES, project_metadata
from ..sources.fixture import as_messages, bindings, events_log, topology, utc
from ..sources.log import read_log, read_superstream
from .registry import query

CUT = "2024-01-10 00:00:00"
CUT_US = micros(CUT)
LATER = "2024-01-15 00:00:00"
LATER_US = micros(LATER)

Spark = SparkSession


def us(c: str):
    return F.unix_micros(c)


def text(c: str = "value"):
    return F.decode(c, "UTF-8")


# Scans


@query('SELECT stream, count(*) AS n, min("offset") AS lo, max("offset") AS hi FROM l WHERE "offset" >= 10 GROUP BY stream')
def read_log_range(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    rows = read_log(log, ranges.resolve_ranges(log, start="offset", start_offset=10))
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))


@query("SELECT stream, \"offset\", body FROM l WHERE stream IN ('events-0', 'events-1', 'events-2')")
def read_superstream_rows(s: Spark, d: str) -> DataFrame:
    return read_superstream(events_log(s, d), topology(s), "events").select("stream", "offset", "body")


@query('SELECT body AS value, stream, "offset", epoch_us(chunk_timestamp) AS chunk_us, epoch_us(creation_time) AS creation_us, rk AS routing_key FROM l')
def project_metadata_rows(s: Spark, d: str) -> DataFrame:
    rows = project_metadata(as_messages(events_log(s, d)), ["routing_key", "creation_time"])
    return rows.select(text().alias("value"), "stream", "offset", us("chunk_timestamp").alias("chunk_us"), us("creation_time").alias("creation_us"), "routing_key")


# Ranges


@query("SELECT * FROM b")
def stream_bounds(s: Spark, d: str) -> DataFrame:
    return ranges.stream_bounds(events_log(s, d))


@query("SELECT stream, first_offset AS start_offset, tail AS end_offset FROM b")
def resolve_ranges_earliest(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(events_log(s, d))


@query("SELECT stream, 10 AS start_offset, 60 AS end_offset FROM b")
def resolve_ranges_offsets(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(events_log(s, d), RangeOptions(start="offset", start_offset=10, end="offset", end_offset=60))


@query("SELECT stream, 1000000000 AS end_offset, tail AS reached FROM b")
def resolve_ranges_beyond_tail(s: Spark, d: str) -> DataFrame:
    """An end beyond the tail stays as asked, and is reported."""
    log = events_log(s, d)
    return integrity.detect_short_ranges(log, ranges.resolve_ranges(log, end="offset", end_offset=1_000_000_000))


@query(f"""r AS (SELECT stream, min("offset") FILTER (WHERE chunk_timestamp >= TIMESTAMP '{CUT}') AS start_offset,
  coalesce(min("offset") FILTER (WHERE coalesce(creation_time, chunk_timestamp) >= TIMESTAMP '{LATER}'), max("offset") + 1) AS end_offset FROM l GROUP BY stream)
SELECT * FROM r WHERE start_offset < end_offset""")
def resolve_ranges_timestamps(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(events_log(s, d), start="timestamp", start_ts=CUT_US, end="timestamp", end_ts=LATER_US)


@query(f"""r AS (SELECT stream, min("offset") FILTER (WHERE chunk_timestamp >= CASE stream WHEN 'events-1' THEN TIMESTAMP '{LATER}' ELSE TIMESTAMP '{CUT}' END) AS start_offset,
  max("offset") + 1 AS end_offset FROM l GROUP BY stream) SELECT * FROM r WHERE start_offset < end_offset""")
def resolve_ranges_by_stream(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(events_log(s, d), start="timestamp", start_ts=CUT_US, start_ts_by_stream={"events-1": LATER_US})


@query("SELECT stream, first_offset AS start_offset, tail AS end_offset FROM b WHERE false")
def resolve_ranges_no_match(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(events_log(s, d), start="timestamp", start_ts=micros("2999-01-01 00:00:00"), on_no_match="latest")


def truncated(s: Spark, d: str) -> DataFrame:
    return events_log(s, d).where(F.col("offset") >= 100)


@query("SELECT stream, 100 AS start_offset, tail AS end_offset FROM b WHERE tail > 100")
def resolve_ranges_truncated(s: Spark, d: str) -> DataFrame:
    return ranges.resolve_ranges(truncated(s, d), start="offset", start_offset=20, fail_on_data_loss=False)


@query("SELECT stream, first_offset AS start_offset, tail AS end_offset FROM b")
def resolve_ranges_missing_stream(s: Spark, d: str) -> DataFrame:
    wanted = topology(s).select("stream").union(s.createDataFrame([("events-9",)], "stream string"))
    return ranges.resolve_ranges(events_log(s, d), streams=wanted, fail_on_data_loss=False)


@query("SELECT stream, CASE stream WHEN 'events-0' THEN 7 WHEN 'events-1' THEN 30 ELSE first_offset END AS start_offset FROM b")
def fill_missing_starts(s: Spark, d: str) -> DataFrame:
    frame = lambda rows: s.createDataFrame(rows, "stream string, offset long")
    return ranges.fill_missing_starts(frame([("events-0", 7)]), ranges.stream_bounds(events_log(s, d)), initial=frame([("events-0", 3)]), checkpoint=frame([("events-1", 30)]))


@query(f"""a AS (SELECT stream, min("offset") FILTER (WHERE chunk_timestamp >= TIMESTAMP '{CUT}') AS anchor FROM l GROUP BY stream)
SELECT stream, count(*) AS n, epoch_us(min(chunk_timestamp)) AS first_us FROM l JOIN a USING (stream) WHERE "offset" >= anchor AND chunk_timestamp >= TIMESTAMP '{CUT}' GROUP BY stream""")
def read_from_timestamp(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    rows = read_log(log, ranges.resolve_ranges(log, start="timestamp", start_ts=CUT_US), start_ts=CUT_US)
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.min(us("chunk_timestamp")).alias("first_us"))


# Splits


def _split_sql(n: str) -> str:
    return f"""r AS (SELECT stream, first_offset AS s, tail - first_offset AS span, row_number() OVER (ORDER BY stream) - 1 AS pos, count(*) OVER () AS k FROM b),
f AS (SELECT *, greatest(1, ceil(span / 1000.0))::BIGINT AS floor FROM r), g AS (SELECT *, {n} AS n FROM (SELECT *, greatest(0, 16 - sum(floor) OVER ())::BIGINT AS extra FROM f)),
x AS (SELECT *, unnest(range(0, least(n, span))) AS i FROM g), sp AS (SELECT stream, i::INT AS split_id, s + i * (span // n) + least(i, span % n) AS start_offset,
s + i * (span // n) + least(i, span % n) + span // n + CASE WHEN i < span % n THEN 1 ELSE 0 END AS end_offset FROM x)"""


@query(_split_sql("floor") + " SELECT * FROM sp")
def split_ranges_max_records(s: Spark, d: str) -> DataFrame:
    return splits.split_ranges(ranges.resolve_ranges(events_log(s, d)), max_records=1000)


@query(_split_sql("floor + extra // k + CASE WHEN pos < extra % k THEN 1 ELSE 0 END") + " SELECT * FROM sp")
def split_ranges_min_partitions(s: Spark, d: str) -> DataFrame:
    return splits.split_ranges(ranges.resolve_ranges(events_log(s, d)), max_records=1000, min_partitions=16)


@query("SELECT stream, 0 AS split_id, first_offset AS start_offset, tail AS end_offset FROM b")
def split_ranges_default(s: Spark, d: str) -> DataFrame:
    return splits.split_ranges(ranges.resolve_ranges(events_log(s, d)))


@query(_split_sql("floor") + ' SELECT l.stream, split_id, count(*) AS n FROM l JOIN sp ON l.stream = sp.stream AND l."offset" >= start_offset AND l."offset" < end_offset GROUP BY ALL')
def read_splits(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    return splits.read_splits(log, splits.split_ranges(ranges.resolve_ranges(log), max_records=1000)).groupBy("stream", "split_id").agg(F.count("*").alias("n"))


@query(_split_sql("floor") + """, c AS (SELECT *, NOT (stream = 'events-1' AND split_id = 1) AS done FROM sp),
p AS (SELECT *, bool_and(done) OVER (PARTITION BY stream ORDER BY start_offset) AS whole FROM c)
SELECT stream, coalesce(max(end_offset) FILTER (WHERE whole), min(start_offset)) AS next_offset FROM p GROUP BY stream""")
def merge_splits(s: Spark, d: str) -> DataFrame:
    bounds = ranges.stream_bounds(events_log(s, d))
    cut = splits.split_ranges(bounds.select("stream", F.col("first_offset").alias("start_offset"), F.col("tail").alias("end_offset")), max_records=1000)
    failed = (F.col("stream") == "events-1") & (F.col("split_id") == 1)
    reports = cut.withColumn("committed", F.when(failed, F.col("start_offset")).otherwise(F.col("end_offset")))
    return splits.merge_splits(reports, bounds.select("stream", F.col("first_offset").alias("base")))


# Limits


@query("""r AS (SELECT *, row_number() OVER (ORDER BY stream) - 1 AS pos, count(*) OVER () AS k FROM b)
SELECT stream, first_offset AS start_offset, first_offset + least(tail - first_offset, 100 // k + CASE WHEN pos < 100 % k THEN 1 ELSE 0 END) AS end_offset FROM r""")
def budget_ranges(s: Spark, d: str) -> DataFrame:
    return limits.budget_ranges(ranges.resolve_ranges(events_log(s, d)), max_records=100)


@query("""r AS (SELECT *, row_number() OVER (ORDER BY stream) - 1 AS pos, count(*) OVER () AS k FROM b)
SELECT stream, first_offset AS start_offset, first_offset + 97 // k + CASE WHEN (pos + k - 1) % k < 97 % k THEN 1 ELSE 0 END AS end_offset FROM r""")
def budget_ranges_bytes(s: Spark, d: str) -> DataFrame:
    return limits.budget_ranges(ranges.resolve_ranges(events_log(s, d)), max_bytes=100_000, size_estimate=1024, rotation=1)


@query("SELECT stream, first_offset AS start_offset, first_offset + 30 AS end_offset FROM b")
def most_restrictive(s: Spark, d: str) -> DataFrame:
    return limits.budget_ranges(ranges.resolve_ranges(events_log(s, d)), max_records=150, max_bytes=90 * 512, size_estimate=512)


#: Batches by the plain rule, round by round: even shares, the remainder in turn, what a stream can't take shared again.
_BATCHES = """k AS (SELECT list(stream ORDER BY stream) AS names, list(first_offset ORDER BY stream) AS lo, list(tail ORDER BY stream) AS hi FROM b),
t AS (SELECT 0::BIGINT AS batch, {n}::BIGINT AS room, lo AS a, lo AS z FROM k
UNION ALL SELECT batch, room - list_sum(give), z, list_transform(range(1, len(z) + 1), lambda i: z[i] + give[i]) FROM (
  SELECT *, list_transform(range(1, len(z) + 1), lambda i: CASE WHEN z[i] < hi[i] THEN least(hi[i] - z[i], room // len(live) + CASE WHEN ((list_position(live, i) - 1 - batch) % len(live) + len(live)) % len(live) < room % len(live) THEN 1 ELSE 0 END) ELSE 0 END)::BIGINT[] AS give FROM (
    SELECT CASE WHEN room = 0 THEN batch + 1 ELSE batch END AS batch, CASE WHEN room = 0 THEN {n} ELSE room END AS room, z, hi, list_filter(range(1, len(z) + 1), lambda i: z[i] < hi[i]) AS live FROM t, k) WHERE len(live) > 0)),
p AS (SELECT batch AS batch_no, unnest(names) AS stream, unnest(a) AS x, unnest(z) AS y FROM t, k),
w AS (SELECT batch_no, stream, min(x) AS lo, max(y) - 1 AS hi, sum(y - x)::BIGINT AS n FROM p WHERE y > x GROUP BY batch_no, stream)"""


@query(_BATCHES.format(n=1000) + " SELECT batch_no, stream, n, lo, hi FROM w")
def micro_batches(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    rows = limits.micro_batches(log, ranges.resolve_ranges(log), max_records=1000)
    return rows.groupBy("batch_no", "stream").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))


@query(_BATCHES.format(n=100).replace("b)", "(SELECT stream, first_offset, CASE stream WHEN 'events-0' THEN tail WHEN 'events-1' THEN least(tail, 57) ELSE tail // 3 END AS tail FROM b))", 1) + " SELECT batch_no, stream, n, lo, hi FROM w")
def micro_batches_skewed(s: Spark, d: str) -> DataFrame:
    """Streams of very different lengths."""
    log = events_log(s, d)
    end = F.when(F.col("stream") == "events-0", F.col("end_offset")).when(F.col("stream") == "events-1", F.least(F.col("end_offset"), F.lit(57))).otherwise(F.floor(F.col("end_offset") / 3))
    rows = limits.micro_batches(log, ranges.resolve_ranges(log).withColumn("end_offset", end), max_records=100)
    return rows.groupBy("batch_no", "stream").agg(F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"))


@query(_BATCHES.format(n=700) + " SELECT stream, batch_no, lo AS start_offset, hi + 1 AS end_offset FROM w")
def plan_batches(s: Spark, d: str) -> DataFrame:
    return limits.plan_batches(ranges.resolve_ranges(events_log(s, d)), max_records=700)


@query("SELECT ((sum(tail - first_offset) // 1000) * 1000)::BIGINT AS n, (sum(tail - first_offset) // 1000)::BIGINT AS batches FROM b")
def micro_batches_held(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    rows = limits.micro_batches(log, ranges.resolve_ranges(log), max_records=1000, min_records=1000)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("batch_no").alias("batches"))


@query('SELECT ("offset" // 1000)::BIGINT AS batch_no, greatest(1, sum(octet_length(encode(body))) // count(*))::BIGINT AS avg_size FROM l GROUP BY 1')
def avg_message_size(s: Spark, d: str) -> DataFrame:
    rows = as_messages(events_log(s, d)).withColumn("batch_no", F.floor(F.col("offset") / 1000))
    return limits.avg_message_size(rows)


@query('SELECT stream, "offset" FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY "offset") AS turn FROM l) ORDER BY turn, stream LIMIT 200')
def fair_limit(s: Spark, d: str) -> DataFrame:
    return limits.fair_limit(events_log(s, d), 200).select("stream", "offset")


@query("""SELECT stream, "offset" FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY "offset") AS turn FROM l
WHERE "offset" % 7 = 0 OR stream = 'events-1') ORDER BY turn, stream LIMIT 200""")
def fair_limit_gaps(s: Spark, d: str) -> DataFrame:
    """Turns go by rows, not by offsets."""
    return limits.fair_limit(events_log(s, d).where("offset % 7 = 0 or stream = 'events-1'"), 200).select("stream", "offset")


# Filters


@query("SELECT event_id, region FROM l WHERE coalesce(region IN ('click', 'error'), false)")
def filter_values(s: Spark, d: str) -> DataFrame:
    rows = filters.filter_values(as_messages(events_log(s, d)), "application_properties.region", ["click", "error"])
    return rows.select("event_id", F.col("application_properties")["region"].alias("region"))


@query("SELECT event_id, region FROM l WHERE coalesce(region IN ('click', 'error'), true)")
def filter_match_unfiltered(s: Spark, d: str) -> DataFrame:
    rows = filters.filter_values(as_messages(events_log(s, d)), "Application-Properties.region", ["click", "error"], match_unfiltered=True)
    return rows.select("event_id", F.col("application_properties")["region"].alias("region"))


@query("SELECT event_id FROM l WHERE length(body) % 2 = 0")
def post_filter(s: Spark, d: str) -> DataFrame:
    rows = as_messages(events_log(s, d))
    return filters.post_filter(rows, lambda df: F.length(text()) % 2 == 0, values=["even"]).select("event_id")


@query("SELECT event_id, event_type AS subject, event_id::VARCHAR AS message_id, (epoch_us(creation_time) // 1000)::VARCHAR AS created, rk AS routing_key FROM l")
def value_at_path(s: Spark, d: str) -> DataFrame:
    at = C.value_at_path
    return as_messages(events_log(s, d)).select("event_id", at("properties.Subject").alias("subject"), at("properties.message-id").alias("message_id"), at("properties.creationTime").alias("created"), at("applicationProperties.routing_key").alias("routing_key"))


@query("SELECT event_id, CASE WHEN creation_time IS NULL THEN 2 ELSE 3 END::INT AS n, event_type AS subject, (epoch_us(creation_time) // 1000)::VARCHAR AS created FROM l")
def message_view(s: Spark, d: str) -> DataFrame:
    rows = as_messages(events_log(s, d)).withColumn("view", C.message_view())
    return rows.select("event_id", F.size("view").alias("n"), F.col("view")["subject"].alias("subject"), F.col("view")["creation_time"].alias("created"))


@query("SELECT stream, count(*) FILTER (WHERE coalesce(region = 'click', false)) AS kept, count(*) FILTER (WHERE NOT coalesce(region = 'click', false)) AS dropped, max(\"offset\") + 1 AS next_offset FROM l GROUP BY stream")
def filter_report(s: Spark, d: str) -> DataFrame:
    rows = as_messages(events_log(s, d))
    return filters.filter_report(rows, filters.keep_by_value(C.value_at_path("application_properties.region"), ["click"]))


@query('SELECT stream, count(*) AS n, sum("offset")::BIGINT AS total FROM l WHERE "offset" >= 10 GROUP BY stream')
def dedup_offsets(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d).select("stream", "offset", "event_id")
    twice = log.union(log.where("event_id % 13 = 0"))
    cut = ranges.resolve_ranges(log, start="offset", start_offset=10)
    return filters.dedup_offsets(twice, cut).groupBy("stream").agg(F.count("*").alias("n"), F.sum("offset").alias("total"))


@query("SELECT region AS filter_value, count(*) AS n FROM l GROUP BY region")
def with_filter_value(s: Spark, d: str) -> DataFrame:
    return filters.with_filter_value(as_messages(events_log(s, d)), "application_properties.region").groupBy("filter_value").agg(F.count("*").alias("n"))


# Spark's own operators over the log


@query("SELECT event_id, body FROM l")
def decode_value(s: Spark, d: str) -> DataFrame:
    return as_messages(events_log(s, d)).selectExpr("event_id", "cast(value AS string) AS body")


@query("SELECT stream, count(*) AS n FROM l GROUP BY stream")
def count_by_stream(s: Spark, d: str) -> DataFrame:
    return events_log(s, d).groupBy("stream").agg(F.count("*").alias("n"))


@query('SELECT a.stream, count(*) AS n, sum(a."offset")::BIGINT AS total FROM l a JOIN l z ON a.body = z.body GROUP BY a.stream')
def self_join(s: Spark, d: str) -> DataFrame:
    rows = as_messages(events_log(s, d)).select("stream", "offset", text().alias("body"))
    other = rows.select("body")
    return rows.join(other, "body").groupBy("stream").agg(F.count("*").alias("n"), F.sum("offset").alias("total"))


@query("SELECT stream, count(*) AS n FROM (SELECT stream FROM l WHERE stream = 'events-0' UNION ALL SELECT stream FROM l WHERE stream <> 'events-0') GROUP BY stream")
def union_streams(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    return log.where("stream = 'events-0'").union(log.where("stream <> 'events-0'")).groupBy("stream").agg(F.count("*").alias("n"))


@query("SELECT epoch_us(time_bucket(INTERVAL 1 hour, chunk_timestamp)) AS window_start_us, count(*) AS n FROM l GROUP BY 1")
def windowed_count(s: Spark, d: str) -> DataFrame:
    counted = events_log(s, d).groupBy(F.window("chunk_timestamp", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    return counted.select(us("w.start").alias("window_start_us"), "n")


# Conversion


@query("SELECT event_id, to_base64(encode(event_type)) AS from_bytes, event_id::VARCHAR AS from_long, event_type AS from_text FROM events")
def coerce_string(s: Spark, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet").withColumn("raw", F.encode("event_type", "UTF-8"))
    return e.select("event_id", C.coerce_string(F.col("raw"), "binary").alias("from_bytes"), C.coerce_string(F.col("event_id"), "bigint").alias("from_long"), C.coerce_string(F.col("event_type"), "string").alias("from_text"))


@query("SELECT event_id, ((event_id - 500) * 1500)::BIGINT * 1000 AS ts_us, CASE WHEN event_id > 500 THEN ((event_id - 500) * 1500)::BIGINT * 1000 END AS opt_us, 9223372036854775000 AS fits_us, 9223372036854775807 AS top_us, -9223372036854775808 AS low_us, 9223372036854775000 AS last_us, true AS over_null FROM events")
def millis_to_timestamps(s: Spark, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet").withColumn("ms", (F.col("event_id") - 500) * 1500)
    last, top = F.lit(9223372036854775), F.lit((1 << 63) - 1)
    edges = [us(C.millis_to_ts(last)).alias("fits_us"), us(C.millis_to_ts(last + 1)).alias("top_us"), us(C.millis_to_ts(-top)).alias("low_us"), us(C.millis_to_ts_or_null(last)).alias("last_us"), C.millis_to_ts_or_null(last + 1).isNull().alias("over_null")]
    return e.select("event_id", us(C.millis_to_ts(F.col("ms"))).alias("ts_us"), us(C.millis_to_ts_or_null(F.col("ms"))).alias("opt_us"), *edges)


@query("SELECT event_id, trunc((event_id - 500) * 1234567 / 1000.0)::BIGINT AS ms, CASE WHEN event_id >= 500 THEN event_id - 500 END AS seq FROM events")
def timestamps_to_millis(s: Spark, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet").withColumn("n", F.col("event_id") - 500)
    return e.select("event_id", C.ts_to_millis(F.timestamp_micros(F.col("n") * 1234567)).alias("ms"), C.non_negative(F.col("n")).alias("seq"))


@query("SELECT event_id, event_id::VARCHAR AS body, octet_length(encode(event_type)) AS bytes FROM events")
def to_body(s: Spark, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", text(C.to_body(F.col("event_id"), "bigint")).alias("body"), C.payload_bytes(C.to_body(F.encode("event_type", "UTF-8"), "binary")).alias("bytes"))


@query("""SELECT event_id, (rk IS NULL AND region IS NULL) AS no_map, epoch_us(creation_time) AS creation_us, rk AS routing_key, event_type AS subject FROM l""")
def to_source_rows(s: Spark, d: str) -> DataFrame:
    rows = C.to_source_rows(as_messages(events_log(s, d)))
    return rows.select("event_id", F.col("application_properties").isNull().alias("no_map"), us("creation_time").alias("creation_us"), "routing_key", F.col("properties.subject").alias("subject"))


@query("SELECT event_id, event_id % 3 = 0 AS no_map, CASE WHEN event_id % 3 <> 0 THEN (event_id % 3 - 1)::INT ELSE NULL END AS nulls FROM events")
def normalize_map(s: Spark, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    e = s.read.parquet(f"{d}/events.parquet").withColumn("m", F.when(F.col("event_id") % 3 == 0, F.create_map().cast("map<string,string>")).when(F.col("event_id") % 3 == 1, F.create_map(F.lit("a"), F.lit("b"))).otherwise(F.create_map(F.lit("a"), none)))
    m = C.normalize_map(F.col("m"))
    return e.select("event_id", m.isNull().alias("no_map"), F.size(F.filter(F.map_values(m), lambda v: v.isNull())).alias("nulls")).withColumn("nulls", F.when(~F.col("no_map"), F.col("nulls")))


@query("SELECT event_id, creation_time IS NOT NULL AS given, epoch_us(creation_time) AS creation_us, CASE WHEN creation_time IS NOT NULL THEN 13 END::INT AS fields FROM l")
def properties_struct(s: Spark, d: str) -> DataFrame:
    rows = events_log(s, d).withColumn("p", C.properties_struct({"creation_time": F.col("creation_time")}))
    return rows.select("event_id", F.col("p").isNotNull().alias("given"), us("p.creation_time").alias("creation_us"), F.when(F.col("p").isNotNull(), F.lit(len(PROPERTY_TYPES))).alias("fields"))


@query("""SELECT event_id, body, coalesce(rk, 'old') AS routing_key, 'kept' AS upper_key, epoch_us(coalesce(creation_time, TIMESTAMP '2020-01-01')) AS creation_us, event_type AS subject FROM l""")
def to_messages(s: Spark, d: str) -> DataFrame:
    rows = events_log(s, d).select(
        F.encode("body", "UTF-8").alias("VALUE"), F.create_map(F.lit("ROUTING_KEY"), F.lit("kept"), F.lit("routing_key"), F.lit("old"), F.lit("id"), F.col("event_id").cast("string")).alias("application_properties"), F.col("rk").alias("routing_key"),
        "creation_time", F.struct(F.col("event_type").alias("subject"), F.timestamp_micros(F.lit(micros("2020-01-01"))).alias("creation_time")).alias("properties"), F.lit(1).alias("extra"),
    )
    m, ap = C.to_messages(rows, ignore_unknown=True), F.col("application_properties")
    return m.select(ap["id"].cast("long").alias("event_id"), text().alias("body"), ap["routing_key"].alias("routing_key"), ap["ROUTING_KEY"].alias("upper_key"), us("properties.creation_time").alias("creation_us"), F.col("properties.subject").alias("subject"))


_WIRE = """octet_length(encode(body)) + coalesce(11 + octet_length(encode(rk)), 0) + coalesce(6 + octet_length(encode(region)), 0) + 10 + length(event_id::VARCHAR) + 7 + octet_length(encode(event_type)) + coalesce(13 + length(epoch_ms(creation_time)::VARCHAR), 0)"""


@query(f"SELECT event_id, ({_WIRE})::BIGINT AS bytes, octet_length(encode(body)) AS payload FROM l")
def wire_bytes(s: Spark, d: str) -> DataFrame:
    return as_messages(events_log(s, d)).select("event_id", C.wire_bytes().alias("bytes"), C.payload_bytes(F.col("value")).alias("payload"))


# Routing and publishing


@query("SELECT event_id, coalesce(rk, event_type) AS key FROM l")
def routing_key(s: Spark, d: str) -> DataFrame:
    return as_messages(events_log(s, d)).select("event_id", route.routing_key().alias("key"))


@query()
def route_hash(s: Spark, d: str) -> DataFrame:
    return route.route_hash(as_messages(events_log(s, d)).drop("stream"), topology(s)).groupBy("stream").agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))


@query("SELECT event_id, 'events-' || (('0x' || substr(md5(coalesce(rk, event_type)), 1, 8))::BIGINT % 3)::VARCHAR AS stream FROM l")
def route_hash_custom(s: Spark, d: str) -> DataFrame:
    own = F.conv(F.substring(F.md5(route.routing_key().cast("binary")), 1, 8), 16, 10).cast("long")
    return route.route_hash(as_messages(events_log(s, d)).drop("stream"), topology(s), hash_col=own).select("event_id", "stream")


_BIND = "VALUES ('click', 'events-0'), ('purchase', 'events-1'), ('signup', 'events-2'), ('error', 'events-0'), ('error', 'events-1')"


@query(f"k AS (SELECT * FROM ({_BIND}) t(key, target)) SELECT event_id, target AS stream FROM l JOIN k ON event_type = key")
def route_key(s: Spark, d: str) -> DataFrame:
    return route.route_key(as_messages(events_log(s, d)).drop("stream"), bindings(s), key=F.col("properties.subject")).select("event_id", "stream")


@query("SELECT event_id, unnest(CASE WHEN event_id % 2 = 0 THEN ['events-0', 'events-2'] WHEN event_id % 3 = 0 THEN ['events-1'] ELSE [] END) AS stream FROM l")
def route_custom(s: Spark, d: str) -> DataFrame:
    rule = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("events-0"), F.lit("events-2"))).when(F.col("event_id") % 3 == 0, F.array(F.lit("events-1")))
    return route.route_custom(as_messages(events_log(s, d)).drop("stream"), rule).select("event_id", "stream")


@query(f"k AS (SELECT * FROM ({_BIND}) t(key, target)) SELECT event_id FROM l WHERE region IS NULL OR region NOT IN (SELECT key FROM k)")
def unrouted(s: Spark, d: str) -> DataFrame:
    return route.unrouted(as_messages(events_log(s, d)), bindings(s), key=F.col("application_properties")["region"]).select("event_id")


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type, stream ORDER BY event_id) - 1 AS publishing_id FROM l")
def assign_publishing_ids(s: Spark, d: str) -> DataFrame:
    out = publish.assign_publishing_ids(events_log(s, d), producer=F.col("event_type"), order=["event_id"], bucket=F.floor(F.col("event_id") / 5000))
    return out.select("event_id", "publishing_id")


@query("""v AS (SELECT event_type AS producer, event_id, CASE WHEN event_id % 97 = 0 THEN event_id - 500 ELSE event_id END AS publishing_id FROM l),
c AS (SELECT *, publishing_id < 0 OR publishing_id <= coalesce(lag(publishing_id) OVER (PARTITION BY producer ORDER BY event_id), -1) AS bad FROM v)
SELECT producer, count(*) FILTER (WHERE bad) AS violations FROM c GROUP BY producer""")
def check_publishing_ids(s: Spark, d: str) -> DataFrame:
    rows = events_log(s, d).select(F.col("event_type").alias("producer"), "event_id", F.when(F.col("event_id") % 97 == 0, F.col("event_id") - 500).otherwise(F.col("event_id")).alias("publishing_id"))
    return publish.check_publishing_ids(rows, order=["event_id"], bucket=F.floor(F.col("event_id") / 1000))


@query('SELECT stream, "offset" AS publishing_id, event_id, rk AS routing_key FROM l WHERE NOT (stream = \'events-0\' AND "offset" <= 499)')
def dedup_publish(s: Spark, d: str) -> DataFrame:
    """Whole messages, maps among their columns, a part of them sent twice."""
    rows = as_messages(events_log(s, d)).withColumns({"producer": F.lit("p"), "publishing_id": F.col("offset"), "attempt": F.lit(0)})
    again = rows.where("event_id % 13 = 0").withColumn("attempt", F.lit(1))
    stored = s.createDataFrame([("p", "events-0", 499)], "producer string, stream string, max_id long")
    return publish.dedup_publish(rows.union(again), stored, order=["attempt"]).select("stream", "publishing_id", "event_id", F.col("application_properties")["routing_key"].alias("routing_key"))


@query("SELECT event_id, 'base-q' || regexp_replace('run/' || event_type || '.1', '[^A-Za-z0-9_-]', '_', 'g') || '-p' || (event_id % 4)::VARCHAR || '-e7' AS streaming, 'base-p' || (event_id % 4)::VARCHAR || '-t' || event_id::VARCHAR AS batch FROM l")
def producer_name(s: Spark, d: str) -> DataFrame:
    part, q = F.col("event_id") % 4, F.concat(F.lit("run/"), F.col("event_type"), F.lit(".1"))
    return events_log(s, d).select("event_id", publish.producer_name(F.lit("base"), partition=part, query=q, epoch=F.lit(7)).alias("streaming"), publish.producer_name(F.lit("base"), partition=part, task=F.col("event_id")).alias("batch"))


@query(f"SELECT stream, count(*) AS records, sum(octet_length(encode(body)))::BIGINT AS payload_bytes, sum({_WIRE})::BIGINT AS wire_bytes, count(*) FILTER (WHERE rk IS NULL) AS errors FROM l GROUP BY stream")
def write_summary(s: Spark, d: str) -> DataFrame:
    return publish.write_summary(as_messages(events_log(s, d)), error=F.col("routing_key").isNull())


@query('SELECT event_id, stream, "offset" FROM l')
def assign_offsets(s: Spark, d: str) -> DataFrame:
    e = s.read.parquet(f"{d}/events.parquet").select("event_id", utc(F.col("ts")).alias("ts"), F.concat(F.lit("events-"), (F.col("user_id") % 3).cast("string")).alias("stream"))
    return publish.assign_offsets(e, order=["ts", "event_id"], bucket=F.date_trunc("hour", "ts")).select("event_id", "stream", "offset")


# Progress, metrics, integrity


@query("SELECT '{' || string_agg('\"' || stream || '\":' || tail::VARCHAR, ',' ORDER BY stream) || '}' AS offsets FROM b")
def offsets_to_json(s: Spark, d: str) -> DataFrame:
    return progress.offsets_to_json(ranges.stream_bounds(events_log(s, d)).select("stream", F.col("tail").alias("next_offset")))


@query("SELECT stream, tail AS next_offset FROM b")
def offsets_from_json(s: Spark, d: str) -> DataFrame:
    return progress.offsets_from_json(offsets_to_json(s, d))


@query("SELECT stream, max(\"offset\") + 1 AS next_offset FROM l GROUP BY stream")
def merge_progress(s: Spark, d: str) -> DataFrame:
    reports = events_log(s, d).groupBy("stream", F.floor(F.col("offset") / 500).alias("part")).agg((F.max("offset") + 1).alias("next_offset"))
    return progress.merge_progress(reports)


@query("SELECT stream, tail - 1 AS last_processed FROM b WHERE tail > 1 AND stream <> 'events-1'")
def record_progress(s: Spark, d: str) -> DataFrame:
    ends = ranges.stream_bounds(events_log(s, d)).select("stream", F.col("tail").alias("next_offset"))
    recorded = ends.where("stream = 'events-1'").select("stream", (F.col("next_offset") - 1).alias("last_processed")).union(s.createDataFrame([("events-2", 5)], "stream string, last_processed long"))
    return progress.record_progress(ends, recorded)


@query("""g AS (SELECT greatest(0, tail - CASE stream WHEN 'events-0' THEN 1000 WHEN 'events-1' THEN 500 ELSE 0 END) AS lag FROM b)
SELECT min(lag) AS min_lag, max(lag) AS max_lag, round(avg(lag), 1) AS avg_lag FROM g""")
def lag_metrics(s: Spark, d: str) -> DataFrame:
    consumed = s.createDataFrame([("events-0", 1000), ("events-1", 500)], "stream string, next_offset long")
    return progress.lag_metrics(ranges.stream_bounds(events_log(s, d)), consumed)


@query(f"""SELECT stream, count(*) FILTER (WHERE "offset" < 900) AS records, (sum(octet_length(encode(body))) FILTER (WHERE "offset" < 900))::BIGINT AS payload_bytes,
(sum({_WIRE}) FILTER (WHERE "offset" < 900))::BIGINT AS wire_bytes, count(*) FILTER (WHERE "offset" >= 900) AS out_of_range, 80 AS data_loss FROM l WHERE "offset" >= 100 GROUP BY stream""")
def read_metrics(s: Spark, d: str) -> DataFrame:
    log = truncated(s, d)
    bounds = ranges.stream_bounds(log)
    asked = bounds.select("stream", F.lit(20).cast("long").alias("start_offset"), F.lit(900).cast("long").alias("end_offset"))
    return progress.read_metrics(as_messages(log), asked, bounds)


@query("""SELECT stream, count(*) FILTER (WHERE "offset" < 50) AS records, 0 AS out_of_range, 0 AS data_loss FROM l WHERE stream <> 'events-2' GROUP BY stream UNION ALL SELECT 'events-2', 0, 0, 50""")
def read_metrics_of_lost_stream(s: Spark, d: str) -> DataFrame:
    """A stream of which nothing was read is reported as well."""
    log = events_log(s, d).where("stream <> 'events-2' and offset < 50")
    asked = topology(s).select("stream", F.lit(0).cast("long").alias("start_offset"), F.lit(50).cast("long").alias("end_offset"))
    return progress.read_metrics(as_messages(log), asked, ranges.stream_bounds(log)).select("stream", "records", "out_of_range", "data_loss")


@query("SELECT stream, 20 AS start_offset, 100 AS first_offset, 80 AS lost FROM b")
def detect_truncation(s: Spark, d: str) -> DataFrame:
    bounds = ranges.stream_bounds(truncated(s, d))
    return ranges.detect_truncation(bounds.select("stream", F.lit(20).cast("long").alias("start_offset")), bounds)


@query("SELECT stream, tail + 5 AS start_offset, tail, tail AS clamped FROM b WHERE stream = 'events-2'")
def detect_regression(s: Spark, d: str) -> DataFrame:
    bounds = ranges.stream_bounds(events_log(s, d))
    return ranges.detect_regression(bounds.select("stream", F.when(F.col("stream") == "events-2", F.col("tail") + 5).otherwise(F.lit(3)).alias("start_offset")), bounds)


@query("""g AS (SELECT stream, "offset", lag("offset") OVER (PARTITION BY stream ORDER BY "offset") AS before FROM l WHERE "offset" % 97 <> 5)
SELECT stream, before + 1 AS gap_start, "offset" AS gap_end FROM g WHERE "offset" > before + 1""")
def detect_gaps(s: Spark, d: str) -> DataFrame:
    return integrity.detect_gaps(events_log(s, d).where("offset % 97 <> 5"))


@query("""SELECT stream, count(*) + count(*) FILTER (WHERE event_id % 1001 = 1) AS rows, count(*) AS distinct_offsets, count(*) AS span, count(*) FILTER (WHERE event_id % 1001 = 1) = 0 AS whole FROM l GROUP BY stream""")
def check_integrity(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    return integrity.check_integrity(log.union(log.where("event_id % 1001 = 1")))


@query("SELECT stream, tail + 10 AS end_offset, tail AS reached FROM b WHERE stream <> 'events-1'")
def detect_short_ranges(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d)
    far = ranges.stream_bounds(log).select("stream", F.col("first_offset").alias("start_offset"), (F.col("tail") + F.when(F.col("stream") == "events-1", 0).otherwise(10)).alias("end_offset"))
    return integrity.detect_short_ranges(log, far)


@query("SELECT stream, CASE stream WHEN 'events-0' THEN 'complete' WHEN 'events-1' THEN 'data_loss' ELSE 'timeout' END AS outcome FROM b")
def range_outcome(s: Spark, d: str) -> DataFrame:
    log = events_log(s, d).where("not (stream = 'events-1' and offset % 97 = 5)")
    asked = ranges.stream_bounds(log).select("stream", F.col("first_offset").alias("start_offset"), (F.col("tail") + F.when(F.col("stream") == "events-2", 10).otherwise(0)).alias("end_offset"))
    return integrity.range_outcome(log, asked)
