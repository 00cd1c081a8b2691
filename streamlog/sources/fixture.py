"""The events table as a log of three streams, with topology and bindings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.convert import properties_struct
from ..operators.publish import assign_offsets

CHUNK = 50


def utc(ts: Column) -> Column:
    """A timestamp without time zone, read as UTC whatever the session's zone is."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, user_id, event_type, stream, offset, chunk_timestamp, creation_time, region, rk, body): offsets by time within a stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", utc(F.col("ts")).alias("ts"))
    placed = assign_offsets(events.withColumn("stream", F.concat(F.lit("events-"), (F.col("user_id") % 3).cast("string"))), order=["ts", "event_id"], bucket=F.date_trunc("day", "ts"))
    keep = lambda n, c: F.when(F.col("event_id") % n != 0, c)
    return placed.select(
        "event_id", "user_id", "event_type", "stream", "offset",
        F.max("ts").over(W.partitionBy("stream", F.floor(F.col("offset") / CHUNK))).alias("chunk_timestamp"), keep(5, F.col("ts")).alias("creation_time"),
        keep(7, F.col("event_type")).alias("region"), keep(11, F.col("user_id").cast("string")).alias("rk"), F.concat_ws("-", "event_type", "event_id").alias("body"),
    )


def as_messages(log: DataFrame) -> DataFrame:
    """The log's rows as messages of the source schema, with ``event_id``."""
    entries = F.map_filter(F.create_map(F.lit("routing_key"), F.col("rk"), F.lit("region"), F.col("region")), lambda _, v: v.isNotNull())
    props = properties_struct({"message_id": F.col("event_id").cast("string"), "subject": F.col("event_type"), "creation_time": F.col("creation_time")})
    return log.select(
        F.encode("body", "UTF-8").alias("value"), "stream", "offset", "chunk_timestamp", props.alias("properties"), entries.alias("application_properties"),
        F.create_map().cast("map<string,string>").alias("message_annotations"), "creation_time", F.col("rk").alias("routing_key"), "event_id",
    )


def topology(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("events", f"events-{k}", k) for k in range(3)], "superstream string, stream string, ordinal int")


def bindings(spark: SparkSession) -> DataFrame:
    rows = [("click", "events-0"), ("purchase", "events-1"), ("signup", "events-2"), ("error", "events-0"), ("error", "events-1")]
    return spark.createDataFrame([("events", *r) for r in rows], "superstream string, binding_key string, stream string")


#: The log in DuckDB's SQL.
L_SQL = """l AS (SELECT event_id, user_id, event_type, stream, "offset", max(ts) OVER (PARTITION BY stream, "offset" // 50) AS chunk_timestamp,
  CASE WHEN event_id % 5 <> 0 THEN ts END AS creation_time, CASE WHEN event_id % 7 <> 0 THEN event_type END AS region,
  CASE WHEN event_id % 11 <> 0 THEN user_id::VARCHAR END AS rk, event_type || '-' || event_id::VARCHAR AS body
  FROM (SELECT *, 'events-' || (user_id % 3)::VARCHAR AS stream,
        row_number() OVER (PARTITION BY user_id % 3 ORDER BY ts, event_id) - 1 AS "offset" FROM events)),
b AS (SELECT stream, min("offset") AS first_offset, max("offset") + 1 AS tail FROM l GROUP BY stream)"""
