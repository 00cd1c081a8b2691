"""Streams over a log written to disk."""

import pytest
from pyspark.sql import functions as F

from streamlog import streaming as S
from streamlog.operators import integrity, publish, ranges
from streamlog.options import RangeOptions


@pytest.fixture()
def log(spark, tmp_path):
    path = f"file://{tmp_path}/in"
    rows = spark.range(60).select("id", F.lit("s").alias("stream"), (F.col("id") % 3).cast("string").alias("key"), F.timestamp_seconds(F.col("id")).alias("chunk_timestamp"))
    for k in range(3):
        publish.append_log(rows.where(F.floor(F.col("id") / 20) == k), path, order=["id"], bucket=F.lit(0), batch_id=k)
    return path


def schema(spark, path):
    return spark.read.parquet(path).schema


def drain(writer):
    q = writer.start()
    q.awaitTermination(120)
    assert q.exception() is None
    return q


def test_drain_and_append(spark, log, tmp_path):
    out, ck = f"file://{tmp_path}/out", f"file://{tmp_path}/ck"
    rows = S.stream_log(spark, log, schema(spark, log), max_files=1).select("id", "stream", "key", "chunk_timestamp")
    q = drain(S.stream_append(rows, out, ck, order=["id"], bucket=lambda: F.lit(0), available_now=True))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 3
    back = spark.read.parquet(out)
    assert back.count() == 60 and integrity.check_integrity(back).collect()[0]["whole"]
    rows = S.stream_log(spark, log, schema(spark, log), max_files=1).select("id", "stream", "key", "chunk_timestamp")
    drain(S.stream_append(rows, out, ck, order=["id"], bucket=lambda: F.lit(0), available_now=True))  # a restart finds nothing new
    assert spark.read.parquet(out).count() == 60


def test_update_mode_writes_every_change(spark, log, tmp_path):
    out = f"file://{tmp_path}/counts"
    counts = S.stateful_counts(S.stream_log(spark, log, schema(spark, log), max_files=1), F.col("key")).withColumn("stream", F.lit("counts"))
    drain(S.stream_append(counts, out, f"file://{tmp_path}/ck2", order=["key"], bucket=lambda: F.lit(0), mode="update", available_now=True))
    last = spark.read.parquet(out).groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("changes")).collect()
    assert {r["n"] for r in last} == {20} and all(r["changes"] > 1 for r in last)


def test_windows(spark, log, tmp_path):
    counted = S.windowed_counts(S.stream_log(spark, log, schema(spark, log)), width="5 seconds", late="10 seconds")
    drain(counted.writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", f"{tmp_path}/ck3").trigger(availableNow=True))
    assert [tuple(r) for r in spark.sql("select count(*), sum(n) from windows").collect()] == [(12, 60)]


def test_union_of_streams(spark, log, tmp_path):
    one, two = (S.stream_log(spark, log, schema(spark, log)) for _ in range(2))
    drain(one.union(two).writeStream.format("memory").queryName("both").option("checkpointLocation", f"{tmp_path}/ck4").trigger(availableNow=True))
    assert spark.sql("select count(*) from both").collect()[0][0] == 120


def test_a_stream_has_no_end(spark, log):
    for bad in ({"end_offset": 5}, {"colour": 1}, {"start": "offset"}, {"start": "latest"}, {"start": "never"}, {"max_records": 10}, {"max_records": 10, "file_records": 20}, {"max_files": 1, "max_bytes": 0}):
        with pytest.raises(ValueError):
            S.stream_log(spark, log, schema(spark, log), **bad)


def seen(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("start, first", [({"start": "offset", "start_offset": 25}, 25), ({"start": "timestamp", "start_ts": 30_000_000}, 30), ({"start": "timestamp", "start_ts_by_stream": {"s": 41_000_000}}, 41), ({"start": "latest"}, 60), ({}, 0)])
def test_starts_count_without_a_checkpoint(spark, log, tmp_path, start, first):
    out, ck = f"file://{tmp_path}/out", f"file://{tmp_path}/ck"

    def drain_from(**k):
        rows = S.stream_log(spark, log, schema(spark, log), checkpoint=ck, max_files=1, **k).select("id", "stream", "key", "chunk_timestamp")
        drain(S.stream_append(rows, out, ck, order=["id"], bucket=lambda: F.lit(0), available_now=True))

    drain_from(**start)
    assert not first == 60 or not (tmp_path / "out").exists()
    more = spark.range(60, 70).select("id", F.lit("s").alias("stream"), F.lit("k").alias("key"), F.timestamp_seconds(F.col("id")).alias("chunk_timestamp"))
    publish.append_log(more, log, order=["id"], bucket=F.lit(0), batch_id=3)
    publish.append_log(more.withColumn("stream", F.lit("new")), log, order=["id"], bucket=F.lit(0), batch_id=4)
    drain_from(start="latest")  # there is a checkpoint: this start doesn't count
    assert seen(spark, out) == sorted([*range(first, 70), *range(60, 70)])


def test_a_start_without_data(spark, log, tmp_path):
    with pytest.raises(ranges.NoMatchError):
        S.stream_log(spark, log, schema(spark, log), checkpoint=f"file://{tmp_path}/ck", start="timestamp", start_ts=10**12)
    with pytest.raises(ranges.DataLossError):
        ranges.start_positions(spark.read.parquet(log).where("offset > 5"), RangeOptions(start="offset", start_offset=2))


def test_two_writers_and_a_replayed_batch(spark, log, tmp_path):
    out = f"file://{tmp_path}/out"
    for name in ("one", "two", "one"):
        rows = S.stream_log(spark, log, schema(spark, log), max_files=2).select("id", "stream", "key", "chunk_timestamp")
        drain(S.stream_append(rows, out, f"file://{tmp_path}/ck-{name}", order=["id"], bucket=lambda: F.lit(0), available_now=True))
    back = spark.read.parquet(out)
    assert back.count() == 120 and integrity.check_integrity(back).collect()[0]["whole"]
    # a batch of the first writer runs again, after the second's: it takes the offsets it had
    before = sorted(map(tuple, back.select("batch_id", "offset", "id").collect()))
    first = min(b for b, *_ in before if b.endswith("-b0"))
    rows = back.where(F.col("batch_id") == first).select("id", "stream", "key", "chunk_timestamp").collect()
    again = spark.createDataFrame(rows, "id long, stream string, key string, chunk_timestamp timestamp")
    writer = first[1 : -len("-b0")]
    publish.append_log(again, out, order=["id"], bucket=F.lit(0), batch_id=0, writer=writer)
    spark.catalog.refreshByPath(out)
    assert sorted(map(tuple, spark.read.parquet(out).select("batch_id", "offset", "id").collect())) == before
    with pytest.raises(publish.BatchChangedError):
        publish.append_log(again.limit(3), out, order=["id"], bucket=F.lit(0), batch_id=0, writer=writer)
    with pytest.raises(publish.BatchChangedError):
        publish.append_log(again.withColumn("stream", F.lit("other")), out, order=["id"], bucket=F.lit(0), batch_id=0, writer=writer)


def test_late_rows_are_left_out_in_append_mode(spark, tmp_path):
    """Windows come out once, when the watermark has passed them; rows behind it don't count."""
    source = f"file://{tmp_path}/in"
    for n, seconds in enumerate(([1, 2, 11], [30], [31], [3, 32], [60], [61])):
        spark.createDataFrame([(x,) for x in seconds], "x long").select(F.timestamp_seconds("x").alias("chunk_timestamp")).coalesce(1).write.parquet(f"{source}/n={n}")
    rows = spark.readStream.schema("chunk_timestamp timestamp, n int").option("maxFilesPerTrigger", 1).parquet(source)
    counted = S.windowed_counts(rows, width="10 seconds", late="5 seconds").select(F.unix_seconds("window.start").alias("at"), F.col("n"))
    drain(counted.writeStream.outputMode("append").format("memory").queryName("late").option("checkpointLocation", f"{tmp_path}/ck6").trigger(availableNow=True))
    assert sorted(map(tuple, spark.sql("select at, n from late").collect())) == [(0, 2), (10, 1), (30, 3)]


def test_publishing_stream(spark, tmp_path):
    """Rows of the sink schema through the whole sink, in a stream that starts over without its checkpoint: ids keep repeats out."""
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("value"), F.col("id").alias("publishing_id"), F.lit("s").alias("stream")).coalesce(1).write.mode("append").parquet(source)
    for name in ("a", "b"):
        rows = spark.readStream.schema("value binary, publishing_id long, stream string").option("maxFilesPerTrigger", 10).parquet(source)
        drain(S.stream_append(rows, out, f"file://{tmp_path}/ck-{name}", order=["publishing_id"], bucket=lambda: F.lit(0), available_now=True, sink=publish.publish_rows, producer="p"))
    back = spark.read.parquet(out)
    assert sorted(r["publishing_id"] for r in back.collect()) == list(range(30)) and integrity.check_integrity(back).collect()[0]["whole"]
