"""Many small appends: what one costs doesn't grow with those before."""

from __future__ import annotations

import shutil

from pyspark.sql import functions as F

from streamlog import streaming
from streamlog.operators import publish
from streamlog.sources.commits import blocks, checkpoint_commits
from streamlog.sources.log import open_log


def put(spark, path, n, rows=30):
    frame = spark.range(rows).select(F.lit("s").alias("stream"), (F.col("id") + n * rows).alias("id"))
    publish.append_log(frame, path, order=["id"], bucket=F.floor(F.col("id") / 7), batch_id=n, file_records=10)


def test_a_small_append_runs_few_jobs(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    for n in range(3):
        put(spark, path, n)
    spark.sparkContext.setJobGroup("fourth", "the fourth append")
    try:
        put(spark, path, 3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fourth"))
    assert jobs <= 8, jobs
    assert [(r["id"], r["offset"]) for r in open_log(spark, path).orderBy("offset").collect()] == [(k, k) for k in range(120)]


def test_remembered_commits_are_those_of_the_log(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    for n in (0, 1, 1, 0):  # batches that are written again keep their place
        put(spark, path, n)
    checkpoint_commits(spark, path)
    put(spark, path, 2)
    publish.vacuum(spark, path)
    put(spark, path, 3)
    assert [r["offset"] for r in open_log(spark, path).orderBy("offset").collect()] == list(range(120))
    shutil.rmtree(tmp_path / "log")
    for n in range(2):  # another log at the same place
        put(spark, path, n, rows=5)
    assert [(r["stream"], r["first_offset"], r["tail"]) for r in publish.recorded_bounds(spark, path).collect()] == [("s", 0, 10)]
    assert open_log(spark, path).count() == 10


def test_a_batch_after_a_small_one_is_one_write(spark, tmp_path):
    """Its numbers come from the write itself; before, they were counted, and its places computed and joined, in jobs of their own."""
    path = f"file://{tmp_path}/log"
    for n in range(4):
        put(spark, path, n)
    spark.sparkContext.setJobGroup("fifth", "the fifth append")
    try:
        put(spark, path, 4)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fifth"))
    assert jobs <= 2, jobs
    assert [(r["id"], r["offset"]) for r in open_log(spark, path).orderBy("offset").collect()] == [(k, k) for k in range(150)]
    assert publish.vacuum(spark, path) == 0


def test_batches_that_follow_small_ones(spark, tmp_path, monkeypatch):
    """One that is larger than a small one may be, one of a new stream, one without messages, one that comes again: all are numbered as ever."""
    monkeypatch.setattr(publish, "SMALL_BATCH", 40)
    path, tried, real = f"file://{tmp_path}/log", [], publish._write_if_small

    def attempt(*a, **k):
        tried.append(real(*a, **k))
        return tried[-1]

    monkeypatch.setattr(publish, "_write_if_small", attempt)
    small = lambda lo, hi, streams=2: spark.range(lo, hi).select(F.concat(F.lit("s'"), (F.col("id") % streams).cast("string")).alias("stream"), "id", F.timestamp_seconds("id").alias("chunk_timestamp"))
    bucket = F.when(F.col("id") % 10 > 2, F.floor(F.col("id") / 10))  # null comes first
    append = lambda rows, n: publish.append_log(rows, path, order=["id"], bucket=bucket, batch_id=n, writer="w")
    spans = [(0, 20, 2), (20, 60, 2), (60, 160, 2), (160, 170, 2), (170, 190, 3), (190, 190, 2), (190, 200, 2), (200, 210, 2)]
    for n, span in enumerate(spans):
        append(small(*span), n)
    append(small(190, 200, 2), 6)
    # the first two are counted, as is what follows a large batch or none, and what comes again; the third is tried, and found to be large
    assert [None if t is None else sum(t[0].values()) for t in tried] == [None, 20, 0, 10]
    want, tails = [], {}
    for n, (lo, hi, streams) in enumerate(spans):
        for k in sorted(range(lo, hi), key=lambda k: (k % 10 > 2, k // 10 if k % 10 > 2 else 0, k)):
            stream = f"s'{k % streams}"
            want.append((f"qw-b{n}", stream, tails.setdefault(stream, 0), k))
            tails[stream] += 1
    assert sorted(tuple(r) for r in open_log(spark, path).select("batch_id", "stream", "offset", "id").collect()) == sorted(want)
    assert {r["stream"]: (r["first_offset"], r["tail"]) for r in publish.recorded_bounds(spark, path).collect()} == {s: (0, n) for s, n in tails.items()}
    assert blocks(spark, path).agg(F.sum("n")).first()[0] == len(want) and publish.vacuum(spark, path) == 0


def test_checkpoints_on_a_local_disk(spark, tmp_path):
    """A query goes on from a checkpoint that was written the other way, and the setting goes with the block."""
    source, out, checkpoint, setting = f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck", "spark.sql.streaming.checkpointFileManagerClass"

    def drain(lo):
        spark.range(lo, lo + 10).coalesce(1).write.mode("append").parquet(source)
        rows = spark.readStream.schema("id long").parquet(source).withColumn("stream", F.lit("s"))
        streaming.stream_append(rows, out, checkpoint, order=["id"], bucket=lambda: F.lit(0), available_now=True).start().awaitTermination()

    drain(0)
    with streaming.local_checkpoints(spark, checkpoint):
        assert spark.conf.get(setting, None).endswith("FileSystemBasedCheckpointFileManager")
        drain(10)
    assert spark.conf.get(setting, None) is None
    drain(20)
    assert [(r["id"], r["offset"]) for r in open_log(spark, out).orderBy("offset").collect()] == [(k, k) for k in range(30)]


def test_records_of_a_file_source_are_dropped(spark, tmp_path):
    """A source lists its records at every batch; those beyond the last 100 batches go, and the query still goes on where it was."""
    source, checkpoint, setting, seen = f"file://{tmp_path}/in", f"file://{tmp_path}/ck", "spark.sql.streaming.fileSource.log.cleanupDelay", []

    def drain():
        rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: seen.append(n)).trigger(availableNow=True).start().awaitTermination()

    spark.range(250).repartition(250).write.option("maxRecordsPerFile", 1).parquet(source)
    files = len(list((tmp_path / "in").glob("*.parquet")))
    spark.conf.set(setting, "1ms")
    try:
        with streaming.local_checkpoints(spark, checkpoint):
            assert spark.conf.get(setting) == "1ms"  # the session's own
            drain()
        assert spark.conf.get(setting) == "1ms"
    finally:
        spark.conf.unset(setting)
    with streaming.local_checkpoints(spark, checkpoint):
        assert spark.conf.get(setting) == "10s"
    assert spark.conf.get(setting, None) is None
    assert seen == list(range(files)) and len(list((tmp_path / "ck/sources/0").glob("[0-9]*"))) <= 125 < files
    drain()
    assert len(seen) == files
