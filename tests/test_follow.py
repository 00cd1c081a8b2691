"""The log as a data source: exact budgets, restarts, superstreams that change, splits as tasks."""

import pytest
from pyspark.sql import functions as F

from streamlog import streaming as S
from streamlog.operators import integrity, publish
from streamlog.sources import datasource
from streamlog.sources.log import open_log


@pytest.fixture()
def log(spark, tmp_path):
    """Three streams of 100, 10 and 1 messages, in two batches."""
    path = f"file://{tmp_path}/in"
    rows = spark.range(111).select("id", F.when(F.col("id") < 100, "s1").when(F.col("id") < 110, "s2").otherwise("s3").alias("stream"), F.timestamp_seconds("id").alias("chunk_timestamp"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("tags"))
    for n in range(2):
        publish.append_log(rows.where(F.col("id") % 2 == n), path, order=["id"], bucket=F.lit(0), batch_id=n)
    return path


def collected(rows, checkpoint, until=None):
    """Batches of a drained query: their rows as (stream, offset)."""
    got = []

    def keep(df, n):
        got.append((n, sorted((r["stream"], r["offset"]) for r in df.select("stream", "offset").collect())))
        if until is not None and len(got) == until:
            raise RuntimeError("stopped here")

    writer = rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    try:
        S.drain(writer)
    except Exception as e:
        assert "stopped here" in str(e)
    return got


def everything(spark, path):
    return sorted((r["stream"], r["offset"]) for r in open_log(spark, path).collect())


def test_budgets_are_exact(spark, log, tmp_path):
    batches = collected(S.follow_log(spark, log, max_records=20, until_now=True), f"file://{tmp_path}/ck")
    assert [len(b) for _, b in batches] == [20, 20, 20, 20, 20, 11]
    assert [sum(s == x for s, _ in batches[0][1]) for x in ("s1", "s2", "s3")] == [10, 9, 1]
    assert sorted(r for _, b in batches for r in b) == everything(spark, log)


def test_restarts_lose_and_repeat_nothing(spark, log, tmp_path):
    ck = f"file://{tmp_path}/ck"
    follow = lambda: S.follow_log(spark, log, max_records=20, until_now=True)
    first = collected(follow(), ck, until=3)  # the third batch fails: it is run again
    rest = collected(follow(), ck)
    assert [n for n, _ in rest][0] == 2 and rest[0] == first[2]
    done = dict(first[:2]) | dict(rest)
    assert sorted(r for b in done.values() for r in b) == everything(spark, log) and sum(map(len, done.values())) == 111
    assert collected(follow(), ck) == []
    more = spark.range(7).select("id", F.lit("s4").alias("stream"), F.timestamp_seconds("id").alias("chunk_timestamp"), F.create_map(F.lit("k"), F.lit("v")).alias("tags"))
    publish.append_log(more, log, order=["id"], bucket=F.lit(0), batch_id=9)
    assert [b for _, b in collected(follow(), ck)] == [[("s4", k) for k in range(7)]]


def test_a_batch_waits_for_enough(spark, log, tmp_path):
    options = datasource.Options.of({"path": log, "min_records": "200", "max_delay": "1h"})
    reader = datasource.LogStreamReader(options, None)
    assert reader.latestOffset() == {"s1": 0, "s2": 0, "s3": 0}
    reader.since -= 3601
    assert reader.latestOffset() == {"s1": 100, "s2": 10, "s3": 1}
    assert collected(S.follow_log(spark, log, min_records=200, max_delay="0ms", until_now=True), f"file://{tmp_path}/ck")[0][1] == everything(spark, log)
    for bad in ({"max_records": 0}, {"min_records": 5, "max_records": 4}, {"max_delay": "soon"}):
        with pytest.raises(ValueError):
            S.follow_log(spark, log, **bad)
    with pytest.raises(ValueError):
        datasource.Options.of({"path": log, "superstream": "x"})


def test_a_superstream_that_changes(spark, log, tmp_path):
    topology, ck = f"file://{tmp_path}/topology", f"file://{tmp_path}/ck"
    name = lambda *streams: spark.createDataFrame([("all", s) for s in streams] + [("other", "s2")], "superstream string, stream string").coalesce(1).write.mode("overwrite").parquet(topology)
    follow = lambda: S.follow_log(spark, log, superstream="all", topology=topology, starts={"s1": 95}, until_now=True)
    name("s1")
    assert [b for _, b in collected(follow(), ck)] == [[("s1", k) for k in range(95, 100)]]
    name("s1", "s3")
    assert [b for _, b in collected(follow(), ck)] == [[("s3", 0)]]
    name("s3")
    assert collected(follow(), ck) == []


def test_a_followed_log_is_appended(spark, log, tmp_path):
    out = f"file://{tmp_path}/out"
    rows = S.follow_log(spark, log, max_records=50, until_now=True).select("id", "stream", "chunk_timestamp", "tags")
    S.drain(S.stream_append(rows, out, f"file://{tmp_path}/ck", order=["id"], bucket=lambda: F.lit(0)))
    back = open_log(spark, out)
    assert back.count() == 111 and all(r["whole"] for r in integrity.check_integrity(back).collect())
    assert {(r["id"], r["tags"]["k"]) for r in back.collect()} == {(k, str(k)) for k in range(111)} and back.agg(F.max("chunk_timestamp").cast("long")).first()[0] == 110


def test_splits_are_tasks(spark, log):
    rows = S.split_log(spark, log, split_records=30)
    assert rows.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, rows.select("stream", "offset", "id", "batch_id").collect())) == sorted(map(tuple, open_log(spark, log).select("stream", "offset", "id", "batch_id").collect()))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        few = S.split_log(spark, log, split_records=30).where("stream = 's1' and `offset` >= 40 and `offset` < 60")
        assert few.rdd.getNumPartitions() == 1 and sorted(r["offset"] for r in few.collect()) == list(range(40, 60))
        assert S.split_log(spark, log).where("stream in ('s2', 'no') and `offset` > 7").count() == 2 and S.split_log(spark, log).where("stream = 'no'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_cuts():
    assert datasource.cut(0, 10, None) == [(0, 10)] and datasource.cut(5, 16, 4) == [(5, 9), (9, 13), (13, 16)] and datasource.cut(0, 1, 9) == [(0, 1)]
