"""Commits: what readers see of appends that fail, run at once, or are written again; and the time index."""

import threading

import pytest
from pyspark.sql import functions as F

from streamlog import shared
from streamlog.operators import integrity, publish, ranges
from streamlog.options import RangeOptions
from streamlog.sources import commits
from streamlog.sources.log import indexed_bounds, open_log, read


def rows_of(spark, lo, hi, streams=1):
    return spark.range(lo, hi).select("id", F.concat(F.lit("s"), (F.col("id") % streams).cast("string")).alias("stream"), F.timestamp_seconds("id").alias("chunk_timestamp"))


def put(rows, path, **k):
    publish.append_log(rows, path, order=["id"], bucket=F.lit(0), **k)


def bounds(spark, path):
    return {r["stream"]: (r["first_offset"], r["tail"]) for r in publish.recorded_bounds(spark, path).collect()}


def test_a_failed_append_leaves_the_log_as_it_was(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/log"
    put(rows_of(spark, 0, 10), path, batch_id=0)
    broken = rows_of(spark, 10, 20).withColumn("id", F.when(F.col("id") == 15, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        put(broken, path, batch_id=1)
    # one that dies after its rows, before its commit
    monkeypatch.setattr(publish, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        put(rows_of(spark, 10, 20), path, batch_id=1)
    monkeypatch.undo()
    assert bounds(spark, path) == {"s0": (0, 10)} and open_log(spark, path).count() == 10 and read(spark, path, stream="s0").count() == 10
    assert publish.vacuum(spark, path) >= 1
    put(rows_of(spark, 10, 25), path, batch_id=1)
    assert bounds(spark, path) == {"s0": (0, 25)}
    assert sorted((r["offset"], r["id"]) for r in open_log(spark, path).collect()) == [(k, k) for k in range(25)]
    assert publish.vacuum(spark, path) == 0


def test_appenders_at_once_leave_no_gap(spark, tmp_path):
    path, failed = f"file://{tmp_path}/log", []

    def run(k):
        try:
            for n in range(2):
                put(rows_of(spark, 100 * k + 10 * n, 100 * k + 10 * n + 5 + k, streams=2), path, batch_id=n, writer=f"w{k}")
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    log = open_log(spark, path)
    assert log.count() == 2 * (5 + 6 + 7) and all(r["whole"] for r in integrity.check_integrity(log).collect())
    assert {k: v[1] for k, v in bounds(spark, path).items()} == {r["stream"]: r["n"] for r in log.groupBy("stream").agg(F.count("*").alias("n")).collect()}
    assert len(commits.snapshot(spark, path)[1].select("batch_id").distinct().collect()) == 6


def sink(spark, lo, hi):
    return spark.range(lo, hi).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("value"), F.col("id").alias("publishing_id"), F.lit("s").alias("stream"))


def test_a_crash_around_the_commit_publishes_once(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/log"
    publish_ = lambda lo, hi, **k: publish.publish_rows(sink(spark, lo, hi), path, producer="p", order=["publishing_id"], bucket=F.lit(0), **k)
    real = publish.commit
    publish_(0, 5)

    def dies(when):
        def commit(*a):
            if when == "after":
                assert real(*a)
            raise RuntimeError("killed")

        return commit

    for when, upto in (("before", 8), ("after", 11)):
        monkeypatch.setattr(publish, "commit", dies(when))
        with pytest.raises(RuntimeError, match="killed"):
            publish_(0, upto)
        monkeypatch.setattr(publish, "commit", real)
        publish_(0, upto)
    got = sorted((r["offset"], r["publishing_id"]) for r in open_log(spark, path).collect())
    assert got == [(k, k) for k in range(11)]


def test_a_batch_that_is_written_again_replaces_itself(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    put(rows_of(spark, 0, 6), path, batch_id=0)
    put(rows_of(spark, 6, 9), path, batch_id=1)
    put(rows_of(spark, 20, 25), path, batch_id=1)  # the last: it may change
    assert sorted((r["offset"], r["id"]) for r in open_log(spark, path).collect()) == [*((k, k) for k in range(6)), *((6 + k, 20 + k) for k in range(5))]
    with pytest.raises(publish.BatchChangedError):
        put(rows_of(spark, 0, 5), path, batch_id=0)
    put(rows_of(spark, 100, 106), path, batch_id=0)
    assert bounds(spark, path) == {"s0": (0, 11)} and open_log(spark, path).where("id >= 100").count() == 6


def test_streams_are_named_by_texts(spark, tmp_path):
    path, names = f"file://{tmp_path}/log", ["007", "7", "2024-01-10", "1e3", "true", "a b/c=d"]
    rows = spark.createDataFrame([(n, k) for n in names for k in range(len(n))], "stream string, id long")
    put(rows, path, batch_id=0)
    put(rows, path, batch_id=1)
    assert {r["stream"]: r["n"] for r in open_log(spark, path).groupBy("stream").agg(F.count("*").alias("n")).collect()} == {n: 2 * len(n) for n in names}
    for n in names:
        assert {(r["stream"], r["offset"]) for r in read(spark, path, stream=n).collect()} == {(n, k) for k in range(2 * len(n))}


def test_only_one_file_of_a_name(spark, tmp_path):
    path = f"file://{tmp_path}/x/1.json"
    assert shared.create_new(spark, path, "a\n") and not shared.create_new(spark, path, "b\n") and (tmp_path / "x/1.json").read_text() == "a\n"
    at = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"file://{tmp_path}/x/{name}")
    (tmp_path / "x/2.new").write_text("c")
    assert not shared._rename_to_new(spark, at("2.new"), at("1.json")) and shared._rename_to_new(spark, at("2.new"), at("2.json"))
    assert (tmp_path / "x/1.json").read_text() == "a\n" and (tmp_path / "x/2.json").read_text() == "c"


@pytest.mark.parametrize("given", [{"start": "timestamp", "start_ts": 33_000_000}, {"end": "timestamp", "end_ts": 41_500_000}, {"start": "timestamp", "start_ts": 5_000_000, "end": "timestamp", "end_ts_by_stream": {"s0": 60_000_000}}, {"start": "timestamp", "start_ts": 10**12, "on_no_match": "latest"}])
def test_the_time_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch, given):
    monkeypatch.setattr(commits, "BLOCK", 7)
    path = f"file://{tmp_path}/log"
    for n in range(3):
        rows = rows_of(spark, 40 * n, 40 * n + 40, streams=2).withColumn("creation_time", F.when(F.col("id") % 3 > 0, F.timestamp_seconds(F.col("id") + F.col("id") * 7 % 11 - 5)))
        put(rows, path, batch_id=n)
    o, log = RangeOptions(**given), open_log(spark, path)
    found = indexed_bounds(spark, path, o)
    spans = lambda f: sorted(tuple(r) for r in f.collect())
    assert {"anchor", "bound"} & set(found.columns)
    assert spans(ranges.resolve_ranges(log, o, bounds=found)) == spans(ranges.resolve_ranges(log, o))
    assert spans(ranges.start_positions(log, o, found)) == spans(ranges.start_positions(log, o))


def test_stored_filter_values_reach_the_scan(spark, tmp_path):
    """Batches without a value aren't read: the predicate is pushed down, and the scan gives fewer rows."""
    from streamlog.operators import filters

    path = f"file://{tmp_path}/log"
    region = lambda n: F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit(("alpha", "beta")[n]))
    for n in range(2):
        rows = rows_of(spark, 100 * n, 100 * n + 100).withColumn("application_properties", F.map_filter(F.create_map(F.lit("region"), region(n)), lambda _, v: v.isNotNull()))
        put(rows, path, batch_id=n, filter_path="application_properties.region")
    log = open_log(spark, path)
    found = filters.stored_values(log, ["beta"])
    assert found.count() == 90 and {r["id"] // 100 for r in found.collect()} == {1}
    assert filters.stored_values(log, ["beta"], match_unfiltered=True).count() == 110
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "filter_value" in plan.split("PushedFilters: [")[1].split("]")[0]
    plain = filters.filter_values(log, "application_properties.region", ["beta"])
    assert sorted(r["id"] for r in plain.collect()) == sorted(r["id"] for r in found.collect())
    with pytest.raises(ValueError):
        filters.stored_values(log, [])


def test_writes_are_counted_as_they_pass(spark, tmp_path):
    rows = spark.range(50).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("value"), F.lit("s").alias("stream"))
    from streamlog.functions.convert import to_messages

    messages = to_messages(rows)
    passing, seen = publish.observed(messages)
    passing.write.parquet(f"file://{tmp_path}/out")
    want = publish.write_summary(messages).collect()[0]
    assert seen.get == {k: want[k] for k in ("records", "payload_bytes", "wire_bytes")}


def test_repeats_are_found_over_batches_and_restarts(spark, tmp_path):
    """Ids of a producer come in three files with repeats in and between them; the query stops after each and goes on from its checkpoint."""
    from streamlog import streaming as S

    source, out, ck = (f"file://{tmp_path}/{x}" for x in ("in", "out", "ck"))
    schema = "producer string, stream string, publishing_id long, body string"
    for n, ids in enumerate(([0, 1, 2, 2], [2, 3, 1, 4], [4, 5, 6, 0])):
        spark.createDataFrame([("p", "s", i, f"{n}-{i}") for i in ids] + [("q", "s", n, f"{n}-q")], schema).coalesce(1).write.mode("append").parquet(source)
        rows = S.dedup_stream(spark.readStream.schema(schema).parquet(source))
        rows.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).select("producer", "publishing_id", "body").collect()]
    assert sorted(g for g in got if g[0] == "q") == [("q", n, f"{n}-q") for n in range(3)]
    assert sorted((i, b.split("-")[0]) for p, i, b in got if p == "p") == [(0, "0"), (1, "0"), (2, "0"), (3, "1"), (4, "1"), (5, "2"), (6, "2")]


def test_a_read_fails_where_rows_are_gone(spark, tmp_path):
    """By the commits at planning: an end beyond the tail, a batch that is gone. While running: files that lost rows, or have some twice."""
    import shutil

    path = f"file://{tmp_path}/log"
    for n in range(3):
        put(rows_of(spark, 10 * n, 10 * n + 10), path, batch_id=n)
    assert read(spark, path, stream="s0", check_rows=True, end="offset", end_offset=25).count() == 25
    with pytest.raises(ranges.DataLossError, match="30 of the offsets"):
        read(spark, path, stream="s0", end="offset", end_offset=99)
    assert read(spark, path, stream="s0", end="offset", end_offset=99, fail_on_data_loss=False).count() == 30
    for folder in (tmp_path / "log/batch_id=b1").rglob("stream=s0"):  # the rows of a committed batch are lost
        shutil.rmtree(folder)
    assert read(spark, path, stream="s0").count() == 20
    for action in (lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.agg(F.max("offset")).collect()):
        with pytest.raises(Exception, match="data loss: stream s0 has 20 offsets in 20 rows"):
            action(read(spark, path, stream="s0", check_rows=True))
    assert read(spark, path, stream="s0", check_rows=True, start="offset", start_offset=20).count() == 10
    second = next((tmp_path / "log/_commits").glob("*1.json"))
    second.unlink()  # and its commit
    with pytest.raises(ranges.DataLossError, match="20 of the offsets"):
        read(spark, path, stream="s0")
    twice = rows_of(spark, 0, 3).withColumn("offset", F.col("id")).unionAll(rows_of(spark, 2, 3).withColumn("offset", F.col("id")))
    with pytest.raises(Exception, match="3 offsets in 4 rows"):
        integrity.checked(twice, spark.createDataFrame([("s0", 0, 3)], "stream string, start_offset long, end_offset long")).collect()
