"""Merged batches, commit checkpoints, and the positions of queries by Spark's checkpoint."""

import shutil
import threading

import pytest
from pyspark.sql import functions as F

from streamlog import shared, streaming
from streamlog.operators import compact, filters, publish, ranges
from streamlog.options import RangeOptions
from streamlog.sources import commits
from streamlog.sources.datasource import Commits
from streamlog.sources.log import indexed_bounds, open_log, read
from streamlog.streaming import positions


def rows_of(spark, lo, hi, streams=2):
    return spark.range(lo, hi).select("id", F.concat(F.lit("00"), (F.col("id") % streams).cast("string")).alias("stream"), F.timestamp_seconds("id").alias("chunk_timestamp"))


def put(rows, path, **k):
    publish.append_log(rows, path, order=["id"], bucket=F.lit(0), **k)


def content(spark, path):
    return sorted((r["stream"], r["offset"], r["id"]) for r in open_log(spark, path).collect())


def batches(spark, path):
    return {r[0] for r in open_log(spark, path).select("batch_id").distinct().collect()}


@pytest.fixture
def log(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    for n in range(4):
        put(rows_of(spark, 20 * n, 20 * n + 20), path, batch_id=n)
    return path


def test_merged_batches_hold_the_same_rows(spark, log):
    before, old = content(spark, log), open_log(spark, log)
    assert compact.compact_log(spark, log) == 3
    assert content(spark, log) == before
    assert len(old.collect()) == 80  # a reader that began before
    names = batches(spark, log)
    assert len(names) == 2 and "b3" in names and any(b.startswith("c") for b in names)
    assert compact.compact_log(spark, log) == 0
    assert publish.vacuum(spark, log) == 3 and publish.vacuum(spark, log) == 0
    assert content(spark, log) == before and read(spark, log, stream="001", check_rows=True).count() == 40
    put(rows_of(spark, 80, 90), log, batch_id=4)
    assert content(spark, log) == sorted(before + [(f"00{k % 2}", k // 2, k) for k in range(80, 90)])
    # the merged batch is merged again
    assert compact.compact_log(spark, log) == 2
    publish.vacuum(spark, log)
    assert content(spark, log) == [(s, k // 2, k) for s, k in sorted((f"00{k % 2}", k) for k in range(90))]


def test_a_merged_batch_written_again(spark, log):
    compact.compact_log(spark, log)
    before = content(spark, log)
    put(rows_of(spark, 100, 120), log, batch_id=1)  # the same numbers: it is there already
    with pytest.raises(publish.BatchChangedError, match="merged"):
        put(rows_of(spark, 20, 25), log, batch_id=1)
    commits.checkpoint_commits(spark, log)
    publish.vacuum(spark, log)
    put(rows_of(spark, 20, 40), log, batch_id=1)
    with pytest.raises(publish.BatchChangedError, match="merged"):
        put(rows_of(spark, 20, 41), log, batch_id=1)
    assert content(spark, log) == before


def test_only_small_batches_are_merged_and_gaps_between_them_stay_others(spark, tmp_path):
    path, at = f"file://{tmp_path}/log", 0
    for n, size in enumerate((4, 30, 4, 4, 2)):
        put(rows_of(spark, at, at + size), path, batch_id=n)
        at += size
    before = content(spark, path)
    assert compact.compact_log(spark, path, small=10, compression="zstd") == 3
    publish.vacuum(spark, path)
    assert content(spark, path) == before and {"b1", "b4"} < batches(spark, path) and len(batches(spark, path)) == 3
    o = RangeOptions(start="timestamp", start_ts=20_500_000)
    spans = lambda f: sorted(tuple(r) for r in f.collect())
    assert spans(ranges.resolve_ranges(open_log(spark, path), o, bounds=indexed_bounds(spark, path, o))) == spans(ranges.resolve_ranges(open_log(spark, path), o))
    assert sorted(tuple(r) for r in streaming.split_log(spark, path, split_records=3).select("stream", "offset", "id").collect()) == before
    for wrong in ({"small": 0}, {"at_once": 1}, {"compression": "best"}):
        with pytest.raises(ValueError):
            compact.compact_log(spark, path, **wrong)
    assert compact.compact_log(spark, f"file://{tmp_path}/none") == 0


def test_at_most_so_many_at_once(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    for n in range(6):
        put(rows_of(spark, 4 * n, 4 * n + 4), path, batch_id=n)
    before = content(spark, path)
    assert compact.compact_log(spark, path, small=8, at_once=2) == 2 and content(spark, path) == before
    assert len(batches(spark, path)) == 5
    assert compact.compact_log(spark, path, small=8, at_once=3) == 3 and content(spark, path) == before
    assert compact.compact_log(spark, path, small=8) == 0 and len(batches(spark, path)) == 3


def test_columns_and_ids_are_kept(spark, tmp_path):
    """Batches of different columns, the highest publishing ids, stored filter values."""
    path = f"file://{tmp_path}/log"
    sink = lambda lo, hi: spark.range(lo, hi).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("value"), F.col("id").alias("publishing_id"), F.lit("s").alias("stream"), F.create_map(F.lit("k"), (F.col("id") % 2).cast("string")).alias("application_properties"))
    send = lambda lo, hi, **k: publish.publish_rows(sink(lo, hi), path, producer="p", order=["publishing_id"], bucket=F.lit(0), **k)
    send(0, 5, batch_id=0)
    send(0, 9, batch_id=1, filter_path="application_properties.k")
    send(0, 12, batch_id=2)
    assert compact.compact_log(spark, path) == 2
    commits.checkpoint_commits(spark, path)
    publish.vacuum(spark, path)
    send(0, 12, batch_id=3)
    send(0, 5, batch_id=0)  # again: known, and merged
    got = sorted((r["offset"], r["publishing_id"]) for r in open_log(spark, path).collect())
    assert got == [(k, k) for k in range(12)]
    found = filters.stored_values(open_log(spark, path), ["1"])  # the values that one of the two batches had
    assert sorted(r["publishing_id"] for r in found.collect()) == [5, 7]


def test_batches_may_have_columns_of_their_own(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    put(rows_of(spark, 0, 4, streams=1), path, batch_id=0)
    put(rows_of(spark, 4, 8, streams=1).withColumn("later", F.col("id") * 2), path, batch_id=1)
    put(rows_of(spark, 8, 10, streams=1).drop("chunk_timestamp"), path, batch_id=2)
    got = lambda: [(r["id"], r["later"], r["chunk_timestamp"] is None) for r in open_log(spark, path).orderBy("offset").collect()]
    want = [(k, 2 * k if 4 <= k < 8 else None, k >= 8) for k in range(10)]
    assert got() == want and open_log(spark, path).columns == ["id", "chunk_timestamp", "offset", "later", "batch_id", "stream"]
    with pytest.raises(ValueError, match="'id' is bigint in the log, not string"):
        put(rows_of(spark, 10, 12, streams=1).withColumn("id", F.col("id").cast("string")), path, batch_id=3)
    assert compact.compact_log(spark, path) == 2 and got() == want
    commits.checkpoint_commits(spark, path)
    publish.vacuum(spark, path)
    assert got() == want
    put(rows_of(spark, 8, 10, streams=1), path, batch_id=2)  # the last batch again, now with its times
    assert [g[:2] for g in got()] == [w[:2] for w in want]


def test_large_ids_are_whole_numbers(spark, tmp_path):
    """Ids beyond 2^53 beside records that have none."""
    path, big = f"file://{tmp_path}/log", 2**53
    rows = lambda *ids: spark.createDataFrame([(bytearray(b"v"), i, "s") for i in ids], "value binary, publishing_id long, stream string")
    for ids in ((big + 1,), (big + 1, big + 2, big + 3), (big + 3, 2**63 - 1), (2**63 - 1,)):
        publish.publish_rows(rows(*ids), path, producer="p", order=["publishing_id"], bucket=F.lit(0))
    assert sorted(r["publishing_id"] for r in open_log(spark, path).collect()) == [big + 1, big + 2, big + 3, 2**63 - 1]


def test_a_compaction_that_dies_leaves_the_log_as_it_was(spark, log, monkeypatch):
    before = content(spark, log)
    monkeypatch.setattr(compact, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        compact.compact_log(spark, log)
    monkeypatch.undo()
    assert content(spark, log) == before and batches(spark, log) == {"b0", "b1", "b2", "b3"}
    assert publish.vacuum(spark, log) == 1
    assert compact.compact_log(spark, log) == 3 and content(spark, log) == before


def test_lost_rows_are_not_merged_away(spark, tmp_path, log):
    for folder in (tmp_path / "log/batch_id=b1").rglob("stream=000"):
        shutil.rmtree(folder)
    with pytest.raises(ranges.DataLossError, match="000"):
        compact.compact_log(spark, log)
    assert "b1" in batches(spark, log)


def test_a_batch_written_again_during_a_compaction_wins(spark, log, monkeypatch):
    real, raced = compact.commit, []

    def slow(*a):
        if not raced:
            raced.append(True)
            put(rows_of(spark, 220, 240), log, batch_id=1)
        return real(*a)

    monkeypatch.setattr(compact, "commit", slow)
    assert compact.compact_log(spark, log) == 3
    got = content(spark, log)
    assert len(got) == 80 and {i for _, _, i in got} == {*range(20), *range(40, 80), *range(220, 240)}


def test_appends_and_compactions_at_once(spark, tmp_path):
    path, failed = f"file://{tmp_path}/log", []

    def run(job, times):
        try:
            for n in range(times):
                job(n)
        except Exception as e:
            failed.append(e)

    jobs = [(lambda n, w=w: put(rows_of(spark, 100 * w + 10 * n, 100 * w + 10 * n + 10), path, batch_id=n, writer=f"w{w}"), 4) for w in range(2)]
    jobs.append((lambda n: (compact.compact_log(spark, path), commits.checkpoint_commits(spark, path)), 4))
    threads = [threading.Thread(target=run, args=j) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    got = content(spark, path)
    assert {i for _, _, i in got} == {100 * w + k for w in range(2) for k in range(40)} and len(got) == 80
    for s in ("000", "001"):
        assert [o for n, o, _ in got if n == s] == list(range(40))


def test_checkpoints_stand_for_the_records_before_them(spark, tmp_path, log, monkeypatch):
    before, folder = content(spark, log), tmp_path / "log/_commits"
    assert commits.checkpoint_commits(spark, log) == 3 and commits.checkpoint_commits(spark, log) is None
    reader = Commits(f"{tmp_path}/log").refresh()
    publish.vacuum(spark, log)
    assert not list(folder.glob("0*.json")) and content(spark, log) == before
    assert publish.recorded_bounds(spark, log).where("tail = 40").count() == 2
    put(rows_of(spark, 80, 100), log, batch_id=4)
    assert [f.name for f in folder.glob("0*.json")] == [f"{4:020d}.json"]
    monkeypatch.setattr(commits, "SETTLED_ROWS", 2)  # the way of long histories
    assert content(spark, log) == sorted(before + [(f"00{k % 2}", k // 2, k) for k in range(80, 100)])
    monkeypatch.undo()
    for known in (reader.refresh(), Commits(f"{tmp_path}/log").refresh()):
        assert known.bounds() == {"000": (0, 50), "001": (0, 50)} and known.version == 4
    # a reader that is several checkpoints behind
    for n in (5, 6):
        put(rows_of(spark, 20 * n, 20 * n + 20), log, batch_id=n)
        commits.checkpoint_commits(spark, log)
        publish.vacuum(spark, log)
    assert reader.refresh().bounds() == {"000": (0, 70), "001": (0, 70)} and len(shared.folders(spark, f"{log}/_checkpoints", "")) == 1
    compact.compact_log(spark, log)
    assert set(reader.refresh().batches) == {next(b for b in batches(spark, log) if b[0] == "c"), "b6"}


def test_records_that_go_while_they_are_read(spark, log, monkeypatch):
    """A reader has looked for checkpoints and found none; then the commits are checkpointed and deleted."""
    real, raced = commits._newest_lines, []

    def late(spark, path, base):
        if not raced:
            raced.append(base)
            commits.checkpoint_commits(spark, path)
            publish.vacuum(spark, path)
        return real(spark, path, base)

    monkeypatch.setattr(commits, "_newest_lines", late)
    assert commits.snapshot(spark, log)[0] == 3 and len(content(spark, log)) == 80 and raced == [None]


def test_a_stream_goes_on_over_merged_batches(spark, tmp_path, log):
    out, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/ck"

    def drain():
        rows = streaming.follow_log(spark, log, max_records=30, until_now=True).select("id", "stream")
        streaming.drain(streaming.stream_append(rows, out, checkpoint, order=["id"], bucket=lambda: F.lit(0)))

    drain()
    compact.compact_log(spark, log)
    commits.checkpoint_commits(spark, log)
    publish.vacuum(spark, log)
    put(rows_of(spark, 80, 100), log, batch_id=4)
    drain()
    assert sorted(r["id"] for r in open_log(spark, out).collect()) == list(range(100))


def test_positions_lag_and_progress_of_a_query(spark, tmp_path, log):
    out, checkpoint, table = (f"file://{tmp_path}/{x}" for x in ("out", "ck", "progress"))
    assert positions.positions(spark, checkpoint).count() == 0 and positions.starts_of(spark, checkpoint) == {}
    positions.keep_progress(spark, checkpoint, table)
    assert positions.lag_summary(spark, log, checkpoint).first().asDict() == {"min_lag": 40, "max_lag": 40, "avg_lag": 40.0}
    run = lambda **k: streaming.drain(streaming.stream_append(streaming.follow_log(spark, log, max_records=30, until_now=True, **k).select("id", "stream"), out, checkpoint, order=["id"], bucket=lambda: F.lit(0)))
    run()
    got = sorted((r["batch"], r["stream"], r["next_offset"], r["done"]) for r in positions.positions(spark, checkpoint).collect())
    assert got == [(b, f"00{s}", min(40, 15 * (b + 1)), True) for b in range(3) for s in range(2)]
    assert positions.starts_of(spark, checkpoint) == {"000": 40, "001": 40}
    put(rows_of(spark, 80, 90, streams=1), log, batch_id=4)
    lag = {r["stream"]: (r["next_offset"], r["tail"], r["lag"]) for r in positions.query_lag(spark, log, checkpoint).collect()}
    assert lag == {"000": (40, 50, 10), "001": (40, 40, 0)}
    for _ in range(2):  # the second time adds nothing
        positions.keep_progress(spark, checkpoint, table)
        kept = sorted((r["batch"], r["stream"], r["last_processed"]) for r in positions.progress_table(spark, table).collect())
        assert kept == [(b, f"00{s}", min(40, 15 * (b + 1)) - 1) for b in range(3) for s in range(2)]
    run()
    positions.keep_progress(spark, checkpoint, table)
    later = [(r["batch"], r["stream"], r["last_processed"]) for r in positions.progress_table(spark, table).where("batch > 2").collect()]
    assert later == [(3, "000", 49)]  # the other stream hasn't moved
    # a batch that is planned and not committed is none that is done
    (tmp_path / "ck/commits/3").unlink()
    assert positions.positions(spark, checkpoint).where("not done").select("batch").distinct().collect()[0][0] == 3
    assert positions.starts_of(spark, checkpoint) == {"000": 40, "001": 40}
    # another query goes on from there
    other = f"file://{tmp_path}/other"
    rows = streaming.follow_log(spark, log, starts=positions.starts_of(spark, checkpoint), until_now=True).select("id", "stream")
    streaming.drain(streaming.stream_append(rows, other, f"file://{tmp_path}/ck2", order=["id"], bucket=lambda: F.lit(0)))
    assert sorted(r["id"] for r in open_log(spark, other).collect()) == list(range(80, 90))


def test_a_query_over_files_has_no_positions(spark, tmp_path):
    source, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/ck"
    spark.range(3).write.parquet(source)
    spark.readStream.schema("id long").parquet(source).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(f"file://{tmp_path}/out").awaitTermination()
    with pytest.raises(ValueError, match="reads files"):
        positions.positions(spark, checkpoint)
