"""Golden vectors, invariants and refusals of the log operators."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlog.functions import convert as C
from streamlog.operators import filters, integrity, limits, progress, publish, ranges, route, splits
from streamlog.options import LimitOptions, RangeOptions, one_target, seconds
from streamlog.schema import project_metadata, validate_sink
from streamlog.sources.log import read, read_log, read_superstream


def frame(spark, rows, start=True):
    return spark.createDataFrame(rows, "stream string, start_offset long, end_offset long")


# Budgets


@pytest.mark.parametrize(
    "span, budget, rotation, want",
    [([300, 100], 100, 0, [50, 50]), ([100], 50, 0, [50]), ([90], 0, 0, [0]), ([100, 10, 1], 20, 0, [10, 9, 1]), ([10, 1, 10], 7, 0, [4, 1, 2]), ([5, 5], 100, 0, [5, 5]), ([0, 0], 3, 0, [0, 0]), ([9, 9, 9], 2, 1, [0, 1, 1])],
)
def test_grants(span, budget, rotation, want):
    assert limits.grants(np.array(span), budget, rotation).tolist() == want


def test_grants_rotate():
    assert sum(limits.grants(np.array([99] * 3), 4, r) for r in range(3)).tolist() == [4, 4, 4]
    served = sum(limits.grants(np.array([99] * 4), 2, r) for r in range(4))
    assert served.sum() == 8 and (served > 0).all()
    assert (limits.grants(np.array([10_000, 1, 1]), 5)[1:] == 1).all()


@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(0, 200), st.integers(0, 20))
def test_grants_bounds(span, budget, rotation):
    out = limits.grants(np.array(span), budget, rotation)
    assert (out >= 0).all() and (out <= span).all()
    assert out.sum() <= max(budget, 0)
    if budget >= len(span):
        assert out.sum() > 0 or not sum(span)


def test_budget_frames(spark):
    r = frame(spark, [("s1", 0, 300), ("s2", 0, 100)])
    got = lambda **k: {x["stream"]: x["end_offset"] for x in limits.budget_ranges(r, **k).collect()}
    assert got(max_records=100) == {"s1": 50, "s2": 50}
    assert got(max_bytes=1, size_estimate=100) == {"s1": 1, "s2": 0}
    assert got(max_bytes=0) == {"s1": 0, "s2": 0}
    assert got(max_records=100, max_bytes=20, size_estimate=1) == {"s1": 10, "s2": 10}
    assert got() == {"s1": 300, "s2": 100}


def test_batches_hold_back(spark):
    log = spark.range(25).select(F.lit("s").alias("stream"), F.col("id").alias("offset"), F.timestamp_seconds(F.col("id")).alias("chunk_timestamp"))
    r = frame(spark, [("s", 0, 25)])
    n = lambda **k: limits.micro_batches(log, r, max_records=10, **k).count()
    assert n() == 25 and n(min_records=10) == 20
    assert n(min_records=10, max_delay="5s", now_us=30_000_000) == 25
    with pytest.raises(ValueError):
        limits.plan_batches(r, max_records=0)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=5), st.integers(1, 60))
def test_phases_are_the_plain_plan(spark, spans, budget):
    """Whole cycles in one row give the batches that a budget after the other gives."""
    at, want, batch = np.zeros(len(spans), np.int64), set(), 0
    while (at < spans).any():
        give = limits.grants(np.array(spans) - at, budget, batch)
        want |= {(f"s{k}", batch, int(at[k]), int(at[k] + give[k])) for k in np.flatnonzero(give)}
        at, batch = at + give, batch + 1
    r = frame(spark, [(f"s{k}", 0, n) for k, n in enumerate(spans)])
    assert {tuple(x) for x in limits.plan_batches(r, max_records=budget).select("stream", "batch_no", "start_offset", "end_offset").collect()} == want
    log = r.select("stream", F.explode(F.when(F.col("end_offset") > 0, F.sequence(F.lit(0).cast("long"), F.col("end_offset") - 1))).alias("offset"))
    got = limits.micro_batches(log, r, max_records=budget).groupBy("stream", "batch_no").agg(F.min("offset").alias("a"), (F.max("offset") + 1).alias("b"))
    assert {tuple(x) for x in got.collect()} == want


def test_fair_limit_over_gaps(spark):
    rows = [("a", k) for k in (0, 1000, 2000)] + [("b", k) for k in (0, 1, 2)]
    log = spark.createDataFrame(rows, "stream string, offset long")
    assert limits.fair_limit(log, 6).count() == 6
    assert [tuple(r) for r in limits.fair_limit(log, 3).orderBy("offset", "stream").collect()] == [("a", 0), ("b", 0), ("a", 1000)]
    assert "WindowGroupLimit" in limits.fair_limit(log, 3)._jdf.queryExecution().executedPlan().toString()


# Splits


def test_split_golden(spark):
    out = splits.split_ranges(frame(spark, [("s1", 0, 1000), ("s2", 0, 10)]), max_records=100, min_partitions=12).collect()
    sizes = {s: sorted(r["end_offset"] - r["start_offset"] for r in out if r["stream"] == s) for s in ("s1", "s2")}
    assert sizes == {"s1": [90] + [91] * 10, "s2": [10]}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 60)), min_size=1, max_size=4), st.integers(1, 30), st.integers(1, 12))
def test_splits_cover(spark, spans, most, least):
    rows = [(f"s{k}", a, a + n) for k, (a, n) in enumerate(spans)]
    out = splits.split_ranges(frame(spark, rows), max_records=most, min_partitions=least).collect()
    for name, a, b in rows:
        own = sorted((r["start_offset"], r["end_offset"]) for r in out if r["stream"] == name)
        assert (not own and a == b) or (own[0][0] == a and own[-1][1] == b and all(x[1] == y[0] for x, y in zip(own, own[1:])))
        assert all(0 < y - x <= most for x, y in own)


def test_merge_splits(spark):
    rows = [("s", 0, 100, 100), ("s", 100, 200, 100), ("s", 200, 300, 300), ("t", 0, 10, 10), ("t", 10, 20, 15), ("t", 0, 10, 4)]
    done = spark.createDataFrame(rows, "stream string, start_offset long, end_offset long, committed long")
    base = spark.createDataFrame([("s", 0), ("t", 0), ("u", 7)], "stream string, base long")
    assert {r["stream"]: r["next_offset"] for r in splits.merge_splits(done, base).collect()} == {"s": 100, "t": 15, "u": 7}


# Ranges


@pytest.fixture(scope="module")
def log(spark):
    rows = [("a", k, 1_000_000 * (k // 2 * 2 + 1), 1_000_000 * k if k != 3 else None) for k in range(5, 15)] + [("b", 0, 9_000_000, None)]
    df = spark.createDataFrame(rows, "stream string, offset long, chunk_us long, created_us long")
    return df.select("stream", "offset", F.timestamp_micros("chunk_us").alias("chunk_timestamp"), F.timestamp_micros("created_us").alias("creation_time"))


def spans(df):
    return {r["stream"]: (r["start_offset"], r["end_offset"]) for r in df.collect()}


def test_ranges(log, spark):
    assert spans(ranges.resolve_ranges(log)) == {"a": (5, 15), "b": (0, 1)}
    assert spans(ranges.resolve_ranges(log, start="latest")) == {}
    assert spans(ranges.resolve_ranges(log, start="timestamp", start_ts=9_000_000)) == {"a": (8, 15), "b": (0, 1)}
    assert spans(ranges.resolve_ranges(log, end="timestamp", end_ts=9_000_000)) == {"a": (5, 9)}
    assert spans(ranges.resolve_ranges(log, end="timestamp", end_ts_by_stream={"a": 7_000_000})) == {"a": (5, 7), "b": (0, 1)}
    with pytest.raises(ranges.NoMatchError):
        ranges.resolve_ranges(log, start="timestamp", start_ts=99_000_000)
    assert spans(ranges.resolve_ranges(log, start="timestamp", start_ts=99_000_000, on_no_match="latest")) == {}
    with pytest.raises(ranges.DataLossError):
        ranges.resolve_ranges(log, start="offset", start_offset=2)
    with pytest.raises(ranges.DataLossError):
        ranges.resolve_ranges(log, streams=spark.createDataFrame([("z",)], "stream string"))
    assert spans(ranges.resolve_ranges(log.where("false"))) == {}
    assert spans(ranges.resolve_ranges(log, end="offset", end_offset=99)) == {"a": (5, 99), "b": (0, 99)}
    known = spark.createDataFrame([("a", 6, 9)], "stream string, first_offset long, tail long")
    assert spans(ranges.resolve_ranges(log, bounds=known)) == {"a": (6, 9)}


def test_rows_find_their_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 10)
    log = spark.range(100).select(F.lit("s").alias("stream"), F.col("id").alias("offset"))
    r = frame(spark, [("s", 0, 25), ("s", 25, 26), ("s", 20, 61), ("s", 99, 1000), ("t", 0, 9), ("s", 5, 5)])
    got = {}
    for x in ranges.locate(log, r).collect():
        got.setdefault(x["range_start"], set()).add(x["offset"])
    assert got == {0: set(range(25)), 25: {25}, 20: set(range(20, 61)), 99: {99}}


def test_read_in_one_call(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    rows = spark.range(30).select("id", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("stream"))
    publish.append_log(rows, path, order=["id"], bucket=F.lit(0))
    top = spark.createDataFrame([("t", "s0"), ("t", "s2")], "superstream string, stream string")
    assert read(spark, path, stream="s1", start="offset", start_offset=4).count() == 6
    assert read(spark, path, superstream="t", topology=top, end="offset", end_offset=3).count() == 6
    for bad in ({}, {"stream": "s0", "superstream": "t"}, {"superstream": "t"}):
        with pytest.raises(ValueError):
            read(spark, path, **bad)
    with pytest.raises(ranges.DataLossError):
        read(spark, path, stream="s9")


def test_read_log(log, spark):
    assert read_log(log, ranges.resolve_ranges(log), start_ts=9_000_000).count() == 8
    many = frame(spark, [(f"x{k}", 0, 5) for k in range(250)] + [("a", 6, 9)])
    assert sorted(r["offset"] for r in read_log(log, many).collect()) == [6, 7, 8]
    top = spark.createDataFrame([("t", "a")], "superstream string, stream string")
    assert read_superstream(log, top, "t").count() == 10
    with pytest.raises(ValueError):
        read_superstream(log, top, "none")


def test_starts(spark):
    f = lambda rows: spark.createDataFrame(rows, "stream string, offset long")
    tails = spark.createDataFrame([("a", 5, 9), ("b", 6, 9)], "stream string, first_offset long, tail long")
    got = lambda **k: {r["stream"]: r["start_offset"] for r in ranges.fill_missing_starts(f([("a", 7)]), tails, **k).collect()}
    assert got() == {"a": 7, "b": 6} and got(superstream=False) == {"a": 7}
    assert got(checkpoint=f([("b", 8)]), superstream=False) == {"a": 7, "b": 8}
    with pytest.raises(ranges.DataLossError):
        ranges.detect_regression(spark.createDataFrame([("a", 10)], "stream string, start_offset long"), tails, fail_on_data_loss=True)


@pytest.mark.parametrize("bad", [{"start": "never"}, {"start": "offset"}, {"start_offset": 3}, {"start": "offset", "start_offset": -1}, {"start": "offset", "start_offset": 9, "end": "offset", "end_offset": 3}, {"end": "timestamp"}, {"on_no_match": "x"}])
def test_range_options(bad):
    with pytest.raises(ValueError):
        RangeOptions(**bad)


def test_other_options():
    assert (seconds("15m"), seconds("250ms"), seconds(500), seconds("2h")) == (900, 0.25, 0.5, 7200)
    for bad in ({"max_records": 0}, {"max_records": 2, "min_records": 3}, {"max_delay": "soon"}):
        with pytest.raises(ValueError):
            LimitOptions(**bad)
    for pair in ((None, None), ("a", "b"), (" ", None)):
        with pytest.raises(ValueError):
            one_target(*pair)


# Conversion


def test_times(spark):
    rows = [(x,) for x in (-1, 0, 1, 1500, (1 << 63) - 1, None)]
    df = spark.createDataFrame(rows, "ms long")
    ms = F.col("ms")
    got = df.select(F.unix_micros(C.millis_to_ts(ms)), F.unix_micros(C.millis_to_ts_or_null(ms))).collect()
    assert [r[1] for r in got] == [None, None, 1000, 1_500_000, None, None]
    assert [r[0] for r in got][:4] == [-1000, 0, 1000, 1_500_000] and got[4][0] == (1 << 63) - 1 and got[5][0] is None
    edge = spark.createDataFrame([(9223372036854775,), (9223372036854776,), (-9223372036854776,)], "ms long").select(F.unix_micros(C.millis_to_ts(ms)), F.unix_micros(C.millis_to_ts_or_null(ms)))
    assert [tuple(r) for r in edge.collect()] == [(9223372036854775000, 9223372036854775000), ((1 << 63) - 1, None), (-(1 << 63), None)]
    us = spark.createDataFrame([(-1500,), (-500,), (500,), (1999,)], "us long")
    assert [r[0] for r in us.select(C.ts_to_millis(F.timestamp_micros("us"))).collect()] == [-1, 0, 0, 1]


@pytest.mark.parametrize("path", ["region", "x.y", ".a", "properties.", "properties.colour"])
def test_bad_paths(path):
    with pytest.raises(ValueError):
        C._path(path)


def test_message_rules(spark):
    df = spark.sql("select cast('x' as binary) value, map('ROUTING_KEY', 'u', 'routing_key', 'old') application_properties, 'new' routing_key, named_struct('subject', 's', 'user_id', cast('id' as binary)) properties, timestamp'1970-01-01 00:00:02' creation_time")
    row = C.to_messages(df).select("application_properties", "properties.*").collect()[0]
    assert row["application_properties"] == {"ROUTING_KEY": "u", "routing_key": "new"} and row["subject"] == "s" and row["creation_time"].second == 2
    with pytest.raises(Exception, match="null"):
        C.to_messages(spark.sql("select cast(null as binary) value")).collect()
    view = C.to_messages(df).select(C.message_view().alias("v"), C.wire_bytes().alias("w")).collect()[0]
    assert view["v"] == {"subject": "s", "user_id": "aWQ=", "creation_time": "2000"} and view["w"] == 1 + 12 + 14 + 8 + 9 + 17


def test_sink_schema(spark):
    ok = spark.sql("select cast('x' as binary) VALUE, 1L publishing_id").schema
    assert validate_sink(ok) == {"value": "VALUE", "publishing_id": "publishing_id"}
    for sql in ("1 value", "cast('x' as binary) value, 1 publishing_id", "cast('x' as binary) value, 2 extra", "1L publishing_id", "cast('x' as binary) value, named_struct('colour', 'x') properties"):
        with pytest.raises(ValueError):
            validate_sink(spark.sql(f"select {sql}").schema)
    assert "extra" not in validate_sink(spark.sql("select cast('x' as binary) value, 2 extra").schema, ignore_unknown=True)
    with pytest.raises(ValueError):
        project_metadata(spark.range(1), ["colour"])


# Filters, routing


def test_filters(spark):
    rows = spark.sql("select * from values (map('r', 'a'), 1), (map('r', 'b'), 2), (map('q', 'a'), 3) t(application_properties, n)")
    got = lambda df: sorted(r["n"] for r in df.collect())
    assert got(filters.filter_values(rows, "application_properties.r", ["a"])) == [1]
    assert got(filters.filter_values(rows, "application_properties.r", ["a"], match_unfiltered=True)) == [1, 3]
    assert got(filters.post_filter(rows, F.col("n") > 1)) == [1, 2, 3] and got(filters.post_filter(rows, F.col("n") > 1, values=["a"])) == [2, 3]
    assert got(filters.post_filter(rows, None, path="application_properties.r", values=["b"])) == [2]
    with pytest.raises(ValueError):
        filters.filter_values(rows, "application_properties.r", [])
    with pytest.raises(ValueError):
        filters.with_filter_value(rows)


@pytest.mark.parametrize("text, seed, want", [("", 0, 0), ("", 1, 0x514E28B7), ("test", 0, 0xBA6BD213), ("Hello, world!", 0, 0xC0363E43), ("a", 0x9747B28C, 0x7FA09EA6), ("aa", 0x9747B28C, 0x5D211726), ("aaa", 0x9747B28C, 0x283E0130), ("aaaa", 0x9747B28C, 0x5A97808A)])
def test_murmur(text, seed, want):
    assert route.murmur3_32([text], seed)[0] == want


def test_routes_need_keys(spark):
    top = spark.createDataFrame([("s0", 0), ("s1", 1)], "stream string, ordinal int")
    rows = spark.sql("select map('routing_key', k) application_properties, named_struct('subject', cast(null as string)) properties from values ('x'), ('y') t(k)")
    assert route.route_hash(rows, top).count() == 2
    with pytest.raises(Exception, match="routing key"):
        route.route_hash(rows, top, key=F.lit("")).collect()
    with pytest.raises(ValueError):
        route.route_hash(rows, top.where("false"))
    assert route.route_custom(rows, F.array().cast("array<string>")).count() == 0


# Publishing, progress, integrity


def test_append(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    rows = spark.range(20).select(F.col("id"), F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("stream"))
    put = lambda df, **k: publish.append_log(df, path, order=["id"], bucket=F.floor(F.col("id") / 7), **k)
    put(rows, batch_id=0)
    put(rows, batch_id=1, compression="zstd")
    put(rows, batch_id=1)  # a retry
    back = spark.read.parquet(path)
    assert back.count() == 40 and all(r["whole"] for r in integrity.check_integrity(back).collect())
    firsts = back.groupBy("stream").agg(F.max(F.when(F.col("batch_id") == "b0", F.col("offset"))).alias("a"), F.min(F.when(F.col("batch_id") == "b1", F.col("offset"))).alias("b")).collect()
    assert all(r["b"] == r["a"] + 1 for r in firsts)
    for bad in ({"mode": "overwrite"}, {"compression": "rar"}):
        with pytest.raises(ValueError):
            put(rows, **bad)
    with pytest.raises(Exception, match="rows for"):
        put(rows, stream="s0")


def test_publishing_ids(spark):
    stored = spark.createDataFrame([("p", "s", 3)], "producer string, stream string, max_id long")
    rows = spark.createDataFrame([("p", "s", k, n) for n, k in enumerate([3, 4, 4, 5, 2])] + [("q", "s", 0, 9)], "producer string, stream string, publishing_id long, n long")
    assert sorted(r["n"] for r in publish.dedup_publish(rows, stored, order=["n"]).collect()) == [1, 3, 9]
    found = {r["producer"]: r["violations"] for r in publish.check_publishing_ids(rows, order=["n"], bucket=F.floor(F.col("n") / 2)).collect()}
    assert found == {"p": 2, "q": 0}
    name = lambda **k: spark.range(1).select(publish.producer_name(**k)).collect()[0][0]
    assert name(base=F.lit("b"), partition=F.lit(1), query=F.lit("a/é 1"), epoch=F.lit(2)) == "b-qa_é_1-p1-e2"
    assert name(base=F.lit(" "), partition=F.lit(1), task=F.lit(2)) is None
    for bad in ({"base": F.lit("b"), "query": F.lit(" "), "epoch": F.lit(1)}, {"base": F.lit("b" * 255), "task": F.lit(1)}):
        with pytest.raises(Exception):
            name(partition=F.lit(0), **bad)


@pytest.mark.parametrize("text", ["", " ", "{", '{"a":1,"a":2}', '{"a":1,}', '{"a":1} x', '{"a":-1}', '{"a":"1"}', None])
def test_bad_offset_texts(spark, text):
    with pytest.raises(Exception, match="not an offset map"):
        progress.offsets_from_json(spark.createDataFrame([(text,)], "offsets string")).collect()


def test_offset_texts(spark):
    f = spark.createDataFrame([("b", 2), ("a", 1)], "stream string, next_offset long")
    text = progress.offsets_to_json(f)
    assert text.collect()[0][0] == '{"a":1,"b":2}'
    assert sorted(map(tuple, progress.offsets_from_json(text).collect())) == [("a", 1), ("b", 2)]
    assert progress.offsets_from_json(spark.createDataFrame([("{}",)], "offsets string")).count() == 0


def test_gaps_between_blocks(spark):
    at = [0, 1, integrity.BLOCK - 1, integrity.BLOCK + 3]
    got = integrity.detect_gaps(spark.createDataFrame([("s", k) for k in at], "stream string, offset long")).collect()
    assert sorted((r["gap_start"], r["gap_end"]) for r in got) == [(2, integrity.BLOCK - 1), (integrity.BLOCK, integrity.BLOCK + 3)]


def test_outcomes(spark):
    log = spark.createDataFrame([("s", k) for k in (3, 4, 6)], "stream string, offset long")
    out = lambda a, b, **k: integrity.range_outcome(log, frame(spark, [("s", a, b)]), **k).collect()[0]["outcome"]
    assert out(3, 5) == "complete" and out(3, 7) == "data_loss" and out(0, 5) == "data_loss"
    assert out(3, 7, filtered=True) == "complete" and out(0, 5, fail_on_data_loss=False) == "complete" and out(3, 5 + 9, filtered=True) == "timeout"


def test_reads_prune(spark, tmp_path):
    """Stream folders and row groups are pruned, and only the columns in use are read."""
    path = f"file://{tmp_path}/log"
    rows = spark.range(100).select("id", F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("stream"), F.lit("x").alias("body"))
    publish.append_log(rows, path, order=["id"], bucket=F.lit(0), batch_id=0)
    log = spark.read.parquet(path)
    r = frame(spark, [("s1", 3, 9), ("s2", 0, 5)])
    plan = read_log(log, r).select("id")._jdf.queryExecution().executedPlan().toString()
    assert read_log(log, r).count() == 11
    assert "s1" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "offset" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "body" not in plan.split("ReadSchema")[1]
