"""Small batches of a log, merged: fewer folders to list and records to read, with every offset kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import delete
from ..sources.commits import columns_line, commit, ranges_of, snapshot, write_blocks
from .publish import COMPRESSIONS, TRIES, ConflictError
from .ranges import DataLossError


def _small_batches(known: DataFrame, small: int, at_once: int) -> list[Row]:
    """(batch_id, attempt) of the oldest batches of under ``small`` rows. One that holds the last offsets of a stream isn't taken: it may still change."""
    lies = known.where("kind = 'range'")
    tails = ranges_of(known).groupBy("stream").agg(F.max(F.col("start_offset") + F.col("n")).alias("tail"))
    each = lies.join(tails, "stream").groupBy("batch_id", "attempt").agg(
        F.sum("n").alias("rows"), F.bool_and(F.col("start_offset") + F.col("n") < F.col("tail")).alias("followed"), F.min("version").alias("version")
    )
    return each.where(F.col("followed") & (F.col("rows") < small)).orderBy("version", "batch_id").limit(at_once).select("batch_id", "attempt").collect()


def _runs(lies: list[Row]) -> list[tuple[str, int, int]]:
    """(stream, start, n) of the stretches without a gap."""
    out: list[tuple[str, int, int]] = []
    for r in sorted(lies, key=lambda r: (r["stream"], r["start_offset"])):
        if out and out[-1][0] == r["stream"] and out[-1][1] + out[-1][2] == r["start_offset"]:
            out[-1] = (r["stream"], out[-1][1], out[-1][2] + r["n"])
        else:
            out.append((r["stream"], r["start_offset"], r["n"]))
    return out


def _rows_of(spark: SparkSession, path: str, chosen: list[Row]) -> DataFrame:
    """The stored rows of these batches, with every column that any of them has."""
    folders = [f"{path}/batch_id={r['batch_id']}/attempt={r['attempt']}" for r in chosen]
    read = lambda: spark.read.option("basePath", path)
    merged = read().option("mergeSchema", "true").parquet(*folders).schema
    texts = [T.StructField(f.name, T.StringType(), f.nullable) if f.name in ("stream", "batch_id", "attempt") else f for f in merged.fields]
    return read().schema(T.StructType(texts)).parquet(*folders).drop("batch_id", "attempt")


def compact_log(spark: SparkSession, path: str, *, small: int = 1_000_000, at_once: int = 1000, compression: str = "none") -> int:
    """Merges the oldest batches of under ``small`` rows, at most ``at_once`` of them, into one, and returns how many; 0 where fewer than two are left, so call it until then.

    Every message keeps its stream, offset and columns; its ``batch_id`` is that of the merged batch. Readers see the old batches or the merged one, by one commit, and a reader that has
    begun goes on with the old files, which stay until ``publish.vacuum``. Batches that hold the end of a stream aren't taken. A merged batch that its writer writes again with the same
    numbers of messages is left as it is; with others it fails (``BatchChangedError``). Rows that can't be found again as the commits count them fail as ``DataLossError``, and nothing changes.
    ``stream_log``, which reads files and no commits, would take a merged batch for new rows: streams over a log that is compacted use ``follow_log``.

    Rows are moved by (stream, million offsets), so a hot stream is many tasks. The commit's text passes the driver: a line a (batch, stream) of the batches taken.
    """
    if small < 1 or at_once < 2 or compression not in COMPRESSIONS:
        raise ValueError(f"small must be 1 or more, at_once 2 or more, compression one of {COMPRESSIONS}")
    for _ in range(TRIES):
        version, known = snapshot(spark, path)
        chosen = [] if known is None else _small_batches(known, small, at_once)
        if len(chosen) < 2:
            return 0
        names, taken = [r["batch_id"] for r in chosen], {(r["batch_id"], r["attempt"]) for r in chosen}
        lies = ranges_of(known).where(F.col("batch_id").isin(names)).collect()
        ids = known.where("kind = 'ids'").where(F.col("batch_id").isin(names)).groupBy("producer", "stream").agg(F.max("max_id").alias("max_id")).collect()
        batch, attempt = f"c{uuid.uuid4().hex}", uuid.uuid4().hex
        folder = f"{path}/batch_id={batch}/attempt={attempt}"
        rows = _rows_of(spark, path, chosen)
        _rewrite(rows, folder, compression)
        written = spark.read.schema("stream string, offset long").parquet(folder)
        runs = _runs(lies)
        _same_offsets(written, runs)
        write_blocks(_times(spark, folder), path, attempt)
        lines = [{"kind": "range", "batch_id": batch, "attempt": attempt, "stream": s, "start_offset": lo, "n": n} for s, lo, n in runs]
        lines.append(columns_line(batch, attempt, rows.schema))
        lines += [{"kind": "ids", "batch_id": batch, "attempt": attempt, **r.asDict()} for r in ids]
        lines += [{"kind": "sealed", "batch_id": r["batch_id"], "attempt": attempt, "stream": r["stream"], "start_offset": r["start_offset"], "n": r["n"]} for r in lies]
        while not commit(spark, path, version + 1, lines):
            version, known = snapshot(spark, path)
            now = {(r["batch_id"], r["attempt"]) for r in ranges_of(known).select("batch_id", "attempt").distinct().collect()}
            if not taken <= now:  # one of them was written again, or merged by another
                break
        else:
            return len(chosen)
        delete(spark, f"{path}/batch_id={batch}")
        delete(spark, f"{path}/_blocks/attempt={attempt}")
    raise ConflictError(f"other writers were ahead {TRIES} times")


def _rewrite(rows: DataFrame, folder: str, compression: str) -> None:
    out = rows.repartition("stream", F.floor(F.col("offset") / 1_000_000)).sortWithinPartitions("stream", "offset").write.option("compression", compression)
    if "filter_value" in rows.columns:
        out = out.option("parquet.bloom.filter.enabled#filter_value", "true").option("parquet.bloom.filter.expected.ndv#filter_value", 10_000)
    out.partitionBy("stream").parquet(folder)


def _times(spark: SparkSession, folder: str) -> DataFrame:
    """The merged rows as the time index takes them, streams as texts."""
    found = spark.read.parquet(folder).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) if f.name == "stream" else f for f in found.fields])).parquet(folder)


def _same_offsets(written: DataFrame, runs: list[tuple[str, int, int]]) -> None:
    """Fails unless each stretch has as many rows as offsets, and nothing lies outside. Offsets are counted once; that none is twice is the commits' own promise."""
    spark = written.sparkSession
    want = spark.createDataFrame(runs, "stream string, start_offset long, n long")
    total = want.groupBy("stream").agg(F.sum("n").alias("n"), F.min("start_offset").alias("lo"), F.max(F.col("start_offset") + F.col("n") - 1).alias("hi"))
    got = written.groupBy("stream").agg(F.count("*").alias("rows"), F.min("offset").alias("least"), F.max("offset").alias("most"))
    wrong = total.join(got, "stream", "full").where(~(F.col("n").eqNullSafe(F.col("rows")) & F.col("lo").eqNullSafe(F.col("least")) & F.col("hi").eqNullSafe(F.col("most")))).take(1)
    if wrong:
        raise DataLossError(f"stream {wrong[0]['stream']!r}: the commits count {wrong[0]['n']} offsets, its files hold {wrong[0]['rows']} rows")
