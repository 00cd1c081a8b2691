"""The commit log of a log: which batches are there, where they lie, and what their producers have published.

A batch's rows go to a folder of their attempt first, ``batch_id=<batch>/attempt=<attempt>``. They are part of the log once ``_commits/<version>.json`` names the attempt; that file is put
there whole, and only if there is none of that version yet. So readers see all of a batch or nothing, an appender that dies leaves the log as it was, and of two
appenders that aim at the same version one must look again. The store needs an atomic rename that doesn't replace (HDFS and its kin, or a local disk).

A record has a line for each stream of the batch (kind ``range``) and one for each of its (producer, stream) pairs (kind ``ids``), and one for its columns (kind ``columns``). Where it merges batches (``operators.compact``) it has
a line for each (batch, stream) that went into it as well (kind ``sealed``). Blocks of offsets with their least and greatest times lie beside it in ``_blocks/attempt=<attempt>``, as Parquet.

``_checkpoints/<version>.json`` names a Parquet folder with the lines of all batches as of that version; records up to it aren't read any more.
"""

from __future__ import annotations

import json
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.ranges import within_ranges
from ..shared import SETTLED_ROWS, create_new, delete, exists, file_state, files, folders, materialise, read_text, settle

_LINE = "kind string, batch_id string, attempt string, stream string, start_offset long, n long, producer string, max_id long, columns string"
_COLUMNS = [c.split()[0] for c in _LINE.split(", ")]
_BLOCK = "stream string, lo long, hi long, n long, least_chunk long, most_chunk long, least_time long, most_time long"
#: Columns that a row's folders give.
_FOLDERS = ("batch_id", "attempt", "stream")
#: Offsets of a block of the time index.
BLOCK = 50_000
#: Up to so many attempts stand in a read's plan as one predicate on the partition column.
LITERAL_ATTEMPTS = 2000
#: Records that an appender's driver reads by itself, at most; more are a Spark job. And the logs of which it remembers the lines.
FEW_RECORDS, REMEMBERED_LOGS = 64, 64
#: Lines by log: up to which version (with the state of its record, which is never written again), above which checkpoint, and the lines.
_remembered: dict[str, tuple[int, tuple[int, int], tuple[int, str] | None, list[dict]]] = {}


def snapshot(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The latest version, -1 before the first commit, and the lines of every batch's latest attempt: one row a (batch, stream) and (batch, producer, stream). Readers see by it what is in the store
    now, so a record that is gone is missing; only appends go by what the driver remembers (``few_lines``)."""
    if not exists(spark, f"{path}/_commits"):
        return -1, None
    base = latest_checkpoint(spark, path)
    while True:
        found = _newest_lines(spark, path, base)
        again = latest_checkpoint(spark, path)
        if again == base:
            return found
        base = again  # records may have gone while they were read


def _record(path: str, version: int) -> str:
    return f"{path}/_commits/{version:020d}.json"


def _frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    schema = T.StructType.fromDDL(f"{_LINE}, version long")
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)), schema=schema)


def few_lines(spark: SparkSession, path: str) -> tuple[int, list[dict]] | None:
    """For appends: what ``snapshot`` gives, as rows, where this driver has read the log before and there are few records since: versions have no gap, so only the new ones are opened. None where it hasn't."""
    known = _remembered.get(path)
    if known is None:
        return None
    version, state, base, rows = known
    if file_state(spark, _record(path, version)) != state or latest_checkpoint(spark, path) != base:
        del _remembered[path]  # a log of its own at the same path, or its records went into a checkpoint
        return None
    new: list[dict] = []
    upto = version
    while file_state(spark, _record(path, upto + 1)) is not None:
        if upto - version >= FEW_RECORDS:
            return None
        upto += 1
        found = [json.loads(line) for line in read_text(spark, _record(path, upto)).splitlines() if line]
        new += [{c: x.get(c) for c in _COLUMNS} | {"version": upto} for x in found]
    if not new:
        return version, rows
    attempts = {r["batch_id"]: r["attempt"] for r in new}
    rows = [r for r in rows + new if attempts.get(r["batch_id"], r["attempt"]) == r["attempt"]]
    _remember(spark, path, upto, base, rows)
    return upto, rows


def _remember(spark: SparkSession, path: str, version: int, base: tuple[int, str] | None, rows: list[dict]) -> None:
    _remembered.pop(path, None)
    state = file_state(spark, _record(path, version))
    if len(rows) <= SETTLED_ROWS and state is not None:
        while len(_remembered) >= REMEMBERED_LOGS:
            del _remembered[next(iter(_remembered))]
        _remembered[path] = (version, state, base, rows)


def latest_checkpoint(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The version and the folder of the newest checkpoint."""
    folder = f"{path}/_checkpoints"
    versions = [int(f[:20]) for f in files(spark, folder) if re.fullmatch(r"\d{20}\.json", f)] if exists(spark, folder) else []
    if not versions:
        return None
    return max(versions), f"{folder}/{spark.read.json(f'{folder}/{max(versions):020d}.json', schema='folder string').first()[0]}"


def _newest_lines(spark: SparkSession, path: str, base: tuple[int, str] | None) -> tuple[int, DataFrame | None]:
    version = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).cast("long")
    records = spark.read.schema(_LINE).json(f"{path}/_commits")
    if base is not None:
        records = records.where(F.col("_metadata.file_name") > f"{base[0]:020d}.json")  # files are skipped by their names
    lines = records.withColumn("version", version)
    if base is not None:
        lines = lines.unionByName(spark.read.schema(f"{_LINE}, version long").parquet(base[1]))
    floor = -1 if base is None else base[0]
    few = lines.limit(SETTLED_ROWS + 1).toArrow()
    if few.num_rows <= SETTLED_ROWS:
        rows = few.to_pylist()
        if not rows:
            return floor, None
        newest = {r["batch_id"]: r["attempt"] for r in sorted(rows, key=lambda r: r["version"])}
        kept, last = [r for r in rows if newest[r["batch_id"]] == r["attempt"]], max(floor, *(r["version"] for r in rows))
        _remember(spark, path, last, base, kept)
        return last, _frame(spark, kept)
    lines = materialise(lines, "commits")
    newest = lines.groupBy("batch_id").agg(F.max_by("attempt", "version").alias("attempt"))
    return max(floor, lines.agg(F.max("version")).first()[0]), lines.join(newest, ["batch_id", "attempt"], "left_semi")


def boundary_offsets(spark: SparkSession, path: str, *, start_ts: Column | None, end_ts: Column | None) -> DataFrame | None:
    """(stream, first_offset, tail, anchor, bound) by commits and time index: ``anchor`` is a stream's first offset whose chunk time is ``start_ts`` or later, ``bound`` the first whose message time is
    ``end_ts`` or later; both are micros, by stream. Of the rows only those of the one block are read in which a bound lies. None where the log has no index."""
    index = blocks(spark, path)
    if index is None:
        return None
    index = settle(index, "time-index") if start_ts is not None and end_ts is not None else index
    whole = index.groupBy("stream").agg(F.min("lo").alias("first_offset"), F.max("hi").alias("tail"))
    rows = committed_rows(spark, path)
    time = F.coalesce("creation_time", "chunk_timestamp") if "creation_time" in rows.columns else F.col("chunk_timestamp")
    for name, most, ts, wanted in (("anchor", "most_chunk", F.col("chunk_timestamp"), start_ts), ("bound", "most_time", time, end_ts)):
        if wanted is None:
            continue
        first = index.where(F.col(most) >= wanted).groupBy("stream").agg(F.min(F.struct("lo", "hi")).alias("b"))
        first = settle(first.select("stream", F.col("b.lo").alias("start_offset"), F.col("b.hi").alias("end_offset")), "time-blocks")
        found = within_ranges(rows, first).where(F.unix_micros(ts) >= wanted).groupBy("stream").agg(F.min("offset").alias(name))
        whole = whole.join(found, "stream", "left")
    return whole


def commit(spark: SparkSession, path: str, version: int, lines: list[dict]) -> bool:
    """Makes ``lines`` the record of ``version``; False if there is one already."""
    return create_new(spark, _record(path, version), "".join(json.dumps(x) + "\n" for x in lines))


def checkpoint_commits(spark: SparkSession, path: str) -> int | None:
    """Keeps the lines of all batches as of now in one Parquet table, so that appends and reads open it and the records after it; returns its version, or None where nothing is new.

    Of merged batches only those are remembered that somebody may write again: batches with a number. Records and older checkpoints stay until ``publish.vacuum``.
    """
    base, (version, known) = latest_checkpoint(spark, path), snapshot(spark, path)
    if known is None or (base is not None and base[0] >= version):
        return None
    name = f"{version:020d}-{uuid.uuid4().hex}"
    needed = known.where("kind <> 'sealed' or batch_id rlike '^[bq]'")
    needed.write.parquet(f"{path}/_checkpoints/{name}")
    if not create_new(spark, f"{path}/_checkpoints/{version:020d}.json", json.dumps({"folder": name}) + "\n"):
        delete(spark, f"{path}/_checkpoints/{name}")  # another was first, with the same lines
        return None
    return version


def drop_covered(spark: SparkSession, path: str, base: tuple[int, str]) -> None:
    """Deletes the records that the checkpoint ``base`` covers, and the checkpoints before it."""
    for name in files(spark, f"{path}/_commits"):
        if re.fullmatch(r"\d{20}\.json", name) and int(name[:20]) <= base[0]:
            delete(spark, f"{path}/_commits/{name}")
    for name in files(spark, f"{path}/_checkpoints"):
        if re.fullmatch(r"\d{20}\.json", name) and int(name[:20]) < base[0]:
            delete(spark, f"{path}/_checkpoints/{name}")
    for folder in folders(spark, f"{path}/_checkpoints", ""):
        if int(folder.rpartition("/")[2][:20]) <= base[0] and folder.rpartition("/")[2] != base[1].rpartition("/")[2]:
            delete(spark, folder)


def ranges_of(known: DataFrame) -> DataFrame:
    """(stream, start_offset, n, batch_id, attempt) of committed batches."""
    return known.where("kind = 'range'").select("stream", "start_offset", "n", "batch_id", "attempt")


def columns_of(known: DataFrame | list[dict] | None, *, but_batch: str | None = None) -> T.StructType | None:
    """The columns of all batches by their names, in the order in which they came; None where a batch's commit doesn't tell them."""
    if known is None:
        return None
    if isinstance(known, list):
        others = [r for r in known if r["batch_id"] != but_batch]
        told = {r["batch_id"] for r in others if r["kind"] == "columns"}
        if any(r["kind"] == "range" and r["batch_id"] not in told for r in others):
            return None
        first: dict[str, int] = {}
        for r in others:
            if r["kind"] == "columns":
                first[r["columns"]] = min(r["version"], first.get(r["columns"], r["version"]))
        return _all_columns(sorted(first, key=lambda c: (first[c], c)))
    told = known.where("kind = 'columns'").where(~F.col("batch_id").eqNullSafe(F.lit(but_batch)))
    if ranges_of(known).where(~F.col("batch_id").eqNullSafe(F.lit(but_batch))).join(told.select("batch_id"), "batch_id", "left_anti").take(1):
        return None
    return _all_columns([r["columns"] for r in told.groupBy("columns").agg(F.min("version").alias("first")).orderBy("first", "columns").collect()])  # one row a schema that the log has had


def _all_columns(schemas: list[str]) -> T.StructType:
    fields: dict[str, T.StructField] = {}
    for columns in schemas:
        for f in T.StructType.fromJson(json.loads(columns)).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))


def columns_line(batch: str, attempt: str, schema: T.StructType) -> dict:
    """The line that tells an attempt's columns, but for those that its folders give."""
    return {"kind": "columns", "batch_id": batch, "attempt": attempt, "columns": T.StructType([f for f in schema.fields if f.name not in _FOLDERS]).json()}


def write_blocks(rows: DataFrame, path: str, attempt: str) -> None:
    """The time index of an attempt's rows, from their stream, offset and time columns alone. Rows without times have none."""
    if "chunk_timestamp" not in rows.columns:
        return
    chunk = F.unix_micros("chunk_timestamp")
    time = F.unix_micros(F.coalesce("creation_time", "chunk_timestamp")) if "creation_time" in rows.columns else chunk
    each = rows.groupBy("stream", F.floor(F.col("offset") / BLOCK).alias("_block")).agg(
        F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi"), F.count(F.lit(1)).alias("n"),
        F.min(chunk).alias("least_chunk"), F.max(chunk).alias("most_chunk"), F.min(time).alias("least_time"), F.max(time).alias("most_time"),
    )
    each.drop("_block").write.parquet(f"{path}/_blocks/attempt={attempt}")


def blocks(spark: SparkSession, path: str) -> DataFrame | None:
    """(stream, lo, hi, n, least_chunk, most_chunk, least_time, most_time) of the committed blocks; times are micros. None if a committed batch has no index."""
    _, known = snapshot(spark, path)
    if known is None or not exists(spark, f"{path}/_blocks"):
        return None
    found = spark.read.schema(f"{_BLOCK}, attempt string").parquet(f"{path}/_blocks").join(ranges_of(known).select("attempt", "stream").distinct(), ["attempt", "stream"], "left_semi")
    indexed, whole = found.agg(F.sum("n")).first()[0], ranges_of(known).agg(F.sum("n")).first()[0]
    return found.drop("attempt") if indexed == whole else None


def committed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of committed batches, with ``stream`` and ``batch_id`` as the texts they are, and every column that a batch has; it is null in the others. A folder without commits is read as it lies."""
    _, known = snapshot(spark, path)
    told = columns_of(known)
    named = spark.read.parquet(path).schema if told is None else T.StructType([*told.fields, *(T.StructField(c, T.StringType()) for c in _FOLDERS)])
    texts = [T.StructField(f.name, T.StringType(), f.nullable) if f.name in _FOLDERS else f for f in named.fields]
    rows = spark.read.schema(T.StructType(texts)).parquet(path)
    if known is None:
        return rows
    attempts = ranges_of(known).select("attempt").distinct()
    few = [r[0] for r in attempts.limit(LITERAL_ATTEMPTS + 1).collect()]
    kept = rows.where(F.col("attempt").isin(few)) if len(few) <= LITERAL_ATTEMPTS else rows.join(attempts, "attempt", "left_semi")
    return kept.drop("attempt")
