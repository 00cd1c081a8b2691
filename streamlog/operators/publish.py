"""Writing: offsets, publishing ids, deduplication, and the append itself."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import payload_bytes, to_messages, wire_bytes
from ..shared import SETTLED_ROWS, delete, discard, exists, folders, materialise, settle
from .filters import with_filter_value
from ..sources.commits import columns_line, columns_of, commit, drop_covered, few_lines, latest_checkpoint, ranges_of, snapshot, write_blocks

#: How often an appender that others were ahead of begins again.
TRIES = 50
#: Offsets of a stream that one task writes in a row, and files where their rows are bounded.
WRITE_RUN, SMALL_FILES = 1_000_000, 25
#: Messages of a batch that one task numbers and writes, at most, and streams whose tails may stand in its plan.
SMALL_BATCH, SMALL_STREAMS = 20_000, 50
COMPRESSIONS = ("none", "gzip", "snappy", "lz4", "zstd")


def _bucket_counts(rows: DataFrame, stream: str, bucket: Column) -> DataFrame:
    return rows.groupBy(F.col(stream).alias("_s"), bucket.alias("_b")).agg(F.count("*").alias("_n"))


def assign_offsets(rows: DataFrame, *, order: Sequence[str], bucket: Column, tails: DataFrame | None = None, stream: str = "stream", offset: str = "offset", counts: DataFrame | None = None, bases: DataFrame | None = None) -> DataFrame:
    """Adds consecutive offsets per stream, in ``order``, from the stream's tail (0 without one).

    ``bucket`` must not fall as ``order`` rises, such as the day of the first key: rows are numbered inside (stream, bucket), and buckets by prefix sums of
    their counts, so no task holds a stream. ``order`` must be unique in a stream, else a retry may number ties anew. ``counts`` are rows by (stream, bucket)
    where they are known already, ``bases`` the first offset of each of them (``_s``, ``_b``, ``_base``), tails included.
    """
    starts = bases
    if starts is None:
        counts = _bucket_counts(rows, stream, bucket) if counts is None else counts
        base = F.coalesce(F.sum("_n").over(W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        starts = counts.select("_s", "_b", base.alias("_base"))
        if tails is not None:
            starts = starts.join(tails.select(F.col("stream").alias("_s"), "tail"), "_s", "left").withColumn("_base", F.col("_base") + F.coalesce("tail", F.lit(0))).drop("tail")
    cut = rows.withColumn("_bucket", bucket)
    here = cut.withColumn("_row", F.row_number().over(W.partitionBy(stream, "_bucket").orderBy(*order)) - 1)
    joined = here.join(starts, (F.col(stream) == F.col("_s")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return joined.withColumn(offset, (F.col("_base") + F.col("_row")).cast("long")).drop("_bucket", "_s", "_b", "_base", "_row")


def assign_publishing_ids(rows: DataFrame, *, producer: Column, order: Sequence[str], bucket: Column) -> DataFrame:
    """Consecutive ``publishing_id`` from 0 for each (producer, stream), by the same two passes as offsets."""
    keyed = rows.withColumn("_writer", F.struct(producer.alias("p"), F.col("stream").alias("s")))
    return assign_offsets(keyed, order=order, bucket=bucket, stream="_writer", offset="publishing_id").drop("_writer")


def check_publishing_ids(rows: DataFrame, *, order: Sequence[str], bucket: Column, producer: str = "producer") -> DataFrame:
    """(producer, violations): explicit ids that are negative, null or not above the one before in writing order.

    ``bucket`` must not fall as ``order`` rises: ids are compared inside (producer, bucket), and a bucket's first with the last of the bucket before.
    """
    bad = lambda i, before: i.isNull() | (i < 0) | (i <= F.coalesce(before, F.lit(-1)))
    cut = rows.select(F.col(producer), "publishing_id", F.struct(*order).alias("_at"), bucket.alias("_bucket"))
    w = W.partitionBy(producer, "_bucket").orderBy("_at")
    within = cut.select(producer, (bad(F.col("publishing_id"), F.lag("publishing_id").over(w)) & (F.row_number().over(w) > 1)).alias("_bad"))
    ends = cut.groupBy(producer, "_bucket").agg(F.min_by("publishing_id", "_at").alias("_first"), F.max_by("publishing_id", "_at").alias("_last"))
    between = ends.select(producer, bad(F.col("_first"), F.lag("_last").over(W.partitionBy(producer).orderBy("_bucket"))).alias("_bad"))
    return within.union(between).groupBy(producer).agg(F.count_if("_bad").alias("violations"))


def _orderable(field: T.StructField) -> Column:
    """A column, or what stands for it where maps keep it from being hashed."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        return F.map_entries(c)
    return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c


def dedup_publish(rows: DataFrame, stored: DataFrame, *, order: Sequence[str], producer: str = "producer") -> DataFrame:
    """Drops rows whose id is not above the highest stored for (producer, stream), and repeats of an id, of which the first in ``order`` stays.

    ``stored`` is (producer, stream, max_id). Rows without an id all stay. Which ids repeat is found first, from the id columns alone, so a hot producer isn't one task and whole rows are shuffled
    only where their id repeats; ties in ``order`` go by a hash of the row, in which maps count by their entries.
    """
    known = stored.select(F.col(producer).alias("_p"), F.col("stream").alias("_s"), "max_id")
    at = F.col("publishing_id")
    fresh = rows.join(known, (F.col(producer) == F.col("_p")) & (F.col("stream") == F.col("_s")), "left").where(F.col("max_id").isNull() | at.isNull() | (at > F.col("max_id"))).select(rows["*"])
    key = [F.col(producer).alias("_p"), F.col("stream").alias("_s"), at.alias("_i")]
    repeated = settle(fresh.where(at.isNotNull()).groupBy(*key).count().where("count > 1").drop("count"), "repeated-ids")
    of = F.col(producer).eqNullSafe(F.col("_p")) & F.col("stream").eqNullSafe(F.col("_s")) & (at == F.col("_i"))
    once = fresh.join(repeated, of, "left_anti")
    rank = F.struct(*order, F.xxhash64(*(_orderable(f) for f in rows.schema.fields)))
    first = fresh.join(repeated, of, "left_semi").groupBy(*key).agg(F.min_by(F.struct(*(f"`{c}`" for c in rows.columns)), rank).alias("_row"))
    return once.unionAll(first.select("_row.*"))


def producer_name(base: Column, *, partition: Column, query: Column | None = None, epoch: Column | None = None, task: Column | None = None) -> Column:
    """Streaming: base-q{query}-p{partition}-e{epoch}; batch: base-p{partition}-t{task}. Letters, digits, - and _ of the query id stay, the rest becomes _.

    No base, no name. Streaming without a query id fails, as does a name of over 255 characters.
    """
    if epoch is not None:
        scope = F.when(query.isNull() | (F.trim(query) == ""), F.raise_error(F.lit("deduplication in a stream needs a query id"))).otherwise(F.regexp_replace(query, r"[^\p{L}\p{Nd}_-]", "_"))
        name = F.concat(base, F.lit("-q"), scope, F.lit("-p"), partition.cast("string"), F.lit("-e"), epoch.cast("string"))
    else:
        name = F.concat(base, F.lit("-p"), partition.cast("string"), F.lit("-t"), task.cast("string"))
    checked = F.when(F.char_length(name) > 255, F.raise_error(F.lit("a producer name has 255 characters at most"))).otherwise(name)
    return F.when(F.trim(base) != "", checked)


def write_summary(messages: DataFrame, *, error: Column | None = None) -> DataFrame:
    """(stream, records, payload_bytes, wire_bytes, errors) of what was written."""
    failed = F.lit(False) if error is None else error
    return messages.groupBy("stream").agg(F.count("*").alias("records"), F.sum(payload_bytes(F.col("value"))).alias("payload_bytes"), F.sum(wire_bytes()).alias("wire_bytes"), F.count_if(failed).alias("errors"))


def observed(messages: DataFrame, name: str = "writes") -> tuple[DataFrame, Observation]:
    """``messages``, and what counts them as they pass: records, payload bytes and wire bytes in all, known once the frame has been written. No second pass over the rows."""
    seen = Observation(name)
    size = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return messages.observe(seen, F.count(F.lit(1)).alias("records"), size(payload_bytes(F.col("value"))).alias("payload_bytes"), size(wire_bytes()).alias("wire_bytes")), seen


class BatchChangedError(RuntimeError):
    """A batch that later ones follow was written again with other numbers of messages."""


class ConflictError(RuntimeError):
    """Other appenders were ahead every time."""


def recorded_bounds(spark: SparkSession, path: str) -> DataFrame | None:
    """(stream, first_offset, tail) of the log at ``path`` by its commits: one row a (stream, batch) is read, not the log. What isn't committed doesn't count; None before the first commit."""
    known = snapshot(spark, path)[1]
    return known and ranges_of(known).groupBy("stream").agg(F.min("start_offset").alias("first_offset"), F.max(F.col("start_offset") + F.col("n")).alias("tail"))


def stored_ids(spark: SparkSession, known: DataFrame | None, *, but_batch: str | None = None) -> DataFrame:
    """(producer, stream, max_id): the highest publishing ids by the commits of ``snapshot``."""
    if known is None:
        return spark.createDataFrame([], "producer string, stream string, max_id long")
    return known.where("kind = 'ids'").where(~F.col("batch_id").eqNullSafe(F.lit(but_batch))).groupBy("producer", "stream").agg(F.max("max_id").alias("max_id"))


def batch_name(batch_id: int | None, writer: str | None = None) -> str:
    """The folder of a batch: its number and whose number it is. Batches without a number get a name of their own."""
    if batch_id is None:
        return f"u{uuid.uuid4().hex}"
    return f"b{batch_id}" if writer is None else f"q{re.sub(r'[^0-9A-Za-z_-]', '_', writer)}-b{batch_id}"


def _stream_sizes(counts: DataFrame | pa.Table) -> dict[str, int]:
    """Messages of each stream: one row a stream."""
    if isinstance(counts, pa.Table):
        sums = counts.group_by("_s").aggregate([("_n", "sum")])
        return dict(zip(sums["_s"].to_pylist(), sums["_n_sum"].to_pylist(), strict=True))
    return {r["_s"]: r["n"] for r in counts.groupBy("_s").agg(F.sum("_n").alias("n")).collect()}


def _places(known: DataFrame | list[dict], batch: str, streams: Sequence[str]) -> tuple[dict[str, int], dict[str, tuple[int, int]]]:
    """Tails of other batches in ``streams``, and (start, n) of this one's own streams."""
    if isinstance(known, list):
        tails: dict[str, int] = {}
        own = {}
        for r in known:
            if r["kind"] == "range" and r["batch_id"] == batch:
                own[r["stream"]] = (r["start_offset"], r["n"])
            elif r["kind"] == "range":
                tails[r["stream"]] = max(tails.get(r["stream"], 0), r["start_offset"] + r["n"])
        return tails, own
    lies = ranges_of(known)
    own = {r["stream"]: (r["start_offset"], r["n"]) for r in lies.where(F.col("batch_id") == batch).collect()}  # one row a stream
    wanted = known.sparkSession.createDataFrame([(x,) for x in {*streams, *own}], "stream string")
    others = lies.where(F.col("batch_id") != batch).join(wanted, "stream", "left_semi").groupBy("stream").agg(F.max(F.col("start_offset") + F.col("n")).alias("tail"))
    return {r["stream"]: r["tail"] for r in others.collect()}, own


def _starts(known: DataFrame | list[dict] | None, batch: str, sizes: dict[str, int]) -> list[Row]:
    """(stream, start_offset, n): where this batch goes in each of its streams, one row a stream. A batch that is there already keeps its place."""
    tails, own = ({}, {}) if known is None else _places(known, batch, list(sizes))
    for stream, (start, before) in own.items():
        now = sizes.get(stream)
        if now != before and (now is None or tails.get(stream, 0) > start):
            raise BatchChangedError(f"batch {batch} had {before} messages of stream {stream!r}, now it has {now or 0}")
    return [Row(stream=x, start_offset=own[x][0] if x in own else tails.get(x, 0), n=n) for x, n in sizes.items() if n]


def _bases(counts: pa.Table, starts: list[Row]) -> pa.Table | None:
    """The first offset of each (stream, bucket); None for buckets of a kind that Arrow orders differently from Spark."""
    kind = counts["_b"].type
    if not (pa.types.is_integer(kind) or pa.types.is_temporal(kind) or pa.types.is_string(kind)):
        return None
    ordered = counts.sort_by([("_s", "ascending"), ("_b", "ascending")])
    nulls = ordered["_b"].is_null()
    ordered = pa.concat_tables([ordered.filter(nulls), ordered.filter(pc.invert(nulls))])  # as Spark does, null comes first
    at, base = {r["stream"]: r["start_offset"] for r in starts}, []
    for stream, n in zip(ordered["_s"].to_pylist(), ordered["_n"].to_pylist(), strict=True):
        base.append(at[stream])
        at[stream] += n
    return ordered.drop_columns(["_n"]).append_column("_base", pa.array(base, pa.int64()))


def _placed(messages: DataFrame, counts: DataFrame | pa.Table, starts: list[Row], schema: T.StructType, *, order: Sequence[str], bucket: Column) -> DataFrame:
    """Messages with their offsets, by counts of (stream, bucket) and where each stream starts."""
    spark, bases = messages.sparkSession, None
    tails = spark.createDataFrame([(r["stream"], r["start_offset"]) for r in starts], "stream string, tail long")
    if isinstance(counts, pa.Table):
        bases = _bases(counts, starts)
        counts = spark.createDataFrame(counts, schema=schema)
        bases = bases if bases is None else spark.createDataFrame(bases, schema=T.StructType([*schema.fields[:2], T.StructField("_base", T.LongType())]))
    return assign_offsets(messages, order=order, bucket=bucket, tails=tails, counts=counts, bases=bases)


def _fits(given: T.StructType, known: T.StructType | None) -> None:
    """A log's column has one type. Batches may have other columns than those before."""
    types = {} if known is None else {f.name: f.dataType.simpleString() for f in known.fields}
    for f in given.fields:
        if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
            raise ValueError(f"column {f.name!r} is {types[f.name]} in the log, not {f.dataType.simpleString()}")


def _is_sealed(known: DataFrame | list[dict] | None, batch: str, sizes: dict[str, int]) -> bool:
    """Whether ``compact`` has merged this batch with others: it is there already. Other numbers of messages fail, but for none at all, as where all of them are known repeats."""
    sealed: dict[str, int] = {}
    if isinstance(known, list):
        for r in known:
            if r["kind"] == "sealed" and r["batch_id"] == batch:
                sealed[r["stream"]] = sealed.get(r["stream"], 0) + r["n"]
    elif known is not None:
        sealed = {r["stream"]: r["n"] for r in known.where("kind = 'sealed'").where(F.col("batch_id") == batch).groupBy("stream").agg(F.sum("n").alias("n")).collect()}
    if not sealed:
        return False
    if sizes and sizes != sealed:
        raise BatchChangedError(f"batch {batch} was merged with others; it had {sum(sealed.values())} messages, now it has {sum(sizes.values())}, or others of a stream")
    return True


def _tails_for_small(known: DataFrame | list[dict] | None, batch: str) -> dict[str, int] | None:
    """The tails of all streams, if a batch is new and follows a small one of the same writer: it is probably small as well. Else None."""
    number = re.fullmatch(r"(.*b)(\d+)", batch)
    if number is None or not isinstance(known, list) or any(r["batch_id"] == batch for r in known):
        return None
    before = f"{number[1]}{int(number[2]) - 1}"
    n = sum(r["n"] for r in known if r["kind"] == "range" and r["batch_id"] == before)
    tails = _places(known, batch, ())[0]
    return tails if 0 < n <= SMALL_BATCH and len(tails) <= SMALL_STREAMS else None


def _write_if_small(messages: DataFrame, tails: dict[str, int], folder: str, *, order: Sequence[str], bucket: Column, compression: str, file_records: int | None) -> tuple[dict[str, int], T.StructType] | None:
    """Numbers and writes a batch in one job, which counts its messages by stream as they pass: their numbers, and the columns written. None, and nothing written, where it isn't small after all.

    The offsets are those of ``assign_offsets``: a stream's few rows are numbered in one go, from tails that stand in the plan.
    """
    each, base = W.partitionBy("stream"), F.lit(0)
    if tails:
        base = F.coalesce(F.create_map(*(c for x, tail in tails.items() for c in (F.lit(x), F.lit(tail).cast("long"))))[F.col("stream")], base)
    place = (base + F.row_number().over(each.orderBy(bucket, *order)) - 1).cast("long").alias("offset")
    names = messages.columns
    columns = [place if c == "offset" else f"`{c}`" for c in names] + ([] if "offset" in names else [place])
    few = messages.limit(SMALL_BATCH + 1).select(*columns, F.count(F.lit(1)).over(each).alias("_n"))
    seen = Observation()
    placed = few.observe(seen, F.collect_set(F.struct("stream", "_n")).alias("sizes")).drop("_n")  # one row a stream
    _write(placed, folder, compression, file_records)
    sizes = {r["stream"]: r["_n"] for r in seen.get["sizes"]}
    if sum(sizes.values()) <= SMALL_BATCH and None not in sizes:
        return sizes, placed.schema
    delete(messages.sparkSession, folder)
    return None


def _write(placed: DataFrame, folder: str, compression: str, file_records: int | None) -> None:
    """Writes numbered messages, each partition's by stream and offset. A commit tells that they are whole, so no file marks it."""
    out = placed.sortWithinPartitions("stream", "offset").write.option("compression", compression).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if "filter_value" in placed.columns:  # a file without a value is skipped by its dictionary or its Bloom filter
        out = out.option("parquet.bloom.filter.enabled#filter_value", "true").option("parquet.bloom.filter.expected.ndv#filter_value", 10_000)
    if file_records:
        out = out.option("maxRecordsPerFile", file_records)
    out.partitionBy("stream").parquet(folder)


def _lines(spark: SparkSession, path: str) -> tuple[int, DataFrame | list[dict] | None]:
    """The snapshot, as rows where this driver knows the log and its commits are few: an append to it then runs no job over them."""
    few = few_lines(spark, path)
    return snapshot(spark, path) if few is None else (few[0], few[1] or None)


def _commit_batch(
    spark: SparkSession, path: str, batch: str, build: Callable[[DataFrame | None], DataFrame], *, order: Sequence[str], bucket: Column, compression: str, file_records: int | None, ids: bool = False
) -> None:
    """Writes what ``build`` makes of the commits so far, and commits it. Where another appender was ahead, the rows stay as they are if it wrote to other streams; else all is done again."""
    for _ in range(TRIES):
        version, known = _lines(spark, path)
        messages = build(snapshot(spark, path)[1] if ids else None)
        _fits(messages.schema, columns_of(known, but_batch=batch))
        attempt = uuid.uuid4().hex
        folder = f"{path}/batch_id={batch}/attempt={attempt}"
        tails = None if ids else _tails_for_small(known, batch)
        small = None if tails is None else _write_if_small(messages, tails, folder, order=order, bucket=bucket, compression=compression, file_records=file_records)
        if small is not None:
            sizes, schema = small
            starts = _starts(known, batch, sizes)
            if not starts:
                delete(spark, folder)
                return
        else:
            counted = _bucket_counts(messages, "stream", bucket)
            few = counted.limit(SETTLED_ROWS + 1).toArrow()
            counts = few if few.num_rows <= SETTLED_ROWS else materialise(counted, "append-counts")
            sizes = _stream_sizes(counts)
            if _is_sealed(known, batch, sizes):
                return
            starts = _starts(known, batch, sizes)
            if not starts:
                return
            placed = _placed(messages, counts, starts, counted.schema, order=order, bucket=bucket)
            schema = placed.schema
            run = max(file_records, WRITE_RUN // file_records * file_records) if file_records else WRITE_RUN  # whole files, and many tasks where files are small
            run = min(run, SMALL_FILES * file_records) if file_records else run
            _write(placed.repartition("stream", F.floor(F.col("offset") / run)), folder, compression, file_records)
        if "chunk_timestamp" in schema.names:
            write_blocks(spark.read.schema(schema).parquet(folder), path, attempt)
        lines = [{"kind": "range", "batch_id": batch, "attempt": attempt, "stream": r["stream"], "start_offset": r["start_offset"], "n": r["n"]} for r in starts]
        lines.append(columns_line(batch, attempt, schema))
        if ids:
            found = messages.where("publishing_id is not null").groupBy("producer", "stream").agg(F.max("publishing_id").alias("max_id")).collect()  # one row a stream
            lines += [{"kind": "ids", "batch_id": batch, "attempt": attempt, **r.asDict()} for r in found]
        while not commit(spark, path, version + 1, lines):
            version, known = _lines(spark, path)
            if ids or sorted(_starts(known, batch, sizes)) != sorted(starts):
                break
        else:
            if known is not None:
                before = {r["attempt"] for r in known if r["batch_id"] == batch} if isinstance(known, list) else {r[0] for r in known.where(F.col("batch_id") == batch).select("attempt").distinct().collect()}
                for gone in before - {attempt}:
                    for old in (f"{path}/batch_id={batch}/attempt={gone}", f"{path}/_blocks/attempt={gone}"):
                        delete(spark, old)
            return
        delete(spark, folder)
        delete(spark, f"{path}/_blocks/attempt={attempt}")
    raise ConflictError(f"batch {batch}: other appenders were ahead {TRIES} times")


def append_log(
    messages: DataFrame, path: str, *, mode: str = "append", stream: str | None = None, order: Sequence[str], bucket: Column, compression: str = "none",
    batch_id: int | None = None, writer: str | None = None, file_records: int | None = None, filter_path: str | None = None,
) -> None:
    """Appends messages (with a ``stream`` column) to the log at ``path``: Parquet by batch, attempt and stream, sorted by offset inside files.

    Only ``append`` is allowed. With ``stream`` every row must be of that stream. ``writer`` tells whose number ``batch_id`` is: writers of one log, such as several
    streaming queries, don't replace each other's batches. A batch is there once it is committed (see ``sources.commits``): one that fails leaves nothing that a reader sees and no gap.
    One that is written again takes the offsets it had and replaces itself; it must have as many messages of each stream as before, unless it is the stream's last
    (``BatchChangedError``). Several appenders may write at once: who comes second takes the offsets behind the first, and does its work again only where both wrote to
    a stream. ``file_records`` bounds the rows of a file. With ``filter_path`` the value there is stored as ``filter_value`` (see ``filters.stored_values``). Columns named batch_id, attempt, or with a leading underscore are the log's own.
    """
    _checked(mode, compression)
    if stream is not None:
        given = F.col("stream")
        messages = messages.withColumn("stream", F.when(given.isNotNull() & (given != stream), F.raise_error(F.concat(F.lit(f"rows for {stream} hold stream "), given))).otherwise(F.lit(stream)))
    messages = messages if filter_path is None else with_filter_value(messages, filter_path)
    _commit_batch(messages.sparkSession, path, batch_name(batch_id, writer), lambda _: messages, order=order, bucket=bucket, compression=compression, file_records=file_records)


def _checked(mode: str, compression: str) -> None:
    if mode != "append":
        raise ValueError(f"a log can only be appended to, not {mode!r}")
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}")


def publish_rows(
    rows: DataFrame, path: str, *, route: Callable[[DataFrame], DataFrame] | None = None, producer: str | None = None, order: Sequence[str], bucket: Column, ignore_unknown: bool = False,
    chunk_timestamp: Column | None = None, mode: str = "append", compression: str = "none", batch_id: int | None = None, writer: str | None = None, file_records: int | None = None,
    filter_path: str | None = None,
) -> None:
    """The sink in one call: rows of the sink schema are checked, made messages, routed, rid of what ``producer`` has published before, and appended.

    ``order`` and ``bucket`` are of message columns. ``route`` takes messages and returns them with ``stream`` (``route_hash``, ``route_key``); without it rows name
    their stream. With ``producer`` rows are deduplicated by ``publishing_id``, against the ids that the log's commits hold as well: the same rows published again add
    nothing, also where two publish them at once, and a failure in between publishes them once. ``chunk_timestamp`` is the time of appending by default; ``filter_path`` is that of ``append_log``, in the messages.
    """
    _checked(mode, compression)
    spark, batch = rows.sparkSession, batch_name(batch_id, writer)
    messages = to_messages(rows, ignore_unknown=ignore_unknown)
    messages = messages.withColumn("chunk_timestamp", F.current_timestamp() if chunk_timestamp is None else chunk_timestamp)
    messages = messages if route is None else route(messages.drop("stream"))
    messages = messages if filter_path is None else with_filter_value(messages, filter_path)
    held = materialise(messages, "publish")  # read several times below
    made = []

    def build(known: DataFrame | None) -> DataFrame:
        if producer is None:
            return held
        made.append(materialise(dedup_publish(held.withColumn("producer", F.lit(producer)), stored_ids(spark, known, but_batch=batch), order=order), "publish"))
        return made[-1]

    _commit_batch(spark, path, batch, build, order=order, bucket=bucket, compression=compression, file_records=file_records, ids=producer is not None)
    for table in (held, *made):
        discard(table)


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes what attempts left that were never committed or that others have replaced, and the commit records that a checkpoint covers; returns how many attempts there were. Not while an
    append is running, whose rows are such an attempt until it commits, nor while reads are that began before the last compaction."""
    base, (_, known) = latest_checkpoint(spark, path), snapshot(spark, path)
    kept = set() if known is None else {r[0] for r in ranges_of(known).select("attempt").distinct().collect()}  # one a batch
    gone = 0
    for batch in folders(spark, path, "batch_id="):
        attempts = folders(spark, batch, "attempt=")
        left = [a for a in attempts if a.rpartition("=")[2] not in kept]
        for folder in left if len(left) < len(attempts) else [batch]:
            delete(spark, folder)
        gone += len(left)
    if exists(spark, f"{path}/_blocks"):
        for attempt in folders(spark, f"{path}/_blocks", "attempt="):
            if attempt.rpartition("=")[2] not in kept:
                delete(spark, attempt)
    if base is not None:
        drop_covered(spark, path, base)
    return gone
