"""How much of each stream a batch takes: budgets over range frames, and the batches they cut a log into."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..options import LimitOptions, seconds
from .ranges import locate


def grants(span: np.ndarray, budget: int, rotation: int = 0) -> np.ndarray:
    """How many records each stream gets of a budget: even shares in rounds, never beyond a stream's span, what is left over shared again.

    In a round the remainder goes, one each, to the streams from place ``rotation`` on; a budget below the number of streams is one such remainder.
    """
    span = np.maximum(np.asarray(span, np.int64), 0)
    if budget >= span.sum():
        return span
    out, left, live = np.zeros_like(span), max(budget, 0), np.flatnonzero(span)
    while left and len(live):
        share, rest = divmod(left, len(live))
        turn = (np.arange(len(live)) - rotation) % len(live)
        give = np.minimum(share + (turn < rest), span[live] - out[live])
        out[live] += give
        if not share:
            break
        left -= int(give.sum())
        live = live[out[live] < span[live]]
    return out


def _ends(budget: int, rotation: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("stream", ignore_index=True)
        ends = pdf.start_offset + grants((pdf.end_offset - pdf.start_offset).to_numpy(), budget, rotation)
        return pd.DataFrame({"stream": pdf.stream, "start_offset": pdf.start_offset, "end_offset": ends})

    return run


def budget_ranges(ranges: DataFrame, *, max_records: int | None = None, max_bytes: int | None = None, size_estimate: int = 1024, rotation: int = 0) -> DataFrame:
    """Range frame -> range frame cut down to a budget of records, of bytes at an estimated size a record, or to the tighter of both.

    One row a stream is grouped; streams count by name. Budgets of zero or less take nothing; a byte budget below one record takes one.
    """
    by = []
    if max_records is not None:
        by.append(ranges.groupBy().applyInPandas(_ends(max_records, rotation), "stream string, start_offset long, end_offset long"))
    if max_bytes is not None:
        records = max(1, max_bytes // max(1, size_estimate)) if max_bytes > 0 else 0
        by.append(ranges.groupBy().applyInPandas(_ends(records, rotation), "stream string, start_offset long, end_offset long"))
    if not by:
        return ranges.select("stream", "start_offset", "end_offset")
    return by[0] if len(by) == 1 else most_restrictive(*by)


def most_restrictive(a: DataFrame, b: DataFrame) -> DataFrame:
    """The smaller end of each stream in either frame."""
    both = a.select("stream", "start_offset", "end_offset").unionByName(b.select("stream", "start_offset", "end_offset"))
    return both.groupBy("stream").agg(F.min("start_offset").alias("start_offset"), F.min("end_offset").alias("end_offset"))


_PHASES = "stream string, batch_no long, batches long, streams long, place long, share long, rest long, start_offset long, end_offset long"


def _segments(streams, place, rest):
    """A cycle of k batches in three runs (length, extra): in ``rest`` of them, up to the one at ``place`` and around the cycle, a stream takes one record more than its share."""
    low = place - rest + 1
    wraps = low < 0
    pick = (lambda c, x, y: F.when(c, x).otherwise(y)) if isinstance(place, Column) else np.where
    return [(pick(wraps, place + 1, low), pick(wraps, 1, 0)), (pick(wraps, streams + low - place - 1, rest), pick(wraps, 0, 1)), (pick(wraps, -low, streams - place - 1), pick(wraps, 1, 0))]


def _taken(batches, streams, place, share, rest):
    """What a stream has taken after so many batches of its phase."""
    least, most = (F.least, F.greatest) if isinstance(place, Column) else (np.minimum, np.maximum)
    zero = F.lit(0) if isinstance(place, Column) else 0
    cycles, left = (F.floor(batches / streams), batches % streams) if isinstance(place, Column) else np.divmod(batches, streams)
    out = cycles * (share * streams + rest) + left * share
    for length, extra in _segments(streams, place, rest):
        out = out + most(zero, least(left, length)) * extra
        left = left - length
    return out


def _batch_at(past, streams, place, share, rest):
    """The batch of its phase, from 0, that takes a stream's record number ``past`` of the phase."""
    columns = isinstance(place, Column)
    cycle = share * streams + rest
    at, left = (F.floor(past / cycle) * streams, past % cycle) if columns else (past // cycle * streams, past % cycle)
    found = F.lit(None).cast("long") if columns else np.full(len(past), -1)
    for length, extra in _segments(streams, place, rest):
        rate = share + extra
        if columns:
            found = F.when(found.isNull() & (left >= 0) & (left < length * rate), at + F.floor(left / rate)).otherwise(found)
        else:
            found = np.where((found < 0) & (left >= 0) & (left < length * rate), at + left // np.maximum(rate, 1), found)
        at, left = at + length, left - length * rate
    return found


def _phases(budget: int):
    """Runs of batches, one row a (stream, phase): while no stream ends, each of k streams takes ``budget // k`` records or one more a batch, so the batch in which the first of them
    ends follows by division. A batch that cuts a stream short is a phase of its own. There are two phases a stream at most."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("stream", ignore_index=True)
        names, at, end, batch = pdf.stream.to_numpy(), pdf.start_offset.to_numpy(np.int64).copy(), pdf.end_offset.to_numpy(np.int64), 0
        out: list[pd.DataFrame] = []

        def emit(s: np.ndarray, batches: int, streams: int, place, share, rest, took: np.ndarray) -> None:
            some = took > 0
            each = {"stream": names[s], "batch_no": batch, "batches": batches, "streams": streams, "place": place, "share": share, "rest": rest, "start_offset": at[s], "end_offset": at[s] + took}
            out.append(pd.DataFrame(each)[some])

        while len(live := np.flatnonzero(at < end)):
            k, left = len(live), (end - at)[live]
            share, rest = divmod(budget, k)
            place = (np.arange(k) - batch) % k
            reached = _batch_at(left - 1, k, place, share, rest) + 1
            full = int((reached - (_taken(reached, k, place, share, rest) > left)).min())
            if full:
                took = _taken(np.full(k, full), k, place, share, rest)
                emit(live, full, k, place, share, rest, took)
            else:
                took = grants(left, budget, batch) if k == len(at) else grants(end - at, budget, batch)[live]
                emit(live, 1, 1, 0, took, 0, took)
            at[live] += took
            batch += full or 1
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in _PHASES.split(", ")])

    return run


def _batch_phases(ranges: DataFrame, max_records: int) -> DataFrame:
    return ranges.groupBy().applyInPandas(_phases(max_records), _PHASES)


_PHASE = ("streams", "place", "share", "rest")


def plan_batches(ranges: DataFrame, *, max_records: int) -> DataFrame:
    """(stream, batch_no, start_offset, end_offset): budget after budget from start to end, the rotation moving on with each batch.

    One task sees the range frame and finds the phases between the streams' ends; the batches inside a phase follow by arithmetic, wherever Spark puts them.
    """
    LimitOptions(max_records=max_records)
    each = _batch_phases(ranges, max_records).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1)))
    upto = lambda n: (F.col("start_offset") + _taken(n, *map(F.col, _PHASE))).cast("long")
    cut = each.select("stream", (F.col("batch_no") + F.col("i")).alias("batch_no"), upto(F.col("i")).alias("start_offset"), upto(F.col("i") + 1).alias("end_offset"))
    return cut.where("start_offset < end_offset")


def micro_batches(log: DataFrame, ranges: DataFrame, *, max_records: int, min_records: int | None = None, max_delay: str | float = "15m", now_us: int | None = None) -> DataFrame:
    """The log's rows in ``ranges`` with the batch each falls into.

    With ``min_records`` the last batch, if it is smaller, is held back, unless its oldest message is older than ``max_delay`` at ``now_us``.
    """
    LimitOptions(max_records=max_records, min_records=min_records, max_delay=max_delay)
    met = locate(log, _batch_phases(ranges, max_records))
    batch = F.col("batch_no") + _batch_at(F.col("offset") - F.col("range_start"), *map(F.col, _PHASE))
    rows = met.withColumn("batch_no", batch.cast("long")).drop("batches", *_PHASE, "range_start")
    if min_records is None:
        return rows
    size = rows.groupBy("batch_no").agg(F.count("*").alias("n"), F.min(F.unix_micros("chunk_timestamp")).alias("oldest"))
    waited = F.lit(False) if now_us is None else F.col("oldest") < now_us - int(seconds(max_delay) * 1e6)
    due = size.where((F.col("n") >= min_records) | waited).select("batch_no")
    return rows.join(due, "batch_no", "left_semi")


def avg_message_size(rows: DataFrame, *, by: Column | str = "batch_no", value: str = "value") -> DataFrame:
    """(by, avg_size): whole bytes of payload a record, 1 at least."""
    mean = F.floor(F.sum(F.coalesce(F.octet_length(value), F.lit(0))) / F.count("*"))
    return rows.groupBy(by).agg(F.greatest(F.lit(1), mean).cast("long").alias("avg_size"))


def fair_limit(log: DataFrame, n: int) -> DataFrame:
    """The first n rows when streams take turns, each in offset order, ties by stream.

    A row's turn is its place among the rows of its stream, whatever offsets are missing. Only a stream's first n rows count, which Spark finds in each
    task before they are shuffled (a window group limit), so no task gets more than n rows of a stream from another.
    """
    turn = F.row_number().over(W.partitionBy("stream").orderBy("offset"))
    return log.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", "stream").limit(n).drop("turn")
