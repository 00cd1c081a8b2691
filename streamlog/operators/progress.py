"""Offsets as text, progress tables, lag and read metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import payload_bytes, wire_bytes


def offsets_to_json(offsets: DataFrame, *, by: Column | None = None) -> DataFrame:
    """(stream, next_offset) rows -> one JSON object, keys in order; ``by`` makes one for each of its values. One row a stream is gathered."""
    entries = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("stream", "next_offset")))))
    return (offsets.groupBy(by) if by is not None else offsets.groupBy()).agg(entries.alias("offsets"))


def offsets_from_json(texts: DataFrame, column: str = "offsets", *, keep: Sequence[str] = ()) -> DataFrame:
    """JSON objects -> (stream, next_offset), after the columns in ``keep``. Blank or broken text, text after the object, repeated keys and negative offsets fail the job."""
    text = F.col(column)
    member = r'\s*"((?:[^"\\]|\\.)*)"\s*:\s*[0-9]+\s*'
    shaped = text.rlike(rf"^\s*\{{(?:{member}(?:,{member})*|\s*)\}}\s*$")
    keys = F.regexp_extract_all(text, F.lit(r'"((?:[^"\\]|\\.)*)"\s*:'), F.lit(1))
    parsed = F.from_json(text, "map<string,bigint>")
    fine = F.coalesce(shaped, F.lit(False)) & (F.size(keys) == F.size(F.array_distinct(keys))) & (F.size(parsed) == F.size(keys))
    checked = F.when(fine, parsed).otherwise(F.raise_error(F.concat(F.lit("not an offset map: "), F.coalesce(text, F.lit("null")))).cast("map<string,bigint>"))
    return texts.select(*keep, F.explode(checked).alias("stream", "next_offset"))


def merge_progress(reports: DataFrame) -> DataFrame:
    """The furthest next offset of each stream."""
    return reports.groupBy("stream").agg(F.max("next_offset").alias("next_offset"))


def record_progress(ends: DataFrame, recorded: DataFrame) -> DataFrame:
    """(stream, last_processed) to append to a progress table: one below the next offset, where that is above 0 and has changed. The table is never read for starts."""
    now = ends.select("stream", (F.col("next_offset") - 1).alias("last_processed")).where("last_processed > 0")
    before = recorded.groupBy("stream").agg(F.max("last_processed").alias("before"))
    return now.join(before, "stream", "left").where("before is null or before <> last_processed").drop("before")


def lag_metrics(bounds: DataFrame, consumed: DataFrame) -> DataFrame:
    """(min_lag, max_lag, avg_lag): messages behind the tail over all streams; a stream not consumed is behind by all; the mean to one decimal."""
    behind = bounds.join(consumed, "stream", "left").select(F.greatest(F.lit(0), F.col("tail") - F.coalesce("next_offset", F.lit(0))).alias("lag"))
    return behind.agg(F.min("lag").alias("min_lag"), F.max("lag").alias("max_lag"), F.round(F.avg("lag"), 1).alias("avg_lag"))


def read_metrics(rows: DataFrame, ranges: DataFrame, bounds: DataFrame) -> DataFrame:
    """(stream, records, payload_bytes, wire_bytes, out_of_range, data_loss) of what a read met, for every stream with a range; ``data_loss`` counts offsets that were gone.

    ``ranges`` and ``bounds`` have one row a stream; a stream without bounds has lost its whole range.
    """
    measured = rows.select("stream", "offset", payload_bytes(F.col("value")).alias("payload"), wire_bytes().alias("wire"))
    first = F.coalesce("first_offset", F.col("end_offset"))
    asked = ranges.join(bounds, "stream", "left").select("stream", "start_offset", "end_offset", F.greatest(F.lit(0), F.least(first, "end_offset") - F.col("start_offset")).alias("data_loss"))
    inside = (F.col("offset") >= F.col("start_offset")) & (F.col("offset") < F.col("end_offset"))
    kept = lambda c: F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0))
    met = measured.join(asked, "stream").groupBy("stream").agg(F.count_if(inside).alias("records"), kept("payload").alias("payload_bytes"), kept("wire").alias("wire_bytes"), F.count_if(~inside).alias("out_of_range"))
    return asked.select("stream", "data_loss").join(met, "stream", "left").na.fill(0)
