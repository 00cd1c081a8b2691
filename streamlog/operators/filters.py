"""Keeping rows by message attributes, custom predicates and offsets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import value_at_path
from .ranges import within_ranges


def keep_by_value(value: Column, values: Sequence[str], *, match_unfiltered: bool = False) -> Column:
    """True where the value is among ``values``; rows without a value as ``match_unfiltered`` says."""
    if not values:
        raise ValueError("filter values are required")
    return F.coalesce(value.isin(*values), F.lit(match_unfiltered))


def filter_values(rows: DataFrame, path: str, values: Sequence[str], *, match_unfiltered: bool = False) -> DataFrame:
    return rows.where(keep_by_value(value_at_path(path), values, match_unfiltered=match_unfiltered))


def stored_values(rows: DataFrame, values: Sequence[str], *, match_unfiltered: bool = False) -> DataFrame:
    """``filter_values`` by the ``filter_value`` column that a sink stored: a predicate that reaches the scan, so files and row groups without the values aren't read."""
    if not values:
        raise ValueError("filter values are required")
    stored = F.col("filter_value")
    return rows.where(stored.isin(*values) | stored.isNull() if match_unfiltered else stored.isin(*values))


def post_filter(rows: DataFrame, predicate: Callable[[DataFrame], Column] | Column, *, path: str | None = None, values: Sequence[str] = (), match_unfiltered: bool = False) -> DataFrame:
    """A custom predicate, which counts only where filter values are set and then takes the place of the path filter. No values: no filter."""
    if not values:
        return rows
    if predicate is None:
        return filter_values(rows, path, values, match_unfiltered=match_unfiltered)
    return rows.where(predicate(rows) if callable(predicate) else predicate)


def filter_report(rows: DataFrame, keep: Column) -> DataFrame:
    """(stream, kept, dropped, next_offset): dropped rows still move a stream's progress on."""
    return rows.groupBy("stream").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"), (F.max("offset") + 1).alias("next_offset"))


def dedup_offsets(rows: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Rows inside their stream's range, each offset once. ``ranges`` has one row a stream."""
    return (rows if ranges is None else within_ranges(rows, ranges)).dropDuplicates(["stream", "offset"])


def with_filter_value(rows: DataFrame, path: str | None = None, *, extractor: Column | None = None) -> DataFrame:
    """Stamps ``filter_value`` at write time, so a later filter on it reaches the scan."""
    if (path is None) == (extractor is None):
        raise ValueError("give a path or an extractor")
    return rows.withColumn("filter_value", extractor if path is None else value_at_path(path))
