"""Columnar word and shingle hashing over Arrow string arrays."""

from __future__ import annotations

import ctypes
import functools
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; bounds a worker's memory whatever the batch size is.
SLICE_BYTES = 2 << 20
WORD_SEPARATORS = "\t\n\v\f\r"
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def release() -> None:
    """Gives free memory of Arrow's pool and of the C library back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


#: A task gives free memory back so often, in seconds; rarely enough that it costs nothing.
RELEASE_S = 0.5


def tidy(run: Callable) -> Callable:
    """A task's function that gives its memory back, between batches and at the end: workers go on to other tasks, and those of a whole pipeline would add up.

    What it holds isn't searched for cycles meanwhile: it makes none, and large tables of words would be walked over and over.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            last = time.monotonic()
            for out in run(batches):
                yield out
                if time.monotonic() - last > RELEASE_S:
                    release()
                    last = time.monotonic()
        finally:
            gc.enable()
            gc.collect()
            release()

    return wrapped


#: Rows of an Arrow batch where texts are long; Spark's default is made for short rows.
BATCH_ROWS = 2000


def short_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches of texts small, unless the session has a setting of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def uniform(hashed: Column) -> Column:
    """A 64-bit hash as a number from 0 to 1, of 53 bits: shares as small as 10^-15 still take their part."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows with about ``limit`` bytes of text each (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _lists(split: pa.Array) -> tuple[np.ndarray, pa.Array]:
    offsets = split.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], split.flatten()


def words_of(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row offsets and the words ``[^\\x20\\x09-\\x0D]+`` of all rows; a null text has none."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    for c in WORD_SEPARATORS:
        text = pc.replace_substring(text, c, " ")
    offsets, words = _lists(pc.split_pattern(text, " "))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = np.concatenate([[0], np.cumsum(real)])
    return counts[offsets], words.filter(pa.array(real))


def shingle_sets(text: pa.Array, width: int) -> list[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its shingles of ``width`` words, A-Z lower-cased.

    A text of fewer words is one shingle; a text without words has none.
    """
    offsets, words = words_of(pc.ascii_lower(text.cast(pa.string())))
    encoded = words.dictionary_encode()
    if len(encoded.dictionary) == 0:
        return [np.empty(0, np.uint64)] * len(text)
    each = pd.util.hash_array(encoded.dictionary.to_pandas().to_numpy(object), categorize=False)
    hashes = each[encoded.indices.to_numpy()]
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = mix(rolled * _M1 + hashes[k : len(hashes) - width + 1 + k]) if len(rolled) else rolled
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            h = np.array([b - a], np.uint64)
            for x in hashes[a:b]:
                h = mix(h * _M1 + x)
            out.append(h)
        else:
            out.append(np.empty(0, np.uint64))
    return out
