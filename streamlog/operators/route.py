"""Which partition streams a row goes to: by hash, by binding key, or by a rule of one's own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class RoutingKeyError(ValueError):
    """A row has no routing key."""


def routing_key() -> Column:
    """The application property, else the subject."""
    return F.coalesce(F.col("application_properties")["routing_key"], F.col("properties.subject"))


def _required(key: Column) -> Column:
    return F.when(key.isNull() | (key == ""), F.raise_error(F.lit("a routing key is required"))).otherwise(key)


def murmur3_32(keys: list[str], seed: int = 104729) -> np.ndarray:
    """Standard 32-bit MurmurHash3 (x86) of UTF-8 texts, over all keys of a length at once."""
    c1, c2, raw = np.uint32(0xCC9E2D51), np.uint32(0x1B873593), [k.encode() for k in keys]
    sizes = np.array([len(r) for r in raw])
    out = np.zeros(len(raw), np.uint32)
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        data = np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(len(at), size)
        h, whole = np.full(len(at), seed, np.uint32), size // 4 * 4
        for k in range(0, whole, 4):
            h ^= turn(np.ascontiguousarray(data[:, k : k + 4]).view("<u4").ravel() * c1, 15) * c2
            h = turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        if size > whole:
            tail = np.zeros((len(at), 4), np.uint8)
            tail[:, : size - whole] = data[:, whole:]
            h ^= turn(tail.view("<u4").ravel() * c1, 15) * c2
        h ^= np.uint32(size)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        out[at] = h ^ (h >> np.uint32(16))
    return out


@F.pandas_udf(T.LongType())
def _murmur(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for k in keys:
        yield pd.Series(murmur3_32(k.tolist()).astype(np.int64))


def _targets(topology: DataFrame) -> tuple[int, Column]:
    """A superstream's partition streams in order. Its partitions are few by design: they are one array in the plan."""
    rows = topology.orderBy("ordinal").select("stream").collect()
    if not rows:
        raise ValueError("the superstream has no partitions")
    return len(rows), F.array(*(F.lit(r[0]) for r in rows))


def route_hash(rows: DataFrame, topology: DataFrame, *, key: Column | None = None, hash_col: Column | None = None) -> DataFrame:
    """Adds ``stream``: the hash of the routing key modulo the number of partitions. ``hash_col`` is a hash of one's own (taken as unsigned).

    Without it, standard Murmur3 of the key's bytes; a row without a key fails the job.
    """
    n, streams = _targets(topology)
    hashed = hash_col if hash_col is not None else _murmur(_required(routing_key() if key is None else key))
    return rows.withColumn("stream", F.element_at(streams, (F.pmod(hashed.cast("long"), F.lit(n)) + 1).cast("int")))


def route_key(rows: DataFrame, bindings: DataFrame, *, key: Column | None = None) -> DataFrame:
    """One row for each binding of the row's key: a key bound to several streams fans out. A row without a key fails the job."""
    keyed = rows.withColumn("_key", _required(routing_key() if key is None else key))
    return keyed.join(bindings.select(F.col("binding_key").alias("_key"), "stream"), "_key").drop("_key")


def route_custom(rows: DataFrame, streams: Column) -> DataFrame:
    """One row for each stream in an array column; rows with an empty or null list go nowhere (see ``unrouted``)."""
    return rows.withColumn("stream", F.explode(streams))


def unrouted(rows: DataFrame, bindings: DataFrame, *, key: Column | None = None) -> DataFrame:
    """Rows that no binding takes, those without a key among them."""
    k = routing_key() if key is None else key
    return rows.withColumn("_key", k).join(bindings.select(F.col("binding_key").alias("_key")), "_key", "left_anti").drop("_key")
