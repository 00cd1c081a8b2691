"""Approximate nearest neighbours by cosine: a hash-prefix forest.

A tree is a sorted array of 64-bit hash strings, one sign of a random projection a bit. A query descends every tree by binary search and then ascends
all trees together, one bit of the common prefix at a time, until the subtrees hold enough candidates; those are ranked by exact cosine.
Vectors are dealt over blocks of bounded size, each with a forest of its own; a query is put to every block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

BITS = 64
#: Vectors of a block and queries of a chunk, on average; bounds what one task holds.
BLOCK, CHUNK = 8192, 2048
#: Trees of a forest, and the entries that the ascent gathers over all trees of a block before it stops.
TREES, GATHER = 48, 6000


def hash_strings(vectors: np.ndarray, trees: int, seed: int = 11) -> np.ndarray:
    """(trees, n) unsigned 64-bit strings; the first bit is the highest."""
    rng = np.random.default_rng(seed)
    out = np.empty((trees, len(vectors)), np.uint64)
    for t in range(trees):
        signs = (vectors @ rng.standard_normal((vectors.shape[1], BITS))) > 0
        out[t] = np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


class Forest:
    """Sorted arrays over unit vectors."""

    def __init__(self, unit: np.ndarray, trees: int = TREES):
        self.n, self.trees = len(unit), trees
        strings = hash_strings(unit, trees)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, 1)

    def candidates(self, queries: np.ndarray, want: int):
        """For each query the places of its candidates: of the deepest common level whose subtrees hold ``want`` entries over all trees."""
        strings, m = hash_strings(queries, self.trees), len(queries)
        depth = np.full(m, -1)
        low, high = np.zeros((self.trees, m), np.int64), np.full((self.trees, m), self.n, np.int64)
        open_ = np.ones(m, bool)
        for level in range(BITS, 0, -1):
            if not open_.any():
                break
            mask = np.uint64(((1 << level) - 1) << (BITS - level))
            at = np.flatnonzero(open_)
            lo = np.stack([np.searchsorted(self.strings[t], strings[t, at] & mask, "left") for t in range(self.trees)])
            hi = np.stack([np.searchsorted(self.strings[t], strings[t, at] | ~mask, "right") for t in range(self.trees)])
            done = (hi - lo).sum(0) >= want
            low[:, at[done]], high[:, at[done]] = lo[:, done], hi[:, done]
            depth[at[done]] = level
            open_[at[done]] = False
        for q in range(m):
            seen = np.zeros(self.n, bool)
            if depth[q] < 0:
                seen[:] = True
            else:
                for t in range(self.trees):
                    seen[self.order[t, low[t, q] : high[t, q]]] = True
            yield np.flatnonzero(seen)


def _search(k: int, trees: int, gather: int):
    def run(table: pa.Table) -> pa.Table:
        size = table["size"][0].as_py()
        ids = table["id"].to_numpy()
        flat = table["vector"].combine_chunks()
        vectors = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)
        # by a power of two, which changes no digit: squares of the largest components neither overflow nor vanish
        vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])
        is_query = table["query"].to_numpy(zero_copy_only=False).astype(bool)
        norms = np.sqrt((vectors * vectors).sum(1))
        points, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        out_q, out_v, out_s = [], [], []
        if len(points) and len(queries):
            unit = vectors / norms[:, None]
            forest = Forest(unit[points], trees)
            for q, places in zip(queries, forest.candidates(unit[queries], gather + k + 1), strict=True):
                places = points[places]
                places = places[ids[places] != ids[q]]
                if not len(places):
                    continue
                near = unit[places] @ unit[q]
                if len(places) > k:  # then exactly, for all that rounding could put among the first
                    places = places[near >= np.partition(near, -k)[-k] - 1e-9]
                exact = (vectors[places] * vectors[q]).sum(1) / (norms[places] * norms[q])
                best = np.lexsort((ids[places], -exact))[:k]
                out_q += [ids[q]] * len(best)
                out_v += ids[places[best]].tolist()
                out_s += exact[best].tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, trees: int = TREES, gather: int = GATHER) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query by cosine of the original vectors, ties to the smaller id.

    A query isn't its own candidate, by id. Null vectors and ids, zero vectors and such with null or non-finite components take no part, nor do
    vectors of another length than the query's. Repeated rows of an id count once each as candidates and once as a query. Fewer candidates than k give fewer rows.
    """

    def clean(df: DataFrame) -> DataFrame:
        v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
        fine = F.col("id").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(F.col("vector").isNotNull()).where(fine).withColumn("size", F.size("vector"))

    points, asked = clean(vectors), clean(queries).dropDuplicates(["id"])
    blocks, chunks = (max(1, -(-df.count() // per)) for df, per in ((points, BLOCK), (asked, CHUNK)))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    stored = points.withColumn("block", place(blocks, 1)).withColumn("chunk", spread(chunks)).withColumn("query", F.lit(False))
    sent = asked.withColumn("chunk", place(chunks, 2)).withColumn("block", spread(blocks)).withColumn("query", F.lit(True))
    found = stored.unionByName(sent).groupBy("size", "block", "chunk").applyInArrow(_search(k, trees, gather), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
