"""Packing by lexical retrieval: each window starts at a seed document, and a sharded BM25 index returns the unused neighbours that fill it.

Documents are placed over the whole corpus by their strongest BM25 terms, and the order of these is cut into shards of bounded size. A shard has its own
inverted index over token ids; document frequencies and the mean length come from all documents. What a long document has beyond whole windows is cut
off first; the rest of it is packed like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import discard, materialise
from .token_planes import encode_texts, numbers
from .words import tidy

WINDOW = 2048
#: Ids of a shard, on average; bounds the index that one task builds.
SHARD_IDS = 1 << 20
#: A document is placed by the commonest of so many strongest terms.
STRONG = 8
#: Neighbours that are ranked at a time; a window takes as many slabs as it needs.
NEIGHBOURS = 32
#: Documents of a shard, at most, for which all scores of frequent terms are held at once (64 MB).
DENSE = 4096
K1, B = 1.2, 0.75


def _statistics(encoded: DataFrame, window: int) -> tuple[np.ndarray, int, float]:
    """Of what documents have beyond whole windows: how many hold each id (one number a vocabulary id), how many there are, and their mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs, ids_held = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for n, raw in zip(batch.column("n").to_pylist(), batch.column("ids"), strict=True):
                ids = numbers(raw.as_py(), n)[n // window * window :]
                if len(ids):
                    if ids.max() >= len(total):
                        total = np.concatenate([total, np.zeros(int(ids.max()) + 1 - len(total), np.int64)])
                    total[ids] += 1  # once for an id, however often the document has it
                    docs, ids_held = docs + 1, ids_held + len(ids)
        terms = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *terms]), pa.array([docs, ids_held, *total[terms]])], names=["term", "df"])

    counts = encoded.mapInArrow(tidy(run), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term, n = counts["term"].to_numpy(), counts["df"].to_numpy()
    df = np.zeros(max(int(term.max(initial=0)) + 1, 1))
    df[term[term >= 0]] = n[term >= 0]
    docs, ids_held = (int(n[term == k].sum()) for k in (-2, -1))
    return df, docs, ids_held / max(docs, 1)


#: A sort key holds a row's number, 32 bits of its weight, and an id.
_ROW_BITS, _TERM_BITS = 10, 21


class Places:
    """Where a document lies in the corpus: the commonest of its strongest terms, three more of them, and a hash that parts equal ones.

    Common is what many documents have among their strongest terms. Near copies agree on such a term where a single strongest one is easily lost to an edit.
    """

    #: Bits below the first term, below each of the next three, and below half of the hash: levels at which over-full places are divided.
    SHIFTS = (42, 34, 26, 18, 9, 0)

    def __init__(self, df: np.ndarray, n_docs: int, mean_length: float, window: int):
        self.idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        self.mean, self.window = max(mean_length, 1.0), window

    def strongest(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """For each document, of the ids beyond whole windows; at most half of the distinct ones, so that short texts aren't placed by what all texts have.
        Ties go to the smaller id."""
        out = []
        for lo in range(0, len(docs), 1 << _ROW_BITS):
            some = [d[len(d) // self.window * self.window :].astype(np.int64) for d in docs[lo : lo + (1 << _ROW_BITS)]]
            sizes = np.array([len(d) for d in some])
            pair, tf = np.unique(np.repeat(np.arange(len(some)), sizes) << _TERM_BITS | np.concatenate(some), return_counts=True)
            row, term = pair >> _TERM_BITS, pair & (1 << _TERM_BITS) - 1
            weight = self.idf[term] * tf / (tf + K1 * (1 - B + B * sizes[row] / self.mean))
            # one sort by row, falling weight and id: a positive float's bits rise with it
            falling = 0xFFFFFFFF - weight.astype(np.float32).view(np.uint32).astype(np.int64)
            term = np.sort(row << (32 + _TERM_BITS) | falling << _TERM_BITS | term) & (1 << _TERM_BITS) - 1
            edges = np.searchsorted(row, np.arange(len(some) + 1)).tolist()
            out += [term[a : a + min(STRONG, -(-(b - a) // 2))] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return out

    def key(self, strong: np.ndarray, common: np.ndarray, own: int) -> int:
        first = [int(t) for t in strong[np.lexsort((strong, -common[strong]))[:4]]] + [0] * 4
        out = first[0] << self.SHIFTS[0]
        for t, shift in zip(first[1:4], self.SHIFTS[1:4], strict=True):
            out |= (t * 0x9E3779B1 >> 12 & 0xFF) << shift
        return out | own & 0x3FFFF


class _Own:
    """A task's hashes of rows by id and ids. Equal rows count on, so that they part into different places."""

    def __init__(self) -> None:
        self.seen: dict[int, int] = {}

    def __call__(self, doc_id: int | None, raw: bytes) -> int:
        own = zlib.crc32(raw, zlib.crc32(str(doc_id).encode()))
        again = self.seen[own] = self.seen.get(own, -1) + 1
        return zlib.crc32(again.to_bytes(8, "little"), own) if again else own


def _cuts(keys: DataFrame, most: float) -> np.ndarray:
    """Lowest keys of all shards but the first. Keys are summed by their first term, and only where that is over-full by further bits."""
    spark, found, level = keys.sparkSession, [], keys
    for above, shift in zip((None, *Places.SHIFTS), Places.SHIFTS, strict=False):
        if above is not None:
            hot = spark.createDataFrame([(int(k),) for k in over], "hot long")
            level = level.join(F.broadcast(hot), F.shiftright("key", above) == F.col("hot"), "left_semi")
        sums = level.groupBy(F.shiftright("key", shift).alias("k")).agg(F.sum("n").alias("n")).toArrow()
        k, n = (sums[c].to_numpy().astype(np.int64) for c in ("k", "n"))
        full = (n > most) & (shift > 0)
        found.append(np.stack([k[~full] << shift, n[~full]]))
        over = k[full]
        if not len(over):
            break
    starts, sizes = np.concatenate(found, axis=1)
    cuts, held = [], 0
    for k in np.argsort(starts):
        if held and held + sizes[k] > most:
            cuts.append(starts[k])
            held = 0
        held += sizes[k]
    return np.array(cuts, np.int64)


def _place(encoded: DataFrame, df, n_docs: int, mean_length: float, window: int) -> DataFrame:
    """Adds ``shard`` and ``key``. The strongest terms of all rows say which are common, and the sizes of all rows where shards end."""
    spark = encoded.sparkSession

    def strong_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, own_of = Places(df.value, n_docs, mean_length, window), _Own()
        for batch in batches:
            sizes, raws = batch.column("n").to_pylist(), batch.column("ids").to_pylist()
            own = [own_of(i, raw) for i, raw in zip(batch.column("id").to_pylist(), raws, strict=True)]
            strong = places.strongest([numbers(raw, n) for raw, n in zip(raws, sizes, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(own, pa.int64()), pa.array(strong, pa.list_(pa.int64()))], names=["n", "own", "strong"])

    slim = materialise(encoded.select("id", "n", "ids").mapInArrow(tidy(strong_terms), "n long, own long, strong array<long>"), "pack-places")
    counts = slim.select(F.explode("strong").alias("term")).groupBy("term").count().toArrow()
    common = np.zeros(len(df.value), np.int64)
    common[counts["term"].to_numpy()] = counts["count"].to_numpy()
    shared = spark.sparkContext.broadcast(common)

    def place_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(df.value, n_docs, mean_length, window)
        for batch in batches:
            keys = [places.key(np.array(s, np.int64), shared.value, own) for s, own in zip(batch.column("strong").to_pylist(), batch.column("own").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(keys, pa.int64())], names=["n", "key"])

    keyed = materialise(slim.mapInArrow(tidy(place_keys), "n long, key long"), "pack-keys")  # its levels are summed one by one
    cuts = spark.sparkContext.broadcast(_cuts(keyed, SHARD_IDS))
    for table in (slim, keyed):
        discard(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, own_of = Places(df.value, n_docs, mean_length, window), _Own()
        for batch in batches:
            ids, raws = batch.column("id").to_pylist(), batch.column("ids").to_pylist()
            strong = places.strongest([numbers(raw, n) for raw, n in zip(raws, batch.column("n").to_pylist(), strict=True)])
            keys = np.array([places.key(s, shared.value, own_of(i, raw)) for s, i, raw in zip(strong, ids, raws, strict=True)], np.int64)
            shard = np.searchsorted(cuts.value, keys, side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), batch.column("ids"), pa.array(shard), pa.array(keys)], names=["id", "n", "ids", "shard", "key"])

    return encoded.select("id", "n", "ids").mapInArrow(tidy(run), "id long, n long, ids binary, shard long, key long")


class ShardIndex:
    """BM25 postings of a shard's documents: by term (for scores) and by document (for a seed's query)."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean_length: float):
        sizes = np.array([len(d) for d in docs], np.int64)
        rows = np.repeat(np.arange(len(docs), dtype=np.int64), sizes)
        flat = np.concatenate(docs).astype(np.int64) if docs else np.empty(0, np.int64)
        span = len(df)
        pairs, tf = np.unique(rows * span + flat, return_counts=True)
        self.doc, self.term = pairs // span, pairs % span
        idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / max(mean_length, 1.0))
        self.weight = (idf[self.term] * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        self.doc_at = np.searchsorted(self.doc, np.arange(len(docs) + 1))
        by_term = np.argsort(self.term, kind="stable")
        self.post_doc, self.post_weight = self.doc[by_term], self.weight[by_term]
        self.term_at = np.searchsorted(self.term[by_term], np.arange(span + 1))
        # Terms of many documents have a row over all of them; in a shard of up to DENSE documents one matrix product scores these terms for all seeds at once.
        dense = len(docs) <= DENSE
        hot = np.flatnonzero(np.diff(self.term_at) * (16 if dense else 8) >= max(len(docs), 1))
        self.row = np.full(span, -1)
        self.row[hot] = np.arange(len(hot))
        self.rows = np.zeros((len(hot), len(docs)), np.float32)
        at = self.row[self.term[by_term]]
        self.rows[at[at >= 0], self.post_doc[at >= 0]] = self.post_weight[at >= 0]
        self.near = (self.rows > 0).astype(np.float32).T @ self.rows if dense else None

    def scores(self, seed: int, n: int) -> np.ndarray:
        """BM25 of all documents for all of the seed's terms."""
        terms = self.term[self.doc_at[seed] : self.doc_at[seed + 1]]
        row = self.row[terms]
        out = self.rows[row[row >= 0]].sum(axis=0) if self.near is None else self.near[seed].copy()
        rare = terms[row < 0]
        sizes = self.term_at[rare + 1] - self.term_at[rare]
        if len(rare):
            ends = np.cumsum(sizes)
            at = np.repeat(self.term_at[rare] - (ends - sizes), sizes) + np.arange(ends[-1])
            out += np.bincount(self.post_doc[at], self.post_weight[at], n).astype(np.float32)
        return out


def _ranked(scores: np.ndarray) -> Iterator[np.ndarray]:
    """All documents with a positive score, best first, ties by number: in slabs, each ranked only when it is asked for."""
    left, size = np.flatnonzero(scores > 0), NEIGHBOURS
    while len(left):
        own = scores[left]
        least = np.partition(own, -size)[-size] if len(left) > size else 0
        slab, left = left[own >= least], left[own < least]
        yield slab[np.argsort(-scores[slab], kind="stable")]
        size *= 4


def _powers(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def fill(sizes: list[int], index: ShardIndex, window: int = WINDOW, twins: np.ndarray | None = None) -> Iterator[list[tuple[int, int, int, str]]]:
    """Sequences of (document, start, length, how): a seed, then its neighbours by score, slab after slab until the window is full. Those that fit go whole,
    and one of a sixteenth of the window or more adds its own scores, so that its near copies follow it; where only such are left in a slab that don't fit,
    the best is cut to fill the window and its rest stays unused. Only when no unused document has a positive score do the next ones in order follow.

    ``twins`` numbers the documents, equal ones alike: no window holds two of them. A window that nothing may fill, as the last of a shard, is cut into
    sequences whose lengths are powers of two, which need no padding.
    """
    n = len(sizes)
    start, left = np.zeros(n, np.int64), np.array(sizes, np.int64)
    following, total = 0, int(left.sum())
    kind = np.arange(n) if twins is None else twins
    order = np.argsort(kind, kind="stable")
    alike = {int(kind[g[0]]): g for g in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1) if len(g) > 1}
    while total:
        while not left[following]:
            following += 1
        seed, room, parts, shut = following, window, [], set()

        def put(d: int, length: int, how: str) -> None:
            nonlocal room, total
            parts.append((d, int(start[d]), length, how))
            start[d] += length
            left[d] -= length
            room -= length
            total -= length
            if kind[d] in alike:
                shut.add(int(kind[d]))

        put(seed, int(min(left[seed], room)), "seed")
        if room and total:
            scores = index.scores(seed, n)
            again = True
            while again and room:
                again = False
                scores[left == 0] = 0
                for k in shut:
                    scores[alike[k]] = 0
                for slab in _ranked(scores):
                    over = None
                    for d in slab.tolist():
                        if kind[d] in shut:
                            continue
                        if left[d] <= room:
                            size = int(left[d])
                            put(d, size, "neighbour")
                            if room and size * 16 >= window:  # the window's query grows by what is no small part of it
                                scores += index.scores(d, n)
                                again = True
                                break
                        elif over is None:
                            over = d
                    if again or not room:
                        break
                    if over is not None:
                        put(over, room, "neighbour")
                        break
            free = left > 0
            for k in shut:
                free[alike[k]] = False
            at = following
            while room and at < n:
                at += int(free[at:].argmax()) if free[at:].any() else n
                if at < n:
                    put(at, int(min(left[at], room)), "next")
                    free[alike.get(int(kind[at]), at)] = False
        if room == 0:
            yield parts
            continue
        for size in _powers(window - room):
            out = []
            while size:
                d, a, length, how = parts.pop(0)
                use = min(size, length)
                out.append((d, a, use, how))
                if use < length:
                    parts.insert(0, (d, a + use, length - use, how))
                size -= use
            yield out


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, how string, ids binary"


def _shard(df, n_docs: int, mean_length: float, window: int, with_ids: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("key", "ascending"), ("id", "ascending"), ("ids", "ascending")])
        shard, doc_ids, sizes = rows["shard"][0].as_py(), rows["id"].to_pylist(), rows["n"].to_pylist()
        tokens = [numbers(raw.as_py(), n) for raw, n in zip(rows["ids"], sizes, strict=True)]
        whole = [n // window * window for n in sizes]
        index = ShardIndex([t[w:] for t, w in zip(tokens, whole, strict=True)], df.value, n_docs, mean_length)
        out, sequence = [], shard << 32

        def piece(d: int, start: int, length: int, offset: int, how: str) -> None:
            ids = tokens[d][start : start + length].astype("<u4").tobytes()
            out.append((doc_ids[d], start, length, zlib.crc32(ids), sizes[d], sequence, offset, how, ids if with_ids else None))

        for d, w in enumerate(whole):
            for start in range(0, w, window):
                piece(d, start, window, 0, "whole")
                sequence += 1
        known: dict[tuple, int] = {}
        twins = np.array([known.setdefault((i, raw), len(known)) for i, raw in zip(doc_ids, rows["ids"].to_pylist(), strict=True)], np.int64)
        for parts in fill([n - w for n, w in zip(sizes, whole, strict=True)], index, window, twins):
            offset = 0
            for d, start, length, how in parts:
                piece(d, whole[d] + start, length, offset, how)
                offset += length
            sequence += 1
        kinds = {"ids": pa.binary(), "how": pa.string()}
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        return pa.table({c: pa.array([r[k] for r in out], kinds.get(c, pa.int64())) for k, c in enumerate(names)})

    return run


def pack(docs: DataFrame, tokenizer: str, *, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a piece: id, start and length in its document, crc32 of its ids, the document's size, sequence and offset there, how it came there, and the ids.

    Every id of every document, the end id included, lies in exactly one piece. A null or empty text is just ``end_id``. Repeated rows and null ids are
    documents of their own, ties go by ids; rows equal in id and text never share a sequence, so a document that a mix repeats is seen in different windows. ``how``
    is ``whole`` (a window of a long document), ``seed``, ``neighbour`` (retrieved) or ``next`` (nothing related was left). Sequences have ``window`` ids or, where
    nothing may fill one, a power of two: there is no padding. An empty table gives no rows.
    """
    spark = docs.sparkSession
    encoded = materialise(encode_texts(docs, tokenizer, end_id=end_id, id_col=id_col, text_col=text_col), "pack-ids")
    df, n_docs, mean_length = _statistics(encoded, window)
    frequencies = spark.sparkContext.broadcast(df)
    placed = _place(encoded, frequencies, n_docs, mean_length, window)
    out = placed.groupBy("shard").applyInArrow(_shard(frequencies, n_docs, mean_length, window, with_ids), _SCHEMA)
    return out.withColumnRenamed("doc_id", id_col)


def packing_report(pieces: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(how, pieces, share, full): the share of all ids by how they came to their place, and of ids that lie in sequences of ``window`` ids."""
    size = F.sum("length").over(W.partitionBy("sequence_id"))
    total = F.sum("length").over(W.partitionBy(F.lit(1)))
    each = pieces.select("how", "length", (size == window).alias("full")).groupBy("how").agg(F.count("*").alias("pieces"), F.sum("length").alias("length"), F.sum(F.when(F.col("full"), F.col("length")).otherwise(0)).alias("in_full"))
    return each.select("how", "pieces", (F.col("length") / total).alias("share"), (F.col("in_full") / F.col("length")).alias("full"))
