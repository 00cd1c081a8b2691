"""Phrase collocations by top-order marginalisation: only the longest windows are counted, and Spark's ROLLUP sums their prefixes.

Every word opens one window of three words, padded where its piece ends; a window's columns are lead columns of the word column. What a shorter phrase occurs is the sum over the
windows that it opens, so no n-grams of other lengths are exploded or counted.

Windows travel in blocks, sorted, with the words of a block as its dictionary and zstandard around it: a tenth of what they take as rows. They are dealt by a hash of the whole window,
so no word or phrase is hot, and those that occur too seldom to be part of an answer give up their last word; the pairs that are left are dealt and thinned out once more. ROLLUP
sums what remains, which is about as much as there are words and frequent phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import discard, materialise
from .words import mix, release, tidy

STOPS = ".,;:!?\n\v\f\r"
PAD = ""
UNKNOWN = "und"
#: Bytes of text whose windows are summed before they leave a task, and the share of the whole that a part holds about: what a worker holds at a time.
SLICE_BYTES = 8 << 20
#: Candidates of a language are ranked inside so many buckets first, so no task ranks them all.
BUCKETS = 64
#: Words that are hashed at a time.
HASHED = 1 << 14
_BLOCK = "part int, words binary, sizes binary, w1 binary, w2 binary, w3 binary, n binary"
_ROWS = "lang string, w1 string, w2 string, w3 string, n long"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _sum_up(columns: list[np.ndarray], n: np.ndarray, base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of codes below ``base`` -> the distinct ones in order, with their summed counts."""
    key, seen = columns[0].astype(np.int64), []
    for k, c in enumerate(columns[1:], 1):
        if key.size and (int(key.max()) + 1) * base >= 2**63:  # what is joined so far is numbered
            distinct, key = np.unique(key, return_inverse=True)
            seen.append((k, distinct))
        key = key * base + c
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if key.size else np.empty(0, np.int64)
    key, n = key[first], np.add.reduceat(n[order], first, dtype=np.int64) if key.size else n[:0].astype(np.int64)
    del order, first
    out: list[np.ndarray] = []
    for k in range(len(columns) - 1, 0, -1):
        key, c = np.divmod(key, base)
        out.insert(0, c)
        if seen and seen[-1][0] == k:
            key = seen.pop()[1][key]
    return [key, *out], n


class Windows:
    """Distinct windows with counts: ``words[c]`` are the texts of codes, of which 0 is the padding; first words stand behind their language and a tab, which no word holds."""

    def __init__(self, words: pa.Array, columns: list[np.ndarray], n: np.ndarray):
        self.words = words
        self.columns, self.n = _sum_up(columns, n, len(words))

    def gave_up(self, least: int, depth: int) -> Windows:
        """The same without the words from ``depth`` on, wherever these prefixes occur less than ``least`` times."""
        prefix, total = _sum_up(self.columns[:depth], self.n, len(self.words))
        starts = np.searchsorted(self._at(depth), np.arange(len(total)))
        seldom = np.repeat(total < least, np.diff(np.append(starts, len(self.n))))
        kept = [c if k < depth - 1 else np.where(seldom, 0, c) for k, c in enumerate(self.columns)]
        return Windows(self.words, kept, self.n)

    def _at(self, depth: int) -> np.ndarray:
        """The place of each window's prefix among the distinct prefixes, in order."""
        changes = np.zeros(len(self.n), bool)
        for c in self.columns[:depth]:
            changes[1:] |= c[1:] != c[:-1]
        return np.cumsum(changes)

    def blocks(self, parts: int, depth: int) -> Iterator[pa.RecordBatch]:
        """Rows of the block table: windows dealt to ``parts`` by a hash of their first ``depth`` words."""
        runs = (self.words.slice(k, HASHED).to_pandas().to_numpy(object) for k in range(0, len(self.words), HASHED))  # few words at a time are Python's objects
        hashes = np.concatenate([pd.util.hash_array(run, categorize=False) for run in runs])
        route = np.zeros(len(self.n), np.uint64)
        for c in self.columns[:depth]:
            route = mix(route * _ODD + hashes[c])
        route = (route % np.uint64(parts)).astype(np.int32)
        order = np.argsort(route, kind="stable")
        cuts = np.searchsorted(route[order], np.arange(parts + 1))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        rows: list[list] = [[] for _ in range(7)]
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            at = order[cuts[part] : cuts[part + 1]]
            used, codes = np.unique(np.concatenate([c[at] for c in self.columns]), return_inverse=True)
            some = self.words.take(pa.array(used))
            first, *rest = np.split(codes.astype(np.min_scalar_type(len(used))), len(self.columns))
            sizes = pc.binary_length(some).to_numpy().astype(np.uint32)
            text = some.buffers()[2].to_pybytes()[: int(sizes.sum())]  # freshly taken: its strings lie back to back from the start
            values = [part, text, sizes, np.diff(first, prepend=first[:1] * 0), *rest, self.n[at].astype(np.min_scalar_type(int(self.n[at].max())))]
            for column, v in zip(rows, values, strict=True):
                column.append(v if isinstance(v, int) else squeeze(v if isinstance(v, bytes) else v.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(c, pa.binary()) for c in rows[1:])], names=["part", "words", "sizes", "w1", "w2", "w3", "n"])

    def rows(self) -> pa.RecordBatch:
        heads = pc.split_pattern(self.words.take(pa.array(self.columns[0])), "\t", max_splits=1, reverse=True)
        lang, first = (pc.list_element(heads, k) for k in (0, 1))
        rest = [self.words.take(pa.array(c)) for c in self.columns[1:]]
        return pa.RecordBatch.from_arrays([*(c.cast(pa.string()) for c in (lang, first, *rest)), pa.array(self.n, pa.int64())], names=["lang", "w1", "w2", "w3", "n"])


def _opened(lang: pa.Array, text: pa.Array) -> Windows:
    """The windows of some texts."""
    text = pc.ascii_lower(pc.fill_null(text.cast(pa.large_string()), ""))
    text = pc.replace_substring_regex(pc.replace_substring(text, "\t", " "), f"[{STOPS}]", " \n ")
    lists = pc.split_pattern(pc.binary_join_element_wise(text, *(pa.scalar(x, pa.large_string()) for x in ("\n", " "))), " ")
    del text  # what is no longer needed goes at once: a worker holds several copies of its slice otherwise
    tokens, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    del lists
    real = pc.greater(pc.binary_length(tokens), 0)
    encoded = tokens.filter(real).dictionary_encode()
    del tokens
    dictionary, code = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False) + np.int32(1)
    del encoded
    langs = pc.fill_null(lang.cast(pa.large_string()), UNKNOWN).dictionary_encode()
    tongue = np.repeat(langs.indices.to_numpy(zero_copy_only=False), sizes)[real.to_numpy(zero_copy_only=False)]
    code[code == pc.index(dictionary, "\n").as_py() + 1] = 0  # the end of a piece; every text ends with one
    after = np.append(code[1:], np.int32(0))
    beyond = np.where(after == 0, np.int32(0), np.append(after[1:], np.int32(0)))
    opens = code > 0
    after, beyond, key = after[opens], beyond[opens], tongue[opens].astype(np.int64) * (len(dictionary) + 1) + code[opens]
    del tongue, code, opens, real
    heads, place = np.unique(key, return_inverse=True)
    del key
    padded = pa.concat_arrays([pa.array([PAD], pa.large_string()), dictionary.cast(pa.large_string())])
    of, word = np.divmod(heads, len(padded))
    named = pc.binary_join_element_wise(langs.dictionary.take(pa.array(of)), padded.take(pa.array(word)), pa.scalar("\t", pa.large_string()))
    return Windows(pa.concat_arrays([padded, named]), [place + len(padded), after, beyond], np.ones(len(place), np.int32))


def _unpacked(held: list[dict]) -> Windows:
    """The windows of blocks, summed."""
    open_ = zstandard.ZstdDecompressor().decompress
    words, columns, counts, known = [], [[], [], []], [], 1
    for b in held:
        sizes = np.frombuffer(open_(b["sizes"]), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        words.append(pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(open_(b["words"]))]))
        kind = np.min_scalar_type(len(sizes))
        first = np.cumsum(np.frombuffer(open_(b["w1"]), kind), dtype=kind)  # differences wrap around, and so do their sums
        for column, codes in zip(columns, (first, *(np.frombuffer(open_(b[c]), kind) for c in ("w2", "w3"))), strict=True):
            column.append(codes.astype(np.int64) + known)
        raw = open_(b["n"])
        counts.append(np.frombuffer(raw, f"u{len(raw) // len(first)}").astype(np.int64))
        known += len(sizes)
    encoded = pa.concat_arrays([pa.array([PAD], pa.large_string()), *words]).dictionary_encode()
    to = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Windows(encoded.dictionary, [to[np.concatenate(c)] for c in columns], np.concatenate(counts))


def _open_batches(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                held.append(whole.slice(k, 64))
                size += pc.sum(pc.binary_length(held[-1].column("text"))).as_py() or 0
                if size >= SLICE_BYTES:
                    yield from _table(held).blocks(parts, 3)
                    held, size = [], 0
                    release()
        if held:
            yield from _table(held).blocks(parts, 3)

    def _table(held: list[pa.RecordBatch]) -> Windows:
        table = pa.Table.from_batches(held).combine_chunks()
        return _opened(*(table[c].combine_chunks() for c in ("lang", "text")))

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[Windows]:
    """The windows of one part after the other; blocks come in the order of their parts."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, blocks in groupby(rows, key=itemgetter("part")):
        yield _unpacked(list(blocks))
        release()


def windows(docs: DataFrame, *, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, w1, w2, w3, n): the padded windows of three words, of which those that occur less than ``least`` times have given up their last word, and where the remaining
    pair does so too, its last. So sums over a prefix are exact wherever they are ``least`` or more, and for one word always. A row may come in several parts.

    A-Z are lower-cased; texts are cut at stops and line ends into pieces, these at spaces and tabs into words. Windows don't leave a piece. A null text has no words, a null language
    is ``und``. An empty table has no rows.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _merged(batches):
            yield from found.gave_up(least, 3).blocks(parts, 2)

    def thinner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _merged(batches):
            yield found.gave_up(least, 2).rows()

    dealt = lambda blocks: blocks.repartition(parts, "part").sortWithinPartitions("part")  # noqa: E731 - parts that meet in a task come one by one
    thinned = dealt(rows.mapInArrow(tidy(_open_batches(parts)), _BLOCK)).mapInArrow(tidy(thin), _BLOCK)
    return dealt(thinned).mapInArrow(tidy(thinner), _ROWS)


def phrase_counts(found: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of one to three words that occur ``least`` times, and one row of size 0 a language with all its words; from ``windows``."""
    sums = found.sparkSession.sql("SELECT lang, w1, w2, w3, sum(n) AS f, 3 - bit_count(grouping_id()) AS size FROM {found} GROUP BY lang, ROLLUP (w1, w2, w3)", found=found)
    last = F.element_at(F.array("w1", "w2", "w3"), F.greatest("size", F.lit(1)).cast("int"))
    whole = sums.where((F.col("size") == 0) | ((last != PAD) & (F.col("f") >= least)))
    return whole.select("lang", F.array_join(F.slice(F.array("w1", "w2", "w3"), F.lit(1), F.col("size").cast("int")), " ").alias("phrase"), F.col("size").cast("int").alias("size"), "f")


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (left right)), by integral division of decimals: exact for counts below 10^15."""
    wide = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, *, least: int = 10, inside: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of two or three words of each language.

    A phrase that occurs a times, cut into parts that occur l and r times, scores floor(10^6 a^2 / (l r)) at its lowest cut, the first of equals. Phrases of fewer than
    ``least`` occurrences are none, nor those inside a longer one that occurs ``inside`` per cent as often or more. Ranks go by score, a, phrase (bytewise). Repeated rows count again;
    other columns are not read; see ``windows`` for nulls and empty tables.
    """
    opened = materialise(windows(docs, least=least, text_col=text_col, lang_col=lang_col), "windows")
    counts = materialise(phrase_counts(opened, least), "phrases")
    word = F.split("phrase", " ")
    part = lambda lo, n: F.array_join(F.slice(word, lo, n), " ")
    phrases = counts.where("size >= 2")
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select("lang", "phrase", "size", F.col("f").alias("a"), "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size")).alias("rest"))
    known = lambda name, f: counts.where("size > 0").select(F.col("lang").alias("of"), F.col("phrase").alias(name), F.col("f").alias(f))
    one = cut.join(known("x", "l"), (F.col("lang") == F.col("of")) & (F.col("head") == F.col("x"))).drop("of", "x")
    both = one.join(known("y", "r"), (F.col("lang") == F.col("of")) & (F.col("rest") == F.col("y"))).drop("of", "y")
    scored = both.withColumn("score", _score("a", "l", "r"))
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    longer = phrases.where("size = 3").select("lang", "f", F.explode(F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2)))).alias("held")).groupBy("lang", "held").agg(F.max("f").alias("most"))
    longer = longer.withColumnRenamed("lang", "of")
    free = lowest.join(longer, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("held")), "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside)).drop("of", "held")
    by = [F.col("m.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    few = free.withColumn("place", F.row_number().over(W.partitionBy("lang", bucket).orderBy(*by))).where(F.col("place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*by)).cast("long")).where(F.col("rank") <= top)
    total = counts.where("size = 0").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    out = ranked.join(total, F.col("lang") == F.col("of")).select("lang", "rank", "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n", F.col("m.score").alias("score"))
    discard(opened)
    return out


#: The same in DuckDB's SQL, by counting every phrase of every length.
ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i : i + size - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3)) v(size) WHERE len(ws) >= size),
f AS MATERIALIZED (SELECT lang, phrase, size, count(*)::BIGINT AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2 AND f >= 10),
j AS (SELECT lang, phrase, size, f AS a, k, array_to_string(ws[1 : k], ' ') AS head, array_to_string(ws[k + 1 : size], ' ') AS rest FROM c, (VALUES (1), (2)) v(k) WHERE k < size),
k AS (SELECT j.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score FROM j JOIN f x ON x.lang = j.lang AND x.phrase = head JOIN f y ON y.lang = j.lang AND y.phrase = rest),
s AS (SELECT lang, phrase, size, a, l, r, score FROM k QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, held, max(f) AS most FROM (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS held FROM c WHERE size = 3) GROUP BY ALL),
t AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s LEFT JOIN h ON h.lang = s.lang AND held = phrase WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
