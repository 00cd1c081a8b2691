"""Language identification, words first: known words score by their log frequency in each language, unseen words by shorter and shorter character n-grams.

The counts are those of all labelled rows. A small model lies whole in every worker. Of a larger one workers hold the commonest words; the other words of the
texts, a few in a hundred, are looked up by joins with the tables of words and n-grams, each distinct word once, and their scores summed by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import discard, forget, materialise
from .words import text_slices, tidy, uniform

#: Words and n-grams of a model that a worker holds whole, at most; of a larger one it holds the commonest words, KEPT at most.
WHOLE, KEPT = 1 << 18, 1 << 18
#: Joined scores are whole numbers of this size, so that their sums don't depend on the order of rows.
UNIT = 2.0**-32
#: Words whose n-grams are counted at a time.
GRAM_WORDS = 10_000
LONGEST = 5
#: Distinct words whose scores a worker remembers, at most.
REMEMBERED = 300_000
UNKNOWN = "und"


def word_lists(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row offsets and the lower-cased runs of letters and marks of all rows; null has none."""
    plain = pc.utf8_lower(pc.fill_null(text.cast(pa.string()), ""))
    lists = pc.split_pattern(pc.replace_substring_regex(plain.cast(pa.large_string()), r"[^\pL\pM]+", " "), " ")
    offsets, words = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = np.concatenate([[0], np.cumsum(real)])
    return counts[offsets - offsets[0]], words.filter(pa.array(real))


@dataclass
class Model:
    """``words`` and ``grams`` (of every length up to LONGEST, word ends marked by a space) lead to rows of ``table``: log frequency in each language.

    Of a model too large for a worker ``words`` are the commonest, ``grams`` none, and ``other_words`` and ``other_grams`` tables: item, and how often
    the j-th language has it as ``n{j}``; ``totals`` tells for each length (0: words) how many items there are, and the sums of their counts.
    """

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    table: np.ndarray | None = None
    prior: np.ndarray | None = None
    other_words: DataFrame | None = None
    other_grams: DataFrame | None = None
    totals: dict[int, dict[str, int]] = field(default_factory=dict)

    def local(self) -> Model:
        """What workers hold."""
        return replace(self, other_words=None, other_grams=None, totals={})

    def decide(self, sums: np.ndarray, lettered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and its share of the posterior, by the summed scores of each text; ``und`` and 0 where there is no letter."""
        langs, scores = np.full(len(sums), UNKNOWN, object), np.zeros(len(sums))
        if len(sums) and self.langs:
            total = sums + self.prior
            share = 1 / np.exp(np.clip(total - total.max(1, keepdims=True), -700, 0)).sum(1)
            langs[lettered] = np.array(self.langs, object)[total.argmax(1)[lettered]]
            scores[lettered] = share[lettered]
        return langs, scores

    def grams_of(self, word: str) -> list[int]:
        """The known n-grams of the longest length of which any is known."""
        marked, get = f" {word} ", self.grams.get
        for n in range(min(LONGEST, len(marked)), 0, -1):
            if hits := [g for k in range(len(marked) - n + 1) if (g := get(marked[k : k + n])) is not None]:
                return hits
        return []

    def score(self, words: list[str]) -> np.ndarray:
        """One row a word: a known word's own; else the mean over its ``grams_of``; else zeros."""
        out, owner, gram = np.zeros((len(words), len(self.langs))), [], []
        for k, w in enumerate(words):
            row = self.words.get(w)
            if row is not None:
                out[k] = self.table[row]
            elif hits := self.grams_of(w):
                owner += [k] * len(hits)
                gram += hits
        if owner:
            n = np.maximum(np.bincount(owner, minlength=len(words)), 1)
            for j in range(len(self.langs)):
                out[:, j] += np.bincount(owner, self.table[gram, j], len(words)) / n
        return out


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, item, n), summed over a part of a batch."""
    for batch in (p for whole in batches for p in text_slices(whole, "text")):
        for lang in pc.unique(batch.column("lang")).to_pylist():
            words = word_lists(batch.filter(pc.equal(batch.column("lang"), lang)).column("text"))[1]
            word, n = pc.value_counts(words).flatten()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(word), pa.string()), word.cast(pa.string()), n], names=["lang", "item", "n"])


def _grams(word: str, lengths: range) -> list[str]:
    marked = f" {word} "
    return [marked[k : k + n] for n in lengths for k in range(len(marked) - n + 1)]


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of counted words, with counts of the same columns: once for each time that a word occurs."""

    def grams(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        each = [_grams(w, range(1, LONGEST + 1)) for w in table["item"].to_pylist()]
        owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
        encoded = pa.array([g for x in each for g in x], pa.string()).dictionary_encode()
        at, items = encoded.indices.to_numpy(), encoded.dictionary
        counts = []
        for name in table.column_names[1:]:
            total = np.zeros(len(items), np.int64)
            np.add.at(total, at, table[name].to_numpy()[owner])
            counts.append(pa.array(total))
        return pa.RecordBatch.from_arrays([items, *counts], names=table.column_names)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= GRAM_WORDS:
            yield grams(held)
            held = []
    if held:
        yield grams(held)


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: float | None = None, train_bytes: float | None = None) -> Model:
    """Learns from all labelled rows; rows without text or language teach nothing. Labels are any texts, told apart by their code points. Without any labelled row the
    model knows no language and answers ``und``.

    Only on request it learns from about ``train_rows`` rows or ``train_bytes`` bytes of text of each language, chosen by hash, the row of the least hash among them.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    place = uniform(F.xxhash64("id", "text"))
    sizes = {r["lang"]: r for r in rows.groupBy("lang").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"), F.min(place).alias("least")).collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return Model([])
    if train_rows is not None or train_bytes is not None:
        most = lambda bound, n: 1.0 if bound is None else bound / max(1, n)
        reach = {x: max(r["least"], min(1.0, most(train_rows, r["rows"]), most(train_bytes, r["bytes"]))) for x, r in sizes.items()}
        rows = rows.where(place <= F.create_map(*(x for lang in langs for x in (F.lit(lang), F.lit(reach[lang]))))[F.col("lang")])
    names = [f"n{j}" for j in range(len(langs))]
    summed = [F.sum(F.when(F.col("lang") == F.lit(x), F.col("n")).otherwise(0)).alias(c) for x, c in zip(langs, names, strict=True)]
    words = rows.select("lang", "text").mapInArrow(tidy(_word_batches), "lang string, item string, n long").groupBy("item").agg(*summed)
    words = materialise(words, "language-words")
    grams = words.mapInArrow(tidy(_gram_batches), words.schema).groupBy("item").agg(*(F.sum(c).alias(c) for c in names))
    grams = materialise(grams, "language-grams")
    length = F.length("item")
    totals = {r["length"]: r.asDict() for t, k in ((words, F.lit(0)), (grams, length)) for r in t.groupBy(k.alias("length")).agg(F.count("*").alias("items"), *(F.sum(c).alias(c) for c in names)).collect()}
    prior = np.array([sizes[x]["rows"] for x in langs], float)
    model = Model(langs, prior=np.log(prior / prior.sum()))
    if sum(r["items"] for r in totals.values()) <= WHOLE:
        held = {k: (words if k == 0 else grams.where(length == k)).toArrow() for k in range(LONGEST + 1)}
        for table in (words, grams):
            discard(table)
        return _hold(model, held, totals)
    level = F.floor(F.log2(sum(F.col(c) for c in names)) * 16)  # how common a word is; few levels, counted over all words
    at, levels = None, words.groupBy(level.alias("level")).count().orderBy(F.col("level").desc()).collect()
    for k, n in zip((r["level"] for r in levels), np.cumsum([r["count"] for r in levels]), strict=True):
        if n <= KEPT:
            at = k
    common = F.lit(False) if at is None else level >= at
    _hold(model, {0: words.where(common).toArrow()}, totals)
    forget(words.sparkSession)  # shuffle files of the counts, which are written by now
    return replace(model, other_words=words.where(~common), other_grams=grams, totals=totals)


def _scores(model: Model, size: Column) -> list[Column]:
    """Log frequencies, in UNITs, from the counts of items of a length."""
    of = lambda name: F.create_map(*(F.lit(float(x)) for k, r in model.totals.items() for x in (k, r[name])))[size.cast("double")]
    return [F.rint(F.log((F.col(f"n{j}") + 0.5) / (of(f"n{j}") + 0.5 * of("items"))) / UNIT).cast("long").alias(f"s{j}") for j in range(len(model.langs))]


def _hold(model: Model, counted: dict[int, pa.Table], totals: dict) -> Model:
    """Puts counted items (by length, 0: words) into the model: log frequencies of each length by itself, with half an observation more of every item."""
    tables, first = [np.empty((0, len(model.langs)))], 0
    for k, table in counted.items():
        if not table.num_rows:
            continue
        total = np.array([[totals[k][f"n{j}"] for j in range(len(model.langs))]], float)
        seen = np.stack([table[f"n{j}"].to_numpy() for j in range(len(model.langs))], axis=1)
        tables.append(np.log((seen + 0.5) / (total + 0.5 * totals[k]["items"])))
        (model.grams if k else model.words).update(zip(table["item"].to_pylist(), range(first, first + table.num_rows), strict=True))
        first += table.num_rows
    model.table = np.concatenate(tables)
    return model


class Scorer:
    """A worker's words with their scores, each found once; it starts anew beyond REMEMBERED words."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, len(self.model.langs) + 1))  # the last column tells whether the word has a letter

    def _places(self, distinct: pa.Array) -> np.ndarray:
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(place < 0)
        if len(self.at) + len(new) > REMEMBERED:
            self._clear()
            new = np.arange(len(words))
        if len(new):
            learned, first = [words[k] for k in new], len(self.at)
            while first + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first : first + len(new), :-1] = self.model.score(learned)
            self.rows[first : first + len(new), -1] = pc.match_substring_regex(distinct.take(pa.array(new)), r"\pL").to_numpy(zero_copy_only=False)
            place[new] = np.arange(first, first + len(new))
            self.at.update(zip(learned, place[new].tolist(), strict=True))
        return place

    def predict(self, text: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its share of the posterior, of every whole text; ``und`` and 0 where there is no letter."""
        offsets, words = word_lists(text)
        sums, some = np.zeros((len(text), len(self.model.langs) + 1)), np.flatnonzero(np.diff(offsets))
        if len(some) and self.model.langs:
            encoded = words.dictionary_encode()
            place = self._places(encoded.dictionary)
            sums[some] = np.add.reduceat(self.rows[place[encoded.indices.to_numpy(zero_copy_only=False)]], offsets[some])
        langs, scores = self.model.decide(sums[:, :-1], sums[:, -1] > 0)
        return langs.tolist(), scores


def _common_words(shared):
    """(row, id, lettered, sums, others): a text's scores by the words that workers hold, and its other words. ``row`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, row = shared.value, TaskContext.get().partitionId() << 33
        table = np.concatenate([model.table, np.zeros((1, len(model.langs)))])  # the last one is for other words
        for part in (p for batch in batches for p in text_slices(batch, "text")):
            offsets, words = word_lists(part.column("text"))
            encoded = words.dictionary_encode()
            distinct, at = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
            place = np.fromiter(map(model.words.get, distinct.to_pylist(), repeat(-1)), np.int64, len(distinct))
            letters = pc.match_substring_regex(distinct, r"\pL").to_numpy(zero_copy_only=False)
            sums, lettered, some = np.zeros((part.num_rows, len(model.langs))), np.zeros(part.num_rows, bool), np.flatnonzero(np.diff(offsets))
            if len(some):
                sums[some] = np.add.reduceat(table[place[at]], offsets[some])
                lettered[some] = np.logical_or.reduceat(letters[at], offsets[some])
            other = place[at] < 0
            ends = np.concatenate([[0], np.cumsum(other)])[offsets].astype(np.int32)
            others = pa.ListArray.from_arrays(pa.array(ends), words.filter(pa.array(other)).cast(pa.string()))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * len(model.langs)), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + part.num_rows)), part.column("id"), pa.array(lettered), flat, others], names=["row", "id", "lettered", "sums", "others"])
            row += part.num_rows

    return run


def _pairs(longest: bool):
    """(word, item): the longest n-grams of each word, or all shorter ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            most = [min(LONGEST, len(w) + 2) for w in words]
            each = [_grams(w, range(n, n + 1) if longest else range(1, n)) for w, n in zip(words, most, strict=True)]
            items = pa.array([g for x in each for g in x], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))), items], names=["word", "item"])

    return run


def _other_scores(words: DataFrame, model: Model) -> DataFrame:
    """(word, s0, s1, ...) of each of the distinct ``words``: a known one's own, else the mean over its known n-grams of the longest length that has any. Words with neither are left out."""
    names = [f"s{j}" for j in range(len(model.langs))]
    # counts travel, not scores: they are small numbers
    looked = materialise(words.join(model.other_words.withColumnRenamed("item", "word"), "word", "left"), "language-others")
    unseen, found = looked.where("n0 is null").select("word"), [looked.where("n0 is not null").select("word", *_scores(model, F.lit(0)))]
    for longest in (True, False):  # most unseen words have a known n-gram of the longest length; only the others ask for shorter ones
        pairs = unseen.mapInArrow(tidy(_pairs(longest)), "word string, item string")
        hits = pairs.join(model.other_grams, "item").select("word", F.length("item").alias("length"), *_scores(model, F.length("item")))
        each = hits.groupBy("word", "length").agg(*(F.rint(F.sum(c) / F.count("*")).cast("long").alias(c) for c in names))
        best = materialise(each.groupBy("word").agg(F.max_by(F.struct(*names), "length").alias("s")).select("word", "s.*"), "language-backoff")
        found.append(best)
        unseen = unseen.join(best.select("word"), "word", "left_anti")
    whole = materialise(found[0].unionByName(found[1]).unionByName(found[2]), "language-scores")
    for table in (looked, *found[1:]):
        discard(table)
    forget(words.sparkSession)
    return whole


def _predict_joined(rows: DataFrame, model: Model) -> DataFrame:
    """(id, lang_pred, score) of (id, text) where the model is too large for a worker."""
    local, n = model.local(), len(model.langs)
    shared = rows.sparkSession.sparkContext.broadcast(local)
    begun = rows.mapInArrow(tidy(_common_words(shared)), "row long, id long, lettered boolean, sums array<double>, others array<string>")
    begun = materialise(begun, "language-rows")  # fixes the numbers of rows
    others = begun.select("row", F.explode("others").alias("word"))
    scores = _other_scores(others.select("word").distinct(), model)
    joined = others.join(scores, "word").groupBy("row").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(n)))
    more = F.array(*(F.coalesce(F.col(f"s{j}"), F.lit(0)) for j in range(n)))
    whole = begun.select("row", "id", "lettered", "sums").join(joined, "row", "left").select("id", "lettered", "sums", more.alias("more"))
    light = replace(local, words={}, table=None)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, more = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for c in ("sums", "more"))
            langs, found = light.decide(sums + more * UNIT, batch.column("lettered").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs.tolist(), pa.string()), pa.array(found)], names=["id", "lang_pred", "score"])

    return whole.mapInArrow(tidy(decide), "id long, lang_pred string, score double")


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each row of ``docs``, from the text alone. Null ids and repeated rows stay; other columns are not read.

    A text without any letter, an empty or a null one is ``und`` with score 0. Ties go to the language that sorts first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if model.other_words is not None:
        return _predict_joined(rows, model).withColumnRenamed("id", id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in (p for batch in batches for p in text_slices(batch, "text")):
            langs, scores = scorer.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    return rows.mapInArrow(tidy(run), "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def accept(docs: DataFrame, model: Model, *, text_col: str = "text", lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """``docs`` without rows that are ``und`` or score below ``least``; a null language becomes the predicted one, other columns stay as they are, whatever their names."""
    if model.other_words is not None:
        return _accept_joined(docs, model, text_col, lang_col, least)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            named = pa.RecordBatch.from_arrays([whole.column(text_at)], names=["text"])
            start = 0
            for part in text_slices(named, "text"):
                batch = whole.slice(start, part.num_rows)
                start += part.num_rows
                langs, scores = scorer.predict(part.column("text"))
                keep = pa.array([x != UNKNOWN and y >= least for x, y in zip(langs, scores, strict=True)], pa.bool_())
                filled = [a if a is not None else b for a, b in zip(batch.column(lang_at).to_pylist(), langs, strict=True)]
                field = batch.schema.field(lang_at)
                yield batch.set_column(lang_at, field, pa.array(filled, field.type)).filter(keep)

    return docs.mapInArrow(tidy(run), docs.schema)


def _accept_joined(docs: DataFrame, model: Model, text_col: str, lang_col: str, least: float) -> DataFrame:
    """``accept`` where the model is too large for a worker. Texts are told apart by 64-bit hashes; rejected ones, and predictions for rows without a language, are joined to the rows."""
    key = F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    found = materialise(_predict_joined(docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")), model), "language-found").dropDuplicates(["id"])
    gone = materialise(found.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least)).select("id"), "language-gone")
    keyed = docs.select(key.alias("id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = keyed.join(gone, "id", "left_anti")
    lang = F.col("row").getField(lang_col)
    filled = kept.where(lang.isNull()).join(found, "id").select(*((F.col("lang_pred") if c == lang_col else F.col("row").getField(c)).alias(c) for c in docs.columns))
    return kept.where(lang.isNotNull()).select("row.*").union(filled)
