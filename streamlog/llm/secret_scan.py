"""Secret scans: fixed rules, and two character Markov models compared by log-likelihood ratio.

The rules find assignments, access keys and long hex runs. The models - one of random strings, one of ordinary identifiers - are trained from all labelled
words of the corpus itself: the values that the rules found, and the other words; Spark sums their transitions, so a model is one number a pair of characters. Keys that no rule finds are among the other words, so a first model, of words that are
surely ordinary, sorts out what looks random before the second one learns from the rest. A run of key characters that the rules left alone is a secret when its
log-likelihood ratio outweighs how rare secrets are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import discard, materialise
from .words import text_slices, tidy, uniform

#: The rules, their order, and the least length of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # whole runs of [0-9a-f]+, without the short ones
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: What the models look at: every run of so many key characters, whatever its shape.
MARKOV_LEAST = 8
_KEY = "A-Za-z0-9+/_=-"
CANDIDATE = re.compile(rf"[{_KEY}]{{{MARKOV_LEAST},}}")
#: How rare a secret is taken to be among such runs: the ratio must outweigh it.
RARITY = 1e9
#: Every HELD-th surely ordinary word is held out of training; the threshold is not below what all but one in OUTLIERS of them reach.
HELD, OUTLIERS = 5, 100
#: A longer word weighs like so many characters, so that no single one makes a model.
LONGEST_WORD = 1000
#: Weights of transitions are whole multiples of one in PARTS, so that their sums don't depend on the order of rows.
PARTS = 1024
#: Ratios are counted in steps of one in STEPS; a threshold is the upper end of a step.
STEPS = 64
#: Surely ordinary words that a first model wants; where there are fewer, all words of letters count.
SURELY = 200
#: How many observations the character frequencies weigh against those of a context.
BACKOFF = 20.0

_CLASSES = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_INDEX = np.full(128, len(_CLASSES), np.int64)
_INDEX[[ord(c) for c in _CLASSES]] = np.arange(len(_CLASSES))
_N = len(_CLASSES) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in KINDS) of the rules' matches, by start, then kind. Code points, end exclusive."""
    spans = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [(m.start(), m.end(), 2) for m in HEX_LONG.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _codes(word: str) -> np.ndarray:
    raw = np.frombuffer(word.encode("ascii", "replace"), np.uint8)
    return _INDEX[np.minimum(raw, 127)]


def train(words: list[str]) -> np.ndarray:
    """Log transition probabilities of a first-order character chain; row _N is the start. A context backs off to the model's own character frequencies."""
    return chain(transitions(words, LONGEST_WORD) / PARTS)


def transitions(words: list[str], longest: float) -> np.ndarray:
    """How often each character follows each other one, or begins a word (row _N), in PARTS; a word of more than ``longest`` characters weighs like so many."""
    counts = np.zeros((_N + 1, _N), np.int64)
    flat = [_codes(w) for w in words if 0 < len(w) <= longest]
    if flat:
        c = np.concatenate(flat)
        before = np.concatenate([[_N], c[:-1]])
        before[np.cumsum([0, *(len(x) for x in flat[:-1])])] = _N
        np.add.at(counts, (before, c), PARTS)
    for w in words:
        if len(w) > longest:
            c, own = _codes(w), np.zeros((_N + 1, _N))
            np.add.at(own, (np.concatenate([[_N], c[:-1]]), c), 1)
            counts += np.rint(own * (PARTS * longest / len(w))).astype(np.int64)
    return counts


def chain(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of counted transitions."""
    alone = counts.sum(0) + 0.1
    return np.log((counts + BACKOFF * alone / alone.sum()) / (counts.sum(1, keepdims=True) + BACKOFF))


@dataclass
class Models:
    """``table`` holds the log-likelihood ratio, random against ordinary, of every character after every other (the last row: at the start)."""

    table: np.ndarray
    least: float

    def ratios(self, words: pa.Array) -> np.ndarray:
        """Log-likelihood ratio of each word."""
        words = words.cast(pa.large_string())
        _, offsets, data = words.buffers()
        at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        c = _INDEX[np.minimum(np.frombuffer(data, np.uint8)[at[0] : at[-1]], 127)] if data else np.empty(0, np.int64)
        before = np.concatenate([[_N], c[:-1]])
        sizes = np.diff(at)
        before[(at[:-1] - at[0])[sizes > 0]] = _N
        total = np.concatenate([[0.0], np.cumsum(self.table[before, c])]) if len(c) else np.zeros(1)
        return total[at[1:] - at[0]] - total[at[:-1] - at[0]]

    def suspects(self, text: pa.Array) -> np.ndarray:
        """Which texts hold a run that looks random, found over all distinct runs at once."""
        lists = pc.split_pattern_regex(pc.fill_null(text.cast(pa.large_string()), ""), rf"[^{_KEY}]+")
        runs = lists.flatten()
        row = np.repeat(np.arange(len(text)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        long = pc.greater_equal(pc.binary_length(runs), MARKOV_LEAST)
        encoded = runs.filter(long).dictionary_encode()
        out = np.zeros(len(text), bool)
        if len(encoded.dictionary):
            random_like = self.ratios(encoded.dictionary) > self.least
            out[row[long.to_numpy(zero_copy_only=False)][random_like[encoded.indices.to_numpy()]]] = True
        return out


#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
_RULE_HINT = r"(?i)passw|secret|token|api|AKIA|[0-9a-f]{24}"


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled words and in how many texts each is: 1, a value that a rule found; 0, a run of key characters outside all matches."""
    found: Counter[tuple[str, int]] = Counter()

    def out() -> pa.RecordBatch:
        keys = list(found)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())]
        found.clear()
        return pa.RecordBatch.from_arrays(columns, names=["word", "label", "texts"])

    for batch in (p for whole in batches for p in text_slices(whole, "text")):
        texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        hinted = pc.match_substring_regex(texts, _RULE_HINT)
        plain = texts.filter(pc.invert(hinted))  # no rule can match these: their words are counted in columns
        lists = pc.split_pattern_regex(plain, rf"[^{_KEY}]+")
        runs, row = lists.flatten(), np.repeat(np.arange(len(plain)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        long = pc.greater_equal(pc.binary_length(runs), 3)
        encoded = runs.filter(long).dictionary_encode()
        size = max(1, len(encoded.dictionary))
        pairs = np.unique(row[long.to_numpy(zero_copy_only=False)] * size + encoded.indices.to_numpy())
        for w, n in zip(encoded.dictionary.to_pylist(), np.bincount(pairs % size, minlength=size).tolist(), strict=False):
            found[w, 0] += n
        for text in texts.filter(hinted).to_pylist():
            at, here = 0, set()
            for a, b, kind in [*base_spans(text), (len(text), len(text), -1)]:
                here |= {(w, 0) for w in re.findall(rf"[{_KEY}]{{3,}}", text[at : max(at, a)])}
                at = max(at, b)
                if kind >= 0:
                    here.add((ASSIGN.match(text, a)[2] if kind == 0 else text[a:b], 1))
            found.update(here)
        if len(found) > HELD_WORDS:
            yield out()
    if found:
        yield out()


def _summed(words: DataFrame, weights, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all ``words`` of what ``weights`` makes of a batch of them: one number a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape[0] * shape[1], np.int64)
        for batch in batches:
            total += weights(batch.column("word")).ravel()
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    rows = words.select("word").mapInArrow(tidy(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(shape)


def _ordinary_weights(words: list[str], longest: float) -> np.ndarray:
    """Transitions of ordinary words as they are, in capitals, in small letters and with a first capital; last, how many end with each character."""
    small = [w.lower() for w in words]
    ends = np.bincount([int(_INDEX[ord(w[-1])]) for w in small], minlength=_N)
    return np.concatenate([*(transitions(x, longest) for x in (words, [w.upper() for w in words], small, [w.capitalize() for w in words])), PARTS * ends[None]])


def _ordinary(weights: np.ndarray) -> np.ndarray:
    """Transitions of the words and their capitals, and those expected of as many identifiers as people write them, each of three words drawn alike: in equal parts snake, kebab,
    path and camel case; of kebab and camel case each with a number from 1 to 2999 behind one of ``_-/``."""
    plain, upper, small, camel = weights[:-1].reshape(4, _N + 1, _N)
    ends = weights[-1]
    n = max(float(ends.sum()), 1.0)
    last, out = ends / n, plain + upper
    marks = _INDEX[[ord(c) for c in "_-/"]]
    for mark in marks:
        out[_N] += small[_N] / 4
        out[:_N] += 3 * small[:_N] / 4
        out[:_N, mark] += 2 * ends / 4
        out[mark] += 2 * small[_N] / 4
    out[_N] += camel[_N] / 4
    out[:_N] += 3 * camel[:_N] / 4 + 2 * np.outer(last, camel[_N]) / 4
    numbers = transitions([str(k) for k in range(1, 3000)], LONGEST_WORD) / PARTS / 2999
    for mark in marks:
        out[:_N, mark] += ends / 2 / 3
        out[mark] += n / 2 / 3 * numbers[_N]
    out[:_N] += n / 2 * numbers[:_N]
    return out


def _random_strings(n: int, rng: np.random.Generator) -> list[str]:
    """Seeded strings over the alphabets that keys are made of, of 8 to 48 characters."""
    letters = _CLASSES[:52]
    alphabets = [np.array(list(a)) for a in (letters[:26] + _CLASSES[52:62], letters + _CLASSES[52:62], _CLASSES[:64], letters[26:] + _CLASSES[52:62], letters)]
    return ["".join(rng.choice(alphabets[k % len(alphabets)], rng.integers(8, 49))) for k in range(n)]


def _high(words: DataFrame, models: Models) -> float:
    """The ratio that all but one in OUTLIERS of the ``words`` stay below, rounded up; none for fewer words than that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step, n = np.unique(np.clip(np.floor(models.ratios(batch.column("word")) * STEPS), -(1 << 20), 1 << 20).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(n)], names=["step", "n"])

    counts = words.select("word").mapInArrow(tidy(run), "step long, n long").groupBy("step").agg(F.sum("n").alias("n")).toArrow().sort_by("step")
    below = np.cumsum(counts["n"].to_numpy())
    if not len(below) or below[-1] < OUTLIERS:
        return -np.inf
    return (int(counts["step"][int(np.searchsorted(below, below[-1] * (1 - 1 / OUTLIERS)))].as_py()) + 1) / STEPS


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", train_docs: float | None = None, longest_word: float = LONGEST_WORD, rarity: float = RARITY, seed: int = 7) -> Models:
    """Both models and their threshold, from all words of all documents, each distinct word once; one of more than ``longest_word`` characters weighs like so many. Only on request
    it learns from about ``train_docs`` whole documents, by hash of their id and text.

    Rule-found values are few in clean text, so seeded random strings over the key alphabet join that label. What the rules missed need not be ordinary: a first model learns from
    the words that are so surely (of letters alone, in two texts or more), from the same in capitals, and from identifiers made of them; of the other words those that it
    takes for random at ``rarity`` are left out, and the rest join it for the final model. A word counts as random where its ratio outweighs ``rarity``, and what all but
    a hundredth of the held-out surely ordinary words reach: no single word can raise that. An empty table leaves the random strings and a few plain words, so a scan is always defined.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if train_docs is not None:
        rows = rows.where(uniform(F.xxhash64("id", "text")) < train_docs / F.lit(max(1, docs.count())))
    each = rows.select("text").mapInArrow(tidy(_word_batches), "word string, label int, texts long").groupBy("word", "label").agg(F.sum("texts").alias("texts"))
    words = materialise(each, "secret-words")
    found, others = words.where("label = 1"), words.where("label = 0")
    letters = F.col("word").rlike("^[A-Za-z]+$")
    held = F.pmod(F.xxhash64("word"), F.lit(HELD)) == 0
    counts = others.where(letters).agg(*(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in {"sure": F.col("texts") > 1, "lettered": F.lit(True), "sure_shown": (F.col("texts") > 1) & ~held, "lettered_shown": ~held}.items())).first()
    few = counts["sure"] < SURELY  # a small or odd table: all words of letters
    sure = letters if few else letters & (F.col("texts") > 1)
    shown = sure & ~held if counts["lettered_shown" if few else "sure_shown"] else sure
    weigh = lambda batch: transitions(batch.to_pylist(), longest_word)
    shape = _N + 1, _N
    random_like = chain((_summed(found, weigh, shape) + transitions(_random_strings(6000, np.random.default_rng(seed)), longest_word)) / PARTS)
    if few and not counts["lettered"]:
        ordinary = _ordinary_weights(["plain", "words", "only"], longest_word).astype(float)
    else:
        ordinary = _summed(others.where(shown), lambda batch: _ordinary_weights(batch.to_pylist(), longest_word), (4 * (_N + 1) + 1, _N))
    made = _ordinary(ordinary)
    first = Models(random_like - chain(made / PARTS), float(np.log(rarity)))
    rest = _summed(others.where(~sure), lambda batch: weigh(batch.filter(pa.array(first.ratios(batch) <= first.least))), shape)
    models = Models(random_like - chain((made + rest) / PARTS), first.least)
    models.least = max(models.least, _high(others.where(sure & held & (F.length("word") >= MARKOV_LEAST)), models))
    discard(words)
    return models


def markov_spans(text: str, base: list[tuple[int, int, int]], models: Models) -> list[tuple[int, int, int]]:
    """Candidates that touch no base span and look random to the models."""
    found = [m.span() for m in CANDIDATE.finditer(text)]
    if not found:
        return []
    ratios = models.ratios(pa.array([text[a:b] for a, b in found], pa.string()))
    out, at, reach = [], 0, 0
    for (a, b), r in zip(found, ratios, strict=True):
        while at < len(base) and base[at][0] < b:  # both go by start: reach is where base spans that begin before b end
            reach = max(reach, base[at][1])
            at += 1
        if r > models.least and reach <= a:
            out.append((a, b, 3))
    return out


def _all_spans(texts: pa.Array, models: Models) -> Iterator[tuple[str | None, list[tuple[int, int, int]]]]:
    for text, suspect in zip(texts.to_pylist(), models.suspects(texts).tolist(), strict=True):
        base = base_spans(text) if text else []
        yield text, sorted(base + markov_spans(text, base, models), key=lambda s: (s[0], s[2])) if suspect else base


def scan(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): ``spans`` is an array of (kind, start, end) by start, then kind; code points, end exclusive.

    One row for each row of ``docs``; a null or empty text has no spans. Base spans of different kinds may overlap; markov spans touch none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in (p for whole in batches for p in text_slices(whole, "text")):
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in found] for _, found in _all_spans(batch.column("text"), models)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, pa.list_(kind))], names=["id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "id long, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, models: Models, *, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; overlapping spans are one. Rows without secrets and other columns, whatever their names, stay as they are."""
    at = docs.columns.index(text_col)

    def clean(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        if not spans:
            return text
        out, done = [], 0
        for a, b, _ in spans:
            if a >= done:
                out += [text[done:a], mark]
            done = max(done, b)
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string())], names=["text"])
            cleaned = [clean(*x) for part in text_slices(texts, "text") for x in _all_spans(part.column("text"), models)]
            field = batch.schema.field(at)
            yield batch.set_column(at, field, pa.array(cleaned, field.type))

    return docs.mapInArrow(tidy(run), docs.schema)


def secret_digests(spans: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``scan`` output, in SQL functions."""
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return spans.select(
        id_col, *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
