"""Counts, models and thresholds are those of all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from streamlog.llm import packing


def test_shards_end_by_the_sizes_of_all_documents(spark, monkeypatch):
    """Of a table that is taken for one of 400,000 documents no shard has more ids than the bound."""
    monkeypatch.setattr(packing, "SHARD_IDS", 300)
    rng, n = np.random.default_rng(3), 400
    rows = [(k, size, bytearray(rng.integers(0, 900, size).astype("<u2").tobytes())) for k, size in enumerate(rng.integers(5, 40, n).tolist())]
    encoded = spark.createDataFrame(rows, "id long, n long, ids binary").repartition(3, "id")
    df = spark.sparkContext.broadcast(np.full(900, 9.0))
    placed = packing._place(encoded, df, 400_000, 22.0, 2048)
    sizes = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert sum(sizes.values()) == sum(r[1] for r in rows) and len(sizes) > 10
    assert max(sizes.values()) <= 300, sizes


def test_a_slice_of_windows_is_opened_in_bounded_memory():
    """What numpy and Python hold of it at most, beside Arrow's own buffers."""
    import tracemalloc

    import pyarrow as pa

    from streamlog.llm import collocations

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 400) % 50_000) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    tracemalloc.start()
    try:
        blocks = list(collocations._open_batches(8)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counted = collocations._unpacked([row for b in blocks for row in b.to_pylist()])
    assert int(counted.n.sum()) == 400_000
    assert peak < 90 * 400_000, peak / 400_000  # bytes a word


def _same_predictions(spark, monkeypatch, **bounds):
    from streamlog.llm import language_id

    rng = np.random.default_rng(8)
    stems = {x: ["".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(60)] for x, letters in (("a", "abcdeé"), ("b", "bcdfxy"), ("c", "xyzaué"))}
    text = lambda x: " ".join(rng.choice(stems[x], 9)) + f" {''.join(rng.choice(list('abcxyz'), 6))}"
    rows = [(k, text("abc"[k % 3]), "abc"[k % 3]) for k in range(150)]
    odd = [(None, None, "a"), (900, "", None), (901, "12 -", "b"), (902, "́", None), (903, rows[0][1], None), (903, rows[0][1], None), (904, "qqq jjj", None), (905, "q", "a")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit(docs.where("doc_id < 100"))
    want, kept = language_id.predict(docs, model).collect(), language_id.accept(docs, model, least=0.6).collect()
    for name, value in bounds.items():
        monkeypatch.setattr(language_id, name, value)
    large = language_id.fit(docs.where("doc_id < 100"))
    assert large.other_words is not None and not large.grams and len(large.words) < len(model.words)
    got = language_id.predict(docs, large).collect()
    order = lambda rows: sorted(rows, key=lambda r: (str(r[0]), str(r[1]), str(r[-1])))
    assert [r[:2] for r in order(got)] == [r[:2] for r in order(want)]
    assert all(abs(g[2] - w[2]) < 1e-7 for g, w in zip(order(got), order(want), strict=True))
    assert order(language_id.accept(docs, large, least=0.6).collect()) == order(kept) and len(kept) < docs.count()


def test_a_model_too_large_for_a_worker_predicts_the_same(spark, monkeypatch):
    _same_predictions(spark, monkeypatch, WHOLE=10, KEPT=40)


def test_a_model_without_any_common_word_predicts_the_same(spark, monkeypatch):
    _same_predictions(spark, monkeypatch, WHOLE=10, KEPT=0)


def test_languages_are_learned_from_all_rows(spark):
    """4,000 rows of one language, each with a word of its own: all words are known."""
    from streamlog.llm import language_id

    word = lambda k: "w" + "".join("abcdefghij"[int(c)] for c in str(k))
    rows = [(k, f"common {word(k)}", "a") for k in range(4000)] + [(-1, "autre", "b")]
    assert len(language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).words) == 4002


def test_secret_models_learn_from_all_words(spark):
    """30,000 words of one text each, beyond 20,000 words and, with copies, 20,000 documents: the sums of transitions are those of all."""
    from streamlog.llm import secret_scan

    words = [f"word{k:x}" for k in range(30_000)] + ["x-" * 700]
    table = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "doc_id long, text string")
    rows = table.select("text").mapInArrow(secret_scan._word_batches, "word string, label int, texts long").groupBy("word", "label").sum("texts").collect()
    assert {(r[0], r[1], r[2]) for r in rows} == {(w, 0, 1) for w in words}
    seen = []
    real = secret_scan._summed
    try:
        secret_scan._summed = lambda *a: seen.append(real(*a)) or seen[-1]
        secret_scan.fit(table)
    finally:
        secret_scan._summed = real
    start = secret_scan._N, secret_scan._INDEX[ord("w")]
    assert seen[2][start] == secret_scan.PARTS * sum(not w.isalpha() for w in words[:-1])  # beside words of letters


def test_words_of_texts_with_and_without_matches(spark):
    """Words, labels and numbers of texts as the rules say, for texts that hint at a rule and others."""
    import re

    from streamlog.llm import secret_scan

    texts = ["abc abc de fgh-i", "token=abcdefgh abc", "capital abc é_x", None, "", "deadbeef" * 3 + " abc", "AKIA" + "Z" * 16 + "abc", "password: 'short' abc/def"]
    want = {}
    for t in texts:
        spans, at, here = secret_scan.base_spans(t or ""), 0, set()
        for a, b, kind in [*spans, (len(t or ""), 0, -1)]:
            here |= {(w, 0) for w in re.findall(r"[A-Za-z0-9+/_=-]{3,}", (t or "")[at : max(at, a)])}
            at = max(at, b)
            if kind >= 0:
                here.add((secret_scan.ASSIGN.match(t, a)[2] if kind == 0 else t[a:b], 1))
        for k in here:
            want[k] = want.get(k, 0) + 1
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).mapInArrow(secret_scan._word_batches, "word string, label int, texts long").collect()
    assert {(r[0], r[1]): r[2] for r in rows} == want


def test_expected_identifiers_are_those_of_written_ones():
    """Transitions of identifiers by their expectation, next to those of 40,000 written ones."""
    from streamlog.llm import secret_scan as s

    words, rng = ["Harbour", "orchard", "sea", "of"], np.random.default_rng(2)
    made = []
    for k in range(40_000):
        parts = [words[i] for i in rng.integers(0, 4, 3)]
        joined = "".join(p.capitalize() for p in parts) if k % 4 == 3 else "_-/"[k % 4].join(p.lower() for p in parts)
        made.append(joined + (f"{'_-/'[k % 3]}{rng.integers(1, 3000)}" if k % 2 else ""))
    weights = s._ordinary_weights(words, 1000)
    plain = s.transitions(words, 1000) + s.transitions([w.upper() for w in words], 1000)
    want, got = s.transitions(made, 1000) / 10_000, s._ordinary(weights.astype(float)) - plain
    assert abs(got.sum() - want.sum()) < 0.01 * want.sum() and np.abs(got - want).max() < 0.02 * want.max()


def test_memory_goes_back_between_batches(monkeypatch):
    """A long task doesn't keep what one batch needed until it ends."""
    from streamlog.llm import words

    calls, now = [], [0.0]
    monkeypatch.setattr(words, "release", lambda: calls.append(now[0]))
    monkeypatch.setattr(words.time, "monotonic", lambda: now[0])

    def run(batches):
        for b in batches:
            now[0] += words.RELEASE_S * 0.6
            yield b

    assert list(words.tidy(run)(iter(range(6)))) == list(range(6))
    assert len(calls) == 4  # at every second batch, and at the end
