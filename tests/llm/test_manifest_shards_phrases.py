"""Merkle manifest, hash-tree shards and phrase collocations: against plain versions, with nulls, empties, ties, repeats and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streamlog.llm import collocations, merkle, queries, sharding

CLASH = "doc_id long, text string, lang string, source string, n_chars long, tree long, rank long, level int, lo long, hi long, path string, key string, bucket int, at string, w1 string, n long, `of` string"
ORACLES = queries.oracle_sql()


def docs(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars), with further columns of the names that the operators use inside."""
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "p", "k", 6, "a", "w", 7, "o") for r in rows], CLASH)


LONG = "long line of a very long text\n" * 20_000
ROWS = [
    *((k, f"text {k}\n of source", "en", f"s{k % 3}", 9) for k in range(40)), (40, None, None, None, None), (41, "", "", "", 0), (42, LONG, "de", "s0", len(LONG)), (43, "é\n\U0001f600", "fr", "é", 3), (44, "a", "en", "S", 1),
    (None, "no id\n", "en", "s1", 6), (None, None, None, None, None), (7, "text 7\n of source", "en", "s1", 9), (7, "another 7\n", "en", "s1", 10), (5, "text 5\n of source", "en", "s2", 9), (-3, "below zero\n", "en", "s1", 11),
]


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_hash_tree_shards", "op13_phrase_collocations"])
def test_queries_agree_with_sql(name, same):
    same(queries.queries()[name], ORACLES[name])


# Manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(rows, width=3):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row, by lists."""

    def climb(level):
        """All levels, and each leaf's siblings as (left, right) from the bottom up."""
        levels = [level]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([H(*last[k : k + width]) for k in range(0, len(last), width)])
        steps = []
        for k in range(len(level)):
            at, own = k, []
            for lv in levels[:-1]:
                run = at // width * width
                own.append(("".join(lv[run:at]), "".join(lv[at + 1 : run + width])))
                at //= width
            steps.append(own)
        return levels[-1][0], steps

    by = {}
    for r in rows:
        doc, text, lang, source, n = r
        leaf = H(enc(doc), enc(source), enc(lang), enc(n), enc(text))
        bent = text if text is None or doc is None or zlib.crc32(str(doc).encode()) % 2 else text.replace("\n", "")
        by.setdefault(source, []).append((doc is not None, doc or 0, leaf, doc, H(enc(doc), enc(source), enc(lang), enc(n), enc(bent))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s]), climb([x[2] for x in sorted(by[s])])) for s in sources}
    root, above = climb([trees[s][1][0] for s in sources])
    out = []
    for s, up in zip(sources, above, strict=True):
        leaves, (subroot, steps) = trees[s]
        for (*_, leaf, doc, bent), low in zip(leaves, steps, strict=True):
            folded = bent
            for left, right in low + up:
                folded = H(left, folded, right)
            out.append((doc, leaf, subroot, root, H("".join(a + b for a, b in low + up)), folded, folded == root))
    return out


def digests(df):
    found = merkle.merkle_digests(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_manifest(spark):
    got = digests(docs(spark, ROWS))
    assert got == sorted(plain_manifest(ROWS), key=str)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("n, sources", [(1, 1), (3, 1), (4, 4), (28, 1), (30, 10), (82, 2)])
def test_manifest_of_all_shapes(spark, monkeypatch, n, sources):
    """Trees that end inside a tier, at its end and beyond it."""
    monkeypatch.setattr(merkle, "TIER", 2)
    rows = [(k, f"t{k}\n", "en", f"s{k % sources}", k) for k in range(n)]
    leaves = docs(spark, rows).select("doc_id", "source", F.sha2(F.col("text").cast("binary"), 256).alias("leaf"))
    nodes = merkle.forest(leaves.selectExpr("0L as tree", f"{n}L as n", "doc_id as rank", "leaf as digest"), tier=2)
    level = [hashlib.sha256(f"t{k}\n".encode()).hexdigest() for k in range(n)]
    want = {(0, k, k + 1): d for k, d in enumerate(level)}
    height = 0
    while len(level) > 1:
        height += 1
        level = [H(*level[k : k + 3]) for k in range(0, len(level), 3)]
        want |= {(height, k * 3**height, min(n, (k + 1) * 3**height)): d for k, d in enumerate(level)}
    assert {(r["level"], r["lo"], r["hi"]): r["digest"] for r in nodes.collect()} == want
    assert digests(docs(spark, rows)) == sorted(plain_manifest(rows), key=str)


def test_manifest_of_nothing_and_of_equal_rows(spark):
    assert merkle.merkle_digests(docs(spark, [])).count() == 0
    same_rows = [(1, "equal\n", "en", "s", 6)] * 11
    assert digests(docs(spark, same_rows)) == sorted(plain_manifest(same_rows), key=str)
    made = merkle.manifest(docs(spark, ROWS).select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("leaf")), group="source", order=["doc_id"])
    proofs = made.proofs()
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0 and proofs.count() == len(ROWS)


# Shards


def plain_place(key, shards):
    """The shard a key descends to, by Python's own md5 and logarithm."""
    from math import log

    def pick(names):
        draws = [(-log((int(hashlib.md5(f"{key}:{n}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / w, n) for n, w in names.items() if w > 0]
        return min(draws)[1]

    def weigh(some, level):
        out = Counter()
        for s in some:
            out[str(getattr(s, level))] += s.weight
        return out

    some = shards
    for level in ("region", "rack", "shard"):
        name = pick(weigh(some, level))
        some = [s for s in some if str(getattr(s, level)) == name]
    return some[0].shard


def test_shards(spark):
    eight, nine = sharding.topology(8), sharding.topology(9)
    got = sharding.assign(docs(spark, ROWS), eight, nine).collect()
    assert len(got) == len(ROWS)
    blank = lambda t: (t or "").encode()
    key = lambda d, t: str(d) if d is not None else "t" + hashlib.md5(t.encode()).hexdigest() if t is not None else ""
    want = Counter((d, len(blank(t)) + 1, zlib.crc32(blank(t)), "key", plain_place(key(d, t), eight), plain_place(key(d, t), nine)) for d, t, *_ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got) == want
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    assert sharding.assign(docs(spark, []), eight).count() == 0 and {r["grown_shard"] for r in sharding.assign(docs(spark, ROWS), eight).collect()} == {None}


def test_equal_rows_are_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    got = sharding.assign(docs(spark, [(1, "same", "en", "s", 4)] * 50 + [(2, "x", "en", "s", 1)]), sharding.topology(1)).collect()
    assert sorted(r["slot"] for r in got) == list(range(51)) and Counter(r["doc_id"] for r in got) == {1: 50, 2: 1}


def test_weights_move_keys_into_their_subtree_only(spark):
    """Shares follow the weights; a heavier rack draws keys into its region, a lighter shard loses some, and nothing else moves."""
    old = [sharding.Shard(f"r{k // 4}", f"k{k // 2}", k, 1.0 + k % 2) for k in range(8)]
    new = [sharding.Shard(s.region, s.rack, s.shard, 4.0 if s.shard == 1 else s.weight) for s in old]
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    both = sharding.place(sharding.place(rows, F.col("key"), old), F.col("key"), new, column="grown")
    moves = {(r["shard"], r["grown"]): r["count"] for r in both.groupBy("shard", "grown").count().collect()}
    held = Counter()
    for (a, _), n in moves.items():
        held[a] += n
    assert all(abs(held[s.shard] / 20_000 - s.weight / 12) < 0.012 for s in old)
    for (a, b), n in moves.items():
        heavier = (a >= 4 and b < 4) or (a in (2, 3) and b in (0, 1)) or (a, b) == (0, 1)  # into the region, the rack and the shard that became heavier
        assert a == b or heavier, (a, b, n)
    empty = [sharding.Shard("r", "k", k, float(k == 1)) for k in range(3)]
    assert {r["shard"] for r in sharding.place(rows, F.col("key"), empty).select("shard").distinct().collect()} == {1}
    for bad in ([], [sharding.Shard("r", "k", 1, -1.0)], [sharding.Shard("r", "k", 1)] * 2, [sharding.Shard("r", "k", 1), sharding.Shard("q", "k", 2)]):
        with pytest.raises(ValueError):
            sharding.place(rows, F.col("key"), bad)


def test_shards_run_without_python(spark, data):
    plan = queries.op12_hash_tree_shards(spark, data)._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "Python" not in plan and "InPandas" not in plan


# Phrases


def plain_phrases(rows, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\v\f\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    out, candidates = {}, {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    most = Counter()
    for (lang, w), a in candidates.items():
        if len(w) == 3:
            for part in (w[:2], w[1:]):
                most[lang, part] = max(most[lang, part], a)
    for (lang, w), a in candidates.items():
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        if len(w) == 3 or 100 * most[lang, w] < inside * a:
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in out.items() for k, (s, a, p, left, right) in enumerate(sorted(all_)[:top])}


def phrases(df, **k):
    return {tuple(r) for r in collocations.collocations(df, **k).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def test_phrases(spark):
    rng = random.Random(4)
    words = ["the", "The", "of", "New", "york", "café", "É", "x y", "\U0001f600", "a-b", "it's"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\v"]) for _ in range(n))
    rows = [(k, text(rng.randint(0, 120)), rng.choice(["en", "de", None, "und", "x\ty", ""]), "s", 1) for k in range(90)]
    rows += [(None, None, "en", "s", 1), (91, "", "en", None, 1), (92, "...", None, "s", 1), (93, "new york city " * 3000, "en", "s", 1), (94, "one", "fr", "s", 1)] + [(95, "again and again", "fr", "s", 1)] * 12
    for least, inside, top in ((10, 50, 2000), (3, 80, 5), (1, 50, 2000)):
        assert phrases(docs(spark, rows), least=least, inside=inside, top=top) == plain_phrases(rows, least, inside, top)
    assert phrases(docs(spark, [])) == phrases(docs(spark, [(1, None, None, None, None)])) == set()


def test_phrases_in_small_slices(spark, monkeypatch):
    """Many slices and parts, and few buckets, give what one does."""
    monkeypatch.setattr(collocations, "SLICE_BYTES", 500)
    monkeypatch.setattr(collocations, "BUCKETS", 3)
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(60)), rng.choice(["en", "de"]), "s", 1) for k in range(60)]
    assert phrases(docs(spark, rows), top=20) == plain_phrases(rows, top=20)


def test_windows_sum_beyond_63_bits():
    """Codes whose joint key would outgrow an integer are numbered on the way."""
    import numpy as np

    base, rng = 1 << 30, np.random.default_rng(1)
    columns = [rng.integers(0, base, 500) for _ in range(3)]
    columns = [np.concatenate([c, c[:200]]) for c in columns]
    found, n = collocations._sum_up(columns, np.ones(700, np.int64), base)
    want = Counter(zip(*(c.tolist() for c in columns), strict=True))
    got = list(zip(*(c.tolist() for c in found), strict=True))
    assert dict(zip(got, n.tolist(), strict=True)) == want and got == sorted(got)


def test_scores_are_exact(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(500):
        left, right = (rng.randrange(1, 10 ** rng.randrange(1, 15)) for _ in range(2))
        rows.append((rng.randrange(1, min(left, right) + 1), left, right))
    df = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", collocations._score("a", "l", "r"))
    assert all(r["s"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in df.collect())


def test_blocks_round_trip():
    made = collocations._opened(pa.array(["en", None, "en"]), pa.array(["a b c. a b", None, "b c\nÉ é"]))
    blocks = [r for b in made.blocks(5, 3) for r in b.to_pylist()]
    whole = collocations._unpacked(blocks)
    rows = lambda w: sorted(map(tuple, (r.values() for r in w.rows().to_pylist())))
    assert rows(whole) == rows(made) and sum(made.n) == 9
