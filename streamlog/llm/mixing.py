"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shared import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: A source's documents are dealt over this many buckets by hash, so no window holds a source, however large.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size) -> the same with weight, cap and target: water-filling over sources.

    With sources by cap/weight, the first whose level - what is left over the weights that are left - doesn't exceed its cap ends the clamping:
    all before it take their cap, all from it on share the rest by weight. One row a source, so these windows stay small.
    """
    cycle = F.array(*(F.lit(int(w)) for w in weights))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(1))
    return (
        sizes.withColumn("weight", F.element_at(cycle, (rank % len(weights) + 1).cast("int")).cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("pool", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(level.rowsBetween(W.currentRow, W.unboundedFollowing)))
        .withColumn("clamped", (F.col("pool") - F.col("capped_before")) * F.col("weight") > F.col("cap") * F.col("weight_left"))
        .withColumn("rest", F.col("pool") - F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0.0)).over(every))
        .withColumn("sharing", F.sum(F.when(F.col("clamped"), 0.0).otherwise(F.col("weight"))).over(every))
        .withColumn("target", F.when(F.col("clamped"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * (F.col("rest") / F.col("sharing")))))
        .select("source", "source_size", "weight", "cap", "target")
    )


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2, seed: str = "mix-1") -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns id, source, ``size`` (words, null text: 0), ``source_size``, ``target`` (words wanted of its source), ``taken`` (words taken, repeats
    counted) and ``copies`` (whole rows to write, the nearest). A source is taken whole as often as its target allows; of one more pass it gives
    documents in the order of a seeded hash of the id (without one, of the text) until the target is met, the last of them in part. So a source's ``taken`` add up to its target
    rounded, and no row exceeds ``max_epochs`` times its size. Null sources are one source, the last. Ties of the hash (repeated rows) go by size.
    Empty sources have target 0. An empty table gives no rows; other columns are not read.
    """
    keyed = _keyed(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")), seed).drop("text")
    rows = materialise(keyed, "mix-sizes")
    return _place(rows, _goals(rows, weights, share, max_epochs)).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("whole") * F.col("size") + F.col("extra")).cast("long").alias("taken"), _copies().alias("copies"),
    )


def repeat(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2, seed: str = "mix-1") -> DataFrame:
    """``docs`` with every row as often as ``mix`` copies it, all columns as they are; a row that isn't taken is left out.

    Full rows aren't shuffled: each source's last pass ends at one place of its order, and a row needs only that. Rows that tie with it go by text.
    """
    full = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    sizes = materialise(_keyed(full.drop("row"), seed).drop("text"), "mix-sizes")
    cuts = materialise(_cuts(sizes, _goals(sizes, weights, share, max_epochs)), "mix-cuts")  # one row a source
    spot, cut = F.struct("bucket", "key"), F.struct("cut_bucket", "cut_key")
    placed = _keyed(full, seed).join(cuts, F.col("source").eqNullSafe(F.col("s"))).withColumn("words", F.col("text").rlike(WORD))
    tied = F.coalesce((spot == cut) & (F.col("size") == F.col("cut_size")), F.lit(False))
    earlier = F.coalesce((spot < cut) | ((spot == cut) & (F.col("size") < F.col("cut_size"))), F.lit(False))
    chosen = placed.withColumn("extra", F.coalesce(F.col("words"), F.lit(False)) & (earlier | (tied & (F.col("among_ties") == F.col("ties")))))
    some = F.col("among_ties").between(1, F.col("ties") - 1)
    if not cuts.where(some).isEmpty():  # repeated ids where a pass ends: these rows are numbered
        number = F.row_number().over(W.partitionBy("source").orderBy("text"))
        split = placed.where(some & tied).withColumn("extra", number <= F.col("among_ties"))
        chosen = chosen.where(~F.coalesce(some & tied, F.lit(False))).unionByName(split)
    copies = F.col("whole") + F.col("extra").cast("long")
    return chosen.withColumn("copies", copies).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def _cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """One row a source: whole passes, the place (bucket, key, size) where its last pass ends, how many rows tie there, and how many of these it takes, the last if half of it or more."""
    last = goals.where((F.col("start") < F.col("part")) & (F.col("part") <= F.col("start") + F.col("bucket_size")))
    inside = rows.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).where("size > 0")
    spots = inside.groupBy("s", "bucket", "key", "size", "start", "part").agg(F.count(F.lit(1)).alias("ties"))
    before = F.coalesce(F.sum(F.col("ties") * F.col("size")).over(W.partitionBy("s").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.col("part") - F.col("start") - F.col("before")
    ends = spots.withColumn("before", before).where((left > 0) & (left <= F.col("ties") * F.col("size")))
    taken = F.floor((left * 2 + F.col("size")) / (F.col("size") * 2)).cast("long")
    ends = ends.select(F.col("s").alias("of"), F.col("bucket").alias("cut_bucket"), F.col("key").alias("cut_key"), F.col("size").alias("cut_size"), "ties", taken.alias("among_ties"))
    sources = goals.select("s", "whole").distinct()
    return sources.join(ends, F.col("s").eqNullSafe(F.col("of")), "left").drop("of")


def _keyed(rows: DataFrame, seed: str) -> DataFrame:
    """Adds size, the seeded hash of the id (of the text, where there is none), and its bucket."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.col("text"), F.lit(""))))
    return rows.withColumn("size", word_count(F.col("text"))).withColumn("key", key).withColumn("bucket", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % BUCKETS).cast("int"))


def _goals(rows: DataFrame, weights: Sequence[int], share: float, max_epochs: int) -> DataFrame:
    """One row a (source, bucket): its source's target, whole passes and words of one more, and the words in the buckets before."""
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights=weights, share=share, max_epochs=max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = targets.withColumn("whole", whole).withColumn("part", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    before = F.coalesce(F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = buckets.withColumn("start", before).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "start", "bucket_size")
    return starts.join(goals, F.col("s").eqNullSafe(F.col("source"))).drop("source")


def _place(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Adds what each row gives to its source's last, partial pass."""
    inside = W.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = rows.withColumn("earlier", earlier).join(goals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return placed.withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - F.col("start") - F.col("earlier"))))


def _copies() -> Column:
    return F.col("whole") + (F.col("extra") * 2 >= F.greatest(F.col("size"), F.lit(1))).cast("long")


#: The same in DuckDB's SQL.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(concat('mix-1:', coalesce(doc_id::VARCHAR, text, ''))) AS k FROM documents),
d2 AS (SELECT *, ('0x' || substr(k, 1, 8))::BIGINT % 4096 AS bucket FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
s2 AS (SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS pool,
              coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
              sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM s1),
s3 AS (SELECT *, (pool - before) * weight > cap * weight_left AS clamped FROM s2),
s4 AS (SELECT *, pool - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER () AS rest, sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER () AS sharing FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN clamped THEN cap ELSE least(cap, weight * (rest / sharing)) END AS target FROM s4),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM s5),
c AS (SELECT d2.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY bucket, k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM d2)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target)::BIGINT - whole * source_size - earlier)))::BIGINT AS taken
FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
"""
