"""From raw documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``. Rejected are documents without a recognisable language; of near duplicates one stays;
secrets are masked in place; sources are repeated or thinned out toward their targets; the rest is packed.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog.llm import language_id, mixing, ngram_jaccard, packing, secret_scan
from streamlog.llm.queries import held_out, tokenizer_path
from streamlog.llm.words import short_batches
from streamlog.shared import materialise

#: A document whose best language has a smaller share of the posterior is rejected.
LEAST_SCORE = 0.5


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no recognisable language, null and empty ones among them; an unlabelled one gets its predicted language."""
    model = language_id.fit(docs.where(~held_out()))
    return language_id.accept(docs, model, least=LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, Jaccard 0.8: of each group of linked documents the one with the smallest id stays, once; one without an id only if none has one.

    Rows are told apart by id and text, so rows that share an id but not their text are documents of their own.
    """
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    linked = ngram_jaccard.near_duplicates(keyed.select("key", "text"), id_col="key", width=5, threshold=(4, 5)).select("key", "component_id")
    named = materialise(linked.join(keyed.select("key", "doc_id").distinct(), "key"), "near-duplicates")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))["key"].alias("first"))
    first = materialise(first, "first-of-each")  # a table of its own, so that Spark can split the rows of a large component
    gone = named.join(first, "component_id").where(F.col("key") != F.col("first")).select("key").distinct()
    kept = keyed.select("row", "key").join(gone, "key", "left_anti")
    again = named.groupBy("key").count().where("count > 1").select("key")
    return kept.join(again, "key", "left_anti").union(kept.join(again, "key", "left_semi").dropDuplicates(["key"])).select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret; no document goes. ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs, secret_scan.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 and 150 % of all words, two epochs at most: each document as often as the mix takes it. Packing parts its copies again."""
    return mixing.repeat(docs, weights=(5, 2, 1), share=1.5, max_epochs=2)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 ids with the neighbours that BM25 finds; pieces with their ids. No window holds a document twice."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, window=2048)



def _bounded(stage):
    """A stage whose Arrow batches hold few texts, so that what its workers hold doesn't add up over the stages."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [(name, _bounded(f)) for name, f in (("language ID", languages), ("n-gram Jaccard join", near_duplicates), ("secret scans", secrets), ("mixing sources", mix), ("packing", packed))]

#: SQL can't express learned models, near-duplicate components or packing; the tests hold each stage against a plain version, on what the stage before kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
