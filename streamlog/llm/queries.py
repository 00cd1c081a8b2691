"""The operators of this package as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, collocations, language_id, matroska, merkle, mixing, neighbours, packing, secret_scan, sharding, token_counts, token_planes
from .ngram_jaccard import near_duplicates
from .words import short_batches


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file; every executor has the package that holds it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out() -> Column:
    """Rows that no language model may learn from: one id in three."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, Jaccard 0.9: each document with the smallest doc_id it is linked to."""
    found = near_duplicates(_table(spark, sf_dir, "documents"), width=3, threshold=(9, 10))
    return found.select("doc_id", "n_shingles", "component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule spans and Markov spans of every text, as counts and digests."""
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.secret_digests(secret_scan.scan(docs, secret_scan.fit(docs)))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the word BPE of 49k ids."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), limit=2048)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all others: the five nearest by cosine."""
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a planted one full of control strings, formatted and read back."""
    planted = spark.createDataFrame([(-7, 0, "user", chat_format.PLANTED), (-7, 1, "assistant", chat_format.PLANTED)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    return chat_format.chat_digests(chat_format.format_chats(turns))


def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 ids, each followed by id 1."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, window=2048, with_ids=False)
    return pieces.drop("ids")


def op7_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level ids with end id 2, written in bit planes and read back."""
    return token_planes.token_planes(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as samples in Matroska, stored, read back and described."""
    return matroska.media_features(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 by turns over sources in code point order, 150 % of all words, two epochs at most."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root, and what a tampered one folds to."""
    return merkle.merkle_digests(_table(spark, sf_dir, "documents"))


def op12_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of a hash tree, and where a ninth shard would put them."""
    return sharding.assign(_table(spark, sf_dir, "documents"), sharding.topology(8), sharding.topology(9))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two or three words of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_jaccard, op2_secret_scan, op3_token_counts, op4_nearest_neighbours, op5_chat_format, op6_retrieval_packing, op7_token_planes, op8_media_columns, op9_language_id, op10_source_mixing, op11_merkle_manifest, op12_hash_tree_shards, op13_phrase_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": chat_format.ORACLE, "op10_source_mixing": mixing.ORACLE, "op11_merkle_manifest": merkle.oracle(), "op12_hash_tree_shards": sharding.ORACLE, "op13_phrase_collocations": collocations.ORACLE}
