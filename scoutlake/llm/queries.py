"""Registered queries of the operators, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from scoutlake.llm import (
    attention_lm, byte_bpe, fingerprints, grid_join, language_id, licences, middle_fill, mixing, path_dedup, quality_net,
    token_alignment, token_counts, toxic_crf,
)
from scoutlake.llm.common import id_fold, stored


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality_net.score_documents(docs, quality_net.fit(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", (id_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op2_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return attention_lm.score_documents(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op3_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return path_dedup.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_counts.section_tokens(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op5_licences(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(table(spark, sf, "documents")).drop("matches")


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxic_crf.fit(docs, table(spark, sf, "labels"))
    scored = toxic_crf.score_documents(docs, model)
    return scored.select("doc_id", (id_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "spans")


def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return grid_join.near_vectors(table(spark, sf, "embeddings"))


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    sized = stored(docs, "sized")
    mixed = mixing.take_words(sized, mixing.source_targets(sized), mixing.SEED, "doc_id", "source")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = byte_bpe.decode_documents(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf, "documents"))


def op11_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    predicted = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs))
    return predicted.select("doc_id", (id_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    filled = middle_fill.transform(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    return middle_fill.restore(filled).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    tokenizers = token_alignment.load(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
    )
    aligned = token_alignment.align_documents(docs, tokenizers, token_alignment.pair_table(docs, tokenizers))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_lm_scores": op2_lm_scores,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_licences": op5_licences,
    "op6_toxicity": op6_toxicity,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_mixing": op8_mixing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_fingerprints": op10_fingerprints,
    "op11_language_id": op11_language_id,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES = {
    "op8_mixing": mixing.ORACLE,
    "op12_fill_in_middle": middle_fill.ORACLE,
}
