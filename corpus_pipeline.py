"""A training-data pipeline over `documents`: filter, deduplicate, mix and encode.

Every stage takes what its predecessor kept, whole. The filters learn from the
documents that are left and the labels outside their held-out folds. Rows that
repeat in the input stay repeated until the near-duplicate stage keeps one document
of each group; the mix repeats documents on purpose, so ids recur in the result.
Rows without an id stay, null texts count as empty ones, an empty table gives an empty result, and columns that
no stage reads are handed through up to the last one, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake.llm import byte_bpe, mixing, path_dedup, quality_net, toxic_crf
from scoutlake.llm.common import stored

READ = ("doc_id", "text", "source")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    """The three columns that the operators read, and the others in one, so that no name can clash with an added one."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in READ]
    return docs.select(*READ, F.struct(*others, F.lit(True).alias("_packed")).alias("_others"))


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col(c) if c in READ else F.col(f"_others.`{c}`") for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3."""
    rows = _packed(docs)
    model = toxic_crf.fit(rows, _labels(spark, sf_dir))
    return _unpacked(toxic_crf.score_documents(rows, model).filter("predicted = 0"), docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5."""
    rows = _packed(docs)
    network = quality_net.fit(rows, _labels(spark, sf_dir))
    return _unpacked(quality_net.score_documents(rows, network).filter("predicted = 1"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, and one row of each id; rows without an id stay."""
    kept = path_dedup.near_duplicates(docs.select("doc_id", "text")).filter("kept and doc_id is not null")
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    kept_rows = named.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    return kept_rows.unionByName(docs.filter("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: repeated documents, and the part of one document at the border of a source."""
    rows = _packed(docs)
    return _unpacked(mixing.repeated(mixing.mix(rows), rows.columns), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the ids and of the decoded bytes."""
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode_documents(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_documents(encoded.drop("text"), ranks)
    return decoded.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]
# Trained scores and a trained vocabulary's merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, f"stage-{at}")
    return docs
