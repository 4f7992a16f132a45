"""The pipeline against its stages applied by hand, with rows and names that could trip it."""

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from scoutlake.llm import byte_bpe, mixing, path_dedup, quality_net, toxic_crf

SF = "/root/testdata/sf0.001"
CLASHING = ("score", "predicted", "spans", "peak", "mass", "size", "source_size", "target", "repeats", "extra", "taken", "_key", "features", "kept")


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = [(None, None, "en", None), (None, "no id", None, "src0"), (-1, None, "en", "src1"), (-2, "", "en", "src1"), (-3, "twice the same", "en", "src1")]
    return real.unionAll(spark.createDataFrame([*odd, odd[-1]], real.schema)).repartition(3).cache()


def key(rows, *columns):
    return sorted(map(str, (tuple(r) for r in rows.select(*columns).collect())))


def test_filters_keep_clashing_columns_and_decide_as_the_operators(spark, docs):
    wide = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in CLASHING})
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    plain = docs.select("doc_id", "text")
    not_toxic = toxic_crf.score_documents(plain, toxic_crf.fit(plain, labels)).filter("predicted = 0")
    good = quality_net.score_documents(plain, quality_net.fit(plain, labels)).filter("predicted = 1")
    for stage, expected in ((corpus_pipeline.drop_toxic, not_toxic), (corpus_pipeline.keep_quality, good)):
        found = stage(spark, wide, SF)
        assert found.schema == wide.schema
        assert key(found, "doc_id", "text") == key(expected, "doc_id", "text")
        assert found.filter(F.col("size") != F.concat(F.lit("size"), F.col("doc_id"))).isEmpty()


def test_one_document_of_each_group_stays(spark, docs):
    found = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    kept = {r.doc_id for r in path_dedup.near_duplicates(docs.select("doc_id", "text")).filter("kept").collect()} - {None}
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(kept) and ids.count(None) == 2


def test_mix_repeats_rows_with_their_columns(spark, docs):
    wide = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in CLASHING})
    found = corpus_pipeline.mix_sources(spark, wide, SF)
    expected = mixing.repeated(mixing.mix(docs), ["doc_id", "text", "source"])
    assert found.columns == wide.columns and key(found, "doc_id", "text", "source") == key(expected, "doc_id", "text", "source")
    assert found.filter(F.col("_key") != F.concat(F.lit("_key"), F.col("doc_id"))).isEmpty()


def test_encoding_of_the_last_stage(spark, docs):
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted(str((r.doc_id, r.source, encoding.encode_ordinary(r.text or ""))) for r in docs.collect())
    assert sorted(str((r.doc_id, r.source, list(r.ids))) for r in corpus_pipeline.encode(spark, docs, SF).collect()) == expected


def test_run_applies_the_stages_in_order(spark, tmp_path, monkeypatch):
    calls = []
    stages = [(name, lambda s, d, sf, name=name: (calls.append(name), d)[1]) for name, _ in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert corpus_pipeline.run(spark, SF).count() == 200
    assert calls == ["toxicity", "quality classifier", "MinHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding"]


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
