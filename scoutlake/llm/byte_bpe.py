"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel and stitched, then encoded.

A pre-token starts where the one before ends and never looks back, so two
pre-tokenisations that share one boundary agree on everything behind it. Long
texts are cut into chunks that overlap. Each chunk is pre-tokenised by itself;
the first boundary that both neighbours report inside their overlap is a true
boundary, and the text is cut there. Only boundaries behind a character that is
no white space count: the pattern looks ahead only from white space, so a segment
that ends at such a place has the pre-tokens that the whole text has there.
Where an overlap has no common boundary, the rest of that text stays one segment,
so the result is exact for any text.

Nulls count as empty texts, which have no ids. Equal long texts are encoded once;
repeated rows are all returned, and other columns are handed through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from scoutlake.llm.common import bounded_batches, text_slices, wider

CHUNK, OVERLAP = 32_768, 1_024


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _id_lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    flat = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode_documents(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """`docs` with a column of token ids, an array of int; a column of that name is replaced."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop(ids)
    shared = spark.sparkContext.broadcast(ranks)
    whole = F.col(text).isNull() | (F.length(text) <= chunk)

    def encode_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value, pattern)
        for batch in batches:
            for part, texts in text_slices(batch, text, 256):
                found = _id_lists([encoding.encode_to_numpy(t, disallowed_special=()) for t in texts])
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, ids])

    schema = wider(docs, f"`{ids}` array<int>")
    short = docs.filter(whole).mapInArrow(encode_whole, schema)

    long = docs.filter(~whole).withColumn("_digest", F.sha2(text, 256))
    segments = text_segments(long.select("_digest", F.col(text).alias("_text")), pattern, chunk, overlap)

    def encode_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value, pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                pieces = part.column("segments").to_pylist()[0]
                found = np.concatenate([encoding.encode_to_numpy(p, disallowed_special=()) for p in pieces])
                yield pa.RecordBatch.from_arrays([part.column("_digest"), _id_lists([found])], ["_digest", "_ids"])

    encoded = segments.mapInArrow(encode_segments, "_digest string, _ids array<int>")
    joined = long.join(encoded, "_digest", "left").select(*docs.columns, F.col("_ids").alias(ids))
    return short.unionByName(joined)


def text_segments(texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(_digest, segments): each distinct text of (_digest, _text) cut at true pre-token boundaries.

    Chunks of one text are dealt to different tasks; the segments of a text,
    which are no larger together than the row it came from, meet again.
    """
    n = F.length("_text")
    chunks = texts.select("_digest", "_text", n.alias("_n"), F.explode(F.sequence(F.lit(0), n - 1, F.lit(chunk))).alias("at"))
    pieces = chunks.select("_digest", "_n", "at", F.substr("_text", F.col("at") + 1, F.lit(chunk + overlap)).alias("piece"))
    # One row per distinct text and place; this shuffle also spreads the chunks of a text.
    pieces = pieces.dropDuplicates(["_digest", "at"])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_of = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for at, piece in zip(batch.column("at").to_pylist(), batch.column("piece").to_pylist()):
                ends = [m.end() for m in pieces_of.finditer(piece)]
                ends = [e for e in ends if e < len(piece) and not piece[e - 1].isspace()]
                heads.append([at + e for e in ends if e < overlap])
                tails.append([at + e for e in ends if e > chunk])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, lists), pa.array(tails, lists)], [*batch.schema.names, "heads", "tails"]
            )

    found = pieces.mapInArrow(bounds, wider(pieces, "heads array<int>, tails array<int>"))
    in_order = Window.partitionBy("_digest").orderBy("at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    common = F.array_min(F.array_intersect("tails", F.lead("heads").over(in_order)))
    met = found.select("_digest", "_n", "at", "piece", common.alias("cut"))
    # A cut holds only if all cuts before it do, as the chunk in front must be in step itself.
    true_cut = F.when(F.count_if(F.col("cut").isNull()).over(so_far) == 0, F.col("cut"))
    cut = met.withColumn("cut", true_cut).withColumn("start", F.lag("cut").over(in_order))
    begin = F.coalesce("start", "at")
    end = F.coalesce("cut", F.least(F.col("at") + chunk, "_n"))
    parts = cut.select(
        "_digest", "at", F.count("start").over(so_far).alias("segment"),
        F.substr("piece", begin - F.col("at") + 1, end - begin).alias("part"),
    )
    joined = parts.groupBy("_digest", "segment").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
    texts_of = joined.select("_digest", "segment", F.array_join(F.col("parts.part"), "").alias("body"))
    ordered = texts_of.groupBy("_digest").agg(F.array_sort(F.collect_list(F.struct("segment", "body"))).alias("all"))
    return ordered.select("_digest", F.col("all.body").alias("segments"))


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`encoded` with the raw bytes of its ids, concatenated; null ids give empty bytes."""
    bounded_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        table = np.empty(max(ranks.values()) + 1, object)
        table[list(ranks.values())] = list(ranks)
        for batch in batches:
            column = batch.column(ids).fill_null(pa.scalar([], pa.list_(pa.int32())))
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())
            tokens = table[flat]
            texts = [b"".join(tokens[i:j]) for i, j in zip([0, *ends[:-1]], ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, decoded])

    encoded = encoded.drop(decoded)
    return encoded.mapInArrow(decode, wider(encoded, f"`{decoded}` binary"))
