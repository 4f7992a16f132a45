"""Threshold-scaled sketches of documents, in DataFrame functions only.

A fingerprint keeps every hash of a text's five-word shingles that lies in the
lowest `1 / SCALE` of the hash range. Two fingerprints merge by union, and their
overlap estimates how far one text is contained in the other even when their
lengths differ much. Fewer words than five are one shingle. Likeness is the shared part
of the smaller fingerprint. The fingerprint of a short text can be empty, as all its hashes
may lie above the threshold; where one of two is empty, the likeness is the shared part of
the smaller whole set of hashes, taken from both texts. Texts without words are alike, and
unlike any other text.

Null texts count as empty. Rows with a null id stand before all others; equal ids
are ordered by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlake.operators.ranges import ranked

SHINGLE, SCALE, BUCKET = 5, 8, 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.lower(text), "\t\n\x0b\x0c\r", " " * 5), " "), "")


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Distinct hashes of all shingles of a text."""

    def shingles(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - shingle + 1)
        many = F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + (k - 1)) for k in range(shingle))))
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= shingle, many).otherwise(few)

    return F.array_distinct(_let(F.transform(words_of(text), lambda w: F.xxhash64(w)), shingles))


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted hashes of a text's fingerprint."""
    below = F.lit(-(2**63) + 2**64 // scale)
    return F.array_sort(F.filter(shingle_hashes(text, shingle), lambda x: x < below))


def printed(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lower(F.hex(x))), ",")


def shared_part(a: Column, b: Column) -> Column:
    """Shared part of the smaller set; 1 if both are empty, 0 if one is."""
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)) / least
    return F.when(least > 0, shared).otherwise((F.size(a) == F.size(b)).cast("double"))


def likeness(a: Column, b: Column, text_a: Column, text_b: Column) -> Column:
    """Estimated by two fingerprints; by the whole sets of both texts where a fingerprint is empty."""

    def exact(pair: Column) -> Column:
        return shared_part(pair["a"], pair["b"])

    whole = _let(F.struct(shingle_hashes(text_a).alias("a"), shingle_hashes(text_b).alias("b")), exact)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared_part(a, b)).otherwise(whole)


def with_next(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch); after the last document comes the first.

    Ids are cut into ranges of `BUCKET` numbers. A document finds its successor
    inside its range; the last of a range takes the first of the next one that
    is not empty. Texts are shuffled once.
    """
    bucket = F.floor(F.col(id_col) / BUCKET)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(bucket.cast("long"), F.lit(-(2**62))).alias("bucket"),
    )
    firsts = rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    numbered = ranked(firsts, ["bucket"])
    total = numbered.agg(F.count("*").alias("total"))
    behind = numbered.select("rank", F.col("first.text").alias("first_text"))
    succession = numbered.select("bucket", F.pmod(F.col("rank") + 1, F.greatest(total.scalar(), F.lit(1))).alias("rank")).join(behind, "rank")
    successors = succession.select("bucket", "first_text", sketch(F.col("first_text")).alias("first_sketch"))
    dealt = rows.repartition("bucket").withColumn("sketch", sketch(F.col("text")))
    in_order = Window.partitionBy("bucket").orderBy("doc_id", "text")
    led = dealt.select(
        "*", F.lead("text").over(in_order).alias("next_text"), F.lead("sketch").over(in_order).alias("next_sketch")
    )
    joined = led.join(successors, "bucket")
    return joined.select(
        "doc_id", "text", "sketch",
        F.coalesce("next_text", "first_text").alias("next_text"), F.coalesce("next_sketch", "first_sketch").alias("next_sketch"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited form, whose second half is the start of the next text."""
    rows = with_next(docs, id_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    start = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half)
    edited = F.concat(start, F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), F.col("text"), F.col("next_text")).alias("near_next"),
    )
