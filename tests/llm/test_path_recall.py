"""Recall of the chosen-path join at its threshold, and the exactness of the parity bound."""

import numpy as np
from pyspark.sql import functions as F

from scoutlake.llm import path_dedup

PLANTED = 10_000


def test_links_at_the_threshold_are_found_without_leaves(spark):
    """Pairs of single words: 46 of 54 shared, 0.852, all nodes branch to the last level."""
    words = F.concat(F.lit("p"), F.col("id"), F.lit("w"))

    def text(first, last):
        return F.array_join(F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: F.concat(words, i)), " ")

    pairs = spark.range(PLANTED, numPartitions=8)
    docs = pairs.select((2 * F.col("id")).alias("doc_id"), text(0, 49).alias("text")).unionAll(
        pairs.select((2 * F.col("id") + 1).alias("doc_id"), text(4, 53).alias("text"))
    )
    found = path_dedup.near_duplicates(docs, size=1, percent=85, leaf=1)
    row = found.agg(
        F.count_if("kept").alias("kept"), F.max("n_shingles").alias("n"),
        F.count_if(F.col("component_id") < F.col("doc_id") - F.col("doc_id") % 2).alias("wrong"),
    ).first()
    assert row.n == 50 and row.wrong == 0 and row.kept - PLANTED <= 2


def test_parities_never_differ_in_more_places_than_the_sets():
    rng = np.random.default_rng(5)
    for size in (1, 10, 300, 5_000):
        base = rng.integers(0, 2**64 - 1, size, dtype=np.uint64)
        for swapped in (0, 1, size // 4, size):
            other = np.concatenate((base[swapped:], rng.integers(0, 2**64 - 1, swapped, dtype=np.uint64)))
            differ = np.bitwise_count((path_dedup.parities(base) ^ path_dedup.parities(other)).view(np.uint64)).sum()
            assert differ <= len(np.setxor1d(base, other))
    assert path_dedup.parities(base).shape == (path_dedup.BITS // path_dedup.WORD,)
