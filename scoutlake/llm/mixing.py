"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sizes are words. A source's target is its weight's share of the words asked for,
but at most `cap` times its size; what a capped source cannot give is dealt to the
others by weight, until no target is above its cap. Each document of a source is
taken as often as its target holds the source whole. The rest of the target is
filled by one more repetition of documents in a seeded order of their ids; the
document at the border takes the words that are still missing. So a source's taken
words are its target, rounded down, and no document is taken more than `cap` times.

Sources are ordered by code point, null last; a null source is a source. Null and
empty texts have size 0 and take nothing. Repeated rows count each for itself; equal
rows are interchangeable. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlake.llm.common import stored
from scoutlake.operators.ranges import ranked

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, "mix"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """(source, source_size, target) of (source, size) rows."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").asc_nulls_last()]
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(ranked(totals, order).select("source", "source_size", turn.alias("weight")), "sources")
    limit = F.col("source_size") * cap
    asked = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    # Each round caps the sources that the level before floods; it ends when none is added.
    level, full = None, -1
    while True:
        flooded = F.lit(False) if level is None else F.col("weight") * level > limit
        now = sources.agg(
            F.count_if(flooded).alias("full"),
            F.coalesce(F.sum(F.when(flooded, limit)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~flooded, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if now.full == full or not now.open:
            break
        level, full = (asked - now.given) / now.open, now.full
    water = F.col("weight") * (level or 0.0)
    return sources.select("source", "source_size", F.least(water, limit.cast("double")).alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    seed: str = SEED,
    text: str = "text",
    id_col: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """`docs` with size, source_size, target, repeats (whole copies), extra (words of one more) and taken."""
    sized = docs.withColumn("size", word_count(text))
    targets = source_targets(stored(sized.select(F.col(source).alias("source"), "size"), "sizes"), weights, share, cap)
    return take_words(sized, targets, seed, id_col, source)


def take_words(sized: DataFrame, targets: DataFrame, seed: str, id_col: str, source: str) -> DataFrame:
    """Repetitions of (id, source, size) rows that fill the targets of their sources."""
    side = targets.withColumnRenamed("source", "_source")
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = sized.join(side, F.col(source).eqNullSafe(F.col("_source"))).drop("_source").withColumn("_key", key)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumns({"repeats": whole.cast("long"), "_bucket": F.substring("_key", 1, 4)})
    # Words in front of a document: those of the buckets before (65,536 at most per source), and those in its bucket.
    per_bucket = rows.groupBy(source, "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy(source).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col(source).alias("_source"), F.col("_bucket").alias("_at"),
        F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(source, "_bucket").orderBy("_key", id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col(source).eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_at")))
    open_words = F.floor("target") - F.col("repeats") * F.col("source_size") - F.col("_before") - F.col("_inside")
    extra = F.greatest(F.lit(0).cast("long"), F.least(open_words, F.col("size")))
    taken = placed.withColumn("extra", extra).withColumn("taken", F.col("repeats") * F.col("size") + F.col("extra"))
    return taken.drop("_key", "_bucket", "_source", "_at", "_before", "_inside")


def repeated(mixed: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """The rows of the mix: whole copies, and the first `extra` words of documents that are taken in part."""
    copies = F.when(F.col("extra") == F.col("size"), F.col("repeats") + 1).otherwise(F.col("repeats"))
    whole = F.when(copies > 0, F.array_repeat(F.lit(None).cast("long"), copies.cast("int")))
    part = F.when((F.col("extra") > 0) & (F.col("extra") < F.col("size")), F.array(F.col("extra")))
    none = F.array().cast("array<bigint>")
    rows = mixed.withColumn("_words", F.explode(F.concat(F.coalesce(whole, none), F.coalesce(part, none))))
    # Every match is a word with the white space in front of it, so a part keeps the text's spacing.
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), "")
    cut = F.when(F.col("_words").isNull(), F.col(text)).otherwise(part)
    return rows.withColumn(text, cut).select(*columns)


ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
sources AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS asked
  FROM totals),
levels AS (
  SELECT 0 AS round, (SELECT max(asked) / sum(weight) FROM sources) AS level
  UNION ALL
  SELECT round + 1, (SELECT (max(asked) - coalesce(sum(CASE WHEN weight * level > 2 * source_size THEN 2 * source_size END), 0)::DOUBLE)
      / sum(CASE WHEN weight * level > 2 * source_size THEN 0 ELSE weight END) FROM sources)
  FROM levels WHERE round < (SELECT count(*) FROM sources)),
targets AS (
  SELECT source, source_size, least(weight * (SELECT arg_max(level, round) FROM levels), (2 * source_size)::DOUBLE) AS target
  FROM sources),
rows AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS repeats,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix|' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS front
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(repeats * size
  + greatest(0, least(CAST(floor(target) AS BIGINT) - repeats * source_size - front, size)) AS BIGINT) AS taken
FROM rows"""
