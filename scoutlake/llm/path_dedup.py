"""Near-duplicates by a chosen-path set similarity join over word shingles.

1. A document becomes the set of its 64-bit shingle hashes. Equal sets are one
   class, represented by its smallest id; only representatives are compared.
2. A class carries minwise tokens: for each of `TREES * DEPTH` hash functions the
   least hash of its set. Two sets agree in a token with their Jaccard similarity.
3. Each tree has `DEPTH` tokens of its own and branches the classes by one that the
   path chooses among those it has not used, so similar sets go down together. A node of at most `LEAF` classes is compared
   exhaustively; a larger one branches again, up to `DEPTH` tokens. A pair at
   the threshold t ends up together in a tree with probability of at least
   t ** DEPTH, so the trees together miss it with (1 - t ** DEPTH) ** TREES:
   about 1 in 100,000 at 0.85, and less where nodes are small early.
4. In every final node all members are first held against the node's smallest
   member: as many pairs as members, whatever the size of a group. Confirmed
   links are merged. A node that is one component by then is done, as further
   links cannot change it. In the others every pair across components is held
   against a bound that cannot lose a link: each set has `BITS` bits, the parities of
   its hashes by place, and two sets differ in at least as many hashes as bits. It is
   sharp up to some thousand hashes; behind it comes the estimate from the tokens. In nodes that stayed large an exact bound comes first:
   hashes that no other set of a large node has cannot be in an intersection, so
   edited copies whose edits are their own fall out before any pairing; another
   one is what both have in common with the node's first member. What is left is
   confirmed. No pair of a node that can matter is left out, and thousands
   of copies cost no quadratic work.
5. Links are confirmed on the full sets: exact intersection of all hashes.

Nulls and texts without words have an empty set and link with nothing. Rows that
repeat an id count as one document with the union of classes linked through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.llm.common import WordHashes, bounded_batches, stored, text_slices, wider
from scoutlake.llm.components import components

TREES, DEPTH, LEAF = 12, 3, 48
SEED = 20_231
# Parity bits of a set, in words of 64.
BITS, WORD = 1_024, 64
# Least share of equal tokens for a pair to be confirmed; at 0.85 about five deviations below the mean.
ESTIMATE = 0.55


def shingle_hashes(text: str, size: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; fewer words than `size` are one shingle."""
    hashes = words.of(text.encode("utf-8", "surrogatepass").lower().split())
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    n = len(hashes) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def token_factors(count: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise_tokens(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """(sets, factors) of 32-bit minima; empty sets must be left out."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat = np.concatenate(sets)
    tokens = np.empty((len(sets), len(factors)), np.uint32)
    for k, factor in enumerate(factors):
        tokens[:, k] = np.minimum.reduceat(((flat * factor) >> np.uint64(32)).astype(np.uint32), starts)
    return tokens


def parities(hashes: np.ndarray) -> np.ndarray:
    """Words of bits: whether an odd number of hashes falls on each place."""
    odd = np.bincount((hashes >> np.uint64(54)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def differing(x: str, y: str) -> Column:
    """Bits in which two sets differ, never more than the hashes that only one of them has."""
    words = (F.bit_count(F.col(f"{x}_{i}").bitwiseXOR(F.col(f"{y}_{i}"))) for i in range(BITS // WORD))
    return reduce(Column.__add__, words)


def sketches(docs: DataFrame, size: int, id_col: str, text: str, trees: int, depth: int) -> DataFrame:
    """(id, n, digest, tokens, bits): set size, digest, minwise tokens and parities; nulls for an empty set."""
    bounded_batches(docs.sparkSession)
    factors = token_factors(trees * depth)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part, texts in text_slices(batch):
                sets = [shingle_hashes(t, size, words) for t in texts]
                filled = [s for s in sets if len(s)]
                tokens = iter(minwise_tokens(filled, factors).view(np.int32).tolist() if filled else [])
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array([next(tokens) if len(s) else None for s in sets], pa.list_(pa.int32())),
                        pa.array([parities(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["id", "n", "digest", "tokens", "bits"],
                )

    return rows.mapInArrow(sketch, "id long, n long, digest string, tokens array<int>, bits array<long>")


def tree_nodes(classes: DataFrame, trees: int, depth: int, leaf: int) -> DataFrame:
    """(node, id, large) of the final nodes of all trees with at least two members.

    Tree t starts with the first of its own tokens; each further branching takes one that
    the path chooses among those not yet on it. Tokens are looked up only for
    members of nodes that branch again, so the wide first level stays narrow.
    """
    first = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.element_at("tokens", t * depth + 1))
    roots = classes.select("id", F.posexplode(first).alias("tree", "token"))
    members = roots.select("id", "tree", F.xxhash64("tree", "token").alias("path"), F.array(F.col("tree") * depth + 1).alias("used"))
    own = F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda k: F.col("tree") * depth + k)
    final = None
    for level in range(1, depth + 1):
        sizes = members.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        sized = members.join(sizes, "path")
        done = sized if level == depth else sized.filter(F.col("size") <= leaf)
        done = done.select(F.col("path").alias("node"), "id", (F.col("size") > leaf).alias("large"))
        final = done if final is None else final.unionAll(done)
        if level < depth:
            large = stored(sized.filter(F.col("size") > leaf), "branches").join(classes.select("id", "tokens"), "id")
            free = F.array_except(own, "used")
            slot = F.element_at(free, (F.pmod("path", F.size(free)) + 1).cast("int"))
            chosen = large.select("id", "tree", "path", "used", "tokens", slot.alias("slot"))
            members = chosen.select(
                "id", "tree",
                F.xxhash64("path", "slot", F.element_at("tokens", F.col("slot"))).alias("path"),
                F.array_append("used", F.col("slot")).alias("used"),
            )
    return final


def full_sets(docs: DataFrame, ids: DataFrame, size: int, id_col: str, text: str) -> DataFrame:
    """(id, hashes) and the other columns of `ids` (one row per id): whole shingle sets, stored."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))

    names = ids.columns

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part, texts in text_slices(batch):
                sets = [shingle_hashes(t, size, words).view(np.int64) for t in texts]
                kept = part.select(names)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(sets, pa.list_(pa.int64()))], [*names, "hashes"]
                )

    wanted = rows.join(ids, "id")
    return stored(wanted.mapInArrow(sets_of, wider(ids, "hashes array<long>")), "sets")


def overlaps(pairs: DataFrame, docs: DataFrame, size: int, percent: int, id_col: str, text: str) -> DataFrame:
    """The pairs (a, b) with the size of their intersection, and whether it makes them a link."""
    sides = [pairs.select(F.col(x).alias("id"), *(F.lit(x == y).alias(f"is_{y}") for y in "ab")) for x in "ab"]
    ends = sides[0].unionAll(sides[1]).groupBy("id").agg(*(F.max(f"is_{x}").alias(f"is_{x}") for x in "ab"))
    sets = full_sets(docs, ends, size, id_col, text)
    # Each side shuffles only the sets that it joins.
    left = sets.filter("is_a").select(F.col("id").alias("a"), F.col("hashes").alias("left"))
    right = sets.filter("is_b").select(F.col("id").alias("b"), F.col("hashes").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    counted = both.select("a", "b", F.size("left").alias("l"), F.size("right").alias("r"), F.size(F.array_intersect("left", "right")).alias("common"))
    linked = 100 * F.col("common") >= percent * (F.col("l") + F.col("r") - F.col("common"))
    return counted.select("a", "b", "common", linked.alias("linked"))


def shared_counts(sets: DataFrame) -> DataFrame:
    """(id, shared): how many hashes of a set occur in any other set; no intersection can be larger."""
    rows = sets.select("id", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    single = rows.groupBy("hash").agg(F.count("*").alias("sets"), F.min("id").alias("id")).filter("sets = 1")
    alone = single.groupBy("id").agg(F.count("*").alias("alone"))
    sizes = sets.select("id", F.size("hashes").alias("n"))
    return sizes.join(alone, "id", "left").select("id", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def links_between(
    docs: DataFrame,
    classes: DataFrame,
    size: int,
    percent: int,
    id_col: str,
    text: str,
    trees: int,
    depth: int,
    leaf: int,
    estimate: float,
) -> DataFrame:
    """Confirmed links (a, b) that join the classes to their components."""
    # Tokens are long, so nodes go without them and pairs look them up.
    nodes = stored(tree_nodes(classes, trees, depth, leaf), "nodes")

    def fits(x: str, y: str) -> Column:
        """Bounds on the sizes and on the hashes of one set alone, which no link breaks."""
        sizes = 100 * F.least(f"n{x}", f"n{y}") >= percent * F.greatest(f"n{x}", f"n{y}")
        alone = (100 + percent) * differing(f"w{x}", f"w{y}") <= (100 - percent) * (F.col(f"n{x}") + F.col(f"n{y}"))
        return sizes & alone

    def alike(pairs: DataFrame) -> DataFrame:
        """The pairs whose tokens agree as often as those of a link do."""
        sides = [classes.select(F.col("id").alias(x), F.col("tokens").alias(f"tokens_{x}")) for x in "ab"]
        same = F.size(F.filter(F.zip_with("tokens_a", "tokens_b", lambda p, q: p == q), lambda equal: equal))
        both = pairs.join(sides[0], "a").join(sides[1], "b")
        return both.filter(same >= int(estimate * trees * depth)).select("a", "b")

    words = [F.col("bits")[i].alias(f"w_{i}") for i in range(BITS // WORD)]
    flat = classes.select("id", "n", *words)

    def side(x: str, name: str) -> DataFrame:
        return flat.select(F.col("id").alias(name), F.col("n").alias(f"n{x}"), *(F.col(f"w_{i}").alias(f"w{x}_{i}") for i in range(BITS // WORD)))

    first = nodes.groupBy("node").agg(F.min("id").alias("a"))
    spokes = nodes.join(first, "node").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    near = spokes.join(side("1", "a"), "a").join(side("2", "b"), "b").filter(fits("1", "2")).select("a", "b")
    stars = alike(stored(near, "near"))
    spoken = stored(overlaps(stored(stars, "stars"), docs, size, percent, id_col, text), "spokes")
    linked = spoken.filter("linked").select("a", "b")

    # What is still apart within a node: all outside the node's largest component, against all others.
    roots = components(linked).select(F.col("node").alias("id"), "root")
    placed = nodes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = stored(_apart(placed).join(classes.select("id", "n"), "id"), "apart")
    # In a large node, a set with too many hashes of its own links with nothing and needs no partner.
    large = placed.filter("large")
    shared = shared_counts(full_sets(docs, large.select("id").distinct(), size, id_col, text))
    large = _apart(large.join(shared, "id").filter(100 * F.col("shared") >= percent * F.col("n")))
    small = placed.filter(~F.col("large")).withColumn("shared", F.col("n"))
    placed = small.unionByName(large)
    # What a member has in common with the node's first member bounds what two members have in common.
    hub = spoken.select("a", F.col("b").alias("id"), "common")
    placed = placed.join(first, "node").join(hub, ["a", "id"], "left")
    # A pair that shares several nodes is taken in the first one.
    homes = placed.groupBy("id").agg(F.sort_array(F.collect_set("node")).alias("homes"))
    placed = stored(placed.join(homes.join(flat.drop("n"), "id"), "id"), "open")
    weights = placed.groupBy("node", "root").agg(F.count("*").alias("size"))
    core = weights.groupBy("node").agg(F.max_by("root", F.struct("size", "root")).alias("core"))
    carried = ("id", "n", "root", "shared", "common", "homes")

    def carry(x: str) -> list[Column]:
        return [F.col(c).alias(f"{c}{x}") for c in carried] + [F.col(f"w_{i}").alias(f"w{x}_{i}") for i in range(BITS // WORD)]

    others = placed.join(core, "node").filter("root <> core").select("node", "core", *carry("1"))
    everyone = placed.select("node", *carry("2"))
    # A pair of two outsiders meets twice; the smaller id keeps it.
    once = (F.col("root2") == F.col("core")) | (F.col("id1") < F.col("id2"))
    most = F.least("shared1", "shared2")
    may = 100 * most >= percent * (F.col("n1") + F.col("n2") - most)
    own = [F.col(f"n{x}") - F.col(f"common{x}") for x in "12"]
    through = F.coalesce(F.least("common1", "common2") + F.least(*own), most)
    # `least` skips nulls, so the bound needs both overlaps.
    through = F.when(F.col("common1").isNotNull() & F.col("common2").isNotNull(), through).otherwise(most)
    may &= 100 * through >= percent * (F.col("n1") + F.col("n2") - through)
    here = F.element_at(F.array_intersect("homes1", "homes2"), 1) == F.col("node")
    met = others.join(everyone, "node").filter((F.col("root1") != F.col("root2")) & once & may & here & fits("1", "2"))
    rest = met.select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).distinct()
    found = overlaps(stored(alike(stored(rest, "met")), "rest"), docs, size, percent, id_col, text).filter("linked")
    return linked.unionAll(found.select("a", "b"))


def _apart(placed: DataFrame) -> DataFrame:
    """The members of nodes that hold more than one component."""
    apart = placed.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return placed.join(apart.select("node"), "node", "left_semi")


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text: str = "text",
    trees: int = TREES,
    depth: int = DEPTH,
    leaf: int = LEAF,
    estimate: float = ESTIMATE,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per input row; ids must not be null to be linked."""
    found = stored(sketches(docs, size, id_col, text, trees, depth), "sketches")
    filled = found.filter(F.col("digest").isNotNull() & F.col("id").isNotNull())
    grouped = filled.groupBy("digest").agg(F.min("id").alias("rep"), F.min_by("n", "id").alias("n"), F.min_by("tokens", "id").alias("tokens"), F.min_by("bits", "id").alias("bits"))
    classes = stored(grouped, "classes")
    links = links_between(
        docs, classes.select(F.col("rep").alias("id"), "n", "tokens", "bits"), size, percent, id_col, text, trees, depth, leaf, estimate
    )
    # Members hang on their representative, so copies are never expanded into pairs.
    members = filled.join(classes.select("digest", "rep"), "digest").select("id", "rep")
    hung = members.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    roots = components(links.unionAll(hung)).select(F.col("node").alias("id"), "root")
    return found.join(roots, "id", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "id").alias("component_id"),
        F.col("root").isNull().alias("kept"),
    )
