"""Embedding near-dedup by an epsilon grid order join.

Vectors of one label are compared by cosine; between unit vectors a cosine of at
least c is a distance of at most sqrt(2 - 2c), the epsilon. Equal vectors are one
class with a number of copies. Classes are sorted by the grid cells (of width
epsilon) of their leading principal dimensions and cut into blocks; blocks form
intervals of `FAN`, those again, up to one interval per label. The join starts with
each label against itself and goes down: a pair of intervals whose boxes are more
than epsilon apart is skipped, others are replaced by the pairs of their parts.
Blocks that are left meet in numpy, in double precision. No pair of vectors is
written: a block pair returns, per vector, how many it links with and the smallest
id it reaches within the pair.

Vectors that are null, zero or hold null or non-finite components, and those
without a label, link with nothing; vectors of different lengths neither. A row
with a null id counts as a copy of an equal vector with an id, else it links with
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.llm.common import bounded_batches, stored
from scoutlake.llm.components import components
from scoutlake.operators.ranges import ranked

LEADING, BLOCK, FAN = 4, 512, 16
SLACK = 1e-9


def usable(vector: str, label: str) -> Column:
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(F.col(vector), lambda x: x != 0), F.lit(False))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading axes by vector length, from sums over all classes."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, unit in _by_length(batch):
                full = np.vstack([unit.T @ unit, unit.sum(axis=0), np.full(d, float(len(unit)))])
                sums[d] = sums.get(d, 0) + full
        for d, full in sums.items():
            flat = full.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(flat), d, np.int32)), pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)],
                ["d", "at", "v"],
            )

    parts = classes.select("vector").mapInArrow(moments, "d int, at int, v double")
    # (d + 2) * d numbers for each vector length.
    found = parts.groupBy("d", "at").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    axes = {}
    for d, rows in found.groupby("d"):
        full = np.zeros((d + 2) * d)
        full[rows["at"]] = rows["v"]
        full = full.reshape(d + 2, d)
        n, mean = full[-1, 0], full[-2] / full[-1, 0]
        _, vectors = np.linalg.eigh(full[:d] / n - np.outer(mean, mean))
        axes[int(d)] = vectors[:, ::-1][:, :LEADING]
    return axes


def _by_length(batch) -> Iterator[tuple[int, np.ndarray]]:
    """(length, unit vectors) of the vectors of a batch, grouped by length, in order within a group."""
    column = batch.column("vector")
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        unit = flat[starts[rows][:, None] + np.arange(d)]
        # Scaling first keeps the norm of very large and very small vectors finite.
        unit = unit / np.abs(unit).max(axis=1, keepdims=True)
        yield int(d), unit / np.linalg.norm(unit, axis=1, keepdims=True)


def sorted_blocks(classes: DataFrame, axes: dict[int, np.ndarray], epsilon: float, block: int) -> DataFrame:
    """(label, d, lo, hi, ids, copies, data, rank): blocks in grid order with the boxes of their projections."""
    shared = classes.sparkSession.sparkContext.broadcast(axes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.zeros((batch.num_rows, LEADING))
            lengths = np.asarray(batch.column("vector").value_lengths())
            for d, unit in _by_length(batch):
                found = unit @ shared.value[d]
                points[np.flatnonzero(lengths == d), : found.shape[1]] = found
            cells = np.floor(points / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths.astype(np.int32)), pa.array(list(points)), pa.array(list(cells))],
                [*batch.schema.names, "d", "point", "cell"],
            )

    kind = dict(classes.dtypes)
    schema = f"label {kind['label']}, vector array<double>, id long, copies long, d int, point array<double>, cell array<int>"
    order = ["label", "d", "cell", "id"]
    placed = classes.select("label", "vector", "id", "copies").mapInArrow(project, schema)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            while (n := _run(rest, block)) < rest.num_rows:
                yield _block(rest.slice(0, n).combine_chunks())
                rest = rest.slice(n)
        if rest is not None and rest.num_rows:
            yield _block(rest.combine_chunks())

    out = f"label {kind['label']}, d int, cell array<int>, lo array<double>, hi array<double>, ids array<long>, copies array<long>, data binary"
    blocks = stored(placed.mapInArrow(cut, out), "blocks")
    # The first vector of a block stands for its place in the order.
    places = ranked(blocks.select("label", "d", "cell", F.col("ids")[0].alias("head")), ["label", "d", "cell", "head"])
    return blocks.withColumn("head", F.col("ids")[0]).join(places.select("head", "rank"), "head").drop("head", "cell")


def _run(table: pa.Table, block: int) -> int:
    """How many rows at the start share label and length, at most `block`; all rows if the run may go on."""
    label, d = table.column("label").to_numpy(), table.column("d").to_numpy()
    end = min(block, len(label))
    other = np.flatnonzero((label[:end] != label[0]) | (d[:end] != d[0]))
    return int(other[0]) if len(other) else end


def _block(table: pa.Table) -> pa.RecordBatch:
    batch = table.to_batches()[0]
    points = np.array(batch.column("point").to_pylist())
    (_, unit), = _by_length(batch)
    ids, copies = batch.column("id").to_pylist(), batch.column("copies").to_pylist()
    return pa.RecordBatch.from_arrays(
        [
            batch.column("label").slice(0, 1), batch.column("d").slice(0, 1), batch.column("cell").slice(0, 1),
            pa.array([points.min(axis=0).tolist()]), pa.array([points.max(axis=0).tolist()]),
            pa.array([ids], pa.list_(pa.int64())), pa.array([copies], pa.list_(pa.int64())), pa.array([unit.tobytes()]),
        ],
        ["label", "d", "cell", "lo", "hi", "ids", "copies", "data"],
    )


def interval_pairs(blocks: DataFrame, epsilon: float, fan: int) -> DataFrame:
    """(label, d, a, b): blocks, a <= b, whose boxes are at most epsilon apart, found from the top down."""
    boxes = stored(blocks.select("label", "d", "rank", "lo", "hi"), "boxes")
    total = boxes.count()
    levels, top = 0, 1
    while top < total:
        levels, top = levels + 1, top * fan
    corners = [f(F.col(c)[i]).alias(f"{c}{i}") for c, f in (("lo", F.min), ("hi", F.max)) for i in range(LEADING)]

    def intervals(level: int) -> DataFrame:
        at = F.floor(F.col("rank") / fan**level).cast("long")
        return boxes.groupBy("label", "d", at.alias("at")).agg(*corners)

    pairs = intervals(levels).select("label", "d", F.col("at").alias("a"), F.col("at").alias("b"))
    for level in range(levels - 1, -1, -1):
        parts = intervals(level).withColumn("up", F.floor(F.col("at") / fan).cast("long"))
        left, right = (
            parts.select("label", "d", F.col("up").alias(f"up_{s}"), F.col("at").alias(f"at_{s}"), *(F.col(c).alias(f"{c}_{s}") for c in parts.columns if c[:2] in ("lo", "hi")))
            for s in ("a", "b")
        )
        up = pairs.select("label", "d", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
        met = up.join(left, ["label", "d", "up_a"]).join(right, ["label", "d", "up_b"]).filter("at_a <= at_b")
        gaps = [F.greatest(F.lit(0.0), F.col(f"lo{i}_b") - F.col(f"hi{i}_a"), F.col(f"lo{i}_a") - F.col(f"hi{i}_b")) for i in range(LEADING)]
        near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= epsilon * epsilon + SLACK
        pairs = stored(met.filter(near).select("label", "d", F.col("at_a").alias("a"), F.col("at_b").alias("b")).distinct(), "interval-pairs")
    return pairs


def block_links(pairs: DataFrame, blocks: DataFrame, cosine: float) -> DataFrame:
    """(id, links, root) for the vectors of a block pair that link: how many others, and the smallest id reached."""
    sides = [blocks.select(F.col("rank").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "data")), *(["d"] if s == "a" else [])) for s in ("a", "b")]
    met = pairs.drop("label", "d").join(sides[0], "a").join(sides[1], "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a"] == row["b"]
                u, v = (np.frombuffer(row[f"data_{s}"]).reshape(-1, row["d"]) for s in ("a", "b"))
                linked = u @ v.T >= cosine
                if same:
                    np.fill_diagonal(linked, False)
                ids = [np.array(row[f"ids_{s}"], np.int64) for s in ("a", "b")]
                copies = [np.array(row[f"copies_{s}"], np.int64) for s in ("a", "b")]
                roots = [ids[0].copy(), ids[0].copy() if same else ids[1].copy()]
                if not linked.any():
                    continue
                far = np.iinfo(np.int64).max
                while True:
                    ahead = np.minimum(roots[0], np.where(linked, roots[1][None, :], far).min(axis=1))
                    back = ahead if same else np.minimum(roots[1], np.where(linked, ahead[:, None], far).min(axis=0))
                    if (ahead == roots[0]).all() and (back == roots[1]).all():
                        break
                    roots = [ahead, back]
                found = [(ids[0], linked @ copies[1], roots[0])]
                if not same:
                    found.append((ids[1], linked.T @ copies[0], roots[1]))
                for x, n, root in found:
                    hit = n > 0
                    yield pa.RecordBatch.from_arrays([pa.array(x[hit]), pa.array(n[hit]), pa.array(root[hit])], ["id", "links", "root"])

    return met.mapInArrow(compare, "id long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    block: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("good", usable("vector", "label"))
    classes = rows.filter("good").groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = stored(classes.filter("id is not null"), "vectors")
    bounded_batches(vectors.sparkSession)
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    blocks = sorted_blocks(classes, principal_axes(classes), epsilon, block)
    found = stored(block_links(interval_pairs(blocks, epsilon, fan), blocks, cosine), "vector-links")
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnsRenamed({"node": "id"})
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "id", "left").join(roots, "id", "left").select(
        "label", "vector", F.col("id").alias("rep"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "root"
    )
    joined = rows.filter("good").join(known, ["label", "vector"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep", "id").alias("component_id")
    )
    alone = rows.filter(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
