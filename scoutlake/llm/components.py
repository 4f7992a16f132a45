"""Connected components of a link table, by alternating star contraction.

Every round hooks each node's larger neighbours onto the smallest node it knows
(large star) and then its smaller ones (small star). Minima are partial
aggregates, links travel by equi-joins that Spark can split, and every round is
written to the shared folder. Nothing is gathered per component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v) with u > v. One star operation; again (u, v) with u > v."""
    if large:
        arcs = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        arcs = links
    smallest = arcs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m")
    )
    joined = arcs.join(smallest, F.col("u") == F.col("node"))
    if large:
        # Larger neighbours are hooked onto the minimum.
        hooked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # The node itself and its smaller neighbours are.
        hooked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            smallest.select(F.col("node").alias("u"), F.col("m").alias("v"))
        )
    return hooked.filter(F.col("u") > F.col("v")).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    """Number of links and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), F.coalesce(digest, F.lit(0))).first())


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from each linked node that is not itself the smallest.

    Links of a node with itself and links with a null end count for nothing.
    """
    links = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    links = stored(links.filter("u is not null and v is not null and u > v").distinct(), "links")
    before = _state(links)
    while before[0]:
        links = stored(_star(_star(links, large=True), large=False), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_component(nodes: DataFrame, links: DataFrame, node: str, alias: str, left: str = "a", right: str = "b") -> DataFrame:
    """`nodes` with the smallest node reachable, the node itself included."""
    found = components(links, left, right).withColumnsRenamed({"node": "_node", "root": "_root"})
    joined = nodes.join(found, F.col(node) == F.col("_node"), "left")
    return joined.withColumn(alias, F.coalesce("_root", node)).drop("_node", "_root")
