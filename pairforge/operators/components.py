"""Connected components of an undirected edge table."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.session import drop_path, written, written_at


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.where("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges point downwards (u > v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return below.unionByName(own).where("u <> v").distinct()


def _fingerprint(edges: DataFrame):
    """Order-free summary of an edge set: one row."""
    return edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()


def connected_components(
    edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int | None = None
) -> DataFrame:
    """``(node, component)`` with the smallest node id as component, by alternating stars.

    Neighbour lists are never collected: a node's smallest neighbour is an aggregate that is joined
    back to the edges. Every round is a table in the shared folder, so lineage stays short and a lost executor
    does not undo it; a round's predecessor is dropped. Runs until the stars settle, unless the caller sets
    ``max_rounds``, beyond which it raises. (Kiveris et al., Connected Components in MapReduce, 2014.)
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    nodes = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    current, path = written_at(
        ends.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars"
    )
    before = _fingerprint(current)
    for _ in count() if max_rounds is None else range(max_rounds):
        earlier = path
        current, path = written_at(_small_star(_large_star(current)), "stars")
        drop_path(spark, earlier)
        after = _fingerprint(current)
        if after == before:
            stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.join(stars, "node", "left").select(
                "node", F.coalesce("component", "node").alias("component")
            )
        before = after
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def merge_components(known: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` after new ``edges``, from the table ``known(node, component)`` of those before.

    Old edges are not read: the new ones are drawn between the components of their ends, and only components that such
    an edge touches are searched and renamed. Component names are the smallest node ids, as in
    :func:`connected_components`, so the result equals a full computation over all edges. New nodes are added; a NULL end is
    no edge. A lookup per new end and one renaming of the table are all that grows with ``known``.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    nodes = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    own = written(
        nodes.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("old"), F.col("component").isNull().alias("new")),
        "components_touched",
    )
    drawn = (
        ends.join(own.select(F.col("node").alias("a"), F.col("old").alias("u")), "a")
        .join(own.select(F.col("node").alias("b"), F.col("old").alias("v")), "b")
        .select("u", "v").where("u <> v").distinct()
    )
    renamed = connected_components(drawn, "u", "v").where("node <> component")
    renamed = written(renamed.select(F.col("node").alias("old"), F.col("component").alias("to")), "components_renamed")
    every = known.select("node", F.col("component").alias("old")).unionByName(own.where("new").select("node", "old"))
    return every.join(renamed, "old", "left").select("node", F.coalesce("to", "old").alias("component"))
