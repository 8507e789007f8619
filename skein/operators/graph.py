"""Components and clusters over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import products
from .tables import written

#: Large clusters that are broadcast, by their number.
BROADCAST = 100_000


def components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """node and its component's smallest node, from nodes(node) and edges(a, b), by labels that also jump to their label's.

    A round is two joins; each is written, and rounds end when no label has changed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both)
    now = written(nodes.select(F.col(node).alias("node"), F.col(node).alias("label")))
    while True:
        near = both.join(now, both.b == now.node).groupBy("a").agg(F.min("label").alias("near"))
        step = now.join(near, now.node == near.a, "left").select("node", F.least("label", F.coalesce("near", "label")).alias("next"), "label")
        jump = step.select(F.col("node").alias("via"), F.col("next").alias("far"))
        step = step.join(jump, step.next == jump.via).select("node", F.col("far").alias("new"), "label")
        step = written(step)
        changed = step.where("new <> label").limit(1).count()
        now = step.select("node", F.col("new").alias("label"))
        if not changed:
            return now.select(F.col("node").alias(node), F.col("label").alias("component"))


def cosine_edges(vectors: DataFrame, key: str, group: str, vector: str, least: float) -> DataFrame:
    """Pairs of a group's rows whose cosine reaches `least` (0 for a vector of length 0)."""
    return products.above(products.blocks(vectors, key, vector, group), least).withColumnRenamed("grp", group)


def split_clusters(vectors: DataFrame, key: str, group: str, vector: str, least: float) -> DataFrame:
    """key, group and cluster: each name group split into the components of its cosine edges; rows without vector drop."""
    some = vectors.where(F.col(vector).isNotNull())
    edges = products.links(products.blocks(some, key, vector, group), least)
    found = components(some, edges, key)
    return some.select(key, group, vector).join(found, key).withColumnRenamed("component", "cluster")


def merging(clusters: DataFrame, key: str, vector: str, least: float, connect: bool = False) -> DataFrame:
    """c1, c2, n: pairs of clusters whose upper median of the cosines between their members reaches `least`, by moments or counts
    (connect: of these pairs so many that they connect clusters as all do).

    Every cluster meets every other, as the rule says; what is moved grows with the rows.
    """
    sizes = clusters.groupBy(F.col("cluster").alias("of")).agg((F.count(vector) >= products.LARGE * F.max(F.size(vector))).alias("large"))
    large = written(sizes.where("large"))
    of = F.broadcast(large) if large.count() <= BROADCAST else large
    rows = clusters.join(of, F.col("cluster") == F.col("of"), "left").withColumn("large", F.coalesce("large", F.lit(False)))
    return products.merges(written(products.blocks(rows, key, vector, "large", "cluster")), least, connect)


def merge_medians(clusters: DataFrame, key: str, vector: str, least: float) -> DataFrame:
    """merging's pairs with the median itself."""
    pairs = written(merging(clusters, key, vector, least))
    some = written(pairs.select("c1").unionByName(pairs.select(F.col("c2").alias("c1"))).distinct().withColumnRenamed("c1", "cluster"))
    packed = written(products.blocks(clusters.join(some, "cluster", "left_semi"), key, vector, tag="cluster"))
    return products.upper_medians(packed, pairs)


def refined(vectors: DataFrame, key: str, group: str, vector: str, split: float, merge: float) -> DataFrame:
    """key and final cluster: groups split by cosine components, then clusters merged by upper medians, transitively."""
    parts = written(split_clusters(vectors, key, group, vector, split))
    merges = merging(parts, key, vector, merge, connect=True).select(F.col("c1").alias("a"), F.col("c2").alias("b"))
    final = components(parts.select("cluster").distinct(), merges, "cluster")
    return parts.select(key, group, "cluster").join(final, "cluster").select(key, group, "cluster", F.col("component").alias("final"))
