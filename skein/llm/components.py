"""Connected components of an edge table by alternating stars; every round is joins and aggregates, none holds a group.

Edges that are few enough by their count (16 bytes each) need no rounds: one task unites them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Edges up to which one task unites them.
FEW = 1 << 20


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or smaller) neighbours, and itself, to the smallest among them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    # a table of its own, so that the join has plain exchanges on both sides and a node of many edges can be split
    least = C.written(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m")))
    joined = both.join(least, "a")
    if large:
        new = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return new.where("a <> b").distinct()


def united(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root of all edges of a task: each node takes the smallest label of its neighbours and then its label's label."""
    got = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in of]
    if got:
        node, at = np.unique(np.concatenate([x for pair in got for x in pair]), return_inverse=True)
        ends = np.split(at, np.cumsum([len(x) for pair in got for x in pair])[:-1])
        a, b = np.concatenate(ends[::2]), np.concatenate(ends[1::2])
        label = np.arange(len(node))
        while True:
            least = np.minimum(label[a], label[b])
            new = label.copy()
            for end in (a, b):
                np.minimum.at(new, end, least)
                np.minimum.at(new, label[end], least)
            new = new[new]
            if (new == label).all():
                break
            label = new
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[label])], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node of edges(a, b).

    Written to the shared folder after each round; ends when a round changes nothing, after a logarithm of the largest
    component's width. What a round leaves is compared by a count and a sum of hashes.
    """
    now = C.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    if now.count() <= FEW:
        return C.written(now.coalesce(1).mapInArrow(united, "node long, root long"))
    mark = None
    while True:
        # b < a throughout: the small star of the large star
        now = C.written(star(star(now, True), False))
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = (row.n, row.h)
