"""Centroid clustering in whole numbers by kd-tree filtering.

Vectors become integers and are packed once into blocks of some thousand rows, each with a kd-tree: nodes hold the number
and the sum of their rows and a box around them. A round sends every block's nodes down level by level: the centroid
nearest to the middle of a box rules out each one that is farther even at the corner of the box that suits it best; a node
with one centroid left is assigned whole, a leaf resolves its rows exactly. Blocks give a row for each centroid (count and
sums), which are added up; the driver holds the centroids alone. All arithmetic is exact: in doubles where numbers stay
below 2^21 in size, so that every sum stays a whole number below 2^53, in Python's integers otherwise.

Cases: vectors that are null, of another length, or hold a null or non-finite component take no part; ties go to the smaller
number; repeated rows count as often as they come; fewer rows than centroids give as many centroids as there are; an empty
table gives an empty table; a null identifier counts as an empty one in the choice of the first centroids; other columns
take no part. A distance, or a sum of distances, beyond 64 bits is null; a scaled component of 2^62 or more is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Rows of a block and most rows of a leaf.
BLOCK_ROWS, LEAF_ROWS = 4096, 32
#: Numbers below this are summed and squared exactly in doubles (64 components, blocks of BLOCK_ROWS).
SMALL = 1 << 21
PACKED = "ids binary, nulls binary, points binary, wide boolean, n long"


def whole_numbers(rows: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """id and v (array of long): floor(scale * x) of every vector of `dims` finite components."""
    x = F.col(vector)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    some = rows.where((F.size(x) == dims) & F.forall(x, finite))
    scaled = F.transform(x, lambda c: c.cast("double") * scale)
    fits = lambda c: F.when(F.abs(c) < float(1 << 62), F.floor(c)).otherwise(F.raise_error(F.lit("a scaled component of 2^62 or more")).cast("long"))
    return some.select(F.col(key).cast("long").alias("id"), F.transform(scaled, fits).alias("v"))


def bounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """First rows and ends of the nodes of each level of a kd-tree over n rows. Node i of a level has nodes 2 i and 2 i + 1
    below it; nodes are cut at their middle row until all are leaves."""
    first, end = np.array([0]), np.array([n])
    levels = [(first, end)]
    while (end - first).max() > LEAF_ROWS:
        cut = (first + end) // 2
        first, end = np.stack([first, cut], 1).ravel(), np.stack([cut, end], 1).ravel()
        levels.append((first, end))
    return levels


def tree_order(points: np.ndarray) -> np.ndarray:
    """Rows in the order of their kd-tree: every node that is cut is sorted along the widest side of its rows."""
    order = np.arange(len(points))
    for first, end in bounds(len(points))[:-1]:
        for a, b in zip(first.tolist(), end.tolist()):
            part = points[order[a:b]]
            wide = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            order[a:b] = order[a:b][np.argsort(part[:, wide], kind="stable")]
    return order


class Tree:
    """Counts, sums and boxes of the nodes over rows that lie in the tree's order."""

    def __init__(self, points: np.ndarray):
        self.points, self.levels = points, bounds(len(points))
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), points.dtype), np.cumsum(points, axis=0)])  # a node's sum is a difference
        self.boxes = []
        for first, _ in reversed(self.levels):  # the leaves' boxes from their rows, the others' from the two below
            if not self.boxes:
                low, high = np.minimum.reduceat(points, first), np.maximum.reduceat(points, first)
            else:
                low, high = self.boxes[-1]
                low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.append((low, high))
        self.boxes.reverse()

    def filtered(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the nearest centroid of each row (in the tree's order), and counts and sums of each centroid."""
        k = len(centroids)
        near = np.full(len(self.points), -1)
        count, total = np.zeros(k, np.int64), np.zeros((k, self.points.shape[1]), self.points.dtype)
        nodes, left = np.array([0]), np.ones((1, k), bool)
        for depth, ((first, end), (low, high)) in enumerate(zip(self.levels, self.boxes)):
            a, b, lo, hi = first[nodes], end[nodes], low[nodes], high[nodes]
            middle = ((lo + hi)[:, None, :] - 2 * centroids[None]) ** 2  # of twice the distance: whole numbers
            far = np.where(left, middle.sum(axis=2), -1)
            best = np.argmin(np.where(left, far, far.max() + 1), axis=1)
            side = centroids[None] - centroids[best][:, None, :]
            corner = np.where(side > 0, hi[:, None, :], lo[:, None, :])
            lost = ((centroids[None] - corner) ** 2).sum(axis=2) > ((centroids[best][:, None, :] - corner) ** 2).sum(axis=2)
            left = left & ~lost.astype(bool)
            alone = left.sum(axis=1) == 1
            for i in np.flatnonzero(alone).tolist():
                c = best[i]
                near[a[i] : b[i]] = c
                count[c] += b[i] - a[i]
                total[c] += self.sums[b[i]] - self.sums[a[i]]
            nodes, left = nodes[~alone], left[~alone]
            if not len(nodes):
                break
            if depth + 1 < len(self.levels):
                nodes, left = np.stack([2 * nodes, 2 * nodes + 1], 1).ravel(), np.repeat(left, 2, axis=0)
        rest = near < 0
        if rest.any():  # leaves in which several centroids are left
            some, rows = np.flatnonzero(left.any(axis=0)), self.points[rest]
            near[rest] = some[np.argmin(distances(rows, centroids[some]), axis=1)]
            for c in some.tolist():
                own = rows[near[rest] == c]
                count[c] += len(own)
                total[c] += own.sum(axis=0)
        return near, count, total


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every row from every centroid, exactly."""
    return (points**2).sum(axis=1)[:, None] - 2 * points.dot(centroids.T) + (centroids**2).sum(axis=1)[None]


def packed(rows: DataFrame, dims: int) -> DataFrame:
    """Blocks of rows(id, v) as they lie in the partitions: identifiers and integers as bytes, in the order of the block's tree."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ids, vectors = part.column("id"), part.column("v").flatten()
                exact = vectors.to_numpy(zero_copy_only=False)
                wide = bool(np.abs(exact).max() >= SMALL)
                points = np.array(exact, object if wide else np.float64).reshape(-1, dims)
                order = tree_order(points)
                data = "\n".join(map(str, points[order].ravel())).encode() if wide else points[order].astype("<i4").tobytes()
                known = np.array([0 if i is None else i for i in ids.to_pylist()], "<i8")[order]
                none = np.array([i is None for i in ids.to_pylist()], bool)[order]
                yield pa.RecordBatch.from_pydict({"ids": [known.tobytes()], "nulls": [none.tobytes()], "points": [data], "wide": [wide], "n": [len(points)]})

    return rows.mapInArrow(blocks, PACKED)


def trees(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[list, Tree]]:
    for batch in batches:
        for row in batch.to_pylist():
            if row["wide"]:
                points = np.array([int(x) for x in row["points"].split(b"\n")], object).reshape(-1, dims)
            else:
                points = np.frombuffer(row["points"], "<i4").astype(np.float64).reshape(-1, dims)
            none = np.frombuffer(row["nulls"], bool)
            yield [None if n else i for i, n in zip(np.frombuffer(row["ids"], "<i8").tolist(), none.tolist())], Tree(points)


def as_numbers(centroids: list[list[int]], tree: Tree) -> tuple[np.ndarray, Tree]:
    """Centroids and the tree in a kind of number that is exact for both."""
    small = tree.points.dtype != object and all(abs(x) < SMALL for c in centroids for x in c)
    if not small and tree.points.dtype != object:
        tree = Tree(tree.points.astype(np.int64).astype(object))
    return np.array(centroids, np.float64 if small else object), tree


def moved(blocks: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after a round: floors of the means of their rows, empty ones as they are."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = [0] * len(centroids), [[0] * dims for _ in centroids]
        for _, tree in trees(batches, dims):
            at, tree = as_numbers(centroids, tree)
            _, n, s = tree.filtered(at)
            for c in np.flatnonzero(n).tolist():
                count[c] += int(n[c])
                total[c] = [x + int(y) for x, y in zip(total[c], s[c])]
        rows = [(c, i, count[c], str(x)) for c in range(len(centroids)) if count[c] for i, x in enumerate(total[c])]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.string()))], ["c", "i", "n", "s"])

    parts = blocks.mapInArrow(sums, "c int, i int, n long, s string")
    found = parts.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # centroids x components
    out = [list(c) for c in centroids]
    for r in found:
        out[r.c][r.i] = int(r.s) // r.n
    return out


def assigned(blocks: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """id, cluster, distance of every row."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tree in trees(batches, dims):
            at, tree = as_numbers(centroids, tree)
            near, _, _ = tree.filtered(at)
            d = [int(x) for x in ((tree.points - at[near]) ** 2).sum(axis=1)]
            d = [x if x < 1 << 63 else None for x in d]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near, pa.int32()), pa.array(d, pa.int64())], ["id", "cluster", "distance"])

    return blocks.mapInArrow(nearest, "id long, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the k smallest digests of `seed:id`; of rows equal in id the smaller vector first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [[int(x) for x in r.v] for r in rows.orderBy(digest, "v").limit(k).select("v").collect()]


def clustered(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    numbers = whole_numbers(rows, key, vector, dims, scale)
    centroids = first_centroids(numbers, k, seed)
    blocks = written(packed(numbers, dims))
    for _ in range(rounds if centroids else 0):
        centroids = moved(blocks, centroids, dims)
    found = written(assigned(blocks, centroids, dims))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    sums = found.groupBy("cluster").agg(F.when(F.count_if(F.col("distance").isNull()) == 0, F.sum(F.col("distance").cast("decimal(20,0)"))).alias("s"))
    all_of = Window.partitionBy()  # a row for each centroid
    total = F.when(F.count_if(F.col("s").isNull()).over(all_of) == 0, F.sum("s").over(all_of))
    long: Column = lambda c: c.cast("decimal(38,0)").try_cast("long")
    sums = sums.select("cluster", long(F.col("s")).alias("cluster_inertia"), long(total).alias("inertia"))
    known = rows.sparkSession.createDataFrame(digests, "number int, centroid_sha256 string")
    known = sums.join(F.broadcast(known), F.col("cluster") == F.col("number")).drop("number")
    out = found.join(F.broadcast(known), "cluster")
    return out.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
