"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation is three rounds of random signs and a fast Hadamard transform; it gives a vector its nearest signed axis.
In each of `tables` tables a vector's bucket is what `width` such rotations give it, one after the other, and the width
follows the number of rows, so that buckets stay small. A query looks into the buckets whose axes are together nearest to it
(multiprobe over the sum of its coordinates along them), and what it finds there is ranked anew by exact inner products of
the original vectors. As the measure is the inner product, vectors of unequal length are first completed to equal length by
one more coordinate (queries by 0).

Rows travel in groups of buckets, a grid of blocks each, so many rows in one bucket (or copies of one vector) are many tasks
of bounded size. A query goes to the groups that hold one of its buckets, with the least sum that it looks at. What it finds
in the first table bounds what the others have to tell: nothing below the k-th product found can be among the k largest. One
that found fewer than k looks into every bucket of one table, which is exact.

Cases: vectors that are null, zero, or hold a null or a component that is not finite take no part, nor do rows without an
id; vectors of different dimensions never meet; a repeated id counts once, with the larger product; equal products rank by
the smaller id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Nearest rows returned; tables; rotations of a table at most.
K, TABLES, WIDTH = 20, 8, 4
#: Rows of a bucket, on average, beyond which tables get another rotation, by the table's width.
BUCKET = (64, 16, 16)
#: Buckets of a table that a query looks into, as a share of all, by the table's width.
SHARES = (1 / 8, 1 / 32, 1 / 256, 1 / 4096)
#: Axes of a rotation, nearest first, that a query's buckets may have, by the table's width: so many that the share above can be
#: had of their combinations, which are put in order to find it.
FEW = (1 << 30, 1 << 30, 32, 19)
#: Groups of a table at most (the table of groups is broadcast).
GROUPS = 1 << 16
#: Rows and queries of a block; queries that are compared at once.
ROWS, QUERIES, TOGETHER = 4096, 4096, 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows of x(n, 2**m), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    wide = 1 << max(0, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), wide))
    out[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, table, wide]).choice([-1.0, 1.0], (3, wide))
    for s in signs:
        out = hadamard(out * s)
    return out


def nearest_axis(y: np.ndarray) -> np.ndarray:
    """Number of the nearest signed axis: 2 i for +i, 2 i + 1 for -i."""
    i = np.abs(y).argmax(axis=1)
    return 2 * i + (y[np.arange(len(y)), i] < 0)


def nearest_axes(y: np.ndarray, probes: int) -> np.ndarray:
    """The `probes` nearest signed axes, nearest first."""
    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def width_for(rows: int, axes: int) -> int:
    """Rotations of a table: enough for buckets of BUCKET rows at most, as far as WIDTH and 60 bits of a bucket's number go."""
    wanted = 1
    while wanted < min(WIDTH, 60 // axes.bit_length()) and axes > 2 and rows > BUCKET[wanted - 1] * axes**wanted:
        wanted += 1
    return wanted


def signed(y: np.ndarray) -> np.ndarray:
    """Coordinates along all signed axes."""
    return np.stack([y, -y], axis=2).reshape(len(y), -1)


#: Axes of a bucket, from the first, that tell its group: a query's buckets have FEW ** PREFIX of these at most.
PREFIX = 2


def group_of(code: np.ndarray, axes: int, width: int, groups: int) -> np.ndarray:
    """Group of a bucket: by its first axes, all but the last or PREFIX of them."""
    first = code // axes ** (width - min(PREFIX, max(1, width - 1)))
    return ((first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(groups)


class Table:
    """Buckets of one table of an index of so many rows, for vectors whose rotation has `axes` signed axes."""

    def __init__(self, number: int, axes: int, rows: int, seed: int):
        self.number, self.axes, self.seed = number, axes, seed
        self.width, self.groups = width_for(rows, axes), max(1, min(GROUPS, -(-rows // ROWS)))
        self.few = min(axes, FEW[self.width - 1])

    def turned(self, u: np.ndarray) -> list[np.ndarray]:
        return [rotated(u, self.number * WIDTH + i, self.seed) for i in range(self.width)]

    def codes(self, u: np.ndarray) -> np.ndarray:
        """Bucket of each row: the numbers of its axes as digits."""
        out = np.zeros(len(u), np.int64)
        for y in self.turned(u):
            out = out * self.axes + nearest_axis(y)
        return out

    def group(self, codes: np.ndarray) -> np.ndarray:
        return group_of(codes, self.axes, self.width, self.groups)

    def sums(self, u: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """For each row of u and each bucket, the sum of its coordinates along the bucket's axes; minus infinity where one of
        them is not among its `few` nearest, so that what probes() goes to is exactly what can reach its least sum."""
        out = np.zeros((len(u), len(codes)))
        for i, y in enumerate(self.turned(u)):
            along = signed(y)
            if self.few < self.axes:
                near, among = nearest_axes(y, self.few), np.full_like(along, -np.inf)
                np.put_along_axis(among, near, np.take_along_axis(along, near, 1), 1)
                along = among
            out += along[:, codes // self.axes ** (self.width - 1 - i) % self.axes]
        return out

    def probes(self, u: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """For each row of u, the least sum that it looks at and the groups of the buckets that reach it."""
        few = self.few
        wanted = max(1, min(int(SHARES[self.width - 1] * self.axes**self.width), few**self.width))
        for at in range(0, len(u), 64):
            part = u[at : at + 64]
            total, code = np.zeros((len(part), 1)), np.zeros((len(part), 1), np.int64)
            for y in self.turned(part):
                near = nearest_axes(y, few)
                along = np.take_along_axis(signed(y), near, 1)
                total = (total[:, :, None] + along[:, None, :]).reshape(len(part), -1)
                code = (code[:, :, None] * self.axes + near[:, None, :]).reshape(len(part), -1)
            least = np.partition(total, total.shape[1] - wanted, axis=1)[:, total.shape[1] - wanted] - 1e-12
            for row, buckets, low in zip(total, code, least):
                yield float(low), np.unique(self.group(buckets[row >= low]))


def axes(u: np.ndarray) -> int:
    """Number of signed axes of rotated(u)."""
    return 2 << max(0, (u.shape[1] - 1).bit_length())


def unit(x: np.ndarray, longest: float, complete: bool, query: bool) -> np.ndarray:
    """Rows of length one; with complete, of x / e**longest and the coordinate that completes it (0 for queries). Lengths
    are logarithms, and rows are scaled by their largest component first, so no finite vector is too long or too short."""
    most = np.abs(x).max(axis=1, keepdims=True)
    x = x / most
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    x = x / norm
    if not complete:
        return x
    if query:
        return np.hstack([x, np.zeros_like(norm)])
    share = np.minimum(1.0, np.exp(np.log(most) + np.log(norm) - longest))
    return np.hstack([x * share, np.sqrt(1.0 - share**2)])


def by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the rows and their vectors (float64), for each dimension of a batch's embeddings."""
    vectors = batch.column("embedding")
    length = np.asarray(vectors.value_lengths())
    values = np.asarray(vectors.flatten(), np.float64)
    start = length.cumsum() - length
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield rows, values[start[rows][:, None] + np.arange(d)]


def first_copies(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows without repetitions of an id and its vector, and without those that equal more than k rows of smaller ids: no
    query can want these."""
    same = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * x.itemsize}").reshape(-1), return_inverse=True)[1].reshape(-1)
    order = np.lexsort((ids, same))
    order = order[np.append(True, (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0))]
    nth = np.arange(len(order)) - np.searchsorted(same[order], same[order])
    return order[nth <= k]


def first_of_each(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places where a pair comes for the first time."""
    return np.sort(np.unique(np.stack([rows, ids], axis=1), axis=0, return_index=True)[1])


def best(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, looks: Iterator[tuple[np.ndarray, slice]], floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of q the k largest inner products with the rows of x that it looks at, ties to the smaller id: rows of
    q, of x, products. looks: rows of q and the stretch of x that they look at; no pair comes twice. floor: what products have to reach.

    Matrix products choose, with room for their rounding; what they choose is summed coordinate by coordinate, so equal
    vectors have equal products wherever they stand.
    """
    rows, cols, near = [], [], []
    for of, stretch in looks:
        rows.append(np.repeat(of, stretch.stop - stretch.start))
        cols.append(np.tile(np.arange(stretch.start, stretch.stop), len(of)))
        near.append((q[of] @ x[stretch].T).reshape(-1))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    rows, cols, near = np.concatenate(rows), np.concatenate(cols), np.concatenate(near)
    other = qid[rows] != xid[cols]
    rows, cols, near = rows[other], cols[other], near[other]
    order = np.lexsort((-near, rows))
    rows, cols, near = rows[order], cols[order], near[order]
    repeated = len(np.unique(xid)) < len(xid)
    apart = first_of_each(rows, xid[cols]) if repeated else np.arange(len(rows))
    first = np.searchsorted(rows[apart], np.arange(len(q)))
    count = np.searchsorted(rows[apart], np.arange(len(q)), side="right") - first
    least = floor.copy()
    enough = count >= k
    least[enough] = np.fmax(floor[enough], near[apart][first[enough] + k - 1])
    room = 1e-12 * np.abs(q).sum(axis=1) * np.abs(x).max(initial=0.0)
    keep = ~(near < (least - room)[rows])
    rows, cols = rows[keep], cols[keep]
    value = np.zeros(len(rows))
    for j in range(q.shape[1]):
        value += q[rows, j] * x[cols, j]
    reach = np.flatnonzero(value >= floor[rows])
    order = reach[np.lexsort((xid[cols[reach]], -value[reach], rows[reach]))]
    order = order[first_of_each(rows[order], xid[cols[order]])] if repeated else order
    rows, cols, value = rows[order], cols[order], value[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep], value[keep]


#: Groups that a query goes to.
LOOKS = pa.list_(pa.struct([("at", pa.int32()), ("least", pa.float64())]))


class Index:
    def __init__(self, vectors: DataFrame, tables: int = TABLES, seed: int = 17):
        """Hashes every vector of vectors(vec_id, embedding) once and writes the index to the shared folder."""
        self.tables, self.seed = tables, seed
        kind = "array<float>" if "float" in vectors.schema["embedding"].dataType.simpleString() else "array<double>"
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
        most = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        good = rows.where(F.col("vec_id").isNotNull() & finite).withColumn("most", most).where("most > 0")
        length = F.log("most") + 0.5 * F.log(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + (x.cast("double") / F.col("most")) * (x.cast("double") / F.col("most"))))
        ends = good.select(length.alias("length")).agg(F.min("length").alias("low"), F.max("length").alias("high"), F.count(F.lit(1)).alias("n")).first()
        self.longest, self.n = float(ends.high or 0.0), ends.n
        self.complete = bool(ends.n) and ends.low < ends.high - 0.005
        longest, complete, n = self.longest, self.complete, self.n

        def hashed(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in of:
                codes, groups = np.zeros((batch.num_rows, tables), np.int64), np.zeros((batch.num_rows, tables), np.int32)
                dims = np.zeros(batch.num_rows, np.int32)
                for at, x in by_dimension(batch):
                    u = unit(x, longest, complete, False)
                    dims[at] = x.shape[1]
                    for t in range(tables):
                        table = Table(t, axes(u), n, seed)
                        codes[at, t] = table.codes(u)
                        groups[at, t] = table.group(codes[at, t]) + t * GROUPS
                starts = pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(starts, pa.array(v.reshape(-1))) for v in (codes, groups)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(dims), *lists], ["vec_id", "embedding", "dim", "codes", "groups"])

        self.rows = C.written(good.select("vec_id", "embedding").mapInArrow(hashed, f"vec_id long, embedding {kind}, dim int, codes array<long>, groups array<int>"))

    def probed(self, queries: DataFrame, tables: range, everywhere: bool) -> DataFrame:
        """vec_id, embedding, dim, floor, and of each group that a query goes to: its number and the least sum it looks at."""
        longest, complete, n, seed = self.longest, self.complete, self.n, self.seed

        def probe(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in of:
                out: list = [[] for _ in range(batch.num_rows)]
                for at, x in by_dimension(batch):
                    u = unit(x, longest, complete, True)
                    for t in tables:
                        table = Table(t, axes(u), n, seed)
                        looks = ((-np.inf, np.arange(table.groups)) for _ in at) if everywhere else table.probes(u)
                        for i, (least, groups) in zip(at, looks):
                            out[i] += [{"at": int(g) + t * GROUPS, "least": least} for g in groups]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), batch.column("dim"), batch.column("floor"), pa.array(out, LOOKS)], ["vec_id", "embedding", "dim", "floor", "looks"])

        kind = self.rows.schema["embedding"].dataType.simpleString()
        got = queries.select("vec_id", "embedding", "dim", "floor").mapInArrow(probe, f"vec_id long, embedding {kind}, dim int, floor double, looks array<struct<at: int, least: double>>")
        return got.select("vec_id", "embedding", "dim", "floor", F.explode("looks").alias("look")).select("vec_id", "embedding", "dim", "floor", "look.at", "look.least")

    def search(self, queries: DataFrame, k: int = K, tables: range | None = None, everywhere: bool = False) -> DataFrame:
        """query_id, vec_id, score: what each of queries (rows of the index; floor: a product that results have to reach)
        finds in some of the tables, among it the k largest inner products; a pair may come twice."""
        tables = range(self.tables) if tables is None else tables
        longest, complete, n, seed = self.longest, self.complete, self.n, self.seed
        asked = self.probed(queries, tables, everywhere)
        part = lambda c: F.slice(c, tables.start + 1, len(tables))
        held = self.rows.select("vec_id", "embedding", "dim", F.explode(F.arrays_zip(part("codes").alias("code"), part("groups").alias("at"))).alias("of"))
        held = held.select("vec_id", "embedding", "dim", "of.code", "of.at")
        # how many blocks a group's rows and queries make: a row for each group, tables * GROUPS at most of a dimension
        rows = held.groupBy("dim", "at").agg(F.ceil(F.count(F.lit(1)) / (2 * ROWS)).cast("int").alias("row_blocks"))
        many = asked.groupBy("dim", "at").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("query_blocks"))
        grid = F.broadcast(rows.join(many, ["dim", "at"]))
        held = held.join(grid, ["dim", "at"]).select("dim", "at", F.pmod(F.xxhash64("vec_id"), "row_blocks").cast("int").alias("rb"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"), F.lit(False).alias("asks"), "vec_id", "embedding", "code", F.lit(0.0).alias("least"), F.lit(0.0).alias("floor"))
        asked = asked.join(grid, ["dim", "at"]).select("dim", "at", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)).alias("rb"), F.pmod(F.xxhash64("vec_id"), "query_blocks").cast("int").alias("qb"), F.lit(True).alias("asks"), "vec_id", "embedding", F.lit(0).cast("long").alias("code"), "least", "floor")

        def ranked(group: pa.Table) -> pa.Table:
            ids, asks, codes = group.column("vec_id").to_numpy(), np.asarray(group.column("asks")), group.column("code").to_numpy()
            values = np.asarray(group.column("embedding").combine_chunks().flatten(), np.float64).reshape(len(ids), -1)
            at = np.flatnonzero(~asks)
            found = [[], [], []]
            if len(at) and asks.any():
                at = at[first_copies(ids[at], values[at], k)]
                at = at[np.argsort(codes[at], kind="stable")]
                x, xid = values[at], ids[at]
                buckets, starts = np.unique(codes[at], return_index=True)
                stretches = [slice(a, b) for a, b in zip(starts, np.append(starts[1:], len(at)))]
                q, qid, least, floor = values[asks], ids[asks], group.column("least").to_numpy()[asks], group.column("floor").to_numpy()[asks]
                u = unit(q, longest, complete, True)
                table = Table(group.column("at")[0].as_py() // GROUPS, axes(u), n, seed)
                for i in range(0, len(q), TOGETHER):
                    part = slice(i, i + TOGETHER)
                    looks = table.sums(u[part], buckets) >= least[part, None]
                    r, c, v = best(q[part], qid[part], x, xid, ((np.flatnonzero(looks[:, b]), stretches[b]) for b in np.flatnonzero(looks.any(axis=0))), floor[part], k)
                    for to, each in zip(found, (qid[part][r], xid[c], v)):
                        to.append(each)
            cat = lambda v, t: pa.array(np.concatenate(v) if v else np.empty(0), t)
            return pa.table({"query_id": cat(found[0], pa.int64()), "vec_id": cat(found[1], pa.int64()), "score": cat(found[2], pa.float64())})

        return held.unionByName(asked).groupBy("dim", "at", "rb", "qb").applyInArrow(ranked, "query_id long, vec_id long, score double")


def largest(pairs: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest of pairs(query_id, vec_id, score), where a pair counts once."""
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, tables: int = TABLES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of vectors(vec_id, embedding) that is_query picks, against all rows."""
    index = Index(vectors, tables)
    queries = index.rows.where(is_query).select("vec_id", "embedding", "dim")
    first = C.written(largest(index.search(queries.withColumn("floor", F.lit(float("-inf"))), k, range(1)), k))
    floors = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    bounded = queries.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    more = index.search(bounded, k, range(1, tables))
    found = C.written(largest(first.select("query_id", "vec_id", "score").unionByName(more), k))
    enough = found.where(F.col("rank") == k).select("query_id")
    short = queries.join(enough, queries.vec_id == enough.query_id, "left_anti")
    if index.n <= 1 or short.isEmpty():
        return found
    rest = largest(index.search(short.withColumn("floor", F.lit(float("-inf"))), k, range(1), everywhere=True), k)
    return found.join(enough, "query_id", "left_semi").select("query_id", "rank", "vec_id", "score").unionByName(rest)
