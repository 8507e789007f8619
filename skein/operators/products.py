"""Cosines of many vectors with one another as blocked matrix products in Arrow batches.

Vectors are packed, as they are and with their lengths, into blocks of a bounded number of rows, by group, and blocks into a few
strips. Each two strips of a group meet in one task, so a row is sent as often as its group has strips, whose number is
fixed up to a million rows. A task goes through its strips tile by tile, in products of unit rows (of length 0: zeros, so
their cosines are 0), and what leaves it is what is asked for: pairs above a threshold, edges that connect as those pairs do,
or counts by pairs of clusters. Two large clusters are told apart by their moments where these tell enough, and their rows stay
where they are. No table of all pairs or list of all cosines exists anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skein.functions.vectors import norm

from .sequences import numbered_within
from .tables import written

#: Rows of a block: a tile of two holds some megabytes.
BLOCK = 1024
#: Strips of a group, and blocks of a strip at most (of 64 dimensions, 64 MB): larger groups have more strips. A group of so few
#: blocks is one strip: its tiles are a task's work.
STRIPS, LONGEST, WHOLE = 8, 128, 12
#: Rows for each dimension from which a cluster is large: its moments are then a fraction of its rows.
LARGE = 4
#: Numbers in a block of moments, or held by a task that adds moments up.
MOMENTS, HELD = 1 << 16, 1 << 22
#: Added to a variance, beyond what rounding can take from it.
SLACK = 1e-6


def blocks(vectors: DataFrame, key: str, vector: str, group: str | None = None, tag: str | None = None, rows: int = BLOCK) -> DataFrame:
    """grp, blk, n_blk, keys, tags, m (vectors one after another), norms of vectors; rows without a vector are left out.

    With a tag, rows are packed in order of tag (what is counted together lies together) and key; without one, by a hash of the
    key into as many blocks as a group's count asks for, which needs no order of all rows.
    """
    v = vectors.where(F.col(vector).isNotNull()).select(
        (F.lit(0) if group is None else F.col(group)).alias("grp"), F.col(key).alias("key"), (F.lit(0) if tag is None else F.col(tag)).alias("tag"), F.col(vector).alias("u"), norm(F.col(vector)).alias("norm")
    )
    if tag is None:
        size = v.groupBy(F.col("grp").alias("of")).agg(F.ceil(F.count(F.lit(1)) / rows).alias("n_blk"))
        placed = v.join(size, v.grp.eqNullSafe(size.of)).withColumn("blk", F.pmod(F.xxhash64("key"), "n_blk")).withColumn("nth", F.lit(0))
    else:
        placed = numbered_within(v, ["grp"], ["tag", "key"], "nth").withColumn("blk", F.floor(F.col("nth") / rows)).withColumn("n_blk", F.ceil(F.col("size_") / rows))
    packed = placed.groupBy("grp", "blk", "n_blk").agg(F.array_sort(F.collect_list(F.struct("nth", "key", "tag", "u", "norm"))).alias("r"))
    return packed.select("grp", "blk", "n_blk", F.col("r.key").alias("keys"), F.col("r.tag").alias("tags"), F.flatten("r.u").alias("m"), F.col("r.norm").alias("norms"))


def kind(packed: DataFrame, column: str) -> str:
    return dict(packed.dtypes)[column].removeprefix("array<").removesuffix(">")


def striped(packed: DataFrame) -> DataFrame:
    """packed with `strip`, the number of a block's strip within its group, and how many strips the group has."""
    long = F.when(F.col("n_blk") <= WHOLE, F.col("n_blk")).otherwise(F.least(F.ceil(F.col("n_blk") / STRIPS), F.lit(LONGEST)))
    return packed.select("*", F.floor(F.col("blk") / long).alias("strip"), F.ceil(F.col("n_blk") / long).alias("n_strips"))


def strips(packed: DataFrame) -> DataFrame:
    """The blocks of each two strips of a group (s1 < s2), and of each strip alone (s1 = s2); `second` for those of s2 in a pair.
    A null group has none."""
    each = striped(packed.where(F.col("grp").isNotNull())).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_strips") - 1)))
    s, o = F.col("strip"), F.col("other")
    return each.select("grp", F.least(s, o).alias("s1"), F.greatest(s, o).alias("s2"), (s > o).alias("second"), "blk", "keys", "tags", "m", "norms")


def unit(m: np.ndarray, norms: np.ndarray) -> np.ndarray:
    m, n = m.astype(np.float64).reshape(len(norms), -1), norms[:, None]
    return np.divide(m, n, out=np.zeros_like(m), where=n != 0)


class Strips:
    """Two strips' keys, tags and unit vectors, in order of their blocks, or one strip with itself (`alone`: both are the same,
    and each pair of rows is to come once); `rows` is the edge of a tile. Tags rise along rows, and from the first strip to the
    second. Rows of the input that are no block are `asked`, by column."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        found: tuple[list, list] = [], []
        self.asked: list[pa.RecordBatch] = []
        for batch in batches:
            second, blk = batch.column("second").to_pylist(), batch.column("blk").to_pylist()
            take = lambda c, i: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
            for i in range(batch.num_rows):
                if blk[i] is not None:
                    found[second[i]].append((blk[i], take("keys", i), take("tags", i), unit(take("m", i), take("norms", i))))
            if None in blk:
                self.asked.append(batch.filter(batch.column("blk").is_null()))
        self.alone = not found[1]
        self.rows = max(len(b[1]) for side in found for b in side)
        sides = [[np.concatenate(c) for c in list(zip(*sorted(side, key=lambda b: b[0])))[1:]] for side in found if side]
        self.keys1, self.tags1, self.m1 = sides[0]
        self.keys2, self.tags2, self.m2 = sides[-1]

    def places(self) -> Iterator[tuple[int, int]]:
        """First row and column of each tile."""
        for i in range(0, len(self.m1), self.rows):
            for j in range(i if self.alone else 0, len(self.m2), self.rows):
                yield i, j

    def cosines(self, i: int, j: int) -> np.ndarray:
        """Cosines of a tile; where each pair is to come once, those that come elsewhere are NaN."""
        out = self.m1[i : i + self.rows] @ self.m2[j : j + self.rows].T
        if self.alone and i == j:
            out[np.tril_indices(len(out))] = np.nan
        return out


def by_strips(moved: DataFrame, f: Callable[[Strips], Iterator[dict]], schema: str) -> DataFrame:
    """What f makes of each two strips, in columns of the schema, with their group as `grp`."""
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches)
        group, s = first.column("grp")[0], Strips(chain([first], batches))
        del first
        for out in f(s):
            if n := len(out[kinds.names[0]]):
                grp = pa.array([group.as_py()] * n, group.type)
                yield pa.RecordBatch.from_arrays([grp, *[pa.array(out[k.name], k.type) for k in kinds]], ["grp", *kinds.names])

    return moved.groupBy("grp", "s1", "s2").applyInArrow(run, f"grp {dict(moved.dtypes)['grp']}, {schema}")


def above(packed: DataFrame, least: float) -> DataFrame:
    """grp, a, b (a < b), similarity of every pair of a group whose cosine reaches `least`."""

    def f(s: Strips) -> Iterator[dict]:
        for i, j in s.places():
            cosines = s.cosines(i, j)
            x, y = np.nonzero(cosines >= least)
            a, b = s.keys1[i + x], s.keys2[j + y]
            yield {"a": np.minimum(a, b), "b": np.maximum(a, b), "similarity": cosines[x, y]}

    k = kind(packed, "keys")
    return by_strips(strips(packed), f, f"a {k}, b {k}, similarity double")


def forest(near: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with near[i, j] that connect rows and columns as all of them do, fewer than there are rows and columns.

    whole: rows and columns are the same things.
    """
    n, m = near.shape
    near = near | near.T if whole else near
    left_r, left_c = np.ones(n, bool), np.ones(m, bool)
    rows, columns = [], []
    while (start := int(np.argmax(left_r))) is not None and left_r[start]:
        left_r[start] = False
        if whole:
            left_c[start] = False
        front = np.array([start])
        while len(front):  # columns near what has been reached, then rows near those
            hit = near[front][:, left_c]
            new = np.flatnonzero(left_c)[hit.any(axis=0)]
            via = front[hit[:, hit.any(axis=0)].argmax(axis=0)] if len(new) else new
            rows.append(via)
            columns.append(new)
            left_c[new] = False
            if whole:
                left_r[new] = False
                front = new
                continue
            hit = near[:, new][left_r]
            reached = np.flatnonzero(left_r)[hit.any(axis=1)]
            rows.append(reached)
            columns.append(new[hit[hit.any(axis=1)].argmax(axis=1)] if len(reached) else reached)
            left_r[reached] = False
            front = reached
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(columns) if columns else np.zeros(0, np.int64)


def joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """label (the same for what is joined) after x[i] and y[i] have been joined for all i, and which i joined something."""
    up: dict[int, int] = {}

    def root(k: int) -> int:
        while (above := up.get(k, k)) != k:
            up[k] = k = up.get(above, above)
        return k

    new = []
    at = np.flatnonzero(label[x] != label[y])
    for i, p, q in zip(at.tolist(), label[x[at]].tolist(), label[y[at]].tolist()):
        p, q = root(p), root(q)
        if p != q:
            up[max(p, q)] = min(p, q)
            new.append(i)
    if new:
        to = np.arange(len(label))
        for k in up:
            to[k] = root(k)
        label = to[label]
    return label, np.array(new, np.int64)


def links(packed: DataFrame, least: float) -> DataFrame:
    """grp, a, b: edges that connect a group's rows as all pairs with a cosine of `least` or more do; fewer than there are rows
    of each two strips, however many pairs are near. Tiles whose rows are all joined are not multiplied."""

    def f(s: Strips) -> Iterator[dict]:
        keys = s.keys1 if s.alone else np.concatenate([s.keys1, s.keys2])
        label, second = np.arange(len(keys)), 0 if s.alone else len(s.keys1)
        for i, j in s.places():
            seen = np.append(label[: second or None][i : i + s.rows], label[second:][j : j + s.rows])
            if (seen == seen[0]).all():
                continue
            x, y = forest(s.cosines(i, j) >= least, s.alone and i == j)
            x, y = x + i, y + j + second
            label, new = joined(label, x, y)
            yield {"a": keys[x[new]], "b": keys[y[new]]}

    k = kind(packed, "keys")
    return by_strips(strips(packed), f, f"a {k}, b {k}")


def segments(tags: np.ndarray) -> np.ndarray:
    """First rows of the stretches of equal tags."""
    return np.flatnonzero(np.append(True, tags[1:] != tags[:-1]))


def has_upper_median(n, above):
    """Whether the element n // 2 of n cosines in rising order is among those above: at most n // 2 are below."""
    return n - above <= (n - n % 2) / 2


def units(ends: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Stretches (from, to) of segments with such ends: as many as have so many rows together, or one that has more."""
    out, at = [], 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + rows, "right")) - 1)
        out.append((at, to))
        at = to
    return out


def summed(hits: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Counts of hits by segments, which begin at such rows and columns."""
    if len(rows) == len(columns) == 1:
        return np.array([[np.count_nonzero(hits)]])
    for axis, first in enumerate((rows, columns)):
        if len(first) < hits.shape[axis]:
            hits = np.add.reduceat(hits, first, axis=axis, dtype=np.int64)
    return hits


def few(near: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """forest(near, whole) by the rows and columns that have any."""
    r, c = near.any(axis=1), near.any(axis=0)
    if whole:
        r = c = r | c
    r, c = np.flatnonzero(r), np.flatnonzero(c)
    if not len(r):
        return r, c
    i, j = forest(near[np.ix_(r, c)], whole)
    return r[i], c[j]


def counted(moved: DataFrame, least: float, connect: bool = False, apart: bool = False) -> DataFrame:
    """c1, c2, n: pairs of tags of two strips (c1 < c2) whose upper median cosine is `least` or more, from counts of the cosines
    above it. apart: the second strip's tags are others than the first's, in an order of their own; connect: pairs that connect
    tags as all such pairs do, fewer than there are tags of each two strips but for those that are added up.

    Tags lie together, so all but the first and the last of a strip are in no other strip: two such tags are decided within
    their task, and leave it only as a result. The counts of others are added up, a few for each tag of a strip.
    """

    def f(s: Strips) -> Iterator[dict]:
        both = []
        for tags, m in ((s.tags1, s.m1), (s.tags2, s.m2)):
            first = segments(tags)
            valid = np.add.reduceat(~np.isnan(m).any(axis=1), first, dtype=np.int64)
            inner = np.ones(len(first), bool)
            inner[[0, -1]] = False
            both.append((tags[first], np.append(first, len(tags)), valid, inner))
        (tag1, ends1, valid1, inner1), (tag2, ends2, valid2, inner2) = both
        # numbers of tags over both strips, which a tag that goes on in the second has once
        after = 0 if s.alone else len(tag1) - (not apart and tag1[-1] == tag2[0])
        label = np.arange(len(tag2) + after)
        for p, q in units(ends1, s.rows):
            for u, v in units(ends2, s.rows):
                if p >= v - 1 + after:  # no tag of the unit comes before one of the other
                    continue
                high = np.zeros((q - p, v - u), np.int64)
                for i in range(ends1[p], ends1[q], s.rows):
                    for j in range(ends2[u], ends2[v], s.rows):
                        rows, columns = (slice(a, min(a + s.rows, b)) for a, b in ((i, ends1[q]), (j, ends2[v])))
                        hits = s.m1[rows] @ s.m2[columns].T >= least
                        high += summed(hits, *(e - e[0] for e in (ends1[p:q], ends2[u:v])))
                n = valid1[p:q, None] * valid2[None, u:v]
                asked = (np.arange(p, q)[:, None] < np.arange(u, v)[None] + after) & (n > 0)
                inner = inner1[p:q, None] & inner2[None, u:v]
                a, b = np.nonzero(asked & ~inner)
                decided = asked & inner & has_upper_median(n, high)
                if connect:
                    x, y = few(decided, s.alone and p == u)
                    x, y = np.minimum(x, y) if s.alone and p == u else x, np.maximum(x, y) if s.alone and p == u else y
                    label, new = joined(label, x + p, y + u + after)
                    x, y = x[new], y[new]
                else:
                    x, y = np.nonzero(decided)
                a, b = np.append(a, x), np.append(b, y)
                c1, c2 = tag1[p:q][a], tag2[u:v][b]
                yield {"c1": np.minimum(c1, c2), "c2": np.maximum(c1, c2), "n": n[a, b], "above": high[a, b]}

    k = kind(moved, "tags")
    each = by_strips(moved, f, f"c1 {k}, c2 {k}, n long, above long")
    sums = each.groupBy("c1", "c2").agg(F.sum("n").alias("n"), F.sum("above").alias("above"))
    return sums.where(has_upper_median(F.col("n"), F.col("above"))).select("c1", "c2", "n")


def with_upper_median(packed: DataFrame, least: float, connect: bool = False) -> DataFrame:
    """c1, c2, n: pairs of tags (c1 < c2) whose upper median cosine is `least` or more, by counts of all cosines."""
    return counted(strips(packed), least, connect)


def moments(packed: DataFrame) -> DataFrame:
    """tag, n, v: how many unit vectors a tag has (but those that hold NaN), their sum, and that of their products with
    themselves as a triangle, such that v of two tags give the sums of their cosines and of the squares of these."""
    k = kind(packed, "tags")
    kinds = to_arrow_schema(StructType.fromDDL(f"tag {k}, n long, v array<double>"))

    def out(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((list(held), [n for n, _ in held.values()], [v for _, v in held.values()]), kinds.types)], kinds.names)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            take = lambda c, i: batch.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
            for i in range(batch.num_rows):
                tags, m = take("tags", i), unit(take("m", i), take("norms", i))
                at = np.triu_indices(m.shape[1])
                weight, first, valid = np.where(at[0] == at[1], 1.0, np.sqrt(2.0)), segments(tags), ~np.isnan(m).any(axis=1)
                for a, b in zip(first, np.append(first[1:], len(tags))):
                    x = m[a:b][valid[a:b]]
                    n, v = held.get(tags[a], (0, 0.0))
                    held[tags[a]] = n + len(x), v + np.append(x.sum(axis=0), (x.T @ x)[at] * weight)
                    if len(held) * len(held[tags[a]][1]) > HELD:
                        yield out(held)
                        held = {}
        if held:
            yield out(held)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag, n, v = None, 0, 0.0
        for batch in batches:
            tag, n = batch.column("tag")[0].as_py(), n + sum(batch.column("n").to_pylist())
            v = v + batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
        yield out({tag: (n, v)})

    schema = f"tag {k}, n long, v array<double>"
    return packed.select("tags", "m", "norms").mapInArrow(parts, schema).groupBy("tag").applyInArrow(added, schema)


def by_moments(found: DataFrame, least: float, connect: bool = False) -> DataFrame:
    """c1, c2, n, sure: pairs of tags (c1 < c2) whose upper median cosine may be `least` or more by the tags' moments; sure: it is.

    A median lies within a standard deviation of the mean, so pairs whose mean is farther than that from `least` are decided.
    connect: sure pairs are those of a forest, as for `counted`.
    """
    width, n = found.agg(F.coalesce(F.max(F.size("v")), F.lit(1)), F.count(F.lit(1))).first()
    dims, n_blk = int(np.sqrt(9 + 8 * width) - 3) // 2, -(-n // max(1, MOMENTS // width))
    packed = found.groupBy(F.pmod(F.xxhash64("tag"), F.lit(max(n_blk, 1))).alias("blk")).agg(F.array_sort(F.collect_list(F.struct("tag", "n", "v"))).alias("r"))
    packed = packed.select(
        F.lit(0).alias("grp"), "blk", F.lit(n_blk).alias("n_blk"), F.col("r.tag").alias("keys"), F.col("r.n").alias("tags"), F.flatten("r.v").alias("m"), F.transform("r", lambda _: F.lit(1.0)).alias("norms")
    )

    def f(s: Strips) -> Iterator[dict]:
        label, second = np.arange(len(s.keys1) + (0 if s.alone else len(s.keys2))), 0 if s.alone else len(s.keys1)
        for i, j in s.places():
            x, y = s.m1[i : i + s.rows], s.m2[j : j + s.rows]
            n = s.tags1[i : i + s.rows, None] * s.tags2[None, j : j + s.rows]
            mean, square = (x[:, c] @ y[:, c].T / np.maximum(n, 1) for c in (slice(dims), slice(dims, None)))
            spread = np.sqrt(np.maximum(square - mean**2, 0) + SLACK)
            may, whole = (mean + spread >= least) & (n > 0), s.alone and i == j
            if whole:
                may = np.triu(may, 1)
            sure = may & (mean - spread >= least)
            a, b = np.nonzero(may & ~sure)
            if connect:
                p, q = few(sure, whole)
                label, new = joined(label, p + i, q + j + second)
                p, q = p[new], q[new]
            else:
                p, q = np.nonzero(sure)
            told = np.repeat([False, True], [len(a), len(p)])
            a, b = np.append(a, p), np.append(b, q)
            c1, c2 = s.keys1[i + a], s.keys2[j + b]
            yield {"c1": np.minimum(c1, c2), "c2": np.maximum(c1, c2), "n": n[a, b], "sure": told}

    k = kind(packed, "keys")
    return by_strips(strips(packed), f, f"c1 {k}, c2 {k}, n long, sure boolean").drop("grp")


def across(left: DataFrame, right: DataFrame, n_left: int, n_right: int) -> DataFrame:
    """The blocks of each strip of left and (as `second`) each of right, which have so many blocks. The side with more is cut
    into STRIPS, and the other, which is sent to each of these, is cut as little as its length allows."""
    more = n_left >= n_right
    length = lambda n, cut: min(-(-n // STRIPS), LONGEST) if cut else LONGEST
    sides = [(left, length(n_left, more), n_left), (right, length(n_right, not more), n_right)]
    counts = [-(-n // long) for _, long, n in sides]
    moved = []
    for i, (packed, long, _) in enumerate(sides):
        own = F.floor(F.col("blk") / long)
        each = packed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(counts[1 - i] - 1).cast("long"))))
        s1, s2 = (own, F.col("other")) if i == 0 else (F.col("other"), own)
        moved.append(each.select(F.lit(0).alias("grp"), s1.alias("s1"), s2.alias("s2"), F.lit(i == 1).alias("second"), "blk", "keys", "tags", "m", "norms"))
    return moved[0].unionByName(moved[1])


def merges(packed: DataFrame, least: float, connect: bool = False) -> DataFrame:
    """c1, c2, n as with_upper_median has them, from written blocks whose group says whether their tags are large.

    Two large tags are decided by their moments, and by their rows only where these don't tell; all others by their rows.
    """
    n_blk = {r.grp: r.n for r in packed.groupBy("grp").agg(F.max("n_blk").alias("n")).collect()}
    small, large = packed.where("not grp"), packed.where("grp")
    found = with_upper_median(small, least, connect)
    if True not in n_blk:
        return found
    told = written(by_moments(written(moments(large)), least, connect))
    found = found.unionByName(told.where("sure").select("c1", "c2", "n"))
    unsure = told.where("not sure").select("c1", "c2")
    if unsure.limit(1).count():
        moved = strips(large).join(F.broadcast(meeting(large, unsure)[1]), ["s1", "s2", "blk"])
        found = found.unionByName(counted(moved, least).join(unsure, ["c1", "c2"], "left_semi"))
    if False in n_blk:
        found = found.unionByName(counted(across(small, large, n_blk[False], n_blk[True]), least, connect, apart=True))
    return found


def meeting(packed: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """c1, c2, s1, s2: in which strips pairs(c1, c2) meet, and s1, s2, blk: the blocks of these that hold their rows."""
    held = striped(packed).select("strip", "blk", F.explode(F.array_distinct("tags")).alias("tag"))
    sides = [held.select(F.col("strip").alias(f"s{i}"), "blk", F.col("tag").alias(f"c{i}")) for i in (1, 2)]
    met = pairs.select("c1", "c2").join(sides[0].drop("blk").distinct(), "c1").join(sides[1].drop("blk").distinct(), "c2")
    met = written(met.select("c1", "c2", "s1", "s2"))
    needed = [met.select(f"c{i}", "s1", "s2").distinct().join(sides[i - 1], [f"c{i}", f"s{i}"]).select("s1", "s2", "blk") for i in (1, 2)]
    return met, written(needed[0].unionByName(needed[1]).distinct())  # a row for a block and a strip at most


#: Bits of a cosine (as a whole number of 2^-47 from -1) and of them those that a round tells apart.
BITS, DIGIT = 48, 16


def upper_medians(packed: DataFrame, pairs: DataFrame) -> DataFrame:
    """c1, c2, median of pairs(c1, c2, n), to 2^-47: the element at n // 2 in rising order, found digit by digit by counting.

    A round goes through the blocks that hold a pair's rows, two strips at a time, and counts the next digit of the cosines
    that begin with what is known of the median; at most 2^DIGIT counts of a pair and two strips are added up.
    """
    state = written(pairs.select("c1", "c2", F.floor(F.col("n") / 2).alias("rest"), F.lit(0).cast("long").alias("known")))
    met, needed = meeting(packed, state)
    moved, k = strips(packed).join(F.broadcast(needed), ["s1", "s2", "blk"]), kind(packed, "tags")
    for left in range(BITS - DIGIT, -1, -DIGIT):

        def f(s: Strips, left: int = left) -> Iterator[dict]:
            ends1, ends2 = (np.append(segments(x), len(x)) for x in (s.tags1, s.tags2))
            at1, at2 = (dict(zip(x[e[:-1]].tolist(), zip(e[:-1].tolist(), e[1:].tolist()))) for x, e in ((s.tags1, ends1), (s.tags2, ends2)))

            def digits(rows: slice, columns: slice, known: int) -> np.ndarray:
                x = s.m1[rows] @ s.m2[columns].T
                whole = np.clip(np.floor((x + 1.0) * 2.0 ** (BITS - 1)), 0, 2.0**BITS - 1).astype(np.int64) >> left
                return (whole & ((1 << DIGIT) - 1))[whole >> DIGIT == known]

            out: dict[str, list] = {"c1": [], "c2": [], "digit": [], "n": []}
            for batch in s.asked:
                for a, b, known in zip(*(batch.column(c).to_pylist() for c in ("c1", "c2", "known"))):
                    (i, i2), (j, j2) = at1[a], at2[b]
                    if max(i2 - i, j2 - j) <= s.rows:
                        found, n = np.unique(digits(slice(i, i2), slice(j, j2), known), return_counts=True)
                    else:
                        n = np.zeros(1 << DIGIT, np.int64)
                        for x in range(i, i2, s.rows):
                            for y in range(j, j2, s.rows):
                                n += np.bincount(digits(slice(x, min(x + s.rows, i2)), slice(y, min(y + s.rows, j2)), known), minlength=1 << DIGIT)
                        found = np.flatnonzero(n)
                        n = n[found]
                    for column, values in zip(out.values(), ([a] * len(n), [b] * len(n), found.tolist(), n.tolist())):
                        column += values
                    if len(out["n"]) > 1 << DIGIT:
                        yield out
                        out = {c: [] for c in out}
            yield out

        asked = met.join(state, ["c1", "c2"]).select(F.lit(0).alias("grp"), "s1", "s2", "c1", "c2", "known")
        sums = by_strips(moved.unionByName(asked, allowMissingColumns=True), f, f"c1 {k}, c2 {k}, digit long, n long").groupBy("c1", "c2", "digit").agg(F.sum("n").alias("n"))
        earlier = Window.partitionBy("c1", "c2").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("below", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(state, ["c1", "c2"])
        hit = sums.where((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("n")))
        state = written(hit.select("c1", "c2", (F.col("rest") - F.col("below")).alias("rest"), (F.shiftleft("known", DIGIT) + F.col("digit")).alias("known")))
    return state.select("c1", "c2", (F.col("known") / F.lit(2.0 ** (BITS - 1)) - 1.0).alias("median"))
