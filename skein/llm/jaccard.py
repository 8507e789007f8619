"""Similarity join of whole texts: sets of shingles (WIDTH words, or as many as asked for) whose Jaccard similarity reaches a threshold.

Equal sets are one class from the start. Index lists hold a set at the positions alone that a link can need; everything at
other positions is skipped, block by block:

- the block of a set's smallest hashes, as many as it may lack and as many again that a linked set must then share;
- of these the rarest, counted over all sets. Hashes of one set only come first and are in no list, so most sets are in
  none; a passage that many texts share comes last. Hashes that hold more than a fixed share of all entries are hot (at
  most HOT_SHARE of them, by counts that cover every text): they come after all others and never meet in one task.
- Sets for which such a block has too few hashes that are not hot are hot sets. They meet the others in the lists above,
  and one another in a second index of the same kind, over all of their hashes instead of a block; hot hashes are listed
  there for those sets alone that consist of little else.

A list is answered through its lowest set: what links to it is settled and needs no pair. Only lists with sets that are not
yet joined are compared further. There one set of the largest joined part is the pivot, and each other set is held as its
difference from it: what it lacks, D, and what it adds, A. The overlap of any two follows from the pivot's answers,

    |X & Z| = |P| - |D_x| - |D_z| + |D_x & D_z| + |A_x & A_z|,

so whole sets are compared with the pivot only. The sets that are not joined to the pivot meet one another and the rest in
a grid of blocks of bounded size; those that are joined to it never meet. Lists are cut first where sizes leave a gap that no
link crosses. Where lists chain more such sets together than a block holds, as more texts do by chance, sets meet within
each list instead of all. A block gives the links' components only; no pairs are emitted, none is lost, and m near copies of
one text cost work in proportion to m.

Shingles and sets are told apart by 64-bit hashes, those of words longer than LONG_WORD bytes by blake2b: among k sets the
chance that two different ones are taken for equal is about k * k / 2**65.

Cases: a text of fewer words than a shingle has one, its whole sequence; a text without words has none and links with
nothing; a row without an id is of the class of equal texts and gets that group's smallest id, and links with no other if
no equal text has an id; repeated rows are one class; an empty table gives an empty table; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .components import components

#: Similarity in hundredths; words of a shingle.
SIMILAR, WIDTH = 90, 3
#: Members of a block, and hashes they may hold together.
MEMBERS, HASHES = 512, 1 << 20
#: Entries that a worker counts together; entries, and classes, that it holds before it hands them on; entries of a part of the index,
#: and least number of parts. A worker's memory follows these: some 100 MB beside its libraries.
COUNTED, HELD, PART, PARTS = 1 << 20, 1 << 18, 1 << 18, 64
#: Bytes of texts whose shingles are made at once (a longer text is on its own).
SLICE = 1 << 18
#: A hash is hot with more than one in HOT_SHARE of all entries (so there are fewer than HOT_SHARE of them), and LEAST_HOT.
HOT_SHARE, LEAST_HOT, LEAST_SEEN = 1 << 17, 64, 8
#: Bytes of a word from which blake2b hashes it: a polynomial modulo a power of two can be fooled by long words.
LONG_WORD = 64
#: Candidates up to which their ids (16 bytes each) are broadcast instead of shuffling texts.
BROADCAST_IDS = 500_000

_M = np.uint64
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_OF_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least n of them."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        with np.errstate(over="ignore"):
            got = np.full(max(n, 1 << 16), base, np.uint64)
            got[0] = 1
            got = _powers[base] = np.cumprod(got, dtype=np.uint64)
    return got


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _M(30))) * _M(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _M(27))) * _M(0x94D049BB133111EB)
        return x ^ (x >> _M(31))


def sequences(word: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words from the words' hashes."""
    n = max(len(word) - width + 1, 0)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total = total * _M(0x9E3779B97F4A7C15) + word[k : k + n]
        return mixed(total + _M(width))


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    b = _LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    blank = _BLANK[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        sums = np.concatenate([[_M(0)], np.cumsum(_OF_BYTE[b] * powers(_BASE, len(b))[: len(b)], dtype=np.uint64)])
        word = mixed((sums[end] - sums[start]) * powers(_INVERSE, len(b))[start])
        for i in np.flatnonzero(end - start > LONG_WORD):
            word[i] = int.from_bytes(hashlib.blake2b(b[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
        runs = sequences(word, width)
        size = np.array([len(t) + 1 for t in texts])
        first = np.searchsorted(start, np.concatenate([[0], size.cumsum()]))
        out = []
        for i in range(len(texts)):
            f, n = first[i], first[i + 1] - first[i]
            if n >= width:
                s = np.sort(runs[f : f + n - width + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            else:
                out.append(sequences(word[f : f + n], n) if n else np.empty(0, np.uint64))
    return out


def in_slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a column as bytes, about `most` at a time, with the row each slice begins at."""
    part, size, at = [], 0, 0
    for i, t in enumerate(column):
        b = t.as_buffer()
        part.append(b.to_pybytes() if b is not None else b"")
        size += len(part[-1])
        if size >= most or i + 1 == len(column):
            yield at, part
            part, size, at = [], 0, i + 1


def smallest(similar: int) -> int:
    """Shingles that a set needs to link with a different one, at least."""
    return -(-similar // (100 - similar))


def lengths(n: int, similar: int) -> tuple[int, int]:
    """How many of a set's n hashes, the smallest ones, are looked at, and how many of these, the rarest, are indexed.

    Two linked sets share at least need(n) of what is looked at, for the n of the smaller; so a set of n shares need of
    the least n that can link to it, and one of those is among the rarest that are left when so many less one are put off.
    """
    if n < smallest(similar):
        return 0, 0
    kept = lambda n: -(-similar * n // 100)
    need = lambda n: min(n - kept(n) + 1, kept(n))
    whole = min(n, n - kept(n) + need(n))
    return whole, whole - need(kept(n)) + 1


def identity(s: np.ndarray) -> int | None:
    """A hash of a set; None for the empty one."""
    with np.errstate(over="ignore"):
        return int(mixed(np.array([s.sum() + _M(len(s))], np.uint64)).view(np.int64)[0]) if len(s) else None


def local_counts(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that occur often in held, and how often."""
    key, times = np.unique(np.concatenate(held), return_counts=True)
    often = times >= max(LEAST_SEEN, int(times.sum()) // HOT_SHARE)
    return key[often].view(np.int64), times[often]


def measured(docs: DataFrame, similar: int, width: int) -> DataFrame:
    """doc_id, n, cls (hash of the set), whole, rare (see lengths) of every row; and rows with often, times (arrays) alone,
    the hashes that occur often among the entries that a worker held."""
    names = ["doc_id", "n", "cls", "whole", "rare", "often", "times"]

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        key, times = local_counts(held)
        none = [pa.nulls(1, pa.int64())] * 5
        return pa.RecordBatch.from_arrays([*none, pa.array([key], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))], names)

    def sets(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in of:
            for at, texts in in_slices(batch.column("text")):
                found = shingle_sets(texts, width)
                cls = [identity(s) for s in found]
                cut = [lengths(len(s), similar) for s in found]
                longs = lambda v: pa.array(v, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), longs([len(s) for s in found]), longs(cls), longs([c[0] for c in cut]), longs([c[1] for c in cut])]
                    + [pa.nulls(len(texts), pa.list_(pa.int64()))] * 2,
                    names,
                )
                for s, c, (whole, _) in zip(found, cls, cut):
                    if whole and c not in seen:
                        seen.add(c)
                        held.append(s[:whole].copy())  # not a view, which would keep the whole set
                        size += whole
                if size >= COUNTED:
                    yield counted(held)
                    held, size, seen = [], 0, set()
        if held:
            yield counted(held)

    return docs.mapInArrow(sets, "doc_id long, n long, cls long, whole long, rare long, often array<long>, times array<long>")


def hot_hashes(rows: DataFrame) -> np.ndarray:
    """The hot hashes, sorted: fewer than HOT_SHARE, whatever the number of texts."""
    entries = rows.agg(F.sum("whole")).first()[0] or 0
    each = rows.where("often is not null").select(F.explode(F.arrays_zip("often", "times")).alias("o")).groupBy(F.col("o.often").alias("key"))
    got = each.agg(F.sum("o.times").alias("times")).where(F.col("times") > max(LEAST_HOT, entries // HOT_SHARE)).select("key").toArrow()
    return np.sort(got.column("key").to_numpy().view(np.uint64))


def is_in(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s if len(hot) else np.zeros(len(s), bool)


def distinct_sets(of: Iterator[pa.RecordBatch], similar: int, width: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray, int, np.ndarray, bool]]:
    """Class, set, number of its hashes that are looked at, which are hot, and whether it is a hot set, of rows with an id;
    repetitions are left out as far as a worker remembers."""
    seen: set[int] = set()
    for batch in of:
        for _, texts in in_slices(batch.column("text")):
            for s in shingle_sets(texts, width):
                whole, rare = lengths(len(s), similar)
                if whole and (c := identity(s)) not in seen:
                    if len(seen) >= HELD:
                        seen.clear()
                    seen.add(c)
                    warm = is_in(s, hot)
                    yield c, s, whole, warm, bool(whole - warm[:whole].sum() < rare)


def dealt(docs: DataFrame, similar: int, width: int, hot: Broadcast, parts: int, second: bool) -> DataFrame:
    """part, blob: the entries of a part of an index, all upper halves of hashes and then all classes; hot hashes are in
    none. The second index has hot sets only."""

    def blobs(cls: list[int], held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        owner = np.repeat(np.array(cls, np.int64), [len(s) for s in held])
        s = np.concatenate(held)
        part = ((s & _M(0xFFFFFFFF)) * _M(parts) >> _M(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, key, owner = part[order], (s[order] >> _M(32)).astype(np.uint32), owner[order]
        at = np.flatnonzero(np.diff(part, prepend=-1))
        ends = [*at[1:].tolist(), len(part)]
        for i in range(0, len(at), 64):
            some = list(zip(at[i : i + 64].tolist(), ends[i : i + 64]))
            yield pa.RecordBatch.from_arrays([pa.array(part[at[i : i + 64]], pa.int32()), pa.array([key[a:b].tobytes() + owner[a:b].tobytes() for a, b in some], pa.binary())], ["part", "blob"])

    def entries(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, held, size = [], [], 0
        for c, s, whole, warm, is_hot in distinct_sets(of, similar, width, hot.value):
            if second and not is_hot:
                continue
            cls.append(c)
            held.append(s[~warm] if second else s[:whole][~warm[:whole]])
            size += len(held[-1])
            if size >= HELD:
                yield from blobs(cls, held)
                cls, held, size = [], [], 0
        if size:
            yield from blobs(cls, held)

    return docs.where("doc_id is not null").mapInArrow(entries, "part int, blob binary")


def shared_entries(dealt_out: DataFrame) -> DataFrame:
    """cls, key, times of the entries whose hash times classes have, at least two."""

    def shared(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        blobs = [b.as_buffer() for b in group.column("blob")]
        n = [len(b) // 12 for b in blobs]
        key = np.concatenate([np.frombuffer(b, np.uint32, k) for b, k in zip(blobs, n)])
        cls = np.concatenate([np.frombuffer(b, np.int64, k, 4 * k) for b, k in zip(blobs, n)])
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        new_key = np.append(True, key[1:] != key[:-1])
        keep = new_key | np.append(True, cls[1:] != cls[:-1])  # a class that several workers had
        key, cls = key[keep], cls[keep]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(at, len(key)))
        times = np.repeat(times, times)
        many = times > 1
        return pa.table({"cls": cls[many], "key": key[many].astype(np.int64) | np.int64(part) << np.int64(32), "times": times[many]})

    return dealt_out.groupBy("part").applyInArrow(shared, "cls long, key long, times long")


def warm_classes(docs: DataFrame, similar: int, width: int, hot: Broadcast) -> DataFrame:
    """cls, n_hot of the classes with hot hashes in what is looked at; of hot sets also cold (how many are not hot in all),
    needed (how many the second index wants) and keys, the hot ones that it takes for want of others."""

    def found(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for c, s, whole, warm, is_hot in distinct_sets(of, similar, width, hot.value):
            n_hot = int(warm[:whole].sum())
            if is_hot:
                cold, needed = int(len(s) - warm.sum()), len(s) + 1 + -similar * len(s) // 100
                # the sign tells these keys from all others
                rows.append((c, n_hot, cold, needed, (s[warm][: max(0, needed - cold)] | _M(1 << 63)).view(np.int64)))
            elif n_hot:
                rows.append((c, n_hot, None, None, None))
            if len(rows) >= 1000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["cls", "n_hot", "cold", "needed", "keys"])

    return docs.where("doc_id is not null").mapInArrow(found, "cls long, n_hot long, cold long, needed long, keys array<long>")


def rarest(entries: DataFrame) -> DataFrame:
    """key, cls of the entries to be listed, from shared_entries with cold, needed: hashes that no other class has come
    first in the order and use up positions."""
    of_class = Window.partitionBy("cls")
    entries = entries.withColumn("left", F.col("needed") - F.col("cold") + F.count(F.lit(1)).over(of_class)).where("left > 0")
    return entries.withColumn("nth", F.row_number().over(of_class.orderBy("times", "key"))).where(F.col("nth") <= F.col("left")).select("key", "cls")


def index_lists(docs: DataFrame, rows: DataFrame, classes: DataFrame, similar: int, width: int) -> DataFrame:
    """key, cls: the index lists; most have more than one class."""
    hot = hot_hashes(rows)
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    parts = max(PARTS, (rows.agg(F.sum("whole")).first()[0] or 0) // PART)
    entries = shared_entries(dealt(docs, similar, width, shared, parts, False))
    entries = entries.join(classes.select(F.col("cls").alias("own"), "whole", "rare"), F.col("cls") == F.col("own")).drop("own")
    if not len(hot):
        return C.written(rarest(entries.withColumns({"cold": F.col("whole"), "needed": F.col("rare")})))
    warm = C.written(warm_classes(docs, similar, width, shared)).dropDuplicates(["cls"])
    entries = entries.join(warm.select(F.col("cls").alias("own"), "n_hot"), F.col("cls") == F.col("own"), "left")
    lists = rarest(entries.withColumns({"cold": F.col("whole") - F.coalesce("n_hot", F.lit(0)), "needed": F.col("rare")}))
    hot_sets = warm.where("needed is not null")
    second = shared_entries(dealt(docs, similar, width, shared, parts, True)).withColumn("key", F.col("key").bitwiseOR(1 << 62))
    second = second.join(hot_sets.select(F.col("cls").alias("own"), "cold", "needed"), F.col("cls") == F.col("own"))
    return C.written(lists.unionByName(rarest(second)).unionByName(hot_sets.select(F.explode("keys").alias("key"), "cls")))


def lows(lists: DataFrame, value: str) -> DataFrame:
    """key, low: the smallest value of each list that holds more than one."""
    ends = lists.groupBy("key").agg(F.min(value).alias("low"), F.max(value).alias("high")).where("low < high")
    # a table of its own: a join with it can then split a list of many entries
    return C.written(ends.select("key", "low"))


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The columns of pairs(cls, pivot, ...), n, p (the pivot's size), lacks, adds (hashes as bytes) from sets(cls, n, hashes)."""
    extra = [c for c in pairs.columns if c not in ("cls", "pivot")]

    def differ(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            p, lacks, adds = [], [], []
            for own, whole in zip(batch.column("hashes"), batch.column("whole")):
                x, y = np.frombuffer(own.as_buffer(), np.uint64), np.frombuffer(whole.as_buffer(), np.uint64)
                i = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = y[i] == x
                left = np.ones(len(y), bool)
                left[i[both]] = False
                p.append(len(y))
                lacks.append(y[left].tobytes())
                adds.append(x[~both].tobytes())
            names = ["cls", "pivot", *extra, "n"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(p, pa.int64()), pa.array(lacks, pa.binary()), pa.array(adds, pa.binary())], [*names, "p", "lacks", "adds"])

    both = pairs.join(sets, "cls").join(sets.select(F.col("cls").alias("pivot"), F.col("hashes").alias("whole")), "pivot")
    kinds = "".join(f", {c} {pairs.schema[c].dataType.simpleString()}" for c in extra)
    return both.select("cls", "pivot", *extra, "n", "hashes", "whole").mapInArrow(differ, f"cls long, pivot long{kinds}, n long, p long, lacks binary, adds binary")


def links_with_pivot(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """a, b of the pairs(cls, pivot) that link."""
    got = differences(pairs, sets).withColumn("c", F.col("p") - (F.octet_length("lacks") / 8).cast("long"))
    return got.where(100 * F.col("c") >= similar * (F.col("n") + F.col("p") - F.col("c"))).select(F.col("cls").alias("a"), F.col("pivot").alias("b"))


def overlaps(rows: list[np.ndarray], wide: int = 4096) -> np.ndarray:
    """Sizes of the intersections of any two of rows (sorted distinct hashes), some thousand hashes at a time."""
    m = len(rows)
    out = np.zeros((m, m), np.float32)
    owner = np.repeat(np.arange(m), [len(r) for r in rows])
    if len(owner):
        flat = np.concatenate(rows)
        _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
        shared = times > 1  # a hash of one row only is in no intersection
        number = np.cumsum(shared) - 1
        keep = shared[at]
        at, owner = number[at[keep]], owner[keep]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        total = int(shared.sum())
        for low in range(0, total, wide):
            i, j = np.searchsorted(at, [low, low + wide])
            part = np.zeros((m, min(wide, total - low)), np.float32)
            part[owner[i:j], at[i:j] - low] = 1
            out += part @ part.T
    return out.astype(np.int64)


def linked(n: np.ndarray, p: int, lacks: list[np.ndarray], adds: list[np.ndarray], similar: int) -> np.ndarray:
    """Which of the sets of one group link, from their differences from its pivot of size p."""
    gone = np.array([len(d) for d in lacks])
    common = p - gone[:, None] - gone[None, :] + overlaps(lacks) + overlaps(adds)
    return 100 * common >= similar * (n[:, None] + n[None, :] - common)


def roots(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row that it reaches."""
    out = np.full(len(link), -1)
    for i in range(len(link)):
        if out[i] < 0:
            front = np.zeros(len(link), bool)
            front[i] = True
            while front.any():
                out[front] = i
                front = link[front].any(axis=0) & (out < 0)
    return out


def comparable(lists: DataFrame, sizes: DataFrame, similar: int) -> DataFrame:
    """key, cls, part of lists(key, cls, part), each list cut where the next larger of sizes(cls, n) is too large to link: what
    links lies on one side of a cut."""
    rows = C.written(lists.join(sizes.select("cls", "n"), "cls"))
    in_order = Window.partitionBy("key").orderBy("n")
    cut = (100 * F.lag("n").over(in_order) < similar * F.col("n")).cast("int")
    cuts = rows.select("key", "n").distinct().withColumn("cut", F.coalesce(cut, F.lit(0)))  # sizes, not sets: a list may be long
    cuts = C.written(cuts.select("key", "n", F.sum("cut").over(in_order).alias("nth")))
    return rows.join(cuts, ["key", "n"]).select(F.struct("key", "nth").alias("key"), "cls", "part")


def parted(members: DataFrame) -> DataFrame:
    """grp, cls, pivot, open of members(grp, cls, part): the pivot is of the largest part of its group; open are the classes of
    other parts."""
    largest = members.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("low"))
    largest = C.written(largest.groupBy("grp").agg(F.max_by(F.struct("part", "low"), F.struct("n", F.negative("part"))).alias("top")))
    return members.join(largest.select("grp", "top.*").withColumnRenamed("part", "main").withColumnRenamed("low", "pivot"), "grp").select("grp", "cls", "pivot", (F.col("part") != F.col("main")).alias("open"))


def open_groups(lists: DataFrame, settled: DataFrame, sizes: DataFrame, similar: int) -> DataFrame:
    """grp, cls, pivot, open (see parted) of the classes in lists whose sets are not all joined: groups that these lists
    connect. A group of more open classes than a block holds is not met as a whole, which would cost their square: each of
    its lists is a group of its own, lists of the same classes once."""
    lists = lists.join(settled, lists.cls == settled.node, "left").select("key", "cls", F.coalesce("root", "cls").alias("part"))
    lists = C.written(lists)
    lists = C.written(comparable(lists.join(lows(lists, "part").select("key"), "key"), sizes, similar))
    lists = C.written(lists.join(lows(lists, "part"), "key"))
    groups = components(lists.select(F.col("part").alias("a"), F.col("low").alias("b")).where("a <> b").distinct())
    members = lists.select("cls", "part").distinct().join(groups, F.col("part") == groups.node).select(F.col("root").alias("grp"), "cls", "part")
    whole = C.written(parted(C.written(members)))
    wide = C.written(whole.groupBy("grp").agg(F.count_if("open").alias("n")).where(F.col("n") > MEMBERS).select("grp"))
    if wide.isEmpty():
        return whole
    of_wide = groups.join(wide, groups.root == wide.grp).select(F.col("node").alias("part"))
    each = C.written(lists.drop("low").join(of_wide, "part", "left_semi"))
    alike = each.groupBy("key").agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(F.xxhash64("cls", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)]).alias("same"))
    once = C.written(alike.groupBy("same").agg(F.min("key").alias("key")).select("key"))
    by_list = each.join(once, "key").select(F.xxhash64("key.key", "key.nth").alias("grp"), "cls", "part").distinct()
    return whole.join(wide, "grp", "left_anti").unionByName(parted(C.written(by_list)))


def verified_edges(parts: DataFrame, similar: int) -> DataFrame:
    """Edges a, b that join what links join, from differences(...) with `open`: the open classes of a group meet all of it,
    in a grid of blocks, the others only those."""
    held = F.octet_length("lacks") + F.octet_length("adds")
    blocks = lambda c: F.greatest(F.ceil(F.count_if(c) / MEMBERS), F.ceil(F.sum(F.when(c, held)) / (8 * HASHES)), F.lit(0)).cast("int")
    size = C.written(parts.groupBy("grp", "pivot").agg(blocks(F.col("open")).alias("nu"), blocks(~F.col("open")).alias("ns")))
    rows = parts.join(size, ["grp", "pivot"]).where("nu > 0")
    rows = rows.withColumn("own", F.when(F.col("open"), F.pmod(F.xxhash64("cls"), F.col("nu"))).otherwise(F.col("nu") + F.pmod(F.xxhash64("cls"), F.col("ns"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("open"), F.col("nu") + F.col("ns")).otherwise(F.col("nu")) - 1)))
    rows = rows.select("grp", "pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "n", "p", "lacks", "adds")

    def links(group: pa.Table) -> pa.Table:
        group = group.sort_by("cls")
        cls = group.column("cls").to_numpy()
        hashes = lambda c: [np.frombuffer(b.as_buffer(), np.uint64) for b in group.column(c)]
        root = roots(linked(group.column("n").to_numpy(), group.column("p")[0].as_py(), hashes("lacks"), hashes("adds"), similar))
        own = root != np.arange(len(root))
        return pa.table({"a": cls[own], "b": cls[root[own]]})

    return rows.groupBy("grp", "pivot", "i", "j").applyInArrow(links, "a long, b long")


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """cls, n, hashes (sorted, as bytes) of the classes of wanted(cls, least), from the text of their smallest id."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def hashes(of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of:
            for at, texts in in_slices(batch.column("text")):
                part = batch.slice(at, len(texts))
                sets = shingle_sets(texts, width)
                own = pa.array([identity(s) or 0 for s in sets], pa.int64())
                cols = [part.column("cls"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["cls", "n", "hashes"]).filter(pc.equal(own, part.column("cls")))  # an id may stand before several texts

    texts = docs.join(wanted, docs.doc_id == wanted.least).select("cls", "text")
    return C.written(texts.mapInArrow(hashes, "cls long, n long, hashes binary").dropDuplicates(["cls"]))


def joined(docs: DataFrame, similar: int = SIMILAR, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs(doc_id, text)."""
    with C.small_batches(docs.sparkSession):  # all that runs in Python is written inside
        return grouped(docs, similar, width)


def grouped(docs: DataFrame, similar: int, width: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = C.written(measured(docs, similar, width))
    rows = every.where("often is null")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.first("whole").alias("whole"), F.first("rare").alias("rare"))
    classes = C.written(classes)

    lists = index_lists(docs, every, classes, similar, width)
    pairs = lists.join(lows(lists, "cls"), "key").where("cls <> low").select("cls", F.col("low").alias("pivot")).distinct()
    pairs = C.written(pairs)
    nodes = pairs.select("cls").unionByName(pairs.select(F.col("pivot").alias("cls"))).distinct()
    sets = whole_sets(docs, C.written(nodes.join(classes, "cls").select("cls", "least")), width)
    links = C.written(links_with_pivot(pairs, sets, similar))
    found = C.written(components(links))
    unsettled = C.written(open_groups(lists, found, sets, similar))
    if not unsettled.isEmpty():
        more = C.written(verified_edges(C.written(differences(unsettled, sets)), similar))
        if not more.isEmpty():
            found = components(links.unionByName(more))

    least = found.join(classes, found.node == classes.cls).groupBy("root").agg(F.min("least").alias("component_id"))
    found = found.join(least, "root").select(F.col("node").alias("cls"), "component_id")
    # a table of its own: the join below can then split a class of many rows
    of_class = classes.join(found, "cls", "left").select("cls", F.coalesce("component_id", "least").alias("component_id"))
    of_class = C.written(of_class)
    out = rows.select("doc_id", "n", "cls").join(of_class, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.when(F.col("cls").isNull(), F.col("doc_id"))).alias("component_id"))


def one_of_each(docs: DataFrame, similar: int = SIMILAR, width: int = WIDTH) -> DataFrame:
    """docs with one row of each group, one of the smallest id (without an id where none has one); rows without words all
    stay."""
    # a row is known by a hash of id and text: ids may be missing or stand before several texts
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), F.col("text"))
    groups = joined(keyed.select(F.col("key").alias("doc_id"), "text"), similar, width).distinct()
    groups = groups.withColumnRenamed("doc_id", "key").join(keyed.select("key", "id").distinct(), "key")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"]
    keep = groups.where("n_shingles > 0").groupBy("component_id").agg(first.alias("kept"), F.lit(True).alias("has_words"))
    keep = keep.drop("component_id").unionByName(groups.where("n_shingles = 0").select(F.col("key").alias("kept"), F.lit(False).alias("has_words")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    rows = rows.join(keep, rows.key == keep.kept).withColumn("nth", F.when(F.col("has_words"), nth).otherwise(1))
    return rows.where("nth = 1").select("row.*")
