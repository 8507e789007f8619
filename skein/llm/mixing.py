"""Mixes sources to target weights by blocks.

The words of a source's documents, in a seeded hashed order, are packed into blocks of fixed length. For each output
shard, source counts are drawn from a multinomial over what the sources have still to give, so the draws of all shards
add up to the targets. The slots of a source are mapped through pseudorandom permutations of its block numbers, a new one
for each pass over the source, and slots and blocks are joined by source and block number. As no target exceeds 3 times its
source, no block and so no document is taken more than 3 times.

Cases: null and empty texts have size 0 and are never taken; a null source is a source of its own and comes last; equal
rows are taken each for itself; a source without words has target 0; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS, MOST_TIMES = (5.0, 2.0, 1.0), 3
#: Words of a block, and output shards.
BLOCK, SHARDS = 64, 16
#: Slots made by one row of the slots' plan.
RUN = 1 << 15


def targets(sizes: list[int], weights: list[float], most: float = MOST_TIMES) -> list[float]:
    """Shares of the whole by weight; a target stops at most times its size and the others share the excess by weight."""
    out, left, free = [0.0] * len(sizes), float(sum(sizes)), set(range(len(sizes)))
    while free:
        total = sum(weights[i] for i in free)
        above = {i for i in free if left * weights[i] / total > most * sizes[i]}
        if not above:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in above:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in above)
        free -= above
    return out


def draws(totals: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: multinomials over what is left, clipped to it; the last shard takes the rest."""
    rng = np.random.default_rng(seed)
    left = np.array(totals, np.int64)
    out = np.zeros((shards, len(totals)), np.int64)
    for k in range(shards - 1):
        slots = int(left.sum()) // (shards - k)
        while slots and left.sum():
            drawn = np.minimum(rng.multinomial(slots, left / left.sum()), left)
            out[k] += drawn
            left -= drawn
            slots -= int(drawn.sum())
    out[shards - 1] = left
    return out


def permuted(x: np.ndarray, size: int, key: int) -> np.ndarray:
    """x through a permutation of 0..size-1: a Feistel network on the next even number of bits, walked until inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(k) for k in np.random.default_rng(key).integers(1, 1 << 62, 4)]

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return left << np.uint64(half) | right

    with np.errstate(over="ignore"):
        v = once(x.astype(np.uint64))
        while (out := v >= np.uint64(size)).any():
            v[out] = once(v[out])
    return v.astype(np.int64)


def checksum(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


class Mix:
    """The tables of one mix; see mixed() and slots()."""

    def __init__(self, docs: DataFrame, seed: int = 11, block: int = BLOCK, shards: int = SHARDS, weights: tuple = WEIGHTS):
        self.spark, self.block, self.shards = docs.sparkSession, block, shards
        slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), C.n_words(F.col("text")).alias("size"), checksum(F.col("text")).alias("text_crc32"))
        slim = C.written(slim)
        sources = C.size_per_source(slim, F.sum("size").alias("words"))
        words = [r.words or 0 for r in sources]
        target = targets(words, [weights[i % len(weights)] for i in range(len(sources))])
        self.blocks = [-(-w // block) for w in words]
        # slots that take the target on average; a source at its limit is taken whole, so many times
        self.totals = [min(MOST_TIMES * m, round(t * m / w)) if w else 0 for t, m, w in zip(target, self.blocks, words)]
        self.counts = draws(self.totals, shards, seed)
        self.seed = seed
        self.numbers = [(i, r.source) for i, r in enumerate(sources)]
        known = [(i, r.source, r.n, w, t) for i, (r, w, t) in enumerate(zip(sources, words, target))]
        rows = C.with_sources(slim, known, "sid int, source string, n long, source_size long, target double")
        rows = rows.withColumn("u", C.unit_hash(seed, F.col("doc_id"), F.col("size"), F.col("text_crc32")))
        self.empty = rows.where("size = 0")
        self.placed = C.hashed_prefix(rows.where("size > 0"), "size").withColumnRenamed("before", "start")

    def slots(self) -> DataFrame:
        """shard, sid, block, pass: the mix, a block for each slot."""
        blocks, counts, seed = self.blocks, self.counts, self.seed
        ends = counts.cumsum(axis=0)
        runs = [(s, at) for s, n in enumerate(self.totals) for at in range(0, n, RUN)] if sum(self.totals) < RUN << 16 else None
        if runs is None:  # too many runs for a list of the driver's
            plan = self.spark.createDataFrame([(s, n) for s, n in enumerate(self.totals) if n], "sid int, total long")
            plan = plan.selectExpr("sid", f"explode(sequence(0L, total - 1, {RUN}L)) first")
        else:
            plan = self.spark.createDataFrame(runs, "sid int, first long")
        totals = self.totals

        def batches(of: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in of:
                for sid, first in zip(batch.sid, batch["first"]):
                    j = np.arange(first, min(first + RUN, totals[sid]), dtype=np.int64)
                    turn, inside = np.divmod(j, blocks[sid])
                    to = np.empty_like(j)
                    for p in np.unique(turn):
                        own = turn == p
                        to[own] = permuted(inside[own], blocks[sid], seed * 1_000_003 + int(sid) * 31 + int(p))
                    shard = np.searchsorted(ends[:, sid], j, side="right")
                    yield pd.DataFrame({"shard": shard.astype("i4"), "sid": np.int32(sid), "block": to, "pass": turn.astype("i4")})

        return plan.repartition(min(4096, max(1, len(runs or [0] * 4096))), "sid", "first").mapInPandas(batches, "shard int, sid int, block long, pass int")

    def pieces(self) -> DataFrame:
        """placed rows, once for each block that holds words of theirs: block, from, words (of the row, from its start)."""
        b = self.block
        rows = self.placed.withColumn("block", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")))
        return rows.withColumn("from", F.expr(f"greatest(block * {b} - start, 0L)")).withColumn("words", F.expr(f"least((block + 1) * {b} - start, size) - greatest(block * {b} - start, 0L)"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row of docs(doc_id, text, source)."""
    mix = Mix(docs, **how)
    times = mix.slots().groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    # the plan of the slots looks small, the slots are not: they are never broadcast
    taken = mix.pieces().join(times.hint("merge"), ["sid", "block"], "left").groupBy("sid", "start", "doc_id", "size", "text_crc32", "source", "source_size", "target")
    taken = taken.agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken"))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return taken.select(*columns).unionByName(mix.empty.withColumn("taken", F.lit(0).cast("long")).select(*columns))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix: a row for each pass that takes words of a document, its text those words in their order.

    A pass that takes all of a document gives its text as it stands. The columns are those of docs; n_chars, where there is
    one, is the new text's. Rows are known by id, size and checksum; such as are equal in these are interchangeable.
    """
    mix = Mix(docs, **how)
    got = mix.pieces().join(mix.slots().select("sid", "block", "pass").hint("merge"), ["sid", "block"])
    got = got.groupBy("sid", "start", "doc_id", "size", "text_crc32", "pass").agg(F.array_sort(F.collect_list(F.struct("from", "words"))).alias("spans"), F.sum("words").alias("some"))
    # rows that are equal in these are told apart by their order
    got = got.select("doc_id", "size", "text_crc32", "sid", "start", F.when(F.col("some") < F.col("size"), F.col("spans")).alias("spans"))
    same = Window.partitionBy("doc_id", "size", "text_crc32", "sid").orderBy("start")
    got = got.withColumn("copy", F.dense_rank().over(same)).drop("start")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), C.n_words(F.col("text")).alias("size"), checksum(F.col("text")).alias("text_crc32"), F.col("source").cast("string").alias("source")).where("size > 0")
    rows = C.with_sources(rows, mix.numbers, "sid int, source string")
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "size", "text_crc32", "sid").orderBy(F.xxhash64("row.text"))))
    equal = [rows[c] == got[c] for c in ("size", "text_crc32", "sid", "copy")]
    out = rows.join(got, [rows.doc_id.eqNullSafe(got.doc_id), *equal]).select("row", "spans")
    words = F.regexp_extract_all("row.text", F.lit(f"{C.WORD}(?:{C.SPACE})?"), F.lit(0))
    out = out.withColumn("w", F.when(F.col("spans").isNotNull(), words))
    part = F.array_join(F.flatten(F.transform("spans", lambda s: F.slice("w", (s["from"] + 1).cast("int"), s["words"].cast("int")))), "")
    # `w` is named twice: named once, the optimizer would move its expression into the lambda, to run for each span
    out = out.withColumn("new", F.when(F.col("spans").isNull() | F.col("w").isNull(), F.col("row.text")).otherwise(part))
    given = {"text": F.col("new"), "n_chars": F.length("new").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("new")}
    return out.select(*[given.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
