"""Shards by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; a row's fractional rank is (rank + 1/2) / rows of
its source, so the sources interleave in proportion wherever one cuts. The order by fractional rank is cut into shards
whose counts differ by one at most (law `rows`), each with the mixture of the whole.

No window spans a source or the table: ranks are sums over buckets of the hashed order plus a row number inside a
bucket, so one source may hold any part of the rows.

Cases: a null text has size 1 and the checksum of the empty text; a null source is a source of its own; rows with equal
hashes are ordered by doc_id, size and checksum, and rows equal in all of these are interchangeable; an empty table gives
an empty table; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Rows numbered by one task at a time.
ROWS_PER_BUCKET = 1024


def interleaved_shards(docs: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot of every row of docs(doc_id, text, source)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    slim = C.written(slim)
    sources = C.size_per_source(slim)
    total = sum(r.n for r in sources)
    rows = C.with_sources(slim, [(i, r.source, r.n) for i, r in enumerate(sources)], "sid int, source string, n long")
    rows = rows.withColumn("u", C.unit_hash(seed, F.col("doc_id"), F.col("text_crc32"))).withColumn("one", F.lit(1).cast("long"))
    ranked = C.hashed_prefix(rows, "one", ROWS_PER_BUCKET)
    ranked = ranked.withColumn("fraction", (F.col("before") + F.lit(0.5)) / F.col("n"))

    # the same once more for the order of the whole table: fractions are spread evenly, so buckets are too
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    ranked = ranked.withColumn("g", F.floor(F.col("fraction") * F.lit(buckets)).cast("long"))
    # sums of some thousand buckets at a time, then of those, so that no task sums more than a part of them
    wide = 4096
    sums = ranked.groupBy("g").agg(F.count(F.lit(1)).alias("inside")).withColumn("gg", F.floor(F.col("g") / wide))
    higher = Window.orderBy("gg").rowsBetween(Window.unboundedPreceding, -1)
    above = sums.groupBy("gg").agg(F.sum("inside").alias("x")).select("gg", F.coalesce(F.sum("x").over(higher), F.lit(0)).alias("far"))
    near = Window.partitionBy("gg").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("near", F.coalesce(F.sum("inside").over(near), F.lit(0))).join(above, "gg").select("g", (F.col("far") + F.col("near")).alias("below"))
    inside = F.row_number().over(Window.partitionBy("g").orderBy("fraction", "sid", "doc_id", "size", "text_crc32")) - 1
    placed = ranked.withColumn("inside", inside).join(sums, "g").withColumn("at", F.col("below") + F.col("inside"))
    shard = F.expr(f"cast((at * {shards}) div {max(1, total)} as int)")
    first = F.expr(f"({total} * cast(shard as long) + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select("doc_id", "source", "size", "text_crc32", "shard", (F.col("at") - first).cast("long").alias("slot"))
