"""Numbers and running sums over a whole table in one order, without a window over all rows.

Rows are dealt into ranges of the order and written once with their range and their place in it; how much each range holds is
a row for each range, summed on the driver; what comes before a row is its range's offset and its own place. The written
table fixes the ranges, so that both reads see the same ones. Rows that tie in the whole order get different numbers, which
of them which is open: name enough columns to tell rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: monotonically_increasing_id has the partition above these bits and the row's place in it below.
PLACE_BITS = 33


def ranged(rows: DataFrame, order: Sequence[Column | str], ranges: int | None = None) -> DataFrame:
    """rows as a written table with `range_`, the number of a row's range of the order, and `place_`, its place in it."""
    dealt = rows.repartitionByRange(*order) if ranges is None else rows.repartitionByRange(ranges, *order)
    at = F.monotonically_increasing_id()
    both = dealt.sortWithinPartitions(*order).withColumn("at_", at)
    return written(both.withColumns({"range_": F.shiftright("at_", PLACE_BITS), "place_": F.col("at_").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))}).drop("at_"))


def with_offsets(table: DataFrame, held: Column, name: str) -> DataFrame:
    """table with what all earlier ranges hold of a sum; a row for each range passes through the driver."""
    sums = sorted((r.range_, r.held or 0) for r in table.groupBy("range_").agg(held.alias("held")).collect())
    before = list(accumulate((n for _, n in sums), initial=0))
    offsets = [(k, b) for (k, _), b in zip(sums, before)]
    known = table.sparkSession.createDataFrame(offsets, f"range_ long, `{name}` long")
    return table.join(F.broadcast(known), "range_")


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str = "seq", ranges: int | None = None) -> DataFrame:
    """rows with their place (from 0) in the order of the whole table."""
    table = with_offsets(ranged(rows, order, ranges), F.count(F.lit(1)), "offset_")
    return table.withColumn(name, F.col("offset_") + F.col("place_")).drop("range_", "place_", "offset_")


def numbered_within(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "seq", ranges: int | None = None) -> DataFrame:
    """rows with their place (from 0) within their group, however many rows a group has: places of the whole table less that
    of the group's first row. Null is a group of its own."""
    table = numbered(rows, [*by, *order], name, ranges)
    first = table.groupBy(*by).agg(F.min(name).alias("first_"), F.count(F.lit(1)).alias("size_"))
    keys = {c: F.col(c).alias(f"{c}_of") for c in by}
    first = first.select(*keys.values(), "first_", "size_")
    same = [table[c].eqNullSafe(first[f"{c}_of"]) for c in by]
    out = table.join(first, same).drop(*[f"{c}_of" for c in by])
    return out.withColumn(name, F.col(name) - F.col("first_")).drop("first_")


def summed_before(rows: DataFrame, order: Sequence[Column | str], value: Column, name: str, ranges: int | None = None) -> DataFrame:
    """rows with the sum of a whole-number value over all rows that come earlier in the order; null counts as 0."""
    table = ranged(rows.withColumn("value_", F.coalesce(value.cast("long"), F.lit(0))), order, ranges)
    table = with_offsets(table, F.sum("value_"), "offset_")
    inside = Window.partitionBy("range_").orderBy("place_").rowsBetween(Window.unboundedPreceding, -1)
    found = table.withColumn(name, F.col("offset_") + F.coalesce(F.sum("value_").over(inside), F.lit(0)))
    return found.drop("range_", "place_", "offset_", "value_")
