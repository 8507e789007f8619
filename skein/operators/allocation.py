"""Sequential allocation: bins take turns, each takes the first free items of its list up to a quota, an item goes to one bin.

What a loop over the bins gives is the one stable matching in which every item prefers the earliest bin, so rounds of offers
find it: every bin offers to the first items of its list, every item keeps the earliest bin that has offered. What an
earlier bin keeps is lost to all later ones for good, so those rows leave the lists, and bins offer anew from what is left.
When no item has changed hands, the offers that items keep are the allocation. A round is a join by item, the first rows
of each bin (limited before the shuffle) and an aggregate, over lists that shrink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written


def allocated(offers: DataFrame, bin_rank: str, item: str, order: Sequence[Column | str], quota: int | str, taken: DataFrame | None = None) -> DataFrame:
    """The rows of offers(bin_rank, item, ...) that a loop over the bins in order of rank would keep.

    order: columns by which a bin's list rises (ties: by item). quota: most items of a bin, or a column with each bin's (the
    same on all its rows). taken: items that no bin may take. Cases: of an item that a bin lists twice the first place
    counts; null bins, null items and quotas below 1 take nothing; repeated rows are one; an empty table gives an empty table.
    """
    most = F.lit(quota) if isinstance(quota, int) else F.col(quota)
    rows = offers.withColumn("quota_", most.cast("long")).where(F.col(bin_rank).isNotNull() & F.col(item).isNotNull() & (F.col("quota_") > 0))
    if taken is not None:
        rows = rows.join(taken.select(item).distinct(), item, "left_anti")
    rest = [c for c in offers.columns if c not in (bin_rank, item)]
    place = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)]).alias("at_")
    listed = rows.select(bin_rank, item, F.struct(place, "quota_", *rest).alias("r")).groupBy(bin_rank, item).agg(F.min("r").alias("r"))
    listed = written(listed.select(bin_rank, item, "r.*"))
    largest = listed.agg(F.max("quota_")).first()[0] or 0
    nth = F.row_number().over(Window.partitionBy(bin_rank).orderBy("at_", item))
    keeper = None
    while True:
        first = listed.withColumn("nth_", nth).where(F.col("nth_") <= largest).where("nth_ <= quota_").drop("nth_")
        kept = first.groupBy(item).agg(F.min(bin_rank).alias("keeper_"))
        if keeper is not None:
            kept = kept.unionByName(keeper).groupBy(item).agg(F.min("keeper_").alias("keeper_"))
        kept = written(kept)
        held = listed.join(kept, item, "left").where(F.col("keeper_").isNull() | (F.col(bin_rank) <= F.col("keeper_")))
        shorter = written(held.drop("keeper_"))
        changed = kept if keeper is None else kept.join(keeper.withColumnRenamed("keeper_", "old_"), item, "left").where("old_ is null or keeper_ < old_")
        if not changed.limit(1).count():
            return first.select(bin_rank, item, *rest)
        keeper, listed = kept, shorter


def plan_offers(plan: DataFrame, assets: DataFrame, usable: Column, wanted: Column) -> DataFrame:
    """bin, group_id, source, asset_id and place of every asset that a bin of plan(ord, group_id, source, categories, ...) may take.

    A bin's list goes through its categories in order and through each category's assets by popularity (assets: source,
    category, asset_id, place). usable: what can be used; wanted: the tags' condition over columns of both.
    """
    each = plan.select("ord", "group_id", "source", *[c for c in plan.columns if c not in ("ord", "group_id", "source", "categories")], F.posexplode("categories").alias("nth_category", "category"))
    return each.join(assets, ["source", "category"]).where(usable & wanted).select(F.col("ord").alias("bin"), "group_id", "source", "asset_id", "nth_category", "place")
