"""Joins, reports and order-dependent picks over tables; every tie is broken by a column that is named."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.vectors import cosine

from .sequences import numbered, numbered_within, summed_before


def coverage(rows: DataFrame, by: str, flags: dict[str, Column]) -> DataFrame:
    """Rows of each group, how many have each flag, and percentages."""
    out = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in flags.items()])
    return out.withColumns({f"pct_{k}": F.when(F.col("n") == 0, 0.0).otherwise(F.round(F.lit(100.0) * F.col(k) / F.col("n"), 4)) for k in flags})


def grand_total(report: DataFrame, counts: Sequence[str]) -> DataFrame:
    out = report.agg(*[F.sum(c).alias(c) for c in ("n", *counts)], F.count(F.lit(1)).alias("groups"))
    return out.withColumns({f"pct_{c}": F.when(F.col("n") == 0, 0.0).otherwise(F.round(F.lit(100.0) * F.col(c) / F.col("n"), 4)) for c in counts})


def longest_prefix(rows: DataFrame, name: str, prefixes: DataFrame, prefix: str, joint: str = "_") -> DataFrame:
    """rows with the longest prefix that, followed by the joint, begins their name; rows without one are dropped.

    Each name is cut at every joint, so this is an equality join; the longest match is one aggregate over the cuts.
    """
    cuts = F.transform(F.sequence(F.lit(1), F.size(F.split(name, joint)) - 1), lambda i: F.array_join(F.slice(F.split(name, joint), F.lit(1), i), joint))
    tries = rows.where(F.col(name).contains(joint)).select(name, F.explode(cuts).alias(prefix)).distinct()
    best = tries.join(prefixes.select(prefix).distinct(), prefix).groupBy(name).agg(F.max_by(prefix, F.length(prefix)).alias(prefix))
    return rows.join(best, name)


def missing(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return wanted.join(done.select(key), key, "left_anti")


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key, the smaller rest of the row first where the order ties: an aggregate that combines before the shuffle."""
    others = [c for c in rows.columns if c not in key]
    first = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)], F.struct(*others).alias("row"))
    return rows.groupBy(*key).agg(F.min(first).alias("m")).select(*key, *[F.col(f"m.row.{c}").alias(c) for c in others]).select(*rows.columns)


def quota(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], most: int) -> DataFrame:
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("nth") <= most)


def byte_survivors(rows: DataFrame, digest: str, rank: Column, path: str) -> DataFrame:
    """One row of each digest: of the lowest rank, then the smallest path; with the number of copies."""
    return rows.groupBy(digest).agg(F.min_by(path, F.struct(rank, F.col(path))).alias(path), F.count(F.lit(1)).alias("copies"))


def mode_first_seen(rows: DataFrame, by: str, value: str, order: str) -> DataFrame:
    """The commonest value of each group; of equally common ones the one seen first."""
    each = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("first"))
    return each.groupBy(by).agg(F.min_by(value, F.struct((-F.col("c")).alias("k"), "first")).alias(value), F.sum("c").alias("members"))


def most_common(rows: DataFrame, value: str, order: str, most: int | None = None) -> DataFrame:
    """value, n, place: counts in falling order, equally common ones as first seen; the first so many."""
    each = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    order = [F.desc("n"), "first"]
    if most is None:
        return numbered(each, order, "place").select(value, "n", (F.col("place") + 1).cast("int").alias("place")).orderBy("place")
    return each.orderBy(*order).limit(most).withColumn("place", F.row_number().over(Window.orderBy(*order))).select(value, "n", "place")  # of `most` rows


def unit_centroids(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """by, v: the mean of each group's vectors, each scaled to length one before and the mean after."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    each = rows.select(by, F.posexplode(F.transform(vector, lambda x: x.cast("double") / length)).alias("i", "x"))
    mean = each.groupBy(by, "i").agg(F.avg("x").alias("x")).groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("v"))
    return mean.select(by, F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, y: a + y * y))).alias("v"))


def histogram(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Counts of each value, missing ones as `null`."""
    return rows.groupBy(F.coalesce(value.cast("string"), F.lit("null")).alias(name)).agg(F.count(F.lit(1)).alias("n"))


def pairs_within(rows: DataFrame, group: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Unordered pairs of a group's rows, columns with suffixes 1 and 2. For groups of a known small size."""
    side = lambda i: rows.select(F.col(group), *[F.col(c).alias(f"{c}{i}") for c in (key, *columns)])
    return side(1).join(side(2), group).where(F.col(f"{key}1") < F.col(f"{key}2"))


def overlap_audit(rows: DataFrame, group: str, key: str, tokens: str) -> DataFrame:
    """Pairs of each group with two members or more: least, largest and mean Jaccard, and the tokens all members share."""
    pairs = pairs_within(rows, group, key, [tokens])
    both, all_ = F.size(F.array_intersect(f"{tokens}1", f"{tokens}2")), F.size(F.array_union(f"{tokens}1", f"{tokens}2"))
    j = F.when(all_ == 0, 0.0).otherwise(both / all_)
    pairs = pairs.select(group, j.alias("j")).groupBy(group).agg(F.min("j").alias("least"), F.max("j").alias("largest"), F.avg("j").alias("mean"), F.count(F.lit(1)).alias("pairs"))
    members = rows.groupBy(group).agg(F.count(F.lit(1)).alias("members"))
    each = rows.select(group, F.explode(F.array_distinct(tokens)).alias("t")).groupBy(group, "t").agg(F.count(F.lit(1)).alias("c"))
    shared = each.join(members, group).where("c = members").groupBy(group).agg(F.count(F.lit(1)).alias("shared"))
    return members.where("members >= 2").join(pairs, group).join(shared, group, "left").na.fill(0, ["shared"])


def flagged(below: float) -> Column:
    """Whether a group of overlap_audit is suspicious: little overlap and hardly a word that all share."""
    return (F.col("least") < below) & (F.col("shared") < 2)


def suspicious(audit: DataFrame, below: float, group: str | None = None) -> DataFrame:
    """The suspicious groups, the least overlap (to three digits) first, then by group."""
    return audit.where(flagged(below)).orderBy(F.round("least", 3), F.col(group or audit.columns[0]))


#: Entries from which a palette is no longer written into the plan.
LONG_PALETTE = 256


def nearest_of_many(rows: DataFrame, channels: Sequence[str], entries: list[dict], number: str, others: Sequence[str]) -> DataFrame:
    table = rows.sparkSession.sparkContext.broadcast((np.array([[e[o] for o in others] for e in entries]), np.array([e[number] for e in entries])))

    @F.pandas_udf("struct<d: long, k: long>")
    def found(*columns: pd.Series) -> pd.DataFrame:
        colours, numbers = table.value
        x = np.stack([c.to_numpy() for c in columns], axis=1)
        best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        for i, colour in enumerate(colours):  # in order of number, so ties stay with the lower
            d = np.abs(x - colour).max(axis=1)
            nearer = d < best
            best[nearer], at[nearer] = d[nearer], numbers[i]
        return pd.DataFrame({"d": best, "k": at})

    return rows.withColumn("nearest", found(*[F.col(c).cast("long") for c in channels]))


def nearest(rows: DataFrame, channels: Sequence[str], palette: DataFrame, number: str, others: Sequence[str]) -> DataFrame:
    """rows with the number of the palette entry nearest by the largest difference of a channel; ties to the lower.

    The palette is a dimension table that the driver holds: an array beside each row, or a broadcast one for Arrow batches
    where it is long; never a join.
    """
    entries = sorted((r.asDict() for r in palette.collect()), key=lambda r: r[number])
    if len(entries) > LONG_PALETTE:
        return nearest_of_many(rows, channels, entries, number, others)
    each = F.array(*[F.struct(F.greatest(*[F.abs(F.col(c) - F.lit(e[o])) for c, o in zip(channels, others)]).alias("d"), F.lit(e[number]).alias("k")) for e in entries])
    return rows.withColumn("nearest", F.array_min(each))


def ranked_candidates(rows: DataFrame, key: str, priority: str, path: str) -> DataFrame:
    """The candidate of the lowest priority number, then the smallest path."""
    return rows.groupBy(key).agg(F.min(F.struct(priority, path)).alias("c")).select(key, f"c.{priority}", f"c.{path}")


def row_bands(boxes: DataFrame, by: str, top: str, bottom: str, left: str) -> DataFrame:
    """band and place of each box, in reading order: sorted by centre height, a gap over half the median height (1 at
    least) begins a band; within a band by left edge."""
    centre = (F.col(top) + F.col(bottom)) / 2
    tolerance = boxes.groupBy(by).agg(F.greatest(F.median(F.col(bottom) - F.col(top)) * 0.5, F.lit(1.0)).alias("tolerance"))
    order = Window.partitionBy(by).orderBy("centre", left)
    rows = boxes.withColumn("centre", centre).join(tolerance, by).withColumn("gap", F.col("centre") - F.lag("centre").over(order))
    rows = rows.withColumn("band", F.sum((F.coalesce("gap", F.lit(0.0)) > F.col("tolerance")).cast("int")).over(order))
    number = F.row_number().over(Window.partitionBy(by).orderBy("band", left, "centre")) - 1
    return rows.withColumn("place", number).drop("centre", "gap", "tolerance")


def round_robin(rows: DataFrame, order: Sequence[Column | str], axes: dict[str, Sequence[str]], within: Sequence[str] = ()) -> DataFrame:
    """seq (from 0, in order, after all filters) and each axis at seq modulo its length: axes advance in step."""
    out = numbered_within(rows, within, order).drop("size_") if within else numbered(rows, order)
    pick = lambda v: F.element_at(F.array(*[F.lit(x) for x in v]), (F.col("seq") % len(v) + 1).cast("int"))
    return out.withColumns({k: pick(v) for k, v in axes.items()})


def reconcile(assets: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Assets and records by key; status both, no_record or no_asset."""
    a, r = assets.select(key, F.lit(1).alias("a")).distinct(), records.select(key, F.lit(1).alias("r")).distinct()
    return a.join(r, key, "full_outer").select(key, F.when(F.col("a").isNull(), "no_asset").when(F.col("r").isNull(), "no_record").otherwise("both").alias("status"))


def even_sample(rows: DataFrame, by: str, order: str, least: int) -> DataFrame:
    """At least `least` rows of each stratum (all of a smaller one), evenly spaced in order."""
    placed = numbered_within(rows, [by], [order], "nth")
    return placed.withColumn("step", F.greatest(F.floor(F.col("size_") / least), F.lit(1))).where("nth % step = 0").drop("step", "nth", "size_")


def budgeted(plan: DataFrame, order: str, wanted: str, made: str, limit: int) -> DataFrame:
    """What each row of a plan may still make, in order, of a limit that what is made has used in part."""
    open_ = F.greatest(F.col(wanted) - F.col(made), F.lit(0))
    rows = summed_before(plan, [order], open_, "used_")
    return rows.withColumn("to_make", F.least(open_, F.greatest(F.lit(limit) - F.col("used_"), F.lit(0)))).drop("used_")


def cost_plan(jobs: DataFrame, done: DataFrame, key: str, price: float, is_paid: Column) -> DataFrame:
    """One row: total, skipped, to_do, paid, staged and cost."""
    rows = jobs.withColumn("paid", is_paid).join(done.select(key, F.lit(1).alias("there")).distinct(), key, "left")
    todo = F.col("there").isNull()
    out = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(~todo).alias("skipped"), F.count_if(todo).alias("to_do"), F.count_if(todo & F.col("paid")).alias("paid"), F.count_if(todo & ~F.col("paid")).alias("staged"))
    return out.withColumn("cost", F.round(F.col("paid") * F.lit(price), 2))


def appended_variants(old: Column, new: Column, key: str) -> Column:
    """old and those of new whose key old lacks."""
    return F.concat(old, F.filter(new, lambda v: ~F.exists(old, lambda o: o[key] == v[key])))


def replaced(rows: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """rows with those of new in place of rows of the same key, and those of other keys added."""
    return rows.join(new.select(key), key, "left_anti").unionByName(new)


def most_wanted(rows: DataFrame, by: str, tie: str, most: int) -> DataFrame:
    """The rows of the largest values; of equal ones the first by tie."""
    return rows.orderBy(F.desc(by), tie).limit(most)


def known(rows: DataFrame, digest: str, held: DataFrame, path: str) -> DataFrame:
    """rows with status (new or known) and, where the digest is in held(digest, path), its smallest path."""
    first = held.groupBy(digest).agg(F.min(path).alias(path))
    return rows.join(first, digest, "left").withColumn("status", F.when(F.col(path).isNull(), "new").otherwise("known"))


def looked_up(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str, default: str) -> DataFrame:
    """rows with the value of their key in a table, or the default."""
    found = table.select(F.col(table_key).alias("key_"), F.col(value).alias("value_"))
    return rows.join(found, rows[key] == F.col("key_"), "left").withColumn(value, F.coalesce("value_", F.lit(default))).drop("key_", "value_")


def present(rows: DataFrame, held: DataFrame, key: str, there: str, absent: str) -> DataFrame:
    """rows with status: whether their key is in held, which may have it many times."""
    once = held.select(key).distinct().withColumn("held_", F.lit(True))
    return rows.join(once, key, "left").withColumn("status", F.when(F.col("held_"), there).otherwise(absent)).drop("held_")


def cleared_groups(rows: DataFrame, group: str, most: int) -> DataFrame:
    """rows without the group of those whose group has more than `most` members."""
    large = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") > most).select(F.col(group).alias("group_"))
    return rows.join(large, F.col(group) == F.col("group_"), "left").withColumn(group, F.when(F.col("group_").isNull(), F.col(group))).drop("group_")


def missing_states(rows: DataFrame, group: str, state: str, wanted: Sequence[str]) -> DataFrame:
    """group and missing: the wanted states that no row of a group has."""
    every = rows.select(group).distinct().select(group, F.explode(F.array(*[F.lit(w) for w in wanted])).alias("missing"))
    return every.join(rows.select(group, F.col(state).alias("missing")), [group, "missing"], "left_anti")


def cycles(rows: DataFrame, by: Sequence[str], value: str, least: int = 2) -> DataFrame:
    """by, cycle and n: the distinct values of each group, in order, where there are so many."""
    each = rows.groupBy(*by).agg(F.sort_array(F.collect_set(value)).alias("cycle"))
    return each.withColumn("n", F.size("cycle").cast("long")).where(F.col("n") >= least)


def aligned(rows: DataFrame, stack: str, measures: Sequence[str]) -> DataFrame:
    """stack, aligned (whether all its members measure the same) and members."""
    return rows.groupBy(stack).agg((F.count_distinct(F.struct(*measures)) == 1).alias("aligned"), F.count(F.lit(1)).alias("members"))


def rollup_counts(rows: DataFrame, outer: str, inner: str, counts: dict[str, Column], all_: str = "all") -> DataFrame:
    """Counts by outer and inner, and by outer alone, where inner says so; rows without an outer value don't count."""
    out = rows.where(F.col(outer).isNotNull()).rollup(outer, inner).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in counts.items()])
    return out.where(F.col(outer).isNotNull()).withColumn(inner, F.coalesce(inner, F.lit(all_)))


def mean_vectors(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """by and centre: the mean of each group's vectors, component by component."""
    each = rows.select(by, F.posexplode(vector).alias("i", "x")).groupBy(by, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return each.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c")).select(by, F.col("c.x").alias("centre"))


def by_margin(rows: DataFrame, vector: str, centres: DataFrame, label: str) -> DataFrame:
    """rows with the label whose centre is nearest by cosine (ties: the smaller label) and its margin over the second, of
    centres(label, centre): one array beside each row, for some hundred labels, not a join of every row with every centre."""
    all_ = centres.agg(F.array_sort(F.collect_list(F.struct(label, "centre"))).alias("centres")).scalar()
    scored = rows.withColumn("centres_", all_).withColumn("s_", F.transform("centres_", lambda c: F.struct((-cosine(F.col(vector), c["centre"])).alias("s"), c[label].alias("label"))))
    best = scored.withColumn("s_", F.slice(F.array_sort("s_"), 1, 2)).drop("centres_")
    at = lambda i: F.get("s_", F.lit(i))
    return best.withColumns({"best": at(0)["label"], "margin": at(1)["s"] - at(0)["s"]}).drop("s_")
