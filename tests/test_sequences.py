import random

import pytest
from pyspark.sql import functions as F

from skein.operators import allocation, sequences
from skein.operators import relations as R


def table(spark, n, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice("aaaaaaab"), r.randrange(50), r.choice([None, 1, 2, 3])) for i in range(n)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, g string, k int, v int").repartition(7)


@pytest.mark.parametrize("ranges", [None, 1, 13])
def test_numbers_follow_the_whole_order(spark, ranges):
    rows, df = table(spark, 500)
    got = {r.id: r.seq for r in sequences.numbered(df, [F.desc("k"), "id"], ranges=ranges).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


def test_numbers_within_a_group_that_has_nearly_all_rows(spark):
    rows, df = table(spark, 400)
    df = df.unionByName(spark.createDataFrame([(1000, None, 1, 1), (1001, None, 0, 1)], df.schema))
    rows = rows + [(1000, None, 1, 1), (1001, None, 0, 1)]
    want = {}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        want |= {r[0]: (i, len(own)) for i, r in enumerate(own)}
    got = {r.id: (r.seq, r.size_) for r in sequences.numbered_within(df, ["g"], ["k", "id"], ranges=9).collect()}
    assert got == want


def test_sums_before(spark):
    rows, df = table(spark, 300)
    want, total = {}, 0
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        want[r[0]] = total
        total += r[3] or 0
    assert {r.id: r.s for r in sequences.summed_before(df, ["k", "id"], F.col("v"), "s", ranges=11).collect()} == want


def test_ties_repeated_rows_and_empty_tables(spark):
    same = spark.createDataFrame([(1, "x")] * 40, "k int, seq string").repartition(5)
    assert sorted(r.n for r in sequences.numbered(same, ["k"], "n").collect()) == list(range(40))
    none = same.where("k > 1")
    assert sequences.numbered(none, ["k"], "n").count() == sequences.numbered_within(none, ["seq"], ["k"], "n").count() == sequences.summed_before(none, ["k"], F.lit(1), "n").count() == 0


def test_no_window_spans_the_table(spark):
    _, df = table(spark, 50)
    for out in (R.round_robin(df, ["id"], {"x": ("p", "q")}), R.budgeted(df.withColumn("made", F.lit(0)), "id", "v", "made", 40), R.even_sample(df, "g", "id", 5)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan or "range_" in plan


def loop(plan, quota, taken=()):
    """What a loop over bins and their lists keeps."""
    seen, out = set(taken), []
    for b in sorted({r[0] for r in plan if r[0] is not None}):
        kept = 0
        for _, item in sorted((place, item) for bin_, item, place in plan if bin_ == b and item is not None):
            if kept >= (quota[b] if isinstance(quota, dict) else quota):
                break
            if item not in seen:
                seen.add(item)
                kept += 1
                out.append((b, item))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_allocation_equals_a_loop_where_bins_and_quotas_interact(spark, seed):
    r = random.Random(seed)
    items = r.choice([8, 30, 60])
    plan = [(r.randrange(7), r.randrange(items), r.randrange(40)) for _ in range(r.choice([60, 200]))]
    plan = list({(b, i): (b, i, p) for b, i, p in plan}.values()) + [(None, 1, 1), (1, None, 1)]
    df = spark.createDataFrame(plan, "bin int, item int, place int")
    taken = r.sample(range(items), 3)
    got = allocation.allocated(df, "bin", "item", ["place"], 4, spark.createDataFrame([(t,) for t in taken], "item int"))
    assert sorted((x.bin, x.item) for x in got.collect()) == loop(plan, 4, taken)


def test_allocation_with_own_quotas_repeated_offers_and_none(spark):
    plan = [(0, 5, 1), (0, 5, 3), (0, 6, 2), (1, 5, 1), (1, 6, 2), (1, 7, 3), (1, 7, 3), (1, 8, 4), (2, 8, 1), (2, 9, 2), (3, 9, 1)]
    quota = {0: 1, 1: 2, 2: 5, 3: 0}
    df = spark.createDataFrame([(*p, quota[p[0]]) for p in plan], "bin int, item int, place int, most int")
    got = allocation.allocated(df, "bin", "item", ["place"], "most")
    assert sorted((x.bin, x.item) for x in got.collect()) == loop(plan, quota) == [(0, 5), (1, 6), (1, 7), (2, 8), (2, 9)]
    assert allocation.allocated(df.where("bin > 9"), "bin", "item", ["place"], 3).count() == 0


def test_a_long_chain_of_lost_offers(spark):
    # every bin wants what the one before it took
    plan = [(b, i, i) for b in range(12) for i in range(b, -1, -1)] + [(b, 100 + b, 1000) for b in range(12)]
    df = spark.createDataFrame(plan, "bin int, item int, place int")
    assert sorted((x.bin, x.item) for x in allocation.allocated(df, "bin", "item", ["place"], 1).collect()) == loop(plan, 1)


def test_offers_of_a_plan(spark):
    plan = spark.createDataFrame([(0, "floor", "one", ["stone", "metal"], ["hex"]), (1, "deck", "one", ["metal"], [])], "ord int, group_id string, source string, categories array<string>, wanted array<string>")
    assets = spark.createDataFrame([("one", "metal", "m1", 0, ["hex", "old"], 2000), ("one", "metal", "m2", 1, ["plain"], 2000), ("one", "stone", "s1", 0, ["hex"], 2000), ("one", "metal", "m3", 2, ["hex"], 10)], "source string, category string, asset_id string, place int, tags array<string>, edge int")
    wanted = (F.size("wanted") == 0) | F.arrays_overlap("wanted", "tags")
    offers = allocation.plan_offers(plan, assets, F.col("edge") >= 1024, wanted)
    got = allocation.allocated(offers, "bin", "asset_id", ["nth_category", "place"], 2)
    assert sorted((r.group_id, r.asset_id) for r in got.collect()) == [("deck", "m2"), ("floor", "m1"), ("floor", "s1")]
