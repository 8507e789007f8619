import hashlib
import math
import random

import numpy as np
import pytest

from skein.llm import centroids, queries

DIMS = 64


def plain(rows, k=16, rounds=3, seed=1):
    """id, cluster, distance, inertias and digest of each row, by whole numbers and loops."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == DIMS and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    at = [v for _, v in sorted(kept, key=key)[:k]]
    d = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    near = lambda v: min(range(len(at)), key=lambda c: (d(v, at[c]), c))
    for _ in range(rounds):
        own = [[] for _ in at]
        for _, v in kept:
            own[near(v)].append(v)
        at = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(own, at)]
    out = [(i, near(v), d(v, at[near(v)])) for i, v in kept]
    part = {c: sum(x for _, k, x in out if k == c) for c in range(len(at))}
    return [(i, c, x, part[c], sum(part.values()), hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest()) for i, c, x in out]


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def sample(n, seed=0, spread=0.05):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(DIMS)] for _ in range(9)]
    return [(i, [x + r.gauss(0, spread) for x in r.choice(middles)]) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = sample(700)
    assert order(centroids.clustered(frame(spark, rows)).collect()) == order(plain(rows))


def test_query_equals_the_plain_version(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert order(queries.op12_centroids(spark, sf).collect()) == order(plain(rows))


def test_ties_repeated_rows_and_rows_that_take_no_part(spark):
    whole = [float(i % 3) for i in range(DIMS)]
    rows = [(i, whole) for i in range(20)] + [(5, whole)] * 3 + [(None, [0.5] * DIMS)] * 2 + sample(40, 3)
    odd = [(100, None), (101, []), (102, whole[1:]), (103, [None] + whole[1:]), (104, [math.nan] + whole[1:]), (105, [math.inf] + whole[1:]), (106, [-math.inf] + whole[1:])]
    assert order(centroids.clustered(frame(spark, rows + odd)).collect()) == order(plain(rows))


def test_few_rows_and_none(spark):
    rows = sample(5, 4)
    got = centroids.clustered(frame(spark, rows)).collect()
    assert order(got) == order(plain(rows)) and all(r.distance == 0 for r in got)
    assert centroids.clustered(frame(spark, [])).count() == 0
    assert centroids.clustered(frame(spark, [(1, None)])).count() == 0


def test_large_numbers_are_exact_and_what_does_not_fit_is_null(spark):
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.randrange(6) for _ in range(DIMS)]) for i in range(60)]
    assert order(centroids.clustered(frame(spark, rows)).collect()) == order(plain(rows))
    far = sample(40, 7) + [(99, [1e12] * DIMS), (98, [-1e15] * DIMS)]
    want = [(i, c, x if x < 1 << 63 else None, s if s < 1 << 63 else None, a if a < 1 << 63 else None, h) for i, c, x, s, a, h in plain(far, k=4)]
    got = {r.vec_id: r for r in centroids.clustered(frame(spark, far), k=4).collect()}
    for i, c, x, _, _, h in want:
        assert (got[i].cluster, got[i].distance, got[i].centroid_sha256) == (c, x, h)


def test_a_component_that_no_whole_number_holds_is_an_error(spark):
    with pytest.raises(Exception, match="2.62"):
        centroids.clustered(frame(spark, [(1, [1e18] * DIMS)])).count()


def test_other_columns(spark):
    rows = [(i, v, 7, "x") for i, v in sample(60, 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int, id string")
    got = centroids.clustered(table)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert order(got.collect()) == order(plain([r[:2] for r in rows]))


@pytest.mark.parametrize("spread", [0.01, 0.3])
def test_tree_assigns_as_all_distances_do_and_prunes(spread):
    points = np.floor(64 * np.array([v for _, v in sample(3000, 9, spread)]))
    at = points[:16].copy()
    at[7] = at[3]  # a tie goes to the smaller number
    tree = centroids.Tree(points[centroids.tree_order(points)])
    near, count, total = tree.filtered(at)
    d = ((tree.points[:, None, :] - at[None]) ** 2).sum(axis=2)
    assert (near == d.argmin(axis=1)).all() and count.sum() == 3000
    assert all((total[c] == tree.points[near == c].sum(axis=0)).all() for c in range(16))


def test_dominated_centroids_are_pruned_before_leaves(monkeypatch):
    points = np.floor(64 * np.array([v for _, v in sample(3000, 9, 0.01)]))
    seen = []
    real = centroids.distances
    monkeypatch.setattr(centroids, "distances", lambda p, c: seen.append(len(p)) or real(p, c))
    tree = centroids.Tree(points[centroids.tree_order(points)])
    middles = np.array([points[np.random.default_rng(i).integers(3000)] for i in range(16)])
    tree.filtered(middles)
    assert sum(seen) < 3000  # the rest lay in nodes that were assigned whole
