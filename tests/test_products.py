import numpy as np
import pytest

from skein.operators import graph, products


def vectors(spark, n=60, seed=0):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, 5)) + 2 * np.eye(5)[r.integers(0, 5, n)]
    v[3] = 0
    group, tag = r.integers(0, 3, n), r.integers(0, 7, n)
    rows = [(i, int(group[i]), int(tag[i]), v[i].tolist()) for i in range(n)] + [(n, 0, 0, None)]
    norms = np.linalg.norm(v, axis=1)
    unit = v / np.where(norms == 0, 1, norms)[:, None]
    return spark.createDataFrame(rows, "k int, g int, cluster int, v array<double>"), group, tag, unit @ unit.T


@pytest.mark.parametrize("rows", [7, 1024])
def test_pairs_above_a_threshold(spark, rows):
    df, group, _, s = vectors(spark)
    got = {(r.grp, r.a, r.b): r.similarity for r in products.above(products.blocks(df, "k", "v", "g", rows=rows), 0.5).collect()}
    want = {(int(group[i]), i, j): s[i, j] for i in range(60) for j in range(i + 1, 60) if group[i] == group[j] and s[i, j] >= 0.5}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("rows", [7, 1024])
def test_few_links_connect_as_all_pairs_do(spark, rows):
    df, group, _, s = vectors(spark)
    packed = products.blocks(df, "k", "v", "g", rows=rows)
    nodes = df.selectExpr("k node")
    parts = lambda edges: {r.node: r.component for r in graph.components(nodes, edges.selectExpr("a", "b")).collect()}
    few = products.links(packed, 0.3)
    assert parts(few) == parts(products.above(packed, 0.3))
    if rows > 60:
        assert few.count() < 60


def test_forests():
    r = np.random.default_rng(2)
    for _ in range(200):
        n, m, whole = *r.integers(1, 9, 2), bool(r.integers(0, 2))
        near = np.triu(r.random((n, n)) < 0.3, 1) if whole else r.random((n, m)) < 0.3
        i, j = products.forest(near, whole)
        assert near[i, j].all() or (whole and (near | near.T)[i, j].all())

        def joined(pairs):
            label = list(range(n if whole else n + m))
            for a, b in pairs:
                a, b = label[a], label[b if whole else b + n]
                label = [min(a, b) if x in (a, b) else x for x in label]
            return label

        assert joined(zip(i.tolist(), j.tolist())) == joined(zip(*np.nonzero(near))), (near, whole, i, j)
        assert len(i) < (n if whole else n + m)


@pytest.mark.parametrize("rows", [7, 1024])
@pytest.mark.parametrize("least", [-0.2, 0.0, 0.15, 0.9])
def test_upper_medians_by_counting(spark, rows, least):
    df, _, tag, s = vectors(spark)
    packed = products.blocks(df, "k", "v", tag="cluster", rows=rows)
    want = {}
    for a in range(7):
        for b in range(a + 1, 7):
            x = np.sort(s[np.ix_(tag == a, tag == b)].ravel())
            if len(x) and x[len(x) // 2] >= least:
                want[a, b] = (len(x), x[len(x) // 2])
    pairs = products.with_upper_median(packed, least)
    assert {(r.c1, r.c2): r.n for r in pairs.collect()} == {k: n for k, (n, _) in want.items()}
    if least == 0.0:
        got = {(r.c1, r.c2): r.median for r in products.upper_medians(packed, pairs).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k][1]) < 1e-12 for k in got)


def test_small_clusters_are_decided_within_their_tile(spark):
    """A cluster of one for each row: what leaves a tile is what merges and what its edge clusters have, not all pairs."""
    r = np.random.default_rng(8)
    v = np.repeat(r.normal(size=(300, 6)), 2, axis=0) + 0.01 * r.normal(size=(600, 6))
    df = spark.createDataFrame([(i, i, x.tolist()) for i, x in enumerate(v)], "k int, cluster int, v array<double>")
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    s = unit @ unit.T
    for rows in (100, 1024):
        got = {(x.c1, x.c2) for x in products.with_upper_median(products.blocks(df, "k", "v", tag="cluster", rows=rows), 0.99).collect()}
        assert got == {(i, j) for i in range(600) for j in range(i + 1, 600) if s[i, j] >= 0.99}


def test_equal_vectors_and_one_cosine_for_all(spark):
    df = spark.createDataFrame([(i, i % 3, [1.0, 1.0]) for i in range(30)], "k int, cluster int, v array<double>")
    packed = products.blocks(df, "k", "v", tag="cluster", rows=8)
    found = products.upper_medians(packed, products.with_upper_median(packed, 0.99)).collect()
    assert sorted((r.c1, r.c2) for r in found) == [(0, 1), (0, 2), (1, 2)] and all(abs(r.median - 1) < 1e-12 for r in found)


def test_no_rows(spark):
    df, *_ = vectors(spark)
    packed = products.blocks(df.where("k > 1000"), "k", "v", "g")
    assert products.above(packed, 0.1).count() == products.links(packed, 0.1).count() == products.with_upper_median(packed, 0.1).count() == 0


def test_a_row_is_sent_once_for_each_strip(spark):
    """Each block went to as many tiles as there are blocks, so what was moved grew with the square of the rows."""
    df, *_ = vectors(spark)
    packed = products.blocks(df, "k", "v", tag="cluster", rows=2)
    sent = products.strips(packed).groupBy("blk").count().collect()
    assert len(sent) == 30 and {r["count"] for r in sent} == {products.STRIPS}


def test_a_small_group_is_one_strip(spark):
    """12 blocks were six strips and five blocks were five, so up to 1 GB what was moved grew faster than the rows."""
    df, *_ = vectors(spark)
    for rows in (5, 12, 60):
        assert {r["count"] for r in products.strips(products.blocks(df, "k", "v", tag="cluster", rows=rows)).groupBy("blk").count().collect()} == {1}


def test_links_of_near_rows_follow_the_rows(spark):
    """Each two blocks sent edges of their own: some 1,300 for 60 near rows in blocks of two. Rows of no group have none."""
    df = spark.createDataFrame([(i, None if i > 59 else 0, [1.0, i / 1000]) for i in range(64)], "k int, g int, v array<double>")
    edges = products.links(products.blocks(df, "k", "v", "g", rows=2), 0.9)
    assert edges.count() < products.STRIPS * 60
    parts = graph.split_clusters(df, "k", "g", "v", 0.9).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in parts) == [1, 1, 1, 1, 60]


def test_medians_of_clusters_beyond_a_strip(spark):
    df, _, tag, s = vectors(spark, n=150, seed=3)
    packed = products.blocks(df, "k", "v", tag="cluster", rows=3)
    want = {}
    for a in range(7):
        for b in range(a + 1, 7):
            x = np.sort(s[np.ix_(tag == a, tag == b)].ravel())
            if x[len(x) // 2] >= 0.05:
                want[a, b] = x[len(x) // 2]
    got = {(r.c1, r.c2): r.median for r in products.upper_medians(packed, products.with_upper_median(packed, 0.05)).collect()}
    assert got and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_joined_labels():
    label, new = products.joined(np.arange(6), np.array([0, 1, 2, 5, 4]), np.array([1, 2, 0, 4, 5]))
    assert label.tolist() == [0, 0, 0, 3, 4, 4] and new.tolist() == [0, 1, 3]


def test_units_are_whole_segments():
    assert products.units(np.array([0, 1, 2, 3, 9, 10, 12]), 3) == [(0, 3), (3, 4), (4, 6)]


def clustered(spark, sizes, seed, wide=5):
    """Rows in clusters of such sizes, a row of length 0, one that holds NaN and one without a vector, and all cosines."""
    r = np.random.default_rng(seed)
    tag = np.repeat(np.arange(len(sizes)), sizes)
    v = r.normal(size=(len(tag), wide)) + r.choice([0, 1, 4], len(sizes))[tag][:, None] * r.normal(size=(len(sizes), wide))[r.integers(0, len(sizes), len(sizes))][tag]
    v[3], v[-1] = 0, np.nan
    norms = np.linalg.norm(v, axis=1)
    unit = v / np.where(norms == 0, 1, norms)[:, None]
    rows = [(i, int(tag[i]), x.tolist()) for i, x in enumerate(v)] + [(len(v), 0, None)]
    return spark.createDataFrame(rows, "k int, cluster int, v array<double>"), tag, unit @ unit.T


def medians(tag, s, least):
    want = {}
    for a in range(tag.max() + 1):
        for b in range(a + 1, tag.max() + 1):
            x = s[np.ix_(tag == a, tag == b)].ravel()
            x = np.sort(x[~np.isnan(x)])
            if len(x) and x[len(x) // 2] >= least:
                want[a, b] = (len(x), x[len(x) // 2])
    return want


SIZES = [40, 1, 3, 90, 25, 1, 60, 2, 33, 19, 21, 1, 70, 28]


@pytest.mark.parametrize("rows", [7, 1024])
@pytest.mark.parametrize("least", [-0.3, 0.1, 0.5])
def test_large_and_small_clusters(spark, rows, least, monkeypatch):
    df, tag, s = clustered(spark, SIZES, 5)
    monkeypatch.setattr(products.blocks, "__defaults__", (*products.blocks.__defaults__[:-1], rows))
    want = medians(tag, s, least)
    assert {(r.c1, r.c2): r.n for r in graph.merging(df, "k", "v", least).collect()} == {k: n for k, (n, _) in want.items()}
    nodes = spark.createDataFrame([(i,) for i in range(len(SIZES))], "node int")
    parts = lambda pairs: sorted(graph.components(nodes, pairs.selectExpr("c1 a", "c2 b")).collect())
    assert parts(graph.merging(df, "k", "v", least, connect=True)) == parts(spark.createDataFrame(list(want), "c1 int, c2 int"))
    if least == 0.1:
        got = {(r.c1, r.c2): r.median for r in graph.merge_medians(df, "k", "v", least).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k][1]) < 1e-12 for k in got)


def test_moments_leave_close_pairs_to_rows(spark):
    df, tag, s = clustered(spark, SIZES, 6)
    packed = products.blocks(df.where("cluster in (0, 3, 4, 6, 8, 10, 12, 13)"), "k", "v", tag="cluster", rows=16)
    want, kinds = medians(tag, s, -2), set()
    for least in (-0.2, 0.0, 0.2, 0.6):
        told = {(r.c1, r.c2): r for r in products.by_moments(products.moments(packed), least).collect()}
        for pair in want:
            if not {*pair} - {0, 3, 4, 6, 8, 10, 12, 13}:
                n, median = want[pair]
                kinds.add(told[pair].sure if pair in told else None)
                assert told[pair].n == n and (median >= least or not told[pair].sure) if pair in told else median < least
    assert kinds == {None, True, False}


def test_rows_of_large_clusters_far_apart_stay(spark, monkeypatch):
    """All rows went to each strip, eight times, to count cosines of clusters that their moments tell apart."""
    r = np.random.default_rng(1)
    rows = [(i, i % 6, (r.normal(size=6) * 0.1 + np.eye(6)[i % 6]).tolist()) for i in range(600)]
    strips, moved = products.strips, []
    monkeypatch.setattr(products, "strips", lambda packed: moved.append(strips(packed)) or moved[-1])
    monkeypatch.setattr(products.blocks, "__defaults__", (*products.blocks.__defaults__[:-1], 50))
    assert graph.merging(spark.createDataFrame(rows, "k int, cluster int, v array<double>"), "k", "v", 0.5).count() == 0
    assert moved and sum(len(x.keys) for m in moved for x in m.select("keys").collect()) < 60


def test_merges_of_many_clusters_follow_the_clusters(spark, monkeypatch):
    """Clusters that all merge were joined by all of their pairs: 44,850 for 300 of them."""
    components, edges = graph.components, []
    monkeypatch.setattr(graph, "components", lambda nodes, pairs, node="node": edges.append(pairs) or components(nodes, pairs, node))
    df = spark.createDataFrame([(i, str(i), [1.0, i / 1000, 0.0, 0.0]) for i in range(300)], "k int, name string, v array<double>")
    assert {r.final for r in graph.refined(df, "k", "name", "v", 0.9, 0.9).collect()} == {0}
    assert edges[-1].count() < 10 * 300
