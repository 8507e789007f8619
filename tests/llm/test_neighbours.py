import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import neighbours, queries


def exact(ids, x, query_ids, k=20):
    out = {}
    for i in np.flatnonzero(np.isin(ids, query_ids)):
        s = np.zeros(len(ids))
        for j in range(x.shape[1]):
            s += x[i, j] * x[:, j]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(rows, want):
    got = {}
    for r in sorted(rows, key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and len(found) == len(want[q]) and q not in [f[0] for f in found]
    true = sum(len({v for v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
    return true / max(1, sum(map(len, want.values()))), got


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(7, 48))
    y = neighbours.rotated(x, 3, 5)
    assert y.shape == (7, 64) and np.allclose((y**2).sum(1), (x**2).sum(1))
    assert neighbours.nearest_axes(y, 1)[:, 0].tolist() == neighbours.nearest_axis(y).tolist()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want = exact(ids, x, ids[ids % 20 == 0])
    share, got = recall(queries.op2_cross_polytope(spark, sf).collect(), want)
    assert share >= 0.9, share
    for q, found in got.items():
        i = int(np.flatnonzero(ids == q)[0])
        for v, s in found:
            assert abs(s - x[i] @ x[int(np.flatnonzero(ids == v)[0])]) < 1e-12


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, dim string")


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 0.0]), (4, [nan, 1.0, 0.0]), (5, [inf, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (20, [1.0, 0.0, 0.0]), (21, [0.5, 0.5, 0.0]), (22, [0.5, 0.5, 0.0]), (23, [9.0, 9.0, 9.0]), (40, [1.0, 2.0]), (41, [2.0, 1.0]), (60, [])]
    got = neighbours.nearest(frame(spark, [(i, v, 7, "x") for i, v in odd]), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(20, 1, 23, 9.0), (20, 2, 21, 0.5), (20, 3, 22, 0.5), (40, 1, 41, 4.0)]
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(frame(spark, [(20, [1.0], 1, "x")]), F.col("vec_id") % 20 == 0).count() == 0


def test_copies_and_unequal_lengths(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERIES", 7)
    monkeypatch.setattr(neighbours, "TOGETHER", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16)).astype("f4") * rng.uniform(0.2, 3, (900, 1)).astype("f4")
    x[300:600] = x[0]
    ids = np.arange(900)
    want = exact(ids, x.astype("f8"), ids[ids % 20 == 0])
    share, got = recall(neighbours.nearest(frame(spark, [(int(i), v.tolist(), 1, "x") for i, v in zip(ids, x)]), F.col("vec_id") % 20 == 0).collect(), want)
    assert share >= 0.9, share


def test_finite_vectors_of_any_length(spark):
    rows = [(20, [1.0, 0.0]), (21, [1e200, 0.0]), (22, [1e-200, 0.0]), (23, [9.0, 9.0]), (40, [1e300, 1e300]), (41, [-1e-320, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in neighbours.nearest(docs, F.col("vec_id") % 20 == 0).collect()}
    assert [got[20, i] for i in range(1, 6)] == [(40, 1e300), (21, 1e200), (23, 9.0), (22, 1e-200), (41, -1e-320)]
    assert {got[40, i][0] for i in range(1, 6)} == {20, 21, 22, 23, 41} and got[40, 1] == (21, float("inf"))


def test_wider_tables_and_several_groups(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BUCKET", (2, 2, 2))
    monkeypatch.setattr(neighbours, "ROWS", 100)
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(60, 16)).repeat(25, axis=0) + 0.3 * rng.normal(size=(1500, 16))).astype("f4")
    ids = np.arange(1500)
    assert neighbours.width_for(1500, 32) == 2 and neighbours.Table(0, 64, 1500, 17).groups == 15
    want = exact(ids, x.astype("f8"), ids[ids % 20 == 0])
    share, got = recall(neighbours.nearest(frame(spark, [(int(i), v.tolist(), 1, "x") for i, v in zip(ids, x)]), F.col("vec_id") % 20 == 0).collect(), want)
    assert share >= 0.9, share
    for q, found in got.items():
        scores = dict(want[q])
        assert all(s == scores[v] for v, s in found if v in scores)


def looked_at(x, n_queries=64):
    """Shares of the rows (of 10,000 of them) that a query looks at: counted in each table, and distinct; recall of the 20
    nearest of all rows."""
    q = x[:n_queries]
    s = q @ x.T
    s[np.arange(n_queries), np.arange(n_queries)] = -9
    top = np.argsort(-s, axis=1)[:, :20]
    some = np.concatenate([top.reshape(-1), np.arange(min(10_000, len(x)))])
    seen, products = np.zeros((n_queries, len(some)), bool), 0.0
    for t in range(neighbours.TABLES):
        table = neighbours.Table(t, neighbours.axes(x), len(x), 17)
        least = np.array([p[0] for p in table.probes(q)])
        looks = table.sums(q, table.codes(x[some])) >= least[:, None]
        products, seen = products + looks[:, top.size :].mean(), seen | looks
    of = np.arange(top.size).reshape(top.shape)
    return products, seen[:, top.size :].mean(), np.take_along_axis(seen, of, 1).mean()


def test_share_of_rows_falls_as_rows_grow():
    rng = np.random.default_rng(8)

    def clustered(n):
        x = rng.normal(size=(n // 25, 64))[rng.integers(0, n // 25, n)] + 0.5 * rng.normal(size=(n, 64))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    few, more = looked_at(clustered(4_000)), looked_at(clustered(40_000))
    many = looked_at(clustered(270_000), 16)
    assert few[1] > 2 * more[1] and more[1] > 2 * many[1] and many[1] < 0.1, (few, more, many)
    assert min(few[2], more[2], many[2]) >= 0.9, (few, more, many)


@pytest.mark.parametrize("rows, width, groups", [(10_000, 2, 3), (20_000, 3, 5), (600_000, 4, 147)])
def test_buckets_that_reach_the_sum_are_in_the_groups(rows, width, groups):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = neighbours.Table(1, neighbours.axes(x), rows, 17)
    codes = table.codes(x)
    assert table.width == width and table.groups == groups
    for q, (least, visited) in zip(x[:80], table.probes(x[:80])):
        reached = table.sums(q[None], codes)[0] >= least
        assert set(table.group(codes[reached])) <= set(visited)
        nearest = table.sums(q[None], table.codes(q[None]))[0, 0]
        assert nearest >= least and nearest >= table.sums(q[None], codes).max() - 1e-12


def test_what_reaches_the_sum_is_what_is_listed():
    """Of four rotations: as many buckets as the share says, and no bucket outside them reaches the least sum."""
    x = np.random.default_rng(10).normal(size=(5, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    table = neighbours.Table(0, neighbours.axes(x), 40_000_000, 17)
    assert table.width == 4 and table.few**4 >= neighbours.SHARES[3] * table.axes**4
    codes = np.random.default_rng(11).integers(0, table.axes**4, 200_000)
    for q, (least, visited) in zip(x, table.probes(x)):
        reached = table.sums(q[None], codes)[0] >= least
        assert np.isin(table.group(codes[reached]), visited).all()
        assert reached.mean() < 3 * neighbours.SHARES[3]


def test_groups_that_a_query_goes_to_stay_bounded():
    """Copies of queries to shuffle, for each row of the table (a twentieth of them asks): they stop growing."""
    x = np.random.default_rng(12).normal(size=(32, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    copies = {}
    for n in (10**5, 10**6, 10**7, 10**8, 10**9):
        table = neighbours.Table(0, neighbours.axes(x), n, 17)
        visited = np.mean([len(g) for _, g in table.probes(x)])
        assert visited <= min(table.groups, table.few ** min(neighbours.PREFIX, max(1, table.width - 1)))
        copies[n] = visited * neighbours.TABLES / 20
    assert copies[10**5] < 12 and copies[10**6] < 110 and copies[10**7] < 320 and copies[10**8] < 160 and copies[10**9] < 160, copies


@pytest.mark.parametrize("rows, width", [(10**6, 3), (4 * 10**7, 4)])
def test_recall_of_wide_tables_through_their_groups(rows, width):
    """The width of large tables forced on a small one: a row counts as found where its bucket reaches the sum and its group is visited."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(400, 64)).repeat(25, axis=0) + 0.4 * rng.normal(size=(10_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x[::100]
    s = q @ x.T
    s[np.arange(len(q)), np.arange(0, 10_000, 100)] = -9
    top = np.argsort(-s, axis=1)[:, :20]
    found = np.zeros(top.shape, bool)
    for t in range(neighbours.TABLES):
        table = neighbours.Table(t, neighbours.axes(x), rows, 17)
        assert table.width == width
        codes = table.codes(x)
        for i, (least, visited) in enumerate(table.probes(q)):
            own = codes[top[i]]
            found[i] |= (table.sums(q[i : i + 1], own)[0] >= least) & np.isin(table.group(own), visited)
    assert found.mean() >= 0.9, found.mean()


def test_copies_that_no_query_can_want():
    x = np.array([[1.0, 2.0]] * 6 + [[2.0, 1.0]])
    kept = neighbours.first_copies(np.array([9, 3, 5, 1, 7, 2, 8]), x, 2)
    assert sorted(kept.tolist()) == [1, 3, 5, 6]
    kept = neighbours.first_copies(np.array([1, 1, 1, 1, 7, 2, 1]), x, 1)
    assert sorted(zip(np.array([1, 1, 1, 1, 7, 2, 1])[kept].tolist(), x[kept, 0].tolist())) == [(1, 1.0), (1, 2.0), (2, 1.0)]


def test_repeated_ids_count_once(spark):
    rows = [(20, [1.0, 0.1])] + [(7, [3.0, i / 100]) for i in range(50)] + [(8, [3.0, 0.0])] * 40 + [(i, [1.0, 0.0]) for i in range(30, 60)]
    got = neighbours.nearest(frame(spark, [(i, v, 1, "x") for i, v in rows]), F.col("vec_id") == 20).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [7, 8, *range(30, 48)]
