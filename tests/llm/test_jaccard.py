import random

import numpy as np
import pytest

from skein.llm import jaccard, queries
from skein.llm.components import components
from tests.llm.brute import ODD, frame, words


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}


def brute(texts, similar=90):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (a == b or min(len(a), len(b)) >= 0.85 * max(len(a), len(b))) and 100 * len(a & b) >= similar * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def check(rows, texts):
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts)


def near(rnd, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**9)}"
    return " ".join(w)


def family(seed, groups=12, most=40, passage=True):
    rnd = random.Random(seed)
    texts = []
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = " ".join(rnd.choice(vocabulary) for _ in range(60))
    for _ in range(groups):
        base = " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([12, 40, 150, 400])))
        texts += [near(rnd, base, rnd.choice([0, 0, 1, 1, 2, 3, 5])) for _ in range(rnd.randint(1, most))]
    if passage:
        texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 30))) + " " + shared for _ in range(80)]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 50))) for _ in range(100)] + [None, "", "One", "one", "One two", "one  two", "two one"]
    rnd.shuffle(texts)
    return texts


def test_sets_are_those_of_the_definition():
    texts = [t or "" for t in ODD]
    got = jaccard.shingle_sets([t.encode() for t in texts])
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]
    flat = {}
    for t in texts:
        for s in shingles(t):
            flat.setdefault(s, len(flat))
    assert len({h for g in got for h in g.tolist()}) == len(flat)


@pytest.mark.parametrize("similar", [50, 80, 90])
def test_linked_sets_share_an_entry(similar):
    """Whatever the hashes' counts, one of the entries of two linked sets is common."""
    rnd = random.Random(5)
    seen = 0
    for _ in range(1500):
        n = rnd.randint(1, 400)
        x = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))
        y = np.unique(np.concatenate([np.array(rnd.sample(x.tolist(), n - rnd.randint(0, n * (100 - similar) // 100)), np.uint64), np.array([rnd.getrandbits(64) for _ in range(rnd.randint(0, n // 10))], np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and len(x) != both and 100 * both >= similar * (len(x) + len(y) - both):
            seen += 1
            times = {h: rnd.randint(1, 3) for h in {*x.tolist(), *y.tolist()}}
            entries = []
            for s in (x, y):
                whole, rare = jaccard.lengths(len(s), similar)
                assert 0 < rare <= whole <= len(s)
                entries.append(set(sorted(s[:whole].tolist(), key=lambda h: (times[h], h))[:rare]))
            assert entries[0] & entries[1]
    assert seen > 200


def test_long_words_that_a_polynomial_takes_for_equal():
    word = "a"
    while len(word) < 4096:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    x, y = jaccard.shingle_sets([f"{w} and more words".encode() for w in (word, other)])
    assert len(np.intersect1d(x, y)) == 1


def test_hot_passage_and_many_near_copies(spark, monkeypatch):
    """Hot hashes, parts of several workers and open groups of several blocks."""
    for name, value in {"LEAST_HOT": 10, "LEAST_SEEN": 2, "HOT_SHARE": 1 << 9, "HELD": 4000, "COUNTED": 4000, "MEMBERS": 16}.items():
        monkeypatch.setattr(jaccard, name, value)
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base = text(70), text(120)
    texts = [text(rnd.choice([5, 30, 100])) + " " + passage for _ in range(150)] + [near(rnd, base, rnd.choice([1, 2, 3, 4, 6])) for _ in range(250)]
    texts += [passage + " " + text(rnd.choice([1, 2, 3])) for _ in range(60)] + [passage, text(40), text(40)]
    rnd.shuffle(texts)
    check(jaccard.joined(frame(spark, texts).repartition(5)).collect(), texts)


def test_overlaps():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    got = jaccard.overlaps(rows, wide=7)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


@pytest.mark.parametrize("seed, members", [(1, 512), (2, 6)])
def test_components_of_families(spark, seed, members, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", members)
    texts = family(seed)
    check(jaccard.joined(frame(spark, texts)).collect(), texts)


def test_chained_lists_are_not_met_as_a_whole(spark, monkeypatch):
    """Rows sent to blocks grow no faster than sets where lists chain all of them (the square of the open ones before)."""
    monkeypatch.setattr(jaccard, "MEMBERS", 16)
    sent = {}
    for size in (60, 240):
        rnd = random.Random(9)
        word = lambda: f"w{rnd.randrange(10**9)}"
        joint = [" ".join(word() for _ in range(4)) for _ in range(size + 1)]
        # neighbours share a passage and little else; every tenth text has a near copy
        texts = [" ".join([joint[i], *(word() for _ in range(20)), joint[i + 1]]) for i in range(size)]
        texts += [near(rnd, t + " " + t.replace("w", "v"), 1) for t in texts[::10] for _ in range(2)]
        rows = []
        real = jaccard.differences

        def kept(pairs, sets):
            if "open" in pairs.columns:
                rows.append((pairs.where("open").groupBy("grp").count().selectExpr("max(count)").first()[0] or 0, pairs.count()))
            return real(pairs, sets)

        monkeypatch.setattr(jaccard, "differences", kept)
        check(jaccard.joined(frame(spark, texts)).collect(), texts)
        monkeypatch.setattr(jaccard, "differences", real)
        assert all(most <= jaccard.MEMBERS for most, _ in rows)
        sent[size] = sum(n for _, n in rows)
    assert 0 < sent[240] <= 5 * sent[60]


def test_awkward_texts(spark):
    check(jaccard.joined(frame(spark).selectExpr("*", "1 as n", "2 as cls", "3 as grp")).collect(), ODD)
    assert jaccard.joined(frame(spark, [])).count() == 0
    rows = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "A B C D"), (3, "other words of it"), (3, "still other words here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(rows).collect()), key=str)
    assert got == [(3, 2, 3), (3, 2, 3), (5, 2, 5), (5, 2, 5), (None, 2, 5)]


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    assert [d.doc_id for d in docs] == list(range(len(docs)))
    check(queries.op8_jaccard_join(spark, sf).collect(), [d.text for d in docs])


def test_one_of_each(spark):
    texts = family(3, groups=5)
    docs = frame(spark, texts + ["", None, ""]).selectExpr("*", "7 as kept_id", "8 as n", "9 as row")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    want = sorted({c for i, (n, c) in brute(texts).items()} | {len(texts), len(texts) + 1, len(texts) + 2})
    assert sorted(r.doc_id for r in got.collect()) == want
    twice = jaccard.one_of_each(docs.unionByName(docs).where("text <> ''"))
    assert sorted(r.doc_id for r in twice.collect()) == sorted({c for n, c in brute(texts).values() if n})


def test_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 103), (103, 101), (200, 201)] + [(300, i) for i in range(301, 340)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 103: 100, 101: 100, 200: 200, 201: 200, **{i: 300 for i in range(300, 340)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
