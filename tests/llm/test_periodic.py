import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from skein.llm import periodic, queries
from tests.llm.brute import ODD, frame, words


def runs_of(w):
    """(start, end, smallest period) of every run, by trying each period at each word."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def plain(doc_id, text, planted=True):
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if planted and doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    s, e, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2])) if runs else (None, None, None)
    best = (s, e - s, q, 1000 * (e - s) // q) if runs else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_odd_texts(spark):
    texts = [t for t in ODD if t is None or len(t) < 10_000] + ["a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "x y " + "p q r " * 5 + "p q z", "u " * 6 + "v " * 7 + "u v " * 4]
    for planted in (False, True):
        got = sorted(map(tuple, periodic.periodic_runs(frame(spark, texts), planted).collect()))
        assert got == sorted(plain(i, t, planted) for i, t in enumerate(texts))
    assert sum(r[1] for r in got) > 5


def test_random_texts_that_lie_one_after_another():
    r = random.Random(2)
    for _ in range(600):
        docs = []
        for _ in range(r.randrange(1, 6)):
            kinds, n = r.choice([1, 2, 3, 5, 50]), r.randrange(90)
            w = [r.randrange(kinds) for _ in range(n)]
            if n and r.random() < 0.6:
                a = r.randrange(n)
                p = 1 + (n - a) // r.randrange(3, 11)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        at = np.cumsum([0, *map(len, docs)])
        got = periodic.found_runs(np.array([x for d in docs for x in d], np.int64), np.repeat(np.arange(len(docs)), [len(d) for d in docs]))
        assert got.tolist() == [[s + o, e + o, q] for d, o in zip(docs, at.tolist()) for s, e, q in runs_of(d)], docs


def test_masked_words_are_in_no_run():
    assert periodic.minimum_overlap() == 5
    w = list(range(500)) + [1, 2, 3] * 4 + list(range(600, 900)) + list(range(50))
    first, end = periodic.surviving(np.array(w), np.zeros(len(w), np.int64))
    assert first.tolist() == [500] and end.tolist() == [512]  # the far repetition of 0 to 49 is no run's


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, queries.op13_periodic_runs(spark, sf).collect()))
    assert got == sorted(plain(d.doc_id, d.text) for d in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_very_long_texts(spark):
    r = random.Random(4)
    some = [str(r.randrange(5000)) for _ in range(100_000)]
    texts = [" ".join(some * 4), "a " * 300_000, "a b " * 100_000 + "c", " ".join(some * 3)]
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in periodic.periodic_runs(frame(spark, texts)).collect()}
    assert got == {0: (1, 0, 400_000, 100_000), 1: (1, 0, 300_000, 1), 2: (1, 0, 200_000, 2), 3: (0, None, None, None)}


def test_empty_tables_ties_repeated_rows_and_other_columns(spark):
    assert periodic.periodic_runs(frame(spark, [])).count() == 0
    clash = spark.createDataFrame([(None, "a a a a a a b b b b b b", 5, "x")] * 2, "doc_id long, text string, n_runs int, start string")
    rows = periodic.periodic_runs(clash, planted=True).collect()
    assert [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in rows] == [(None, 2, 0, 6, 1, 6000)] * 2
