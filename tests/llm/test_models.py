import zlib

import numpy as np

from skein.llm import language, quality_model, queries
from tests.llm.brute import ODD, frame


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_quality_on_rows_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op6_quality_model(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(got) == sorted(d.doc_id for d in docs)
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if held(r.doc_id)]
    right = np.mean([got[r.doc_id].predicted == r.quality for r in labels])
    assert right >= 0.95, right


def test_quality_does_not_depend_on_held_out_labels(spark):
    docs = spark.createDataFrame([(i, ("good words here %d " % i if i % 3 else "BAD!! ***  %d " % i) * 5) for i in range(120)], "doc_id long, text string")
    label = lambda flip: spark.createDataFrame([(i, int(bool(i % 3)) ^ int(flip and held(i)), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    a, b = (sorted(quality_model.scored(docs, quality_model.learned(docs, label(f))).collect()) for f in (False, True))
    assert a == b and {r.predicted for r in a if r.doc_id % 3 == 0} == {0} and {r.predicted for r in a if r.doc_id % 3} == {1}


def test_quality_of_awkward_input(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    for labels in (none, one):
        model = quality_model.learned(frame(spark), labels)
        got = quality_model.scored(frame(spark).selectExpr("*", "1 as score"), model).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert quality_model.scored(frame(spark, []), model).count() == 0
    assert quality_model.scored(spark.createDataFrame([(None, None)], "doc_id long, text string"), model).count() == 1


def test_descent_solves_the_dual():
    """Against projected gradient on the same dual problem, densely."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 12)).astype(np.uint32) for _ in range(30)]
    y = np.where(rng.random(30) < 0.5, 1.0, -1.0)
    ratio = np.zeros(quality_model.BUCKETS)
    ratio[:40] = rng.normal(size=40)
    w, bias = quality_model.descent(rows, y, ratio, np.full(30, 1.0), 3000, 1)
    x = np.zeros((30, 41))
    for i, k in enumerate(rows):
        x[i, k] = ratio[k] * quality_model.scaled(len(k))
    x[:, 40] = 1
    q = (x * y[:, None]) @ (x * y[:, None]).T
    a = np.zeros(30)
    for _ in range(200_000):
        a = np.clip(a - 0.05 * (q @ a - 1), 0, 1)
    want = (a * y) @ x
    value = lambda v: 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()
    assert abs(value(np.append(w[:40], bias)) - value(want)) < 1e-2


def test_gradients_are_those_of_differences():
    net = language.Network(["a", "b", "c"], units=3)
    net.p = {k: v.astype("f8") for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (7, 4)), np.array([0, 1, 2, 1])
    x[5:, 1] = language.END
    _, g = net.gradients(x, y)
    for k, v in net.p.items():
        for _ in range(6):
            i = tuple(int(rng.integers(0, s)) for s in v.shape)
            i = (i[0], int(x[rng.integers(0, 5), 0])) if k[0] == "E" else i
            old, e = v[i], 1e-5
            v[i] = old + e
            up = net.gradients(x, y)[0]
            v[i] = old - e
            down = net.gradients(x, y)[0]
            v[i] = old
            assert abs((up - down) / 2 / e - g[k][i]) < 1e-7


def test_language_on_rows_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op9_language(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted(got) == sorted(d.doc_id for d in docs)
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 for i, r in got.items())
    right = np.mean([got[d.doc_id].lang_pred == d.lang for d in docs if held(d.doc_id) and d.lang])
    assert right >= 0.97, right


def test_pooling_is_that_of_single_texts():
    net = language.fitted([(b"the cat and the dog " * 3, "en"), (b"le chat et le chien " * 3, "fr")] * 5, rounds=30)
    texts = [b"the cat", b"x" * 1000, b"le chat et le chien " * 40, b"", "é".encode()]
    together = language.pooled(net, texts)
    for t, row in zip(texts, together):
        assert np.allclose(language.pooled(net, [t])[0], row, atol=1e-6) and abs(row.sum() - (1 if t else 0)) < 1e-4


def test_language_of_awkward_input(spark):
    docs = frame(spark).selectExpr("doc_id", "text", "case when doc_id % 2 = 0 then 'aa' when doc_id % 3 = 0 then 'bb' end lang", "1 as score")
    net = language.learned(docs)
    got = {r.doc_id: r for r in language.labelled(docs, net).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= got[i].score <= 1
    assert {r.lang_pred for r in language.labelled(docs, None).collect()} == {"und"}
    assert language.learned(docs.where("lang is null")) is None
    assert language.labelled(frame(spark, []), net).count() == 0
