import zlib
from collections import Counter, defaultdict

from skein.llm import common, mixing, queries, sharding
from tests.llm.brute import ODD, frame, words


def check_shards(rows, texts, k=8):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes = Counter(r.shard for r in rows)
    assert not rows or max(sizes.values()) - min(sizes.get(s, 0) for s in range(k)) <= 1
    for s in range(k):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 1, zlib.crc32(b))


def test_shards_of_awkward_texts(spark):
    check_shards(sharding.interleaved_shards(frame(spark)).collect(), dict(enumerate(ODD)))
    assert sharding.interleaved_shards(frame(spark, [])).count() == 0
    same = sharding.interleaved_shards(spark.createDataFrame([(1, "t", None)] * 20 + [(None, None, "s")] * 3, "doc_id long, text string, source string")).collect()
    assert sorted(Counter(r.shard for r in same).values()) == [2, 3, 3, 3, 3, 3, 3, 3]


def test_shards_match_the_mixture(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_interleaved_shards(spark, sf).collect()
    check_shards(rows, {i: r.text for i, r in docs.items()})
    each = defaultdict(Counter)
    for r in rows:
        each[docs[r.doc_id].source][r.shard] += 1
    for of in each.values():  # each source is dealt out evenly
        assert max(of.values()) - min(of.get(s, 0) for s in range(8)) <= 2


def test_many_buckets(spark, sf, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 3)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check_shards(queries.op3_interleaved_shards(spark, sf).collect(), docs)


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    t = mixing.targets([10, 100, 100], [5, 2, 1])
    assert t[0] == 30 and abs(t[1] - 120) < 1e-9 and abs(t[2] - 60) < 1e-9
    assert mixing.targets([0, 5], [5, 2]) == [0, 5] and mixing.targets([], []) == []
    t = mixing.targets([1, 10, 1000], [5, 2, 1])
    assert t[:2] == [3, 30] and abs(t[2] - 978) < 1e-9


def test_permutations_and_draws():
    import numpy as np

    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 5)) == list(range(n))
    d = mixing.draws([100, 7, 0, 1000], 8, 3)
    assert list(d.sum(axis=0)) == [100, 7, 0, 1000] and d.sum(axis=1).max() - d.sum(axis=1).min() <= 8


def test_mix(spark, sf):
    rows = queries.op4_block_mixing(spark, sf).collect()
    again = queries.op4_block_mixing(spark, sf).collect()
    assert sorted(rows) == sorted(again)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(docs) == sorted(r.doc_id for r in rows)
    taken, target = Counter(), {}
    for r in rows:
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken <= 3 * r.size
        s = docs[r.doc_id].source
        taken[s] += r.taken
        target[s] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-6 * sum(target.values())


def test_mix_of_awkward_texts(spark):
    rows = mixing.mixed(frame(spark)).collect()
    assert sorted((r.doc_id, r["size"]) for r in rows) == [(i, len(words(t))) for i, t in enumerate(ODD)]
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mixed(frame(spark, [])).count() == 0
    assert [r.taken for r in mixing.mixed(frame(spark, [None, ""])).collect()] == [0, 0]


def test_mixed_documents_have_the_words_taken(spark):
    docs = frame(spark).selectExpr("doc_id", "text", "source", "1L as n_chars", "'x' as size", "7 as block")
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mixed(docs).collect()}
    out, whole = Counter(), dict(enumerate(ODD))
    for r in got.collect():
        assert r.n_chars == len(r.text) and r.size == "x"
        assert set(words(r.text)) <= set(words(whole[r.doc_id]))
        out[r.doc_id] += len(words(r.text))
    assert all(out[i] == n for i, n in taken.items())


def plain_mix(rows, seed=11):
    """What a mix takes of each of rows(doc_id, text, source), block by block and slot by slot."""
    import hashlib

    import numpy as np

    def place(r):
        n, crc = len(words(r[1])), zlib.crc32((r[1] or "").encode())
        u = int(hashlib.md5(f"{seed}:{r[0]}:{n}:{crc}".encode()).hexdigest()[:12], 16)
        return u, r[0], n, crc

    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(words(r[1])) for r in rows if r[2] == s) for s in names]
    target = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    blocks = [-(-n // mixing.BLOCK) for n in sizes]
    totals = [min(3 * b, round(t * b / n)) if n else 0 for t, b, n in zip(target, blocks, sizes)]
    taken = {}
    for sid, s in enumerate(names):
        times = Counter()
        for turn in range(-(-totals[sid] // blocks[sid]) if blocks[sid] else 0):
            slots = np.arange(min(blocks[sid], totals[sid] - turn * blocks[sid]))
            times.update(mixing.permuted(slots, blocks[sid], seed * 1_000_003 + sid * 31 + turn).tolist())
        at = 0
        for r in sorted((r for r in rows if r[2] == s), key=place):
            n = len(words(r[1]))
            taken[r[0]] = sum(times[w // mixing.BLOCK] for w in range(at, at + n))
            at += n
    return taken


def test_mix_is_the_plain_one(spark, sf, monkeypatch):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.taken for r in queries.op4_block_mixing(spark, sf).collect()} == plain_mix(docs)
    many = [(i, " ".join(["w"] * (i % 90)), f"s{i % 40}") for i in range(400)]
    monkeypatch.setattr(common, "BROADCAST_SOURCES", 3)
    prefix = common.hashed_prefix
    monkeypatch.setattr(common, "hashed_prefix", lambda slim, value, n=3: prefix(slim, value, 3, 4))
    rows = spark.createDataFrame(many, "doc_id long, text string, source string")
    assert {r.doc_id: r.taken for r in mixing.mixed(rows).collect()} == plain_mix(many)
    check_shards(sharding.interleaved_shards(rows).collect(), {i: t for i, t, _ in many})


def test_equal_ids_and_sizes_of_different_texts(spark):
    rows = [(7, f"{c} " * 40, s) for c in "abcdefgh" for s in ("x", "y")] + [(None, f"n{i} " * 9, "x") for i in range(30)] + [(7, "a " * 40, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = Counter()
    for r in mixing.mixed_documents(docs).collect():
        assert len(set(words(r.text))) == 1
        taken[r.doc_id, words(r.text)[0], r.source] += len(words(r.text))
    allowed = Counter()
    for i, t, s in rows:
        allowed[i, words(t)[0], s] += 3 * len(words(t))
    assert all(n <= allowed[k] for k, n in taken.items()) and sum(taken.values()) == sum(r.taken for r in mixing.mixed(docs).collect())
