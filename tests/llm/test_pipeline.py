"""Each stage on what its predecessor kept, against plain Python."""

import base64
import hashlib
from collections import Counter

import public_tokenizers as P

import corpus_pipeline
from tests.llm.brute import words
from tests.llm.test_near_duplicates import components
from tests.llm.test_rules_pii import base, base_spans


def mask(text):
    spans = [(a, b, f"[{k.upper()}]") for a, _, k, b in base_spans(text)]
    out, at = "", 0
    for a, b, mark in spans:
        if a >= at:
            out += text[at:a] + mark
        at = max(at, b)
    return out + text[at:]


def test_stages(spark, sf):
    import tiktoken

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got, tables = docs, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, got, sf)
        assert i == 4 or got.columns == docs.columns and got.dtypes == docs.dtypes
        got = spark.createDataFrame(got.collect(), got.schema)
        tables.append(got.collect())
    good, single, clean, mixed, encoded = tables

    kept = {r.doc_id: r for r in good}
    assert all(given[i] == r for i, r in kept.items())
    for i, r in given.items():
        n, _, _, _, again = base(r.text)
        if n < 10 or 100 * again > 20 * n:
            assert i not in kept
        elif labels.get(i) == 1:
            assert i in kept, r.text[:100]

    order = sorted(kept)
    want = {order[c] for c in components([kept[i].text for i in order], 80, 5)}
    assert {r.doc_id for r in single} == want and all(kept[r.doc_id] == r for r in single) and len(single) == len(want)

    assert {r.doc_id: r.text for r in clean} == {i: mask(kept[i].text) for i in want}
    assert all(r.n_chars == len(r.text) for r in clean if r.text != kept[r.doc_id].text)

    whole = {r.doc_id: words(r.text) for r in clean}
    out = Counter()
    for r in mixed:
        out[r.doc_id] += len(words(r.text))
        assert not Counter(words(r.text)) - Counter(whole[r.doc_id]) and r.source == kept[r.doc_id].source
    assert all(n <= 3 * len(whole[i]) for i, n in out.items())

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert sorted((r.doc_id, tuple(r.ids)) for r in encoded) == sorted((r.doc_id, tuple(enc.encode_ordinary(r.text))) for r in mixed)
    assert sorted(r.decoded_sha256 for r in encoded) == sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in mixed)


def test_run_is_the_stages(spark, sf):
    a, b = (sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, sf).collect()) for _ in range(2))
    assert a and a == b
