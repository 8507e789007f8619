import base64
import hashlib

import public_tokenizers as P
import pytest

from skein.llm import byte_bpe, common, queries, token_count
from tests.llm.brute import ODD, frame


def test_counts_are_the_library_s(spark):
    from tokenizers import Tokenizer

    got = {r.doc_id: r for r in token_count.token_counts(frame(spark), P.path("word_bpe_49k.json"), limit=50).collect()}
    ref = Tokenizer.from_file(P.path("word_bpe_49k.json")).encode_batch([t or "" for t in ODD], add_special_tokens=False)
    assert len(got) == len(ODD)
    for i, (t, e) in enumerate(zip(ODD, ref)):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), len(e.ids), len(e.ids) > 50), t


def test_counts_query(spark, sf):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in queries.op1_token_counts(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == {d.doc_id: len(t.encode(d.text, add_special_tokens=False).ids) for d in docs}


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_identifiers_are_the_library_s_and_decode(spark, reference):
    got = {r.doc_id: r for r in byte_bpe.encode_decode(frame(spark), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_ids=True).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        ids = reference.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].decoded == (t or "")
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()


def test_identifiers_query(spark, sf, reference):
    got = {r.doc_id: r for r in queries.op7_byte_bpe(spark, sf).collect()}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = reference.encode_ordinary(d.text)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()


def test_classes_are_the_libraries_for_every_code_point():
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    for kind in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"):
        library = tiktoken.Encoding("one", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        want = bytes(library.encode_ordinary(every)).decode()
        got = "".join(common.Splitter(kind)(every))
        assert got.replace("\x1c", "").replace("\x1d", "").replace("\x1e", "").replace("\x1f", "") == want.translate({c: None for c in range(0x1C, 0x20)})


def test_newer_characters(spark, reference):
    """Letters and numbers that the libraries don't know, and every capital whose lower case Python doesn't know."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ends = [[int(e, 16) for e in r.split("-")] for r in common.NEWER.split()]
    some = [c for r in ends for c in {r[0], r[-1], (r[0] + r[-1]) // 2}] + list(token_count.LOWER)
    texts = [f"ab{chr(c)}cd 1{chr(c)}'s {chr(c)}X {chr(c)}{chr(c)}" for c in some]
    counted = {r.doc_id: r.n_tokens for r in token_count.token_counts(frame(spark, texts), P.path("word_bpe_49k.json")).collect()}
    coded = {r.doc_id: r.ids for r in byte_bpe.encode_decode(frame(spark, texts), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_ids=True).collect()}
    for i, text in enumerate(texts):
        assert counted[i] == len(t.encode(text, add_special_tokens=False).ids), ascii(text)
        assert coded[i] == reference.encode_ordinary(text), ascii(text)


def test_empty_tables_and_other_columns(spark):
    empty = frame(spark, [])
    assert token_count.token_counts(empty, P.path("word_bpe_49k.json")).count() == 0
    assert byte_bpe.encode_decode(empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
    clash = spark.createDataFrame([(1, "some text", 5, 6)], "doc_id long, text string, n_tokens int, n_bytes int")
    assert token_count.token_counts(clash, P.path("word_bpe_49k.json")).first().n_tokens == 2
    assert byte_bpe.encode_decode(clash, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).first().n_tokens == 2
    nobody = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert token_count.token_counts(nobody, P.path("word_bpe_49k.json")).first().n_tokens == 0
