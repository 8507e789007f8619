import hashlib
import random

import public_tokenizers as P
import pytest

from skein.llm import piece_bpe, queries
from tests.llm.brute import ODD, frame

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    with open(MODEL, "rb") as f:
        return piece_bpe.PieceCodec(f.read())


def encoded(codec, texts):
    import numpy as np

    return [np.frombuffer(b, "<i4").tolist() for b in codec.encode_all(texts)]


def test_identifiers_are_the_library_s_and_decode(spark, library):
    texts = ODD + ["▁ ▁▁a", "a\x00b﻿", "  " * 100 + "日", " ▁x" * 50, "<s> </s> <unk> <0x0A>"]
    got = {r.doc_id: r for r in piece_bpe.encode_decode(frame(spark, texts), MODEL, keep_ids=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].decoded == library.decode(ids), t
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_texts(codec, library):
    r = random.Random(1)
    pieces = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    texts = []
    for _ in range(800):
        texts.append("".join(r.choice(pieces).replace("▁", " ") for _ in range(r.randrange(30))))
        texts.append("".join(r.choice("aab  bhelo\nthin▁gs.,12é日本") for _ in range(r.randrange(80))))
        texts.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x3000, 0x9FFF), r.randrange(0x1F300, 0x1F700), r.randrange(0, 0xD800)])) for _ in range(r.randrange(60))))
        texts.append("".join(r.choice(pieces).strip("▁") for _ in range(r.randrange(60))))
    texts += [" " * n + x + " " * m for n in range(0, 70, 3) for m in (0, 1, 15, 31) for x in ("x", "日", "\n", "")]
    assert encoded(codec, texts) == library.encode(texts)


@pytest.mark.parametrize("length", [1, 2, 13, 14, 15, 16, 17, 31, 32, 47, 100])
def test_runs_of_marks_with_and_without_rounds(codec, library, length):
    with open(MODEL, "rb") as f:
        by_rounds = piece_bpe.PieceCodec(f.read())
    by_rounds.marks = None
    for text in (" " * length, " " * length + "the", "the" + " " * length + "日本"):
        assert encoded(codec, [text]) == encoded(by_rounds, [text]) == [library.encode(text)]


def test_very_long_segments(codec, library):
    r = random.Random(3)
    for text in ("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)), "ab" * 100_000, " " * 100_000 + "x", "a" * 100_000, "日本" * 50_000):
        assert encoded(codec, [text])[0] == library.encode(text)


def test_decoding_of_any_identifiers(codec, library):
    r = random.Random(5)
    for _ in range(1500):
        ids = [r.choice([r.randrange(0, 300), r.randrange(3, 259), r.randrange(32000), 259, 28705]) for _ in range(r.randrange(12))]
        assert codec.decode(ids).decode() == library.decode(ids), ids


def test_query_has_the_library_s_identifiers(spark, sf, library):
    got = {r.doc_id: r for r in queries.op11_piece_bpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_tables_repeated_rows_and_other_columns(spark):
    assert piece_bpe.encode_decode(frame(spark, []), MODEL).count() == 0
    clash = spark.createDataFrame([(1, "some text", 5, [6])] * 3 + [(None, None, None, None)], "doc_id long, text string, n_tokens int, ids array<int>")
    assert sorted(r.n_tokens for r in piece_bpe.encode_decode(clash, MODEL).collect()) == [0, 2, 2, 2]
