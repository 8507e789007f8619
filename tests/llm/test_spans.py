"""Texts with many spans: sums over stretches, cuts from pieces, and masks against plain Python."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from skein.llm import pii


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_running_sums_and_maxima(spark, n):
    values = [random.Random(n + i).randrange(1000) for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    got = df.select(pii.running(F.col("v"), 0, lambda a, x: a + x).alias("s"), pii.running(F.col("v"), 0, lambda a, x: F.greatest(a, x)).alias("m")).first()
    assert got.s == [0, *itertools.accumulate(values)][:n] and got.m == [0, *itertools.accumulate(values, max)][:n]


def test_cuts_are_slices_of_code_points(spark):
    r = random.Random(2)
    text = "".join(r.choice(["a", "\n", "é", "日", "\U0001f600", "\r"]) for _ in range(2 * pii.PIECE + 77))
    ends = sorted({0, 1, pii.PIECE - 1, pii.PIECE, pii.PIECE + 1, 2 * pii.PIECE, len(text), len(text) + 9, *(r.randrange(len(text)) for _ in range(9))})
    pairs = [(a, b) for a in ends for b in ends if a <= b]
    df = spark.createDataFrame([(text, pairs)], "t string, p array<struct<a:int,b:int>>").withColumn("parts", pii.pieces(F.col("t")))
    got = df.select("parts", F.transform("p", lambda p: pii.cut(F.col("parts"), p["a"], p["b"])).alias("c")).first()
    assert "".join(got.parts) == text and got.c == [text[a:b] for a, b in pairs]


def mask(text, spans):
    """Spans of (start, kind, stop) in order; one that begins inside an earlier one's stretch goes with it."""
    out, at = [], 0
    for start, kind, stop in spans:
        if start >= at:
            out += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_masks_of_random_texts(spark):
    r = random.Random(3)
    bits = ["a@b.cd", "x.y@z-1.q.w", "1.2.3.4", "999.1.1.1", "4539148803436467", "4539 1488 0343 6467", "+1 (743) 555-3824", "+49 30 1234567 8", "DE89370400440532013001", "DE89 3704 0044 0532 0130 00", "123-45-6789", "call", "ssn", " ", "\n", "日本", "\U0001f600", ".", ",", "+", "-", "5"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", "  "]) for _ in range(r.choice([3, 30, 400]))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {x.doc_id: [(s.start, s.kind, s.stop) for s in x.found] for x in pii.found(docs).select("row.doc_id", "found").collect()}
    assert sum(map(len, spans.values())) > 500
    got = {x.doc_id: x.text for x in pii.masked(docs).collect()}
    assert got == {i: mask(t, spans[i]) for i, t in enumerate(texts)}


def test_a_hundred_thousand_spans_in_one_text(spark):
    n = 100_000
    text = " ".join(f"u{i}@h{i % 7}.org" for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.monotonic()
    assert pii.reported(docs).first().n_email == n
    assert pii.masked(docs).first().text == " ".join(["[EMAIL]"] * n)
    assert time.monotonic() - start < 120  # a cost of spans times length would be hours
