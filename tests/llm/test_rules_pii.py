import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from skein.llm import pii, quality_rules, queries
from tests.llm.brute import ODD, frame, words


def base(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)


def check_rules(rows, texts):
    assert sorted(r["row"].doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base(texts[r["row"].doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r["row"].doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_rules(spark, sf):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    check_rules(quality_rules.judged(frame(spark), quality_rules.trusted_ids(none)).collect(), dict(enumerate(ODD)))
    trusted = quality_rules.trusted_ids(spark.createDataFrame([(0, 1), (7, 1), (None, 1)], "doc_id long, quality int"))
    check_rules(quality_rules.judged(frame(spark), trusted).collect(), dict(enumerate(ODD)))
    assert quality_rules.judged(frame(spark, []), trusted).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules.judged(docs, quality_rules.trusted_ids(labels)).collect()
    check_rules(rows, {r.doc_id: r.text for r in docs.collect()})


def test_ratio_is_that_of_plain_counts(spark):
    """Scores by the same buckets, counted and summed in plain Python."""
    import math

    texts = ["the cat sat on the mat and the dog ran " * 2, "BUY!! NOW!! BUY!! NOW!! BUY!! CHEAP!! BUY!! NOW!! PILLS!! ALL!!", "the dog sat on the cat and the mat ran off", "a b", ""]
    rows = quality_rules.judged(frame(spark, texts), quality_rules.trusted_ids(spark.createDataFrame([(0, 1), (2, 1)], "doc_id long, quality int"))).collect()
    flat = spark.createDataFrame([(w,) for w in {w for t in texts for w in words(t)}], "w string")
    bucket = {r.w: r.b for r in flat.select("w", F.pmod(F.hash("w"), F.lit(quality_rules.BUCKETS)).alias("b")).collect()}
    keys = [[bucket[w] for w in words(t)] for t in texts]
    raw, good = Counter(k for ks in keys for k in set(ks)), Counter(k for i in (0, 2) for k in set(keys[i]))
    share, more = good.total() / raw.total(), quality_rules.SMOOTH
    for r in rows:
        i = r["row"].doc_id
        ratio = lambda k: math.log((good[k] - (i in (0, 2)) + more * share) / ((raw[k] - 1 + more) * share))  # noqa: B023, E731
        assert abs(r.llr - (sum(map(ratio, keys[i])) / len(keys[i]) if keys[i] else 0)) < 1e-9


def test_clean_texts_that_no_label_names_are_kept(spark):
    """A quarter of the labels is hidden: its good texts of ten words stay, most of its junk goes."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = quality_rules.trusted_ids(labels.where("doc_id % 4 <> 0"))
    rows = {r["row"].doc_id: r for r in quality_rules.judged(docs, seen).collect()}
    hidden = [(rows[r.doc_id], r.quality) for r in labels.where("doc_id % 4 = 0").collect()]
    good, bad = ([r for r, q in hidden if q == v and r.n_words >= 10] for v in (1, 0))
    assert len(good) > 50 and all(r.kept for r in good if not r.base_failed)
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)
    assert sum(not r.kept for r in bad if not r.base_failed) > 0


def test_clashing_columns_and_equal_rows(spark):
    docs = spark.createDataFrame([(1, "some words of a text", 5, 6, True, 0.5)] * 3, "doc_id long, text string, w int, grams int, kept boolean, llr double")
    rows = quality_rules.judged(docs, quality_rules.trusted_ids(spark.createDataFrame([(1, 1)], "doc_id long, quality int"))).collect()
    assert len(rows) == 3 and len({(r.llr, r.kept, r.n_words) for r in rows}) == 1 and rows[0]["row"].w == 5
    got = pii.reported(docs.selectExpr("*", "1 as t", "2 as found", "3 as `all`")).collect()
    assert [r.n_email for r in got] == [0, 0, 0]


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


#: The kinds in their order and what confirms a match.
BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
]


def base_spans(text):
    out = []
    for k, (kind, pattern, ok) in enumerate(BASE):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII) if ok(m[0])]
    return sorted(out)


def check_pii(rows, texts):
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)], (texts[r.doc_id], r)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (texts[r.doc_id], r, joined)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_spans(spark, sf):
    rows = pii.reported(frame(spark)).collect()
    check_pii(rows, dict(enumerate(ODD)))
    spans = {r.doc_id: r.spans for r in rows}
    at = next(i for i, t in enumerate(ODD) if t and t.startswith("iban"))
    assert spans[at].count("iban:") == 2
    at = next(i for i, t in enumerate(ODD) if t and t.startswith("social"))
    assert spans[at].count("ssn:") == 2
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_pii(queries.op10_pii(spark, sf).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert pii.reported(frame(spark, [])).count() == 0


def test_random_spans(spark):
    import random

    rnd = random.Random(3)
    texts = ["".join(rnd.choice(["a", "@", ".", "b.c", "1", "23", "+", " ", "-", "(", ")", "4539148803436467", "%", "é", "x@y.z", "+1 555", "\n", "_"]) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    check_pii(pii.reported(frame(spark, texts)).collect(), dict(enumerate(texts)))


def test_masking(spark):
    docs = frame(spark).selectExpr("*", "cast(length(text) as long) n_chars", "1 as start", "2 as t")
    got = pii.masked(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        before = ODD[r.doc_id]
        if not base_spans(before) and "iban" not in (before or "") and "social" not in (before or ""):
            assert r.text == before
        else:
            assert "[" in r.text and not base_spans(r.text) and r.n_chars == len(r.text)
