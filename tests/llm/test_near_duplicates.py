"""The pipeline's stage: five-word shingles, similarity 0.8."""

import corpus_pipeline
from skein.llm import jaccard
from tests.llm.brute import frame, words
from tests.llm.test_jaccard import family


def shingles(text, width):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def components(texts, similar, width):
    sets = [shingles(t, width) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= similar * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_sets_of_any_width():
    texts = ["a b c d", "b a c d", "a c b d", "d c b a", "a b c d e", "a b c d e f", "a", "a a", ""]
    for width in (1, 2, 3, 5):
        got = jaccard.shingle_sets([t.encode() for t in texts], width)
        assert [len(g) for g in got] == [len(shingles(t, width)) for t in texts]
        assert len({h for g in got for h in g.tolist()}) == len({s for t in texts for s in shingles(t, width)})


def test_stage_drops_near_copies_by_five_words(spark, sf):
    for texts in (family(4, groups=6), [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]):
        docs = frame(spark, texts)
        got = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect())
        root = components(texts, 80, 5)
        assert got == [i for i, r in enumerate(root) if r == i]


def test_one_row_of_each_group_whatever_the_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, "first text of an id"), (1, "quite another text of the same id"), (2, long), (2, "something else of two"), (3, long + " end"), (1, "first text of an id"),
        (None, "no id and twice"), (None, "no id and twice"), (None, long), (None, "v " + long), (4, "First  text of an id"), (None, ""), (None, ""), (5, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(docs, 80, 5).collect()), key=str)
    want = [rows[i] for i in (0, 1, 2, 3, 6, 11, 12, 13)]
    assert got == sorted(want, key=str)
    only = spark.createDataFrame([(None, "v " + long), (None, long), (None, long)], "doc_id long, text string")
    assert jaccard.one_of_each(only, 80, 5).count() == 1
