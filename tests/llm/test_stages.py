"""Every stage on empty tables, nulls, repeated rows, long texts and columns with clashing names."""

import public_tokenizers as P
import pytest

import corpus_pipeline
from skein.llm import byte_bpe, language, token_count
from tests.llm.brute import ODD

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, w array<string>, row string, key string, t string, found int, parts int, kept string, grams string, size string, `a b` int, nth int, n_words int"
PROSE = "the river runs past the old mill and the quiet garden where nobody walks after rain has fallen on the stones near the gate "


def table(spark, rows):
    more = (["x"], "row", "key", "t", 1, 2, "kept", "grams", "size", 3, 4, 5)
    return spark.createDataFrame([(i, text, "en", source, len(text or ""), *more) for i, text, source in rows], EXTRA)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame([(1, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows():
    texts = [PROSE + f"number {i} of the series with words like w{i * 7} and w{i * 11} that others lack" for i in range(30)]
    return [(i, t, ["s1", "s2", None][i % 3]) for i, t in enumerate(texts)] + [(3, texts[3], "s1")] * 2 + [(None, texts[5], "s2"), (40, None, "s1"), (41, "", None), (None, None, None), (42, PROSE * 2000 + "mail me at a@b.cd", "s2")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, table(spark, rows()).where("doc_id = -1"), sf_dir).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_are_those_of_documents(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = table(spark, rows())
    out = stage(spark, docs, sf_dir)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
    got = out.collect()
    assert got and all((r["key"], r["a b"], r["w"], r["n_words"]) == ("key", 3, ["x"], 5) for r in got)
    ids = [r.doc_id for r in got]
    if name == "quality_rules":
        assert set(ids) >= {i for i in range(30)} and not {40, 41} & set(ids)
    if name == "near_duplicates":
        assert ids.count(3) == 1 and {40, 41} <= set(ids)
    if name == "personal_data":
        assert len(got) == len(rows()) and sum(r.text is None for r in got) == 2
        assert next(r.text for r in got if r.doc_id == 42).endswith("[EMAIL]")


def test_encoding_of_awkward_rows(spark, sf_dir):
    got = corpus_pipeline.encode(spark, table(spark, rows()), sf_dir).collect()
    assert len(got) == len(rows()) and sum(r.n_tokens == 0 for r in got) == 3


def test_rows_equal_in_id_and_text_are_treated_alike(spark):
    twice = spark.createDataFrame([(i % 5, ODD[10 + i % 5], "en", 1) for i in range(15)], "doc_id long, text string, lang string, quality int")
    for made in (token_count.token_counts(twice, P.path("word_bpe_49k.json")), byte_bpe.encode_decode(twice, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), language.labelled(twice, language.learned(twice))):
        out = [tuple(r) for r in made.collect()]
        assert len(out) == 15 and len(set(out)) == 5
