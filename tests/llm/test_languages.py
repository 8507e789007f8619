from skein.llm import language


def test_every_language_is_learnt_or_none(spark, monkeypatch):
    rows = [(i, t, lang) for i in range(12) for t, lang in (("the cat and the dog sat", "en"), ("oui", "fr"), ("der hund " * 4000, "de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language, "fitted", lambda some: seen.extend(some))
    language.learned(docs)
    assert {lang for _, lang in seen} == {"en", "fr", "de"} and max(len(t) for t, _ in seen) == language.LEARN
    assert sum(len(t) for t, lang in seen if lang == "de") == len("der hund " * 4000)  # the whole text, once
    many = spark.range(300 * 40).selectExpr("id as doc_id", "'long enough for a sample' as text", "'l' || id % 300 as lang")
    seen.clear()
    language.learned(many)
    assert {lang for _, lang in seen} == {f"l{i}" for i in range(300)}


def test_three_hundred_languages_are_labelled(spark):
    net = language.fitted([(f"text {i}".encode(), f"l{i}") for i in range(300)], rounds=2)
    got = language.labelled(spark.createDataFrame([(1, "some text"), (None, "some text"), (2, "²½Ⅷ① 12")], "doc_id long, text string"), net).collect()
    assert [r.lang_pred for r in got if r.doc_id == 2] == ["und"] and len({r.lang_pred for r in got if r.doc_id != 2}) == 1
    assert {r.doc_id: r.held_out for r in got} == {1: False, None: False, 2: False}


def test_copies_of_one_row_are_one_row(spark, monkeypatch):
    """60,000 copies of the only French row are learnt as it is, and take nothing from the others."""
    english = spark.range(1000).selectExpr("id * 4 as doc_id", "'some words of row ' || id as text", "'en' as lang")
    french = spark.range(60_000).selectExpr("element_at(array(6L, 9L, 12L, 19L), cast(id % 4 + 1 as int)) as doc_id", "'quelques mots' as text", "'fr' as lang")
    seen = []
    monkeypatch.setattr(language, "fitted", lambda some: seen.extend(some))
    for part in (french, french.where("doc_id = 6"), french.where("doc_id = 19")):
        seen.clear()
        language.learned(english.unionByName(part))
        kinds = [lang for _, lang in seen]
        assert set(kinds) == {"en", "fr"} and kinds.count("fr") == 1 and kinds.count("en") >= language.SAMPLE_ROWS


def test_windows_are_drawn_from_the_whole_text(spark, monkeypatch):
    monkeypatch.setattr(language, "TRAIN", 50)
    text = "".join(f"{i:063d} " for i in range(3000))
    seen = []
    monkeypatch.setattr(language, "fitted", lambda some: seen.extend(some))
    language.learned(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"))
    at = sorted(int(t) for t, _ in seen)
    assert len(at) == 50 and at[0] < 300 and at[-1] > 2700


def test_rounds_follow_the_number_of_languages():
    assert language.rounds_for(4) == language.ROUNDS and language.rounds_for(300) * language.BATCH >= 300 * language.SEEN
