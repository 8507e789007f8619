import pytest

from skein.llm import quality_rules
from tests.llm.brute import ODD, frame


def test_target_is_every_row_labelled_good(spark):
    labels = spark.range(25_000).selectExpr("id as doc_id", "cast(id % 25 <> 0 as int) as quality").unionByName(spark.createDataFrame([(None, 1), (1, 1)], "doc_id long, quality int"))
    got = [r.trusted_id for r in quality_rules.trusted_ids(labels).collect()]
    assert sorted(got) == [i for i in range(25_000) if i % 25]


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_scores_by_either_join(spark, most, monkeypatch):
    docs = frame(spark, ODD).unionByName(spark.createDataFrame([(None, "words of a row without an id", None)], "doc_id long, text string, source string"))
    trusted = quality_rules.trusted_ids(spark.createDataFrame([(i, 1) for i in range(5, 25)], "doc_id long, quality int"))

    def scores():
        return sorted((str(r["row"].doc_id), r.llr, r.kept) for r in quality_rules.judged(docs, trusted).collect())

    want = scores()
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", most, raising=False)
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        got = scores()
    finally:
        spark.conf.set(conf, old)
    assert [g[::2] for g in got] == [w[::2] for w in want] and all(abs(g[1] - w[1]) < 1e-9 for g, w in zip(got, want))
