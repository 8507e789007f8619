from skein.llm import pii
from tests.llm.brute import frame

DE, GB, NO = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"


def test_accounts_before_upper_case_words(spark):
    texts = {
        f"IBAN {DE} BIC COBADEFF": [DE],
        "iban DE89370400440532013000 EUR 500": ["DE89370400440532013000"],
        f"bank {DE} {GB} {NO} AND MORE": [DE, GB, NO],
        f"é transfer {GB}": [GB],
        f"konto {DE}": [DE],
        "iban DE89 3704 0044 0532 0130 01 BIC COBADEFF": [],
        "iban DE89370400440532013000EUR 500": [],
    }
    rows = pii.reported(frame(spark, list(texts))).collect()
    for r in rows:
        t, want = list(texts.items())[r.doc_id]
        assert [s for s in r.spans.split(",") if s.startswith("iban")] == [f"iban:{t.index(w)}:{t.index(w) + len(w)}" for w in want], t
    assert [r.text for r in pii.masked(frame(spark, list(texts)[:2])).orderBy("doc_id").collect()] == ["IBAN [IBAN] BIC COBADEFF", "iban [IBAN] EUR 500"]
