"""Plain versions of what the operators compute, for small inputs; and inputs that are awkward."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD = [
    None, "", " ", "\n\n \t", "a", "word", "a b c", "a b c d e " * 30, "x" * 5000, "x " * 30000, "1 " * 4000 + "end", "1" * 3000, "a.b" * 2000,
    "é café naïve ÉCOLE straße", "日本語 テスト 한국어", "\x1c\x1d odd \x85 blanks \xa0 here　and", "Σ ΑΣ ΣΑΣ", "<|endoftext|> in <|startoftext|>text", "👩‍👩‍👧 family 🇩🇪",
    "line\nline\n line\nline\n\n\n", "mail a.b@c.d.e, x@y.zz and p@q..r also a@b.c%d@e.f ok", "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.02.3.255 9.9.9",
    "card 4539 1488 0343 6467 and 4539148803436467 or 4539-1488-0343-6467 no 4539148803436468", "call +1 (743) 555-3824 or +49 30 1234567, +1.2 +123456789012345678", "iban DE89 3704 0044 0532 0130 00 bank GB82WEST12345698765432 bad DE89370400440532013001",
    "social security 123-45-6789 but 987-65-4321", "email a@b.cd", "" * 20, "# * $ % & | < >" * 9, "the same text again", "the same text again",
]


def words(text):
    return WORD.findall(text or "")


def rows(texts=ODD):
    return [(i, t, ["s1", "s2", None, "s1"][i % 4]) for i, t in enumerate(texts)]


def frame(spark, texts=ODD):
    return spark.createDataFrame(rows(texts), "doc_id long, text string, source string")
