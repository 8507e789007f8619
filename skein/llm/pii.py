"""Personal data in whole texts, in DataFrame functions alone.

Regular expressions propose spans, checks confirm them (Luhn for cards, mod 97 for account numbers, ranges and digit
counts for the rest) and words nearby move a span's score. The base kinds stay whatever their score; a span of a kind that
the method adds (iban, ssn) needs a score of at least KEEP_FROM.

Positions are code points: the pieces between the matches of a pattern and the matches themselves add up to them. Patterns
are written so that Java's matcher neither recurses nor starts anew at each character of a long run: a separator that
stands between two digits (or labels) is first replaced by one private character, which makes the run a run of one class.
Sums and maxima over a text's spans are taken in stretches of STRETCH, and what stands around a span is cut from pieces of
PIECE code points into which the text is split once, so that a text of any length with any number of spans costs little
more than its length: 100,000 spans in a text take seconds.

Cases: a null text is empty and has no spans; overlapping spans of different kinds are all reported, and masked as one;
repeated rows are treated each for itself; an empty table gives an empty table; the input's columns are carried in a struct
`row` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4
#: Score of a confirmed span, what a word of its context adds, and the score that an added kind needs.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
CONTEXT_ADDS, KEEP_FROM, NEAR = 0.3, 0.5, 40
#: Words whose presence nearby speaks for a kind (fixed values).
CONTEXT = {
    "email": "mail|email|e-mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|credit|visa|payment|account",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|transfer|konto",
    "ssn": "ssn|social security|security number",
}
#: Stands for a separator inside a run; what stands there in a text is replaced first.
MARK = "\ue000"
LOCAL = rf"A-Za-z0-9._%+{MARK}-"
LABEL = "A-Za-z0-9-"
#: What follows the first four characters of an account number, upper-case words after it perhaps included.
ACCOUNT = "(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
#: Characters of an account number by country; numbers of other countries are taken as long as mod 97 allows.
ACCOUNT_LENGTHS = {
    n: codes.split()
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++{MARK}[{LABEL}{MARK}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9{MARK}]{{14,}}",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?={ACCOUNT})",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must have for the pattern to be tried.
NEEDS = {"email": None, "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]{2}-[0-9]"}
LENGTHS = "array<struct<gap:int,len:int,hit:string>>"
SPAN = "array<struct<start:int,kind:int,stop:int,hit:string>>"


#: Spans whose sums are taken together; code points of a piece of a text.
STRETCH, PIECE = 64, 512


def let(value: Column, body) -> Column:
    """body of a value that is evaluated once, however often and within whatever lambda it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: int, add) -> Column:
    """What add makes of all earlier values, at each place of an array of int; zero at the first."""
    none = F.array().cast("array<int>")
    fold = lambda part, start: F.aggregate(part, start, add)
    stretch = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRETCH).cast("int")), lambda i: F.slice(v, i * STRETCH + 1, F.lit(STRETCH)))
    step = lambda a, x: F.struct(add(a["last"], x).alias("last"), F.concat(a["out"], F.array(a["last"])).alias("out"))
    before = lambda parts: F.aggregate(F.transform(parts, lambda part: fold(part, F.lit(zero))), F.struct(F.lit(zero).alias("last"), none.alias("out")), step, lambda a: a["out"])
    each = lambda parts: F.flatten(F.zip_with(parts, before(parts), lambda part, start: F.transform(part, lambda _, i: fold(F.slice(part, F.lit(1), i), start))))
    return F.when(F.size(values) > 0, let(values, lambda v: let(stretch(v), each))).otherwise(none)


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(parts: Column, start: Column, stop: Column) -> Column:
    """Code points start (from 0) to stop of a text in pieces; what lies beyond its ends is empty."""
    a, b = F.floor(start / PIECE).cast("int"), F.floor((stop - 1) / PIECE).cast("int")
    at = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    inside = F.substring(at(a), start % PIECE + 1, stop - start)
    ends = F.concat(F.substring(at(a), start % PIECE + 1, F.lit(PIECE)), F.array_join(F.slice(parts, a + 2, F.greatest(b - a - 1, F.lit(0))), ""), F.substring(at(b), F.lit(1), (stop - 1) % PIECE + 1))
    return F.when(stop <= start, "").when(a == b, inside).otherwise(ends)


def proposed(text: Column, kind: str) -> Column:
    """Array of the lengths and hits that the pattern of a kind proposes, in order: gap before it, len, hit."""
    pattern, of = PATTERNS[kind], text
    if kind == "email":
        of = F.regexp_replace(F.translate(text, MARK, "\n"), rf"(?<=[{LABEL}])\.(?=[{LABEL}])", MARK)
    elif kind == "card":
        of = F.regexp_replace(F.translate(text, MARK, "\n"), "(?<=[0-9])[ -](?=[0-9])", MARK)
    between, hits = F.split(of, pattern, -1), F.regexp_extract_all(of, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(hits, F.slice(between, 1, F.greatest(F.size(between) - 1, F.lit(0))), lambda h, b: F.struct(F.length(b).alias("gap"), F.length(h).alias("len"), h.alias("hit")))
    needed = F.contains(text, F.lit("@")) if NEEDS[kind] is None else text.rlike(NEEDS[kind])
    return F.when(needed, lengths).otherwise(F.array().cast(LENGTHS))


def placed(lengths: Column, kind: str) -> Column:
    """Array of the spans of what is proposed."""
    earlier = running(F.transform(lengths, lambda x: x["gap"] + x["len"]), 0, lambda a, x: a + x)

    def span(x: Column, before: Column) -> Column:
        start = before + x["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + x["len"]).alias("stop"), x["hit"].alias("hit"))

    return F.zip_with(lengths, earlier, span)


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    bare = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4)), "")

    def add(rest: Column, c: Column) -> Column:
        return F.when(c == "", rest).when(c <= "9", (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(turned, F.lit(0), add) == 1


def whole_accounts(parts: Column, heads: Column) -> Column:
    """The spans of account numbers from those of their first four characters; a hit is empty where no number begins.

    Words that belong to no number may follow in upper case: of the parts that end before a space, or where all ends, and
    that mod 97 confirms, the one as long as its country's numbers are, or else the longest. Each beginning is tried, so
    that one number takes none of the next.
    """

    def whole(s: Column) -> Column:
        # 34 characters, a space before each of the last 30, and the character after
        words = F.split(F.regexp_extract(cut(parts, s["start"], s["start"] + 65), f"^.{{4}}{ACCOUNT}", 0), " ")
        heads = F.transform(words, lambda _, i: F.array_join(F.slice(words, F.lit(1), i + 1), " "))
        size = lambda p: F.length(F.replace(p, F.lit(" "), F.lit("")))
        good = F.filter(heads, lambda p: (size(p) >= 15) & mod_97(p))
        own = F.coalesce(*[F.when(F.substring(F.get(words, F.lit(0)), 1, 2).isin(codes), n) for n, codes in ACCOUNT_LENGTHS.items()])
        hit = F.coalesce(F.get(F.filter(good, lambda p: size(p) == own), F.lit(0)), F.get(good, F.size(good) - 1), F.lit(""))
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (s["start"] + F.length(hit)).alias("stop"), hit.alias("hit"))

    return F.transform(heads, whole)


def confirmed(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(hit, r"\."), lambda p: F.when(F.length(part(p)) > 3, False).otherwise(F.concat(F.lit("0"), part(p)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return hit != ""
    return F.lit(True)


def keeps(kind: str):
    return lambda span: confirmed(kind, span["hit"])


def score(kind: Column, parts: Column, start: Column, stop: Column) -> Column:
    """A kind's score, more if a word of its context stands within NEAR code points before or after."""
    near = F.lower(F.concat(cut(parts, F.greatest(start - NEAR, F.lit(0)), start), F.lit(" "), cut(parts, stop, stop + NEAR)))
    base, known = F.lit(None).cast("double"), F.lit(False)
    for i, k in enumerate(KINDS):  # a pattern for each kind: one that isn't constant would be compiled anew for each span
        base, known = F.when(kind == i, SCORES[k]).otherwise(base), F.when(kind == i, F.regexp_like(near, F.lit(rf"\b(?:{CONTEXT[k]})\b"))).otherwise(known)
    return F.least(F.lit(1.0), base + F.when(known, CONTEXT_ADDS).otherwise(0.0))


def found(docs: DataFrame) -> DataFrame:
    """row (the input's columns), t (the text), parts (it in pieces, where something is proposed), found: array of start, kind,
    stop, score by start, then kind."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    for k in KINDS:
        rows = rows.withColumn(f"l_{k}", proposed(F.col("t"), k))
    some = F.greatest(*[F.size(f"l_{k}") for k in KINDS]) > 0
    rows = rows.withColumn("parts", F.when(some, pieces(F.col("t"))))
    for k in KINDS:
        rows = rows.withColumn(f"p_{k}", F.when(F.size(f"l_{k}") > 0, placed(F.col(f"l_{k}"), k)).otherwise(F.array().cast(SPAN)))
    rows = rows.withColumn("p_iban", whole_accounts(F.col("parts"), F.col("p_iban")))
    every = F.concat(*[F.filter(f"p_{k}", keeps(k)) for k in KINDS])
    rows = rows.withColumn("all", F.when(F.col("parts").isNotNull(), every).otherwise(F.array().cast(SPAN))).select("row", "t", "parts", "all")
    scored = F.transform("all", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"), score(s["kind"], F.col("parts"), s["start"], s["stop"]).alias("score")))
    return rows.select("row", "t", "parts", F.array_sort(F.filter(scored, lambda s: (s["kind"] < BASE) | (s["score"] >= KEEP_FROM))).alias("found"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def reported(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores of every whole text of docs(doc_id, text)."""
    rows = found(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
        F.sha2(joined(F.filter("found", lambda s: s["kind"] < BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """docs with each span (overlapping ones as one) replaced by its kind in brackets; n_chars, where there is one, anew."""
    rows = found(docs)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    # a span that begins before an earlier one's end is part of that one's stretch, which ends where the last of them does
    rows = rows.withColumn("reached", running(F.transform("found", lambda s: s["stop"]), 0, lambda a, x: F.greatest(a, x)))
    heads = F.filter(F.arrays_zip(F.col("found"), F.col("reached")), lambda x: x["found"]["start"] >= x["reached"])
    rows = rows.withColumn("heads", heads)
    kept = F.transform("heads", lambda h: F.concat(cut(F.col("parts"), h["reached"], h["found"]["start"]), F.element_at(names, h["found"]["kind"] + 1)))
    last = F.array_max(F.transform("found", lambda s: s["stop"]))
    whole = F.concat(F.array_join(kept, ""), cut(F.col("parts"), last, F.length("t")))
    rows = rows.withColumn("new", F.when(F.size("found") > 0, whole).otherwise(F.col("row.text")))
    given = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        given["n_chars"] = F.when(F.size("found") > 0, F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*[given.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
