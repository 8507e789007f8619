"""Quality rules on whole texts, in DataFrame functions alone.

Base rules look at one document. The method's verdict compares it with the corpus: hashed n-grams (runs of NGRAM whole
words) are counted once over the trusted target and once over the raw corpus, each document giving each of its n-grams
once; a document's score is the mean over its n-grams, repetitions included, of log p(n-gram | target) - log p(n-gram | raw),
and every document is kept or not by one fixed threshold. What the document itself gave is left out of both counts, so no
trusted text speaks for itself; SMOOTH occurrences in the target's share stand for those not seen, so an n-gram that no
other document has, or a small target, speaks for neither side, at every size of the corpus.

Cases: null and empty texts have no words and fail the base rules; without trusted rows the method objects to nothing;
repeated rows are judged each for itself, all alike; an empty table gives an empty table; columns of the input, whatever
their names, are carried in a struct `row` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Buckets of n-grams; mean log ratio from which a text is kept.
BUCKETS, KEEP_FROM = 1 << 16, -0.25
#: Words of an n-gram, and occurrences added to the raw count of each. (Pairs of words are mostly seen once in such texts and
#: told 25 % of the junk of a table of 10,000 texts from clean texts where single words told 70 %.)
NGRAM, SMOOTH = 1, 4.0
#: Trusted rows up to which their ids are broadcast instead of shuffling n-grams.
BROADCAST_IDS = 500_000
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window whose repetition counts.
WINDOW = 5


def words_of(text) -> F.Column:
    """Array of the words of a text that is not null."""
    return F.regexp_extract_all(text, F.lit(C.WORD), F.lit(0))


def grams(words: str) -> F.Column:
    """A bucket for each word: that of the n-gram it begins (of fewer words at the end)."""
    if NGRAM == 1:
        return F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(BUCKETS)))
    return F.transform(words, lambda w, i: F.pmod(F.hash(w, *[F.get(words, i + k) for k in range(1, NGRAM)]), F.lit(BUCKETS)))


def with_words(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return rows.withColumn("w", words_of(F.col("t")))


def with_grams(rows: DataFrame) -> DataFrame:
    return rows.withColumn("grams", grams("w"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every row labelled good: the trusted target."""
    return labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()


def marked(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """rows with `good`: whether the id of `row` is trusted; trusted ids are broadcast up to a counted number."""
    if trusted.count() <= BROADCAST_IDS:
        trusted = F.broadcast(trusted)
    rows = rows.join(trusted, F.col("row.doc_id").cast("long") == F.col("trusted_id"), "left")
    return rows.withColumn("good", F.col("trusted_id").isNotNull()).drop("trusted_id")


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with two arrays, others and own: the log ratio of each bucket for a document that has it, without that
    document's own occurrence, if it is not trusted and if it is; null without a trusted row."""
    some = with_grams(marked(with_words(docs.select("doc_id", "text")), trusted))
    each = some.select(F.col("good").cast("long").alias("good"), F.explode_outer(F.array_distinct("grams")).alias("bucket"))
    # explode_outer: for explode() the optimizer infers a filter on the array's size and evaluates it anew, word by word
    counts = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    # a row for each bucket, then one row: BUCKETS is all that ever meets in a task
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0, ["raw", "good"])
    one = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("c"), F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))
    one = one.withColumn("share", F.try_divide(F.col("all_good"), F.col("all_raw")))  # null for a table without words

    def ratio(own: int) -> F.Column:
        good, raw = lambda x: F.greatest(x["good"] - own, F.lit(0)), lambda x: F.greatest(x["raw"] - 1, F.lit(0))
        return F.transform("c", lambda x: F.log((good(x) + SMOOTH * F.col("share")) / ((raw(x) + SMOOTH) * F.col("share"))))

    return one.select(F.when(F.col("all_good") > 0, F.struct(ratio(0).alias("others"), ratio(1).alias("own"))).alias("ratios"))


def judged(docs: DataFrame, trusted: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """row (the input's columns), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept."""
    rows = marked(with_words(docs), trusted).withColumn("n", F.size("w"))
    lines = F.filter(F.split("t", "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\f\r")) != "")
    rows = rows.withColumn("lines", lines)
    window = F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    rows = with_grams(rows.withColumn("windows", F.when(F.col("n") >= WINDOW, window)))
    rows = rows.withColumn("again", F.size(F.array_distinct("windows")) < F.size("windows"))
    # only where a window occurs twice: windows in order of their hash, those with an equal neighbour, by position
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("placed", F.when(F.col("again"), placed))
    twice = F.filter("placed", lambda x, j: F.coalesce(F.get("placed", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("placed", j + 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("twice", F.when(F.col("again"), F.array_sort(F.transform(twice, lambda x: x["i"]))))
    covered = F.aggregate(F.transform("twice", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("twice", k + 1) - i, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    of = lambda side: F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get(F.col("ratios")[side], b))
    total = F.when(F.col("good"), of("own")).otherwise(of("others"))
    # a scalar subquery right below its only use: it goes into the expression, and its array is never copied into rows
    rows = rows.withColumn("ratios", log_ratios(docs, trusted).scalar()).select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("again"), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.coalesce(F.when(F.size("grams") > 0, total / F.size("grams")), F.lit(0.0)).alias("llr"),
    )
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= keep_from))


def kept_rows(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """docs without those that the rules or the verdict reject."""
    # a filter would be moved below the projections and evaluate all they share once for each use; it isn't moved below
    # a projection with a column that is not deterministic, as long as it uses that column
    rows = judged(docs, trusted).withColumn("at", F.monotonically_increasing_id())
    return rows.where(F.col("kept") & (F.col("at") >= 0)).select("row.*")
