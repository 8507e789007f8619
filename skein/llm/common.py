"""What several corpus operators share: reading, cutting lineage, hashed order within groups."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Letters and numbers of the regex module's Unicode that the tokenizers' libraries don't know yet and take for neither
#: (fixed values, code points and ranges in hexadecimal).
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A "
    "11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 "
    "18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)


class Splitter:
    """All matches of a pattern in a text, by the classes of the libraries: NEWER characters are neither letters nor numbers."""

    def __init__(self, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.findall = self.pattern.findall
        ends = [[int(e, 16) for e in r.split("-")] for r in NEWER.split()]
        self.newer = re.compile("[" + "".join(f"{chr(r[0])}-{chr(r[-1])}" for r in ends) + "]")
        self.has_newer = self.newer.search

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.has_newer(text) is None:
            return self.findall(text)
        # a private character stands for each where the pattern looks
        return [text[m.start() : m.end()] for m in self.pattern.finditer(self.newer.sub("\ue000", text))]


#: Distinct sources up to which their table (some 100 bytes each) is broadcast instead of joined by a shuffle.
BROADCAST_SOURCES = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; only where the cluster names none, a local one (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="skein-shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts its lineage, survives lost executors, gone when the JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/skein-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> Iterator[None]:
    """Arrow batches of so many rows and bytes for what runs inside, however long its texts and sets are."""
    new = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    old = {name: spark.conf.get(name) for name in new}
    for name, value in new.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


def unit_hash(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone; the same in any SQL engine with md5()."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_per_source(slim: DataFrame, *sums: Column) -> list:
    """One row for each source of slim(source, ...), by code points, null last: a table that the driver holds."""
    rows = slim.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    return sorted(rows, key=lambda r: (r.source is None, r.source or ""))


def with_sources(slim: DataFrame, sources: list[tuple], schema: str) -> DataFrame:
    """slim with the columns of its source's row in sources, whose schema names `source`."""
    known = slim.sparkSession.createDataFrame(sources, schema)
    return slim.join(F.broadcast(known) if len(sources) <= BROADCAST_SOURCES else known, slim.source.eqNullSafe(known.source)).drop(known.source)


def hashed_prefix(slim: DataFrame, value: str, rows_per_bucket: int = 1024, wide: int = 4096) -> DataFrame:
    """slim(sid, n, u, ...) with `before`: the sum of value over the rows of its sid that come earlier by (u, tie columns).

    A source, however large, falls into n / rows_per_bucket buckets of its hashed order. The rows of a bucket are summed in
    a task of their own, the sums of `wide` buckets in one, and then the sums of these.
    """
    from pyspark.sql import Window

    ties = [c for c in ("doc_id", "size", "text_crc32") if c in slim.columns]
    cut = slim.withColumn("b", F.floor(F.col("u") * F.ceil(F.col("n") / F.lit(rows_per_bucket))).cast("long"))
    sums = cut.groupBy("sid", "b").agg(F.sum(value).alias("inside")).withColumn("bb", F.floor(F.col("b") / F.lit(wide)).cast("long"))
    earlier = lambda *of, by: Window.partitionBy(*of).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    far = sums.groupBy("sid", "bb").agg(F.sum("inside").alias("x")).select("sid", "bb", F.coalesce(F.sum("x").over(earlier("sid", by="bb")), F.lit(0)).alias("far"))
    sums = sums.withColumn("near", F.coalesce(F.sum("inside").over(earlier("sid", "bb", by="b")), F.lit(0))).join(far, ["sid", "bb"])
    sums = sums.select("sid", "b", (F.col("far") + F.col("near")).alias("below"))
    within = Window.partitionBy("sid", "b").orderBy("u", *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = cut.withColumn("inside", F.sum(value).over(within) - F.col(value))
    return cut.join(sums, ["sid", "b"]).withColumn("before", F.col("below") + F.col("inside")).drop("b", "inside", "below")
