"""The catalogue of queries over the driver's tables, each with SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.functions import geometry as G
from skein.functions import hashing as H
from skein.functions import text as T
from skein.functions import vectors as V
from skein.operators import graph, layout, raster
from skein.operators import relations as R
from skein.operators import allocation, verdicts
from skein.operators.tables import new_folder, written
from skein.plans import floor_plans, generators, library
from skein.sinks import records
from skein.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Vocabularies of the queries, which occur in the driver's tables.
COLOURS = ("red", "blue", "hot", "old", "small", "large")
SIZES = (("small", "minor"), ("large", "major"), ("hot", "active"), ("old", "worn"))
RULES = ((r"\b(?:ring|bolt)s?\b", ("fastener", "metal")), (r"\b(?:gear|plate)s?\b", ("machine", "metal")), (r"\b(?:widget|gizmo)s?\b", ("gadget",)), (r"\bred\b", ("painted",)), (r"\banvil\b", ("tool", "metal")))
LICENSES = ("apache", "gnu general", "creative commons", "mit license")
STOPWORDS = ("that", "with", "from", "this", "which")
WORD4 = "[a-z][a-z\\-]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a query and its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- coverage and audits -------------------------------------------------------------------------------------------

_COVERAGE = """SELECT source, count(*) AS n, count(l.doc_id) AS labelled, count(*) FILTER (WHERE quality = 1) AS good,
 round(100.0::DOUBLE * count(l.doc_id) / count(*), 4) AS pct_labelled, round(100.0::DOUBLE * count(*) FILTER (WHERE quality = 1) / count(*), 4) AS pct_good
 FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source"""


@query(_COVERAGE)
def coverage_report(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(1).alias("there")), "doc_id", "left")
    return R.coverage(rows, "source", {"labelled": F.col("there").isNotNull(), "good": F.col("quality") == 1})


@query(f"""WITH r AS ({_COVERAGE}) SELECT sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS labelled, sum(good)::BIGINT AS good, count(*) AS groups,
 round(100.0::DOUBLE * sum(labelled) / sum(n), 4) AS pct_labelled, round(100.0::DOUBLE * sum(good) / sum(n), 4) AS pct_good FROM r""")
def coverage_totals(spark, sf_dir):
    return R.grand_total(coverage_report(spark, sf_dir), ["labelled", "good"])


_VERDICT = r"""SELECT p_partkey, CASE WHEN p_name = 'red widget' THEN 'nullify' WHEN regexp_matches(p_name, '^old ') THEN 'nullify' WHEN regexp_matches(p_name, 'gizmo$') THEN 'nullify' ELSE 'keep' END AS verdict,
 CASE WHEN p_name = 'red widget' THEN 'exact_generic' WHEN regexp_matches(p_name, '^old ') THEN 'worn' WHEN regexp_matches(p_name, 'gizmo$') THEN 'gadget' END AS reason FROM part"""
_NAME_RULES = [("worn", "^old "), ("gadget", "gizmo$")]


@query(_VERDICT)
def name_verdicts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", verdicts.name_verdict(F.col("p_name"), ["red widget"], _NAME_RULES).alias("v")).select("p_partkey", "v.verdict", "v.reason")


@query(f"SELECT verdict, reason, count(*) AS n FROM ({_VERDICT}) GROUP BY verdict, reason")
def verdict_histogram(spark, sf_dir):
    return name_verdicts(spark, sf_dir).groupBy("verdict", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT p.p_partkey, CASE WHEN verdict = 'keep' THEN p_name END AS p_name FROM part p JOIN ({_VERDICT}) v USING (p_partkey)")
def nullified_names(spark, sf_dir):
    bad = verdicts.name_verdict(F.col("p_name"), ["red widget"], _NAME_RULES)["verdict"] == "nullify"
    return records.nullified(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", bad)


@query("SELECT coalesce(quality::VARCHAR, 'null') AS quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def quality_distribution(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return R.histogram(rows, F.col("quality"), "quality")


_CANON = "trim(regexp_replace(' ' || p_name || ' ', ' (red|blue|hot|old|small|large) ', ' ', 'g'))"


@query(f"SELECT p_partkey, {_CANON} AS canonical FROM part")
def canonical_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.canonical_name(F.col("p_name"), COLOURS).alias("canonical"))


@query(f"SELECT {_CANON} AS canonical, count(*) AS members, min(p_partkey) AS first_key FROM part GROUP BY 1")
def name_clusters(spark, sf_dir):
    key = F.coalesce(F.nullif(F.col("canonical"), F.lit("")), F.concat(F.lit("__unclassified:"), F.col("p_partkey")))
    return canonical_names(spark, sf_dir).groupBy(key.alias("canonical")).agg(F.count(F.lit(1)).alias("members"), F.min("p_partkey").alias("first_key"))


@query(f"""WITH c AS (SELECT {_CANON} AS canonical, p_name, count(*) AS c, min(p_partkey) AS f FROM part GROUP BY 1, 2)
 SELECT canonical, arg_max(p_name, c * 1000000000 - f) AS p_name, sum(c)::BIGINT AS members FROM c GROUP BY canonical""")
def cluster_names(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", T.canonical_name(F.col("p_name"), COLOURS).alias("canonical"))
    return R.mode_first_seen(rows, "canonical", "p_name", "p_partkey")


_TAGS = """SELECT p_partkey, list_distinct_ordered AS tags FROM (SELECT p_partkey, array_to_string(list_filter(
 list_concat(CASE WHEN regexp_matches(p_name, '\\b(ring|bolt)s?\\b') THEN ['fastener','metal'] ELSE [] END, CASE WHEN regexp_matches(p_name, '\\b(gear|plate)s?\\b') THEN ['machine','metal'] ELSE [] END,
 CASE WHEN regexp_matches(p_name, '\\b(widget|gizmo)s?\\b') THEN ['gadget'] ELSE [] END, CASE WHEN regexp_matches(p_name, '\\bred\\b') THEN ['painted'] ELSE [] END,
 CASE WHEN regexp_matches(p_name, '\\banvil\\b') THEN ['tool','metal'] ELSE [] END), lambda x: x <> ''), ',') AS list_distinct_ordered FROM part)""".replace("\\\\", "\\")


@query(_TAGS)
def category_tags(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(T.categories(F.col("p_name"), RULES), ",").alias("tags"))


@query(f"SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM ({_TAGS})) WHERE tag IN ('metal', 'gadget', 'painted', 'tool') GROUP BY tag")
def tag_histogram(spark, sf_dir):
    tags = table(spark, sf_dir, "part").select(F.explode(T.categories(F.col("p_name"), RULES)).alias("tag"))
    allowed = spark.createDataFrame([("metal",), ("gadget",), ("painted",), ("tool",)], "tag string")
    return tags.join(F.broadcast(allowed), "tag", "left_semi").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT doc_id, count(DISTINCT w) AS n_words, sum(length(w)) FILTER (WHERE rn = 1)::BIGINT AS letters FROM (
 SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id, w) AS rn FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD4}')) AS w FROM documents)
 WHERE length(w) >= 4 AND w NOT IN ('that', 'with', 'from', 'this', 'which')) GROUP BY doc_id""")
def caption_words(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("doc_id", T.content_words(F.col("text"), STOPWORDS).alias("w")).where(F.size("w") > 0)
    return words.select("doc_id", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("letters"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'small') THEN 'minor' WHEN contains(p_name, 'large') THEN 'major' WHEN contains(p_name, 'hot') THEN 'active' WHEN contains(p_name, 'old') THEN 'worn' END AS first_state,
 CASE WHEN contains(p_name, 'old') THEN 'worn' WHEN contains(p_name, 'hot') THEN 'active' WHEN contains(p_name, 'large') THEN 'major' WHEN contains(p_name, 'small') THEN 'minor' END AS worst_state FROM part""")
def keyword_states(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", T.first_keyword(name, SIZES).alias("first_state"), T.worst_keyword(name, SIZES, ("worn", "active", "major", "minor")).alias("worst_state"))


@query(f"""WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_extract_all(lower(text), '{WORD4}'), lambda w: length(w) >= 4)) AS w FROM conversations),
 p AS (SELECT a.conv_id, CASE WHEN len(list_distinct(list_concat(a.w, b.w))) = 0 THEN 0.0 ELSE len(list_intersect(a.w, b.w))::DOUBLE / len(list_distinct(list_concat(a.w, b.w))) END AS j FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn < b.turn),
 m AS (SELECT conv_id, count(*) AS members FROM t GROUP BY conv_id HAVING count(*) >= 2),
 s AS (SELECT e.conv_id, count(*) AS shared FROM (SELECT conv_id, x, count(*) AS c FROM (SELECT conv_id, unnest(w) AS x FROM t) GROUP BY ALL) e JOIN m ON e.conv_id = m.conv_id AND e.c = m.members GROUP BY 1)
 SELECT m.conv_id, members, round(min(j), 6) AS least, round(max(j), 6) AS largest, round(avg(j), 6) AS mean, count(*) AS pairs, coalesce(any_value(shared), 0) AS shared, min(j) < 0.4 AND coalesce(any_value(shared), 0) < 2 AS flagged
 FROM m JOIN p USING (conv_id) LEFT JOIN s USING (conv_id) GROUP BY m.conv_id, members""")
def group_overlap_audit(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.content_words(F.col("text"), ()).alias("w"))
    out = R.overlap_audit(rows, "conv_id", "turn", "w")
    return out.withColumn("flagged", R.flagged(0.4)).withColumns({c: F.round(c, 6) for c in ("least", "largest", "mean")})


# ---- joins, sync, dedup --------------------------------------------------------------------------------------------


@query("""WITH a AS (SELECT doc_id, source || '_' || (doc_id % 7)::VARCHAR || '_x' AS name FROM documents), s AS (SELECT DISTINCT source AS sheet FROM documents UNION SELECT DISTINCT source || '_3' FROM documents)
 SELECT a.doc_id, a.name, arg_max(s.sheet, length(s.sheet)) AS sheet FROM a JOIN s ON starts_with(a.name, s.sheet || '_') GROUP BY a.doc_id, a.name""")
def longest_prefix_sheet(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = docs.select("doc_id", F.concat_ws("_", "source", (F.col("doc_id") % 7).cast("string"), F.lit("x")).alias("name"))
    sheets = docs.select(F.col("source").alias("sheet")).distinct()
    sheets = sheets.unionByName(sheets.select(F.concat("sheet", F.lit("_3")).alias("sheet")))
    return R.longest_prefix(rows, "name", sheets, "sheet").select("doc_id", "name", "sheet")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_outputs(spark, sf_dir):
    return R.missing(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT coalesce(s.k, t.k) AS doc_id, CASE WHEN t.k IS NULL THEN 'link' WHEN s.k IS NULL THEN 'prune' WHEN s.h = t.h THEN 'skip' ELSE 'replace' END AS action
 FROM (SELECT doc_id AS k, md5(text) AS h FROM documents WHERE doc_id % 5 <> 0) s FULL JOIN (SELECT doc_id AS k, md5(CASE WHEN doc_id % 3 = 0 THEN text ELSE text || 'x' END) AS h FROM documents WHERE doc_id % 2 = 0) t ON s.k = t.k""")
def mirror_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    old = F.md5(F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat("text", F.lit("x"))))
    return records.mirror_plan(docs.where("doc_id % 5 <> 0").select("doc_id", F.md5("text").alias("h")), docs.where("doc_id % 2 = 0").select("doc_id", old.alias("h")), "doc_id", "h")


@query("""SELECT h AS digest, arg_min(path, rank * 100000000 + doc_id) AS path, count(*) AS copies FROM (SELECT doc_id, md5(text) AS h, source || '/' || lpad(doc_id::VARCHAR, 9, '0') AS path, CASE WHEN source = 'src3' THEN 0 ELSE 1 END AS rank FROM documents) GROUP BY h
 """.replace("rank * 100000000 + doc_id", "{'r': rank, 'p': path}"))
def byte_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.md5("text").alias("digest"), F.concat_ws("/", "source", F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("path"), F.when(F.col("source") == "src3", 0).otherwise(1).alias("rank"))
    return R.byte_survivors(rows, "digest", F.col("rank"), "path")


@query("SELECT doc_id, CASE WHEN k.h IS NULL THEN 'new' ELSE 'known' END AS status, k.path FROM documents d LEFT JOIN (SELECT md5(text) AS h, min(item_id) AS path FROM benchmark GROUP BY 1) k ON md5(d.text) = k.h")
def known_hashes(spark, sf_dir):
    held = table(spark, sf_dir, "benchmark").select(F.md5("text").alias("h"), F.col("item_id").alias("path"))
    return R.known(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h")), "h", held, "path").select("doc_id", "status", "path")


@query("SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) = 1")
def first_wins_binding(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")
    return R.first_wins(rows, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("SELECT p_brand, p_partkey, nth FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey)::INT AS nth FROM part) WHERE nth <= 5")
def quota_per_group(spark, sf_dir):
    return R.quota(table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 5).drop("p_retailprice")


@query("SELECT c_custkey, n_name, coalesce(r_name, 'nowhere') AS r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey")
def lookup_with_default(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region").where("r_name <> 'ASIA'")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return R.looked_up(rows, "n_regionkey", region, "r_regionkey", "r_name", "nowhere").select("c_custkey", "n_name", "r_name")


@query("SELECT l_orderkey, min(priority) AS priority, arg_min(path, {'k': priority, 'p': path}) AS path FROM (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS priority, lpad(l_partkey::VARCHAR, 9, '0') AS path FROM lineitem) GROUP BY l_orderkey")
def ranked_references(spark, sf_dir):
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", rank.alias("priority"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("path"))
    return R.ranked_candidates(rows, "l_orderkey", "priority", "path")


@query("SELECT coalesce(o.k, c.k) AS k, CASE WHEN o.k IS NULL THEN 'no_asset' WHEN c.k IS NULL THEN 'no_record' ELSE 'both' END AS status FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey % 3 > 0) o FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 > 0) c ON o.k = c.k")
def reconciled(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("k"))
    return R.reconcile(orders, table(spark, sf_dir, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").alias("k")), "k")


@query("SELECT p_partkey, name, state FROM (SELECT p_partkey, p_name AS name, CASE WHEN p_size < 10 THEN 'small' END AS state FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, NULL, 'new' FROM part WHERE p_partkey % 3 <> 0)")
def inserted_records(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    old = part.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_name").alias("name"), F.when(F.col("p_size") < 10, "small").alias("state"))
    return records.inserted_if_absent(part.select("p_partkey"), old, "p_partkey", {"name": F.lit(None).cast("string"), "state": F.lit("new")})


@query("SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'STANDARD' ELSE p_type END AS p_type FROM part")
def recoded_types(spark, sf_dir):
    return records.recoded(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type", ["SMALL", "MEDIUM"], "STANDARD")


@query("SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'good' END, d.source) AS source FROM documents d LEFT JOIN labels l USING (doc_id)")
def upserted_field(spark, sf_dir):
    new = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("source"))
    return records.upserted(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", new, "source")


@query("SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'SUPPLIER', count(*) FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def set_operations(spark, sf_dir):
    segments = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    rest = table(spark, sf_dir, "supplier").select("s_nationkey").subtract(table(spark, sf_dir, "nation").where("n_regionkey = 1").select("n_nationkey"))
    return segments.unionByName(rest.agg(F.count(F.lit(1)).alias("n")).select(F.lit("SUPPLIER").alias("c_mktsegment"), "n"))


@query("""WITH RECURSIVE o AS (SELECT s_nationkey * 10 + l_linenumber AS bin, l_partkey AS item, min(l_orderkey) AS place FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag <> 'R' AND l_partkey % 50 > 0 GROUP BY 1, 2),
 b AS (SELECT bin, list(item ORDER BY place, item) AS items, row_number() OVER (ORDER BY bin) AS k FROM o GROUP BY bin),
 s AS (SELECT 0::BIGINT AS k, 0::BIGINT AS bin, []::BIGINT[] AS taken, []::BIGINT[] AS got UNION ALL
 SELECT b.k, b.bin, list_concat(t, g), g FROM (SELECT b.k, b.bin, s.taken AS t, list_filter(b.items, lambda x: NOT list_contains(s.taken, x))[1:5] AS g FROM s JOIN b ON b.k = s.k + 1) b)
 SELECT bin, unnest(got) AS item FROM s WHERE k > 0""")
def sequential_quota(spark, sf_dir):
    """Each nation's line numbers take, in turn, five parts that no earlier one has: first come, first served against a quota."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select((F.col("s_nationkey") * 10 + F.col("l_linenumber")).cast("long").alias("bin"), F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("place"))
    offers = rows.groupBy("bin", "item").agg(F.min("place").alias("place"))
    taken = table(spark, sf_dir, "part").where("p_partkey % 50 = 0").select(F.col("p_partkey").alias("item"))
    return allocation.allocated(offers, "bin", "item", ["place"], 5, taken).select("bin", "item")


# ---- sequences, windows, jobs --------------------------------------------------------------------------------------

_AXES = {"state": ("intact", "worn", "broken"), "angle": ("top", "side")}


@query("""SELECT n_name AS folder, v AS variant, seq, (['intact','worn','broken'])[seq % 3 + 1] AS state, (['top','side'])[seq % 2 + 1] AS angle FROM (
 SELECT n_name, v, row_number() OVER (ORDER BY n_nationkey, v) - 1 AS seq FROM nation, (SELECT unnest([1, 2, 3]) AS v) WHERE n_regionkey <> 2)""")
def round_robin_jobs(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("folder"), F.lit(3).alias("variants"))
    return generators.jobs("rotation", nation, axes=_AXES).select("folder", "variant", "seq", "state", "angle")


@query("""SELECT n_name AS folder, v AS variant, seq, (['intact','worn','broken'])[seq % 3 + 1] AS state, lower(n_name) || '_' || lpad((seq + 1)::VARCHAR, 3, '0') AS label FROM (
 SELECT n_name, v, row_number() OVER (ORDER BY v, n_nationkey) - 1 AS seq FROM nation, (SELECT unnest([1, 2, 3]) AS v))""")
def interleaved_jobs(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("folder"), F.lit(3).alias("variants"))
    return generators.jobs("interleaved", nation, axes={"state": _AXES["state"]}).select("folder", "variant", "seq", "state", "label")


@query("""SELECT r_name AS folder, t.treatment, t.i::BIGINT AS seq, (['n','e','s','w'])[t.i % 4 + 1] AS angle, CASE WHEN t.i < 3 THEN 'v1' ELSE 'v2' END AS version FROM region,
 (SELECT unnest([0,1,2,3,4]) AS i, unnest(['etched','gilt','worn','lit','dark']) AS treatment) t""")
def treatment_jobs(spark, sf_dir):
    lists = [F.array(*[F.lit(t) for t in ts]) for ts in (("etched", "gilt", "worn"), ("lit", "dark"))]
    symbols = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("ord"), F.col("r_name").alias("folder"), lists[0].alias("common"), lists[1].alias("extra"))
    return generators.jobs("treatments", symbols, axes={"angle": ("n", "e", "s", "w")}, first=("common",), second=("extra",)).select("folder", "treatment", "seq", "angle", "version")


_SECTIONS = [("bow_full", ("bow_port", "bow_mid")), ("aft_full", ("aft_port", "aft_mid"))]


@query("""SELECT n_nationkey AS ord, CASE WHEN n_nationkey % 2 = 0 THEN '  - bow_full (whole bow): all of ' || n_name || '.' ELSE '  - bow_port (bow_port): left ' || n_regionkey || '.' END || chr(10) || '  - aft_mid (r' || n_regionkey || '): core.' AS block,
 CASE WHEN n_nationkey % 2 = 0 THEN 'bow_full=all of ' || n_name || ' | ' ELSE '' END || 'bow_port=left ' || n_regionkey || ' | aft_mid=core' AS summary FROM nation""")
def zone_blocks(spark, sf_dir):
    zones = F.create_map(F.lit("bow_port"), F.concat(F.lit("left "), F.col("n_regionkey")), F.lit("aft_mid"), F.lit("core"), F.lit("bow_full"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("all of "), F.col("n_name"))))
    positions = F.create_map(F.lit("bow_full"), F.lit("whole bow"), F.lit("aft_mid"), F.concat(F.lit("r"), F.col("n_regionkey")))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("folder"), zones.alias("zones"), positions.alias("positions"))
    return generators.jobs("layouts", rows, axes={"light": ("dim", "bright")}, sections=_SECTIONS).select("ord", "block", "summary")


@query("""SELECT total, total - to_do AS skipped, to_do, paid, to_do - paid AS staged, round(paid * 0.04::DOUBLE, 2) AS cost, round(paid * 0.04::DOUBLE, 2) <= 8.0 AS admitted FROM (SELECT count(*) AS total, count(*) FILTER (WHERE l.doc_id IS NULL) AS to_do,
 count(*) FILTER (WHERE l.doc_id IS NULL AND d.doc_id % 2 = 0) AS paid FROM documents d LEFT JOIN labels l USING (doc_id))""")
def job_plan(spark, sf_dir):
    jobs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("label"))
    return generators.plan(jobs, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label")), 0.04, 8.0, F.col("label") % 2 == 0)


@query("""SELECT s_suppkey, least(greatest(want - made, 0), greatest(150 - coalesce(sum(greatest(want - made, 0)) OVER (ORDER BY s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0))::BIGINT AS to_make
 FROM (SELECT s_suppkey, s_nationkey::BIGINT AS want, s_suppkey % 4 AS made FROM supplier)""")
def pool_budget(spark, sf_dir):
    plan = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("want"), (F.col("s_suppkey") % 4).alias("made"))
    return R.budgeted(plan, "s_suppkey", "want", "made", 150).select("s_suppkey", "to_make")


@query("""WITH b AS (SELECT user_id, event_id, (event_id % 997)::DOUBLE AS top, (event_id % 997 + 4 + event_id % 7)::DOUBLE AS bottom, (event_id % 89)::DOUBLE AS lft FROM events),
 t AS (SELECT user_id, greatest(median(bottom - top) * 0.5, 1.0) AS tol FROM b GROUP BY 1),
 g AS (SELECT b.*, tol, (top + bottom) / 2 - lag((top + bottom) / 2) OVER (PARTITION BY b.user_id ORDER BY (top + bottom) / 2, lft, event_id) AS gap FROM b JOIN t USING (user_id)),
 n AS (SELECT *, sum(CASE WHEN coalesce(gap, 0) > tol THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY (top + bottom) / 2, lft, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS band FROM g)
 SELECT user_id, max(band) AS bands, count(*) AS boxes FROM n GROUP BY user_id""")
def row_band_counts(spark, sf_dir):
    e = F.col("event_id")
    boxes = table(spark, sf_dir, "events").select("user_id", (e % 997).cast("double").alias("top"), (e % 997 + 4 + e % 7).cast("double").alias("bottom"), (e % 89).cast("double").alias("left"))
    return R.row_bands(boxes, "user_id", "top", "bottom", "left").groupBy("user_id").agg(F.max("band").alias("bands"), F.count(F.lit(1)).alias("boxes"))


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k, greatest(floor(count(*) OVER (PARTITION BY source) / 15), 1)::BIGINT AS step FROM documents) WHERE k % step = 0")
def even_sample(spark, sf_dir):
    return R.even_sample(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 15)


@query("SELECT o_orderpriority, o_orderkey, rank FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 20")
def top_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return R.quota(rows, ["o_orderpriority"], [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderpriority", "o_orderkey", F.col("nth").alias("rank"))


# ---- packs, identifiers, contracts ---------------------------------------------------------------------------------


@query("SELECT p_partkey, left(md5(p_name || '_' || p_partkey), 16) AS id FROM part")
def pack_ids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", H.short_id(F.concat_ws("_", "p_name", F.col("p_partkey").cast("string"))).alias("id"))


_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


@query(f"SELECT p_brand, left(sha1(string_agg(p_name, '|' ORDER BY p_name)), 16) AS digest, count(*) AS members FROM part GROUP BY p_brand")
def member_digests(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(H.member_digest(F.collect_list("p_name")).alias("digest"), F.count(F.lit(1)).alias("members"))


@query(f"""SELECT p_partkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || (['8','9','a','b'])[('0x' || substr(h, 17, 1))::INT % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id
 FROM (SELECT p_partkey, sha1(unhex('{_NAMESPACE.replace('-', '')}') || encode(p_name)) AS h FROM part)""")
def stable_uuids(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", H.uuid5(_NAMESPACE, F.col("p_name")).alias("id"))


@query("""SELECT p_partkey, p_name || ' — ' || CASE WHEN contains(p_name, st) THEN o ELSE st || ', ' || o END AS name, array_to_string(list_concat(string_split(p_name, ' '), [CASE WHEN o = 'iso' THEN o ELSE 'facing-' || o END, 'state-' || st, 'group:' || p_brand]), ';') AS tags
 FROM (SELECT *, CASE WHEN p_size % 2 = 0 THEN 'old' ELSE 'new' END AS st, (['north','south','iso'])[p_size % 3 + 1] AS o FROM part)""")
def display_presets(spark, sf_dir):
    state = F.when(F.col("p_size") % 2 == 0, "old").otherwise("new")
    facing = F.element_at(F.array(F.lit("north"), F.lit("south"), F.lit("iso")), F.col("p_size") % 3 + 1)
    name = T.display_name(F.col("p_name"), F.lit("stem"), state, facing)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), F.array_join(T.preset_tags(F.split("p_name", " "), facing, state, F.col("p_brand")), ";").alias("tags"))


_CHECKS = """SELECT event_id AS id, 'error' AS level, 'value is negative' AS message FROM events WHERE value < 1 UNION ALL SELECT event_id, 'error', 'k is missing' FROM events WHERE try_cast(json_extract_string(props, '$.k') AS INT) IS NULL
 UNION ALL SELECT event_id, 'warning', 'k is large' FROM events WHERE try_cast(json_extract_string(props, '$.k') AS INT) > 90"""


@query(_CHECKS)
def contract_violations(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("int")
    checks = [("error", "value is negative", F.col("value") < 1), ("error", "k is missing", k.isNull()), ("warning", "k is large", k > 90)]
    return verdicts.violations(table(spark, sf_dir, "events"), F.col("event_id"), checks)


@query("SELECT md5(text) AS h, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return verdicts.duplicate_keys(table(spark, sf_dir, "documents").select(F.md5("text").alias("h")), "h")


@query("""SELECT doc_id, CASE WHEN NOT (contains(lower(text), 'apache') OR contains(lower(text), 'gnu general') OR contains(lower(text), 'creative commons') OR contains(lower(text), 'mit license')) THEN 'license' WHEN least(n_chars, 4000) < 600 THEN 'size'
 WHEN lang NOT IN ('en', 'fr', 'de') THEN 'mime' WHEN doc_id % 5 = 0 THEN 'duplicate' ELSE 'ok' END AS gate FROM documents""")
def license_gate(spark, sf_dir):
    g = verdicts.gate(F.col("text"), F.col("n_chars"), F.lit(4000), F.col("lang"), F.col("doc_id") % 5 == 0, LICENSES, ("en", "fr", "de"))
    return table(spark, sf_dir, "documents").select("doc_id", g.alias("gate"))


@query("SELECT p_partkey, CASE WHEN contains(p_name, 'old') THEN NULL WHEN contains(p_name, 'ring') OR contains(p_name, 'bolt') THEN 'fasteners' WHEN contains(p_name, 'gear') THEN 'machines' ELSE 'misc' END AS route FROM part")
def keyword_routes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", verdicts.routed(F.col("p_name"), ("old",), (("fasteners", ("ring", "bolt")), ("machines", ("gear",))), "misc").alias("route"))


@query("SELECT conv_id, to_json(list({'turn': turn, 'role': role} ORDER BY turn))::VARCHAR AS doc FROM conversations GROUP BY conv_id")
def nested_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return rows.select("conv_id", F.to_json("turns").alias("doc"))


@query("SELECT '!journal!' || left(md5(p_partkey::VARCHAR), 16) AS key, p_name AS value FROM part WHERE p_partkey % 2 = 0")
def key_value_store(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, H.short_id(F.col("p_partkey").cast("string"))).alias("_id"), "p_name")
    return records.key_values(rows, "_id", F.struct("p_name"), "!journal!").select("key", F.get_json_object("value", "$.p_name").alias("value"))


# ---- strings -------------------------------------------------------------------------------------------------------


@query(r"""SELECT page_id, left(trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_'), 48) AS slug, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS tag,
 left(trim(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), 90) AS file FROM pages""")
def slugs(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", T.slugify(u).alias("slug"), T.normalize_tag(u).alias("tag"), T.safe_filename(u).alias("file"))


@query(r"""SELECT s_suppkey, regexp_extract(f, '^(.+)_(\d+)\.png$', 1) AS stem, regexp_extract(f, '^(.+)_(\d+)\.png$', 2)::INT AS idx, regexp_extract(f, '^(.+)_(\d+)\.png$', 1) || '.png' AS source FROM (SELECT s_suppkey, 'sheet_' || s_nationkey || '_' || s_suppkey || '.png' AS f FROM supplier)""")
def stem_and_index(spark, sf_dir):
    file = F.concat(F.lit("sheet_"), F.col("s_nationkey"), F.lit("_"), F.col("s_suppkey"), F.lit(".png"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", files.stem_and_index(file).alias("f")).select("s_suppkey", "f.stem", "f.idx", "f.source")


@query("SELECT p_partkey, 'tok, ' || p_name || ', ' || lower(p_type) || ' view, ' || 'new, ' || replace(p_name, ' ', ', ') || CASE WHEN p_size > 25 THEN ', size ' || p_size ELSE '' END AS caption FROM part")
def training_captions(spark, sf_dir):
    described = F.when(F.col("p_size") > 25, F.concat(F.lit("size "), F.col("p_size")))
    return table(spark, sf_dir, "part").select("p_partkey", T.training_caption(F.lit("tok"), F.col("p_name"), F.lower("p_type"), F.lit("new"), F.split("p_name", " "), described).alias("caption"))


@query("SELECT p_partkey, p_name AS name, 'x' || p_size || ',y' AS rest FROM part")
def parsed_specs(spark, sf_dir):
    spec = F.concat("p_name", F.lit(":x"), F.col("p_size"), F.lit(",y"))
    rows = table(spark, sf_dir, "part").select("p_partkey", files.caption_line(F.replace(spec, F.lit(":"), F.lit(","))).alias("c"))
    return rows.select("p_partkey", F.col("c.trigger").alias("name"), F.concat_ws(",", "c.subject", F.array_join("c.tags", ",")).alias("rest"))


@query("SELECT region AS r_name, n, longest FROM (SELECT r_name AS region, count(*) AS n, array_to_string(list_sort(list(n_name))[1:3], '; and ') AS longest FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)")
def joined_clauses(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.slice(F.sort_array(F.collect_list("n_name")), 1, 3), "; and ").alias("longest"))


# ---- vectors and clusters ------------------------------------------------------------------------------------------

_SPLIT, _MERGE = 0.30, 0.25


def _few(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@query(f"""SELECT a.label, a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id
 WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {_SPLIT}""")
def cosine_pairs(spark, sf_dir):
    return graph.cosine_edges(_few(spark, sf_dir), "vec_id", "label", "embedding", _SPLIT).withColumn("similarity", F.round("similarity", 6))


_CLUSTERS = f"""e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {_SPLIT}),
 r(node, reach) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a), c AS (SELECT v.vec_id, v.label, v.embedding, m.cluster FROM embeddings v JOIN (SELECT node, min(reach) AS cluster FROM r GROUP BY node) m ON v.vec_id = m.node)"""


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT vec_id, label, cluster FROM c")
def split_clusters(spark, sf_dir):
    return graph.split_clusters(_few(spark, sf_dir), "vec_id", "label", "embedding", _SPLIT).select("vec_id", "label", "cluster")


@query(f"""WITH RECURSIVE {_CLUSTERS}, big AS (SELECT * FROM c WHERE cluster IN (SELECT cluster FROM c GROUP BY cluster HAVING count(*) > 1)), p AS (SELECT a.cluster AS c1, b.cluster AS c2, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM big a JOIN big b ON a.cluster < b.cluster)
 SELECT c1, c2, round(median, 6) AS median FROM (SELECT c1, c2, list_sort(list(s))[(count(*) // 2 + 1)::INT] AS median FROM p GROUP BY c1, c2) WHERE median >= {_MERGE}""")
def median_merges(spark, sf_dir):
    parts = written(graph.split_clusters(_few(spark, sf_dir), "vec_id", "label", "embedding", _SPLIT))
    big = parts.join(parts.groupBy("cluster").count().where("count > 1").select("cluster"), "cluster", "left_semi")
    return graph.merge_medians(big, "vec_id", "embedding", _MERGE).withColumn("median", F.round("median", 6))


@query(f"""WITH RECURSIVE {_CLUSTERS}, p AS (SELECT a.cluster AS c1, b.cluster AS c2, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM c a JOIN c b ON a.cluster < b.cluster),
 g AS (SELECT c1, c2 FROM (SELECT c1, c2, list_sort(list(s))[(count(*) // 2 + 1)::INT] AS median FROM p GROUP BY c1, c2) WHERE median >= 0.45), h AS (SELECT c1 AS a, c2 AS b FROM g UNION ALL SELECT c2, c1 FROM g),
 t(node, reach) AS (SELECT DISTINCT cluster, cluster FROM c UNION SELECT t.node, h.b FROM t JOIN h ON t.reach = h.a)
 SELECT c.vec_id, c.label, c.cluster, f.final FROM c JOIN (SELECT node, min(reach) AS final FROM t GROUP BY node) f ON f.node = c.cluster""")
def refined_clusters(spark, sf_dir):
    return graph.refined(_few(spark, sf_dir), "vec_id", "label", "embedding", _SPLIT, 0.45)


@query("""WITH m AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY label, i), c AS (SELECT label, list(x ORDER BY i) AS v FROM m GROUP BY label),
 s AS (SELECT e.vec_id, c.label, list_cosine_similarity(e.embedding::DOUBLE[], c.v) AS s FROM embeddings e, c), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k FROM s)
 SELECT a.vec_id, CASE WHEN a.s - b.s >= 0.05 THEN a.label END AS label, round(a.s - b.s, 6) AS margin FROM r a JOIN r b ON a.vec_id = b.vec_id AND a.k = 1 AND b.k = 2""")
def margin_gate(spark, sf_dir):
    vectors = _few(spark, sf_dir)
    scored = R.by_margin(vectors.select("vec_id", "embedding"), "embedding", R.mean_vectors(vectors, "label", "embedding"), "label")
    return scored.select("vec_id", verdicts.margin_gate(F.col("best"), F.col("margin"), 0.05).alias("label"), F.round("margin", 6).alias("margin"))


@query("""WITH v AS (SELECT vec_id, (['intact','damaged','stateless','destroyed','odd'])[vec_id % 5 + 1] AS d, (vec_id % 10) / 10.0::DOUBLE AS dm, (['active','inactive','none'])[vec_id % 3 + 1] AS a, (vec_id % 7) / 10.0::DOUBLE AS am FROM embeddings),
 w AS (SELECT *, a <> 'none' AND am >= 0.4 AND am > dm AND d IN ('intact', 'stateless') AS o, ' (margin ' || printf('%.2f', dm) || ')' AS m FROM v)
 SELECT vec_id, CASE WHEN o THEN a WHEN dm < 0.2 THEN NULL WHEN d IN ('intact', 'damaged', 'destroyed') THEN d END AS state,
 CASE WHEN o THEN 'activation=' || a || ' (margin ' || printf('%.2f', am) || ', beats damage ' || d || '/' || printf('%.2f', dm) || ')' WHEN dm < 0.2 THEN 'damage margin too low (' || printf('%.2f', dm) || ')'
 WHEN d = 'stateless' THEN 'stateless object' || m WHEN d = 'odd' THEN 'unknown damage label ' || chr(39) || 'odd' || chr(39) ELSE 'damage=' || d || m END AS reason FROM w""")
def state_decisions(spark, sf_dir):
    v = F.col("vec_id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (v % len(values) + 1).cast("int"))
    decided = verdicts.state_decision(pick(("intact", "damaged", "stateless", "destroyed", "odd")), (v % 10) / 10.0, pick(("active", "inactive", "none")), (v % 7) / 10.0, 0.2, 0.4)
    return _few(spark, sf_dir).select("vec_id", decided.alias("d")).select("vec_id", "d.state", "d.reason")


# ---- pixels and geometry -------------------------------------------------------------------------------------------

_PARTS = "SELECT 'sheet_' || p_size || '_' || p_partkey AS stem, p_name AS name, CASE WHEN p_size % 3 = 0 THEN 'north' END AS orientation, CASE WHEN p_size % 2 = 0 THEN 'worn' END AS state, CASE WHEN p_partkey % 5 = 0 THEN p_brand END AS group_id, p_size, p_partkey FROM part"
#: An image of 40 x 40 pixels for each supplier.
_PIXELS = """SELECT image_id, p // 40 AS y, p % 40 AS x, ((i * 37) % 16 + CASE WHEN i % 5 = 0 THEN 200 ELSE 32 END)::INT AS r, ((i * 11) % 16 + 48)::INT AS g, ((i * 7) % 16 + CASE WHEN i % 7 = 0 THEN 160 ELSE 64 END)::INT AS b
 FROM (SELECT s_suppkey AS image_id, p, s_suppkey * 7 + p * 3 AS i FROM supplier, (SELECT unnest(range(0, 1600)) AS p))"""
_PALETTE = ((200, 50, 70), (40, 50, 160), (210, 60, 170))


def pixels(spark, sf_dir):
    p = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1599).cast("long")))
    images = raster.dealt(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image_id")), 1600)
    rows = images.select("image_id", p.alias("p")).withColumn("i", F.col("image_id") * 7 + F.col("p") * 3)
    i = F.col("i")
    return rows.select(
        "image_id", F.expr("p div 40").alias("y"), (F.col("p") % 40).alias("x"), ((i * 37) % 16 + F.when(i % 5 == 0, 200).otherwise(32)).cast("int").alias("r"),
        ((i * 11) % 16 + 48).cast("int").alias("g"), ((i * 7) % 16 + F.when(i % 7 == 0, 160).otherwise(64)).cast("int").alias("b"),
    )


_MODAL = f"""SELECT image_id, r * 16 + 8 AS r, g * 16 + 8 AS g, b * 16 + 8 AS b, n FROM (SELECT image_id, r // 16 AS r, g // 16 AS g, b // 16 AS b, count(*) AS n FROM ({_PIXELS}) GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n DESC, r, g, b) = 1"""


@query(_MODAL)
def modal_colours(spark, sf_dir):
    return raster.modal_colour(pixels(spark, sf_dir))


@query(f"""WITH m AS ({_MODAL}), d AS (SELECT p.image_id, p.y, p.x, greatest(abs(p.r - m.r), abs(p.g - m.g), abs(p.b - m.b)) AS bg, [{', '.join(f'greatest(abs(p.r - {r}), abs(p.g - {g}), abs(p.b - {b}))' for r, g, b in _PALETTE)}] AS ds FROM ({_PIXELS}) p JOIN m USING (image_id))
 SELECT image_id, role, count(*) AS n FROM (SELECT image_id, CASE WHEN bg <= 25 THEN -1 ELSE list_position(ds, list_min(ds)) - 1 END AS role FROM d) GROUP BY image_id, role""")
def palette_quantize(spark, sf_dir):
    p = pixels(spark, sf_dir)
    return raster.quantized(p, raster.modal_colour(p), _PALETTE).groupBy("image_id", "role").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH m AS (SELECT image_id, y, x FROM ({_PIXELS}) WHERE r > 100 + image_id % 4 * 51 AND x % 3 <> image_id % 3), s AS (SELECT image_id, count(*) AS n FROM m GROUP BY 1), i AS (SELECT s_suppkey AS image_id, s_suppkey // 4 AS stack FROM supplier),
 p AS (SELECT k.stack, k.image_id AS a, l.image_id AS b FROM i k JOIN i l ON k.stack = l.stack AND k.image_id < l.image_id), c AS (SELECT k.image_id AS a, l.image_id AS b, count(*) AS c FROM m k JOIN m l ON k.y = l.y AND k.x = l.x AND k.image_id // 4 = l.image_id // 4 AND k.image_id < l.image_id GROUP BY ALL)
 SELECT p.stack, p.a, p.b, CASE WHEN coalesce(x.n, 0) + coalesce(y.n, 0) = 0 THEN 0.0 ELSE round(coalesce(c, 0)::DOUBLE / (coalesce(x.n, 0) + coalesce(y.n, 0) - coalesce(c, 0)), 6) END AS iou FROM p LEFT JOIN c ON c.a = p.a AND c.b = p.b LEFT JOIN s x ON x.image_id = p.a LEFT JOIN s y ON y.image_id = p.b""")
def mask_ious(spark, sf_dir):
    image = F.col("image_id")
    masks = pixels(spark, sf_dir).where((F.col("r") > 100 + image % 4 * 51) & (F.col("x") % 3 != image % 3)).select("image_id", "y", "x")
    images = table(spark, sf_dir, "supplier").select(F.expr("s_suppkey div 4").alias("stack"), F.col("s_suppkey").alias("image_id"))
    return raster.mask_iou(masks, images, 40).withColumn("iou", F.round("iou", 6))


@query(f"SELECT image_id, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM ({_PIXELS}) WHERE r > 200 AND x > 3 GROUP BY image_id")
def bounding_boxes(spark, sf_dir):
    return raster.bounding_box(pixels(spark, sf_dir), (F.col("r") > 200) & (F.col("x") > 3))


@query(f"SELECT image_id, round(avg(CASE WHEN r > 200 THEN 1 ELSE 0 END), 6) AS share FROM ({_PIXELS}) GROUP BY image_id")
def mask_coverage(spark, sf_dir):
    return raster.coverage(pixels(spark, sf_dir), F.col("r") > 200).withColumn("share", F.round("share", 6))


@query(f"""WITH p AS ({_PIXELS}) SELECT image_id, floor(median(r))::INT AS r, floor(median(g))::INT AS g, floor(median(b))::INT AS b FROM (
 SELECT * FROM p WHERE x < 2 UNION ALL SELECT * FROM p WHERE y < 2 UNION ALL SELECT * FROM p WHERE x > 37 UNION ALL SELECT * FROM p WHERE y > 37) GROUP BY image_id""")
def border_medians(spark, sf_dir):
    return raster.border_median(pixels(spark, sf_dir), 2)


@query("""WITH s AS (SELECT s_suppkey // 8 AS image_id, s_suppkey AS z, s_nationkey AS role, s_suppkey % 30 AS x0, s_suppkey % 20 AS y0, s_suppkey % 30 + 9 AS x1, s_suppkey % 20 + 7 AS y1 FROM supplier),
 c AS (SELECT image_id, y, x FROM (SELECT DISTINCT image_id FROM s), (SELECT unnest(range(0, 30)) AS y), (SELECT unnest(range(0, 40)) AS x))
 SELECT image_id, role, count(*) AS n FROM (SELECT c.image_id, c.y, c.x, arg_max(role, z) AS role FROM c LEFT JOIN s ON c.image_id = s.image_id AND c.y >= y0 AND c.y < y1 AND c.x >= x0 AND c.x < x1 GROUP BY ALL) GROUP BY image_id, role""")
def painted_regions(spark, sf_dir):
    k = F.col("s_suppkey")
    shapes = table(spark, sf_dir, "supplier").select(F.expr("s_suppkey div 8").alias("image_id"), k.alias("z"), F.col("s_nationkey").alias("role"), (k % 30).alias("x0"), (k % 20).alias("y0"), (k % 30 + 9).alias("x1"), (k % 20 + 7).alias("y1"))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1199).cast("long")))
    canvas = shapes.select("image_id").distinct().select("image_id", at.alias("p")).select("image_id", F.expr("p div 40").alias("y"), (F.col("p") % 40).alias("x"))
    return raster.painted(canvas, shapes).groupBy("image_id", "role").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE i AS (SELECT image_id, y * 40 + x AS p, y, x FROM ({_PIXELS}) WHERE r > 200),
 e AS (SELECT a.image_id, a.p, b.p AS q FROM i a JOIN i b ON a.image_id = b.image_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1 AND b.p IN (a.p - 1, a.p + 1, a.p - 40, a.p + 40)),
 r(image_id, p, q) AS (SELECT image_id, p, p FROM i UNION SELECT r.image_id, r.p, e.q FROM r JOIN e ON e.image_id = r.image_id AND e.p = r.q), c AS (SELECT image_id, p, min(q) AS root FROM r GROUP BY image_id, p)
 SELECT c.image_id, dense_rank() OVER (PARTITION BY c.image_id ORDER BY root) AS label, area, x0, y0, x1, y1 FROM (SELECT c.image_id, root, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM c JOIN i ON i.image_id = c.image_id AND i.p = c.p GROUP BY c.image_id, root) c""")
def image_components(spark, sf_dir):
    ink = pixels(spark, sf_dir).select("image_id", "y", "x", (F.col("r") > 200).alias("ink"))
    return raster.boxes(raster.by_image(ink, ["ink"], raster.label, "label").where("label > 0"), "label")


_RING = "(x - 20) * (x - 20) + (y - 20) * (y - 20) BETWEEN 20 + image_id % 40 AND 140"


@query(f"""WITH RECURSIVE o AS (SELECT image_id, p, p // 40 AS y, p % 40 AS x FROM (SELECT s_suppkey AS image_id, unnest(range(0, 1600)) AS p FROM supplier) WHERE NOT ((p % 40 - 20) * (p % 40 - 20) + (p // 40 - 20) * (p // 40 - 20) BETWEEN 20 + image_id % 40 AND 140)),
 d AS (SELECT dy, dx FROM (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)),
 f(image_id, y, x) AS (SELECT image_id, y, x FROM o WHERE y IN (0, 39) OR x IN (0, 39) UNION SELECT o.image_id, o.y, o.x FROM f, d JOIN o ON o.image_id = f.image_id AND o.y = f.y + dy AND o.x = f.x + dx)
 SELECT s_suppkey AS image_id, round(1 - n / 1600.0::DOUBLE, 6) AS share FROM supplier JOIN (SELECT image_id, count(*) AS n FROM f GROUP BY 1) ON image_id = s_suppkey""")
def filled_holes(spark, sf_dir):
    ink = pixels(spark, sf_dir).select("image_id", "y", "x", F.expr(_RING).alias("ink"))
    return raster.coverage(raster.by_image(ink, ["ink"], raster.fill_holes, "filled", "boolean"), F.col("filled")).withColumn("share", F.round("share", 6))


@query("""SELECT s_suppkey, c AS col, d AS row, round(c * 1.5::DOUBLE * edge, 6) AS x, round(d * (sqrt(3) * edge) + CASE WHEN c % 2 <> 0 THEN sqrt(3) * edge / 2 ELSE 0 END, 6) AS y, d - CASE WHEN c < 0 THEN -1 ELSE c // 2 END AS r
 FROM (SELECT s_suppkey, 10 + s_nationkey AS edge, c, d FROM supplier, (SELECT unnest(range(-1, 7)) AS c), (SELECT unnest(range(-1, 5)) AS d))""")
def hex_grid(spark, sf_dir):
    grid = table(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(10) + F.col("s_nationkey")).alias("edge"), F.explode(F.sequence(F.lit(-1).cast("long"), F.lit(6).cast("long"))).alias("col"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(-1).cast("long"), F.lit(4).cast("long"))).alias("row"))
    return grid.select("s_suppkey", "col", "row", G.hex_centre(F.col("col"), F.col("row"), F.col("edge")).alias("h")).select("s_suppkey", "col", "row", F.round("h.x", 6).alias("x"), F.round("h.y", 6).alias("y"), F.col("h.r").cast("long").alias("r"))


#: A map of 10 x 7 squares for each supplier: a closed wall, another one that varies, two lights, a door with and one without a span.
_MAP = """{"resolution": {"map_size": {"x": 10, "y": 7}, "pixels_per_grid": %s}, "line_of_sight": [[{"x": 1, "y": 1}, {"x": 9, "y": 1}, {"x": 9, "y": 6}, {"x": 1, "y": 6}, {"x": 1, "y": 1}]],
 "objects_line_of_sight": [[{"x": %s, "y": 2}, {"x": 7, "y": 5}]], "portals": [{"position": {"x": 4.5, "y": 1}, "bounds": [{"x": 4, "y": 1}, {"x": 5, "y": 1}], "rotation": 90}, {"position": {"x": 9, "y": 3}, "bounds": []}],
 "lights": [{"position": {"x": 3, "y": 3}, "range": 4, "color": "ffaabbcc"}, {"position": {"x": 8, "y": %s}, "intensity": 0.5}, {"range": 2}]}"""


def _maps(spark, sf_dir):
    k = F.col("s_suppkey")
    doc = F.format_string(_MAP, (k % 5 + 8).cast("string"), (k % 3 + 2).cast("string"), (k % 4 + 2).cast("string"))
    return table(spark, sf_dir, "supplier").select(k.alias("image_id"), files.vector_map(doc).alias("m"))


_ROLES = {"floor": 1, "wall": 2, "light": 3, "door": 1}


@query("""WITH m AS (SELECT s_suppkey AS image_id, s_suppkey AS k, s_suppkey % 5 + 8 AS g FROM supplier), t AS (SELECT *, greatest(2, round_even(g * 0.3::DOUBLE, 0))::BIGINT AS w, greatest(2, round_even(g * 0.25::DOUBLE, 0))::BIGINT AS l FROM m),
 u AS (SELECT *, round_even(w * 1.5::DOUBLE, 0)::BIGINT AS c FROM t),
 s AS (SELECT image_id, 1 AS z, 2 AS role, true AS line, sx * g AS sx, sy * g AS sy, tx * g AS tx, ty * g AS ty, w AS d FROM u, (VALUES (1, 1, 9, 1), (9, 1, 9, 6), (9, 6, 1, 6), (1, 6, 1, 1)) v(sx, sy, tx, ty)
 UNION ALL SELECT image_id, 1, 2, true, (k % 3 + 2) * g, 2 * g, 7 * g, 5 * g, w FROM u
 UNION ALL SELECT image_id, 1, 2, false, sx * g, sy * g, 0, 0, w // 2 FROM u, (VALUES (1, 1), (9, 1), (9, 6), (1, 6), (7, 5)) v(sx, sy) UNION ALL SELECT image_id, 1, 2, false, (k % 3 + 2) * g, 2 * g, 0, 0, w // 2 FROM u
 UNION ALL SELECT image_id, 2, 3, false, 3 * g, 3 * g, 0, 0, l FROM u UNION ALL SELECT image_id, 2, 3, false, 8 * g, (k % 4 + 2) * g, 0, 0, l FROM u
 UNION ALL SELECT image_id, 3, 1, true, 4 * g, g, 5 * g, g, c FROM u UNION ALL SELECT image_id, 3, 1, false, 9 * g, 3 * g, 0, 0, c // 2 FROM u),
 p AS (SELECT image_id, y, x FROM m, (SELECT unnest(range(0, 84)) AS y), (SELECT unnest(range(0, 120)) AS x) WHERE y < 7 * g AND x < 10 * g),
 h AS (SELECT p.image_id, p.y, p.x, s.z, s.role, s.line, s.d, (p.x - sx) * (p.x - sx) + (p.y - sy) * (p.y - sy) AS r2, (p.x - sx) * (tx - sx) + (p.y - sy) * (ty - sy) AS along, (p.x - sx) * (ty - sy) - (p.y - sy) * (tx - sx) AS across, (tx - sx) * (tx - sx) + (ty - sy) * (ty - sy) AS l2 FROM p JOIN s USING (image_id)),
 c AS (SELECT image_id, y, x, arg_max(role, z) AS role FROM h WHERE CASE WHEN line THEN along BETWEEN 0 AND l2 AND CASE WHEN across < 0 THEN 4 * across * across <= d * d * l2 ELSE 4 * across * across < d * d * l2 END ELSE r2 <= d * d END GROUP BY image_id, y, x)
 SELECT p.image_id, coalesce(role, 1) AS role, count(*) AS pixels, sum(p.y * 1000 + p.x)::BIGINT AS places FROM p LEFT JOIN c USING (image_id, y, x) GROUP BY ALL""")
def layout_areas(spark, sf_dir):
    maps = written(_maps(spark, sf_dir))
    canvas = layout.canvases(maps)
    runs = layout.painted_runs(canvas, layout.scanned(layout.map_shapes(maps, 0.3, 0.25, _ROLES), canvas), _ROLES["floor"])
    n = F.col("x1") - F.col("x0")
    places = n * F.col("y") * 1000 + (F.col("x0") + F.col("x1") - 1) * n / 2
    return runs.groupBy("image_id", "role").agg(F.sum(n).alias("pixels"), F.sum(places.cast("long")).alias("places"))


@query("""SELECT image_id, '{"image_size":[' || 10 * g || ',' || 7 * g || '],"pixels_per_grid":' || g || ',"doors":[{"x":' || 4.5 * g || ',"y":' || g || '.0,"rotation_deg":90.0,"closed":true,"freestanding":false,"span_px":[[' || 4 * g || '.0,' || g || '.0],[' || 5 * g || '.0,' || g || '.0]]},'
 || '{"x":' || 9 * g || '.0,"y":' || 3 * g || '.0,"rotation_deg":0.0,"closed":true,"freestanding":false,"span_px":[]}],"lights":[{"x":' || 3 * g || '.0,"y":' || 3 * g || '.0,"range_px":' || 4 * g || '.0,"intensity":1.0,"color":"aabbcc"},'
 || '{"x":' || 8 * g || '.0,"y":' || (image_id % 4 + 2) * g || '.0,"range_px":0.0,"intensity":0.5,"color":"ffffff"}]}' AS value FROM (SELECT s_suppkey AS image_id, s_suppkey % 5 + 8 AS g FROM supplier)""")
def layout_placements(spark, sf_dir):
    return library.placements_json(_maps(spark, sf_dir))


_SIDES = ("north", "south", "east", "west")
_PLAN_ROLES = {"outside": 0, "wall": 1, "floor": 2, "light": 3, "windscreen": 4, "ramp": 5}


@query("""WITH p AS (SELECT s_suppkey AS k, 300 AS w, 280 AS h, 8 + s_suppkey % 3 * 4 AS t, s_suppkey % 2 AS kind, s_suppkey % 4 AS ws, (s_suppkey + 1) % 4 AS rs FROM supplier), q AS (SELECT *, (w - t) // 2 AS r, w * 3 // 4 AS b FROM p),
 m AS (SELECT *, 0 AS i, 0 AS x, 0 AS y, CASE WHEN kind = 0 THEN r + t // 2 ELSE b + t END AS rw, h AS rh FROM q UNION ALL SELECT *, 1, CASE WHEN kind = 0 THEN r - t // 2 ELSE b END, CASE WHEN kind = 0 THEN 0 ELSE (h - h // 2) // 2 END, CASE WHEN kind = 0 THEN w - (r - t // 2) ELSE w - b END, CASE WHEN kind = 0 THEN h ELSE h // 2 END FROM q),
 u AS (SELECT *, CASE WHEN ws < 2 THEN floor(rw * 0.4::DOUBLE)::BIGINT ELSE floor(rh * 0.4::DOUBLE)::BIGINT END AS n, CASE WHEN rs < 2 THEN rw ELSE rh END AS l FROM m WHERE i = 0), v AS (SELECT *, floor(l * 0.25::DOUBLE)::BIGINT AS rn FROM u), g AS (SELECT *, greatest(0, floor(l * 0.5::DOUBLE)::BIGINT - rn // 2) AS p0 FROM v), g2 AS (SELECT *, least(l, p0 + rn) AS p1 FROM g),
 s AS (SELECT k, 2 * i AS z, 1 AS role, x AS x0, y AS y0, x + rw AS x1, y + rh AS y1, NULL::BIGINT AS d FROM m UNION ALL SELECT k, 2 * i + 1, 2, x + t, y + t, x + rw - t, y + rh - t, NULL FROM m
 UNION ALL SELECT k, 10, 2, CASE WHEN kind = 0 THEN r - t // 2 ELSE b END, CASE WHEN kind = 0 THEN (h - 96) // 2 ELSE (h - h // 2) // 2 + (h // 2 - 128) // 2 END, CASE WHEN kind = 0 THEN r - t // 2 ELSE b END + t, CASE WHEN kind = 0 THEN (h - 96) // 2 + 96 ELSE (h - h // 2) // 2 + (h // 2 - 128) // 2 + 128 END, NULL FROM q
 UNION ALL SELECT k, 20, 4, CASE ws WHEN 2 THEN rw - t WHEN 3 THEN 0 ELSE (rw - n) // 2 END, CASE ws WHEN 0 THEN 0 WHEN 1 THEN rh - t ELSE (rh - n) // 2 END, CASE ws WHEN 2 THEN rw WHEN 3 THEN t ELSE (rw - n) // 2 + n END, CASE ws WHEN 0 THEN t WHEN 1 THEN rh ELSE (rh - n) // 2 + n END, NULL FROM u
 UNION ALL SELECT k, 30, 5, CASE rs WHEN 2 THEN rw - t WHEN 3 THEN 0 ELSE p0 END, CASE rs WHEN 0 THEN 0 WHEN 1 THEN rh - t ELSE p0 END, CASE rs WHEN 2 THEN w WHEN 3 THEN t ELSE p1 END, CASE rs WHEN 0 THEN t WHEN 1 THEN h ELSE p1 END, NULL FROM g2
 UNION ALL SELECT k, 40, 3, CASE c WHEN 2 THEN x + e WHEN 3 THEN x + rw - e ELSE x + floor(rw * j::DOUBLE / (o + 1))::BIGINT END, CASE c WHEN 0 THEN y + e WHEN 1 THEN y + rh - e ELSE y + floor(rh * j::DOUBLE / (o + 1))::BIGINT END, NULL, NULL, e FROM (SELECT *, greatest(8, t // 2) AS e, CASE WHEN kind = 0 THEN 1 ELSE 2 END AS o FROM m), (SELECT unnest([0, 1, 2, 3]) AS c), (SELECT unnest([1, 2]) AS j) WHERE j <= o),
 a AS (SELECT k, y, x FROM p, (SELECT unnest(range(0, 280)) AS y), (SELECT unnest(range(0, 300)) AS x)),
 c AS (SELECT a.k, a.y, a.x, arg_max(role, z) AS role FROM a JOIN s ON a.k = s.k AND CASE WHEN d IS NULL THEN a.x >= x0 AND a.x < x1 AND a.y >= y0 AND a.y < y1 ELSE (a.x - x0) * (a.x - x0) + (a.y - y0) * (a.y - y0) <= d * d END GROUP BY ALL)
 SELECT a.k AS image_id, coalesce(role, 0) AS role, count(*) AS pixels, sum(a.y * 1000 + a.x)::BIGINT AS places FROM a LEFT JOIN c ON a.k = c.k AND a.y = c.y AND a.x = c.x GROUP BY ALL""")
def floor_plan_areas(spark, sf_dir):
    k = F.col("s_suppkey")
    side = lambda n: F.element_at(F.array(*map(F.lit, _SIDES)), (n % 4 + 1).cast("int"))
    wanted = table(spark, sf_dir, "supplier").select(k.alias("image_id"), F.when(k % 2 == 0, "hab-2room").otherwise("industrial-bay").alias("preset"), F.lit(300).alias("width"), F.lit(280).alias("height"), (k % 3 * 4 + 8).cast("int").alias("thickness"))
    plans = floor_plans.preset_plans(wanted).withColumns({
        "windscreen": F.struct(side(F.col("image_id")).alias("side"), F.lit(None).cast("int").alias("thickness"), F.lit(0.4).alias("frac")),
        "ramp": F.struct(side(F.col("image_id") + 1).alias("side"), F.lit(0.5).alias("x_frac"), F.lit(0.25).alias("width_frac")),
    })
    runs = floor_plans.painted(plans, _PLAN_ROLES)
    n = F.col("x1") - F.col("x0")
    places = n * F.col("y") * 1000 + (F.col("x0") + F.col("x1") - 1) * n / 2
    return runs.groupBy("image_id", "role").agg(F.sum(n).alias("pixels"), F.sum(places.cast("long")).alias("places"))


@query(f"""WITH p AS (SELECT image_id, 39 - y AS x, x AS y, r FROM ({_PIXELS}) WHERE (x - 15) * (x - 15) + (y - 22) * (y - 22) <= 20 + image_id % 50), b AS (SELECT image_id, min(x) AS x0, min(y) AS y0, max(x) - min(x) + 1 AS width, max(y) - min(y) + 1 AS height FROM p GROUP BY 1)
 SELECT image_id, width, height, sum(r * ((y - y0) * 41 + x - x0))::BIGINT AS digest FROM p JOIN b USING (image_id) GROUP BY ALL""")
def turned_icons(spark, sf_dir):
    rgba = pixels(spark, sf_dir).withColumn("a", F.expr("case when (x - 15) * (x - 15) + (y - 22) * (y - 22) <= 20 + image_id % 50 then 255 else 0 end"))
    size = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image_id"), F.lit(40).alias("w"), F.lit(40).alias("h"))
    rows = raster.facing(rgba, size, "east").groupBy("image_id")
    return rows.agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"), F.sum(F.when(F.col("a") > 0, F.col("r") * (F.col("y") * 41 + F.col("x"))).otherwise(0)).alias("digest"))


@query(f"""WITH p AS (SELECT stem, left(md5(stem), 16) AS id FROM ({_PARTS}) WHERE p_partkey % 4 <> 0) SELECT id, 'tiles/' || stem || '.png' AS img, 1::BIGINT AS presets, (SELECT count(*) FROM p) AS indexed FROM p UNION ALL SELECT 'MassEditMetaData', NULL, 0, (SELECT count(*) FROM p)""")
def pack_documents(spark, sf_dir):
    rows = _library(spark, sf_dir)
    packed = library.presets(rows.select("stem", F.col("p_size").alias("width"), F.lit(None).cast("int").alias("height")), rows.where("p_partkey % 4 <> 0").drop("p_size", "p_partkey"), 100, "tiles")
    docs = written(library.pack_documents(packed))
    flag = F.get_json_object("value", "$.flags.multi-token-edit")
    index = docs.where(F.col("id") == library.INDEX_ID).select(F.size(F.map_keys(F.from_json(F.get_json_object(flag, "$.index"), "map<string,string>"))).cast("long").alias("indexed")).scalar()
    return docs.select("id", F.get_json_object(flag, "$.preset.img").alias("img"), F.when(F.get_json_object(flag, "$.preset.id") == F.col("id"), 1).otherwise(0).cast("long").alias("presets"), index.alias("indexed"))


@query("SELECT s_suppkey, greatest(0, least(cx - side // 2, 800 - side)) AS x, greatest(0, least(cy - side // 2, 600 - side)) AS y, side FROM (SELECT s_suppkey, (s_suppkey * 37 % 800)::INT AS cx, (s_suppkey * 53 % 600)::INT AS cy, least(100 + s_nationkey * 30, 800, 600)::INT AS side FROM supplier)")
def square_crops(spark, sf_dir):
    k = F.col("s_suppkey")
    box = G.square_crop((k * 37 % 800).cast("int"), (k * 53 % 600).cast("int"), (100 + F.col("s_nationkey") * 30).cast("int"), F.lit(800), F.lit(600))
    return table(spark, sf_dir, "supplier").select("s_suppkey", box.alias("b")).select("s_suppkey", "b.x", "b.y", "b.side")


# ---- procedures of the handbook ------------------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN n > 80 THEN NULL ELSE p_brand END AS p_brand FROM part JOIN (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) USING (p_brand)")
def cleared_groups(spark, sf_dir):
    return R.cleared_groups(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", 80)


@query("SELECT p_brand, p_type, array_to_string(list_sort(list(DISTINCT p_name)), ',') AS cycle, count(DISTINCT p_name) AS n FROM part GROUP BY ALL HAVING count(DISTINCT p_name) >= 2")
def variant_cycles(spark, sf_dir):
    return R.cycles(table(spark, sf_dir, "part"), ["p_brand", "p_type"], "p_name").select("p_brand", "p_type", F.array_join("cycle", ",").alias("cycle"), "n")


@query("SELECT b.p_brand, t.s AS missing FROM (SELECT DISTINCT p_brand FROM part) b, (SELECT unnest(['old', 'hot', 'broken']) AS s) t WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_brand = b.p_brand AND starts_with(p.p_name, t.s || ' r'))")
def missing_variants(spark, sf_dir):
    state = F.when(F.col("p_name").rlike("^[a-z]+ r"), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return R.missing_states(table(spark, sf_dir, "part").select("p_brand", state.alias("state")), "p_brand", "state", ("old", "hot", "broken"))


@query("SELECT base, arg_min(f, {'w': w, 'f': f}) AS f, count(*) AS copies FROM (SELECT 'img' || (s_suppkey // 2) AS base, CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS w, 'img' || (s_suppkey // 2) || CASE WHEN s_suppkey % 3 = 0 THEN '-WM' ELSE '' END AS f FROM supplier) GROUP BY base")
def clean_siblings(spark, sf_dir):
    marked = F.col("s_suppkey") % 3 == 0
    base = F.concat(F.lit("img"), F.expr("s_suppkey div 2"))
    rows = table(spark, sf_dir, "supplier").select(base.alias("base"), marked.cast("int").alias("w"), F.concat(base, F.when(marked, "-WM").otherwise("")).alias("f"))
    return R.byte_survivors(rows, "base", F.col("w"), "f").select("base", "f", "copies")


@query("SELECT name, count(*) AS n FROM (SELECT regexp_replace(replace(replace(f, 'х', 'x'), 'σ', 'x'), '(\\d)s(\\d)', '\\1x\\2', 'g') AS name FROM (SELECT 'a' || (['х','x','σ'])[c_custkey % 3 + 1] || (c_custkey % 7) || 's' || (c_custkey % 5) AS f FROM customer)) GROUP BY name HAVING count(*) > 1")
def lookalike_collisions(spark, sf_dir):
    k = F.col("c_custkey")
    letter = F.element_at(F.array(F.lit("х"), F.lit("x"), F.lit("σ")), (k % 3 + 1).cast("int"))
    names = table(spark, sf_dir, "customer").select(T.latin_lookalikes(F.concat(F.lit("a"), letter, k % 7, F.lit("s"), k % 5)).alias("name"))
    return verdicts.duplicate_keys(names, "name")


@query("SELECT lang, coalesce(source, 'all') AS source, count(*) AS n, count(*) FILTER (WHERE n_chars < 600) AS short FROM documents GROUP BY ROLLUP (lang, source) HAVING lang IS NOT NULL")
def verdict_rollup(spark, sf_dir):
    return R.rollup_counts(table(spark, sf_dir, "documents"), "lang", "source", {"short": F.col("n_chars") < 600})


# ---- the library's chain and the rest of the inventory -------------------------------------------------------------


@query("SELECT role, CASE WHEN role IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) THEN 'textured' ELSE 'bare' END AS status FROM (SELECT n_nationkey AS role FROM nation)")
def textured_roles(spark, sf_dir):
    roles, have = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("role")), table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("role"))
    return R.present(roles, have, "role", "textured", "bare")


@query("""SELECT page_id, CASE WHEN regexp_matches(url, 'page=') THEN 'paged' WHEN regexp_matches(url, '/en/') THEN 'english' WHEN regexp_matches(url, '/fr/') THEN 'french' ELSE 'other' END AS trigger FROM pages""")
def fallback_matches(spark, sf_dir):
    file = F.element_at(F.split("url", "/"), -1)
    found = F.coalesce(T.first_match(file, [("page=", "paged")]), T.first_match(F.col("url"), [("/en/", "english"), ("/fr/", "french")]), F.lit("other"))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("trigger"))


@query("SELECT n_regionkey AS deck_set, count(DISTINCT n_nationkey % 2) = 1 AS aligned, count(*) AS decks FROM nation GROUP BY 1")
def registration_check(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("deck_set"), (F.col("n_nationkey") % 2).alias("size"))
    return R.aligned(rows, "deck_set", ["size"]).withColumnRenamed("members", "decks")


@query("SELECT r_regionkey, array_to_string(list_concat(['NATION_0', 'NATION_' || r_regionkey], list_filter([n_first, 'NATION_0'], lambda x: x NOT IN ('NATION_0', 'NATION_' || r_regionkey))), ',') AS variants FROM region JOIN (SELECT n_regionkey, min(n_name) AS n_first FROM nation GROUP BY 1) ON r_regionkey = n_regionkey")
def appended_variants(spark, sf_dir):
    first = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.min("n_name").alias("n_first"))
    rows = table(spark, sf_dir, "region").join(first, F.col("r_regionkey") == F.col("n_regionkey"))
    v = lambda c: F.struct(c.alias("img"))
    old, new = F.array(v(F.lit("NATION_0")), v(F.concat(F.lit("NATION_"), F.col("r_regionkey")))), F.array(v(F.col("n_first")), v(F.lit("NATION_0")))
    return rows.select("r_regionkey", R.appended_variants(old, new, "img").alias("v")).select("r_regionkey", F.array_join("v.img", ",").alias("variants"))


@query("""WITH e AS (SELECT label, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings),
 m AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(list_transform(v, lambda x: x / n)) AS x, unnest(range(1, len(v) + 1)) AS i FROM e) GROUP BY label, i),
 l AS (SELECT label, sqrt(sum(x * x)) AS n, count(*) AS dims FROM m GROUP BY label)
 SELECT l.label, dims, round(sum(x * x / l.n / l.n), 6) AS length, round(max(CASE WHEN i = 1 THEN x END) / l.n, 6) + 0.0 AS first FROM m JOIN l USING (label) GROUP BY l.label, dims, l.n""")
def label_centroids(spark, sf_dir):
    v = R.unit_centroids(_few(spark, sf_dir), "label", "embedding")
    return v.select("label", F.size("v").cast("long").alias("dims"), F.round(V.norm(F.col("v")), 6).alias("length"), (F.round(F.get("v", F.lit(0)), 6) + 0.0).alias("first"))


@query(f"SELECT DISTINCT image_id, r FROM ({_PIXELS}) WHERE r NOT IN (32, 33, 34, 35, 36, 37, 38, 39, 40, 200, 201, 202)")
def palette_violations(spark, sf_dir):
    allowed = spark.createDataFrame([(v,) for v in (*range(32, 41), 200, 201, 202)], "r int")
    return raster.outside_palette(pixels(spark, sf_dir), ["r"], allowed)


@query("""SELECT p_partkey, 'part of ' || p_brand || ': ' || p_name || CASE WHEN p_size > 40 THEN ', with ' || 'ring; and ' || p_type ELSE '' END AS prompt FROM part""")
def prompts(spark, sf_dir):
    parts = F.when(F.col("p_size") > 40, F.array(F.lit("ring"), F.col("p_type"))).otherwise(F.array().cast("array<string>"))
    made = T.template("part of {brand}: {name}{clause}", brand=F.col("p_brand"), name=F.col("p_name"), clause=T.clause(parts))
    return table(spark, sf_dir, "part").select("p_partkey", made.alias("prompt"))


@query("SELECT n_nationkey, round(1.0::DOUBLE + 2 * pi() * k / n, 6) AS angle FROM (SELECT n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS k, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation)")
def angular_sectors(spark, sf_dir):
    w = Window.partitionBy("n_regionkey")
    k, n = F.row_number().over(w.orderBy("n_nationkey")) - 1, F.count(F.lit(1)).over(w)
    return table(spark, sf_dir, "nation").select("n_nationkey", F.round(G.sector_angle(k, n, F.lit(1.0), F.lit(0.0)), 6).alias("angle"))


@query("SELECT s_suppkey, i, round(s_nationkey + (100.0::DOUBLE - s_nationkey) * (i + 0.5) / n, 6) AS at FROM (SELECT s_suppkey, s_nationkey, (s_suppkey % 4)::INT AS n, unnest(range(0, s_suppkey % 4))::INT AS i FROM supplier)")
def spaced_lights(spark, sf_dir):
    at = G.spaced((F.col("s_suppkey") % 4).cast("int"), F.col("s_nationkey").cast("double"), F.lit(100.0))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(at).alias("i", "at")).withColumn("at", F.round("at", 6))


def _library(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    stem = F.concat(F.lit("sheet_"), F.col("p_size"), F.lit("_"), F.col("p_partkey"))
    rows = part.select(stem.alias("stem"), F.col("p_name").alias("name"), F.split("p_name", " ").alias("tags"), F.when(F.col("p_size") % 3 == 0, "north").alias("orientation"), F.when(F.col("p_size") % 2 == 0, "worn").alias("state"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_brand")).alias("group_id"), "p_size", "p_partkey")
    return rows




@query(f"""SELECT left(md5(stem), 16) AS id, name || CASE WHEN state IS NULL AND orientation IS NULL THEN '' ELSE ' — ' || concat_ws(', ', state, orientation) END AS name, concat_ws(';', replace(name, ' ', ';'), 'facing-' || orientation, 'state-' || state, 'group:' || group_id) AS tags,
 'tiles/' || stem || '.png' AS src, p_size AS width FROM ({_PARTS}) WHERE p_partkey % 4 <> 0""")
def preset_pack(spark, sf_dir):
    rows = _library(spark, sf_dir)
    packed = library.presets(rows.select("stem", F.col("p_size").alias("width"), F.lit(None).cast("int").alias("height")), rows.where("p_partkey % 4 <> 0").drop("p_size", "p_partkey"), 100, "tiles")
    first = F.get("data", F.lit(0))
    return packed.select("id", "name", F.array_join("tags", ";").alias("tags"), first["texture"]["src"].alias("src"), first["width"].alias("width"))


@query(f"SELECT 'sheet_' || p_size AS sheet, count(*) AS n, count(*) FILTER (WHERE p_partkey % 4 <> 0) AS record, count(*) FILTER (WHERE p_partkey % 4 <> 0 AND orientation IS NOT NULL) AS oriented, count(*) FILTER (WHERE p_partkey % 4 <> 0 AND group_id IS NOT NULL) AS grouped FROM ({_PARTS}) GROUP BY 1")
def library_status(spark, sf_dir):
    rows = _library(spark, sf_dir)
    sheets = rows.select(F.concat(F.lit("sheet_"), "p_size").alias("sheet")).distinct()
    return library.status(rows, rows.where("p_partkey % 4 <> 0"), sheets).select("sheet", "n", "record", "oriented", "grouped")


@query(f"SELECT id, level, message FROM (SELECT left(md5(stem), 16) AS id, 'warning' AS level, 'no extent' AS message FROM ({_PARTS}) WHERE p_size < 5) UNION ALL SELECT left(md5(stem), 16), 'error', 'name is missing' FROM ({_PARTS}) WHERE p_size % 10 = 0")
def pack_violations(spark, sf_dir):
    rows = _library(spark, sf_dir)
    packed = library.presets(rows.select("stem", F.when(F.col("p_size") < 5, 0).otherwise(9).alias("width"), F.lit(9).alias("height")), rows, 100, "tiles")
    renamed = packed.join(rows.select(F.concat(F.lit("tiles/"), "stem", F.lit(".png")).alias("img"), "p_size"), "img").withColumn("name", F.when(F.col("p_size") % 10 > 0, F.col("name")))
    return library.pack_violations(renamed)


@query(f"""WITH p AS (SELECT left(md5(stem), 16) AS id, p_size, row_number() OVER (ORDER BY left(md5(stem), 16)) - 1 AS nth FROM ({_PARTS}))
 SELECT id, 'warning' AS level, 'preset[' || nth || '].data[' || j || '].' || c AS path, 'no extent' AS message FROM p, (SELECT unnest([0, 1]) AS j), (SELECT unnest(['width', 'height']) AS c) WHERE p_size < 5 AND (j = 0 OR c = 'width')
 UNION ALL SELECT id, 'error', 'preset[' || nth || '].data[1].y', 'a placement''s number is missing' FROM p UNION ALL SELECT id, 'error', 'preset[' || nth || '].tags[1]', 'a tag is missing' FROM p WHERE p_size % 10 = 0
 UNION ALL SELECT id, 'warning', 'preset[' || nth || '].data[1].texture.src', 'src is not img' FROM p""")
def pack_error_paths(spark, sf_dir):
    rows = _library(spark, sf_dir)
    side = F.when(F.col("p_size") < 5, 0).otherwise(9)
    packed = library.presets(rows.select("stem", side.alias("width"), side.alias("height")), rows, 100, "tiles")
    other = lambda d: d.withField("y", F.lit(None).cast("int")).withField("height", F.lit(9)).withField("texture", d["texture"].withField("src", F.lit("elsewhere.png")))
    packed = packed.join(rows.select(F.concat(F.lit("tiles/"), "stem", F.lit(".png")).alias("img"), "p_size"), "img")
    broken = packed.withColumn("data", F.concat("data", F.transform("data", other))).withColumn("tags", F.when(F.col("p_size") % 10 == 0, F.array(F.lit("a"), F.lit(None).cast("string"))).otherwise(F.array(F.lit("a"))))
    return library.pack_errors(broken, ["id"])


@query(r"""SELECT p_partkey, '# ' || p_name || chr(10) || 'name: ' || p_name || '  # by hand' || chr(10) || chr(10) || 'tags: [' || replace(p_name, ' ', ', ') || ', "a, b"]' || chr(10) || '  state: inner' || chr(10) || 'state: ' || CASE WHEN p_size % 2 = 0 THEN 'null' ELSE '"true"' END || ' # seen' || chr(10) || 'other: 1' AS value FROM part""")
def rewritten_records(spark, sf_dir):
    n = F.col("p_name")
    text = F.concat(F.lit("# "), n, F.lit("\nname: old  # by hand\n\ntags: [x]\n  state: inner\nstate:   worn # seen\nother: 1"))
    state = F.when(F.col("p_size") % 2 == 1, "true")
    tags = F.concat(F.split(n, " "), F.array(F.lit("a, b")))
    return table(spark, sf_dir, "part").select("p_partkey", records.rewritten(text, {"name": n, "tags": tags, "state": state, "absent": F.lit("x")}).alias("value"))


@query(r"""SELECT p_partkey, 'a: 1' || chr(10) || 'state: ' || p_name || chr(10) || 'state: other' AS value, p_name <> 'red ring' AS changed FROM part""")
def first_line_set(spark, sf_dir):
    r = records.replaced_line(F.lit("a: 1\nstate: red ring\nstate: other"), "state", F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", r["text"].alias("value"), r["changed"].alias("changed"))


@query("SELECT md5(p_name) AS md5, arg_min(p_brand || '/' || p_partkey, {'f': p_size % 4, 'k': -p_partkey}) AS path FROM part GROUP BY 1")
def first_lines(spark, sf_dir):
    """Written as four files and read again: of equal digests the first file's first line wins."""
    rows = table(spark, sf_dir, "part").select((F.col("p_size") % 4).alias("f"), F.col("p_partkey").alias("k"), F.concat(F.md5("p_name"), F.lit("  "), "p_brand", F.lit("/"), "p_partkey").alias("value"))
    path = new_folder(spark)
    rows.repartition("f").sortWithinPartitions("f", F.desc("k")).select("f", "value").write.partitionBy("f").text(path)
    return files.hash_list(spark, path)


@query("""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN trim(role || ' a ' || turn) WHEN 1 THEN nullif(trim(text), '') WHEN 2 THEN turn || ' true 1.5' END AS told FROM conversations""")
def nested_payloads(spark, sf_dir):
    t, text = F.col("turn"), F.col("text")
    deep = F.struct(F.array(F.struct(F.struct(F.col("role").alias("string")).alias("value"))).alias("first"), F.lit("x").alias("second"))
    listed = F.concat(F.lit('{"caption": "no", "result": ['), F.to_json(deep["first"]), F.lit(', ["a", {"text": {"result": '), t, F.lit("}}], null, {}]}"))
    payload = F.when(t % 4 == 0, listed).when(t % 4 == 1, F.to_json(F.struct(F.array(F.array(text)).alias("string"), F.lit("later").alias("caption")))).when(t % 4 == 2, F.concat(F.lit("["), t, F.lit(", true, 1.5]")))
    payload = F.when(t % 4 == 2, F.replace(payload, F.lit("true"), F.lit('{"text": "true"}'))).when(t % 4 == 3, F.lit('{"text": null, "caption": "not reached"}')).otherwise(payload)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.payload_text(payload).alias("told"))


@query(f"SELECT {_CANON} AS canonical, count(*) AS members FROM part GROUP BY 1")
def group_assignment(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    ids = library.assigned_groups(rows, "p_partkey", "p_name", None, COLOURS, _NAMESPACE, _SPLIT, _MERGE)
    named = rows.select("p_partkey", T.canonical_name(F.col("p_name"), COLOURS).alias("canonical")).join(ids, "p_partkey")
    return named.groupBy("group_id").agg(F.min("canonical").alias("canonical"), F.count(F.lit(1)).alias("members")).drop("group_id")


@query("SELECT doc_id, source FROM documents WHERE starts_with(source, 'src1') AND contains(source, '7') AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY source, doc_id")
def selected_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return library.selected(docs, "source", "src1", "7", "quality").select("doc_id", "source")


# ---- ordered reports and names --------------------------------------------------------------------------------------


@query("SELECT p_type, n, row_number() OVER (ORDER BY n DESC, f)::INT AS place FROM (SELECT p_type, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY p_type) QUALIFY place <= 20")
def most_common_types(spark, sf_dir):
    return R.most_common(table(spark, sf_dir, "part").select("p_type", "p_partkey"), "p_type", "p_partkey", 20)


@query(f"""WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_extract_all(lower(text), '{WORD4}'), lambda w: length(w) >= 4)) AS w FROM conversations),
 p AS (SELECT a.conv_id, CASE WHEN len(list_distinct(list_concat(a.w, b.w))) = 0 THEN 0.0 ELSE len(list_intersect(a.w, b.w))::DOUBLE / len(list_distinct(list_concat(a.w, b.w))) END AS j FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.turn < b.turn),
 m AS (SELECT conv_id, count(*) AS members FROM t GROUP BY conv_id HAVING count(*) >= 2),
 s AS (SELECT e.conv_id, count(*) AS shared FROM (SELECT conv_id, x, count(*) AS c FROM (SELECT conv_id, unnest(w) AS x FROM t) GROUP BY ALL) e JOIN m ON e.conv_id = m.conv_id AND e.c = m.members GROUP BY 1)
 SELECT m.conv_id, members, round(min(j), 3) AS least, coalesce(any_value(shared), 0) AS shared FROM m JOIN p USING (conv_id) LEFT JOIN s USING (conv_id) GROUP BY m.conv_id, members HAVING min(j) < 0.3 AND coalesce(any_value(shared), 0) < 2""")
def flagged_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.content_words(F.col("text"), ()).alias("w"))
    return R.suspicious(R.overlap_audit(rows, "conv_id", "turn", "w"), 0.3, "conv_id").select("conv_id", "members", F.round("least", 3).alias("least"), "shared")


@query(r"""WITH f AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, '\.(png|jpe?g|svg|psd|webp|gif|bmp)$', '', 'i'), '^\d+\s*[-_.]\s*', ''), '[_-]\d{1,3}$', ''), '[_-]v\d+$', '') AS s
 FROM (SELECT p_partkey, p_size || '_' || replace(p_name, ' ', '-') || CASE WHEN p_partkey % 3 = 0 THEN '_v2' WHEN p_partkey % 3 = 1 THEN '_' || p_partkey ELSE '' END || '.PNG' AS n FROM part))
 SELECT p_partkey, array_to_string(list_transform(string_split(trim(regexp_replace(s, '[_\s-]+', ' ', 'g')), ' '), lambda w: CASE WHEN w = upper(w) AND w <> lower(w) THEN w ELSE upper(left(w, 1)) || lower(substr(w, 2)) END), ' ') AS description FROM f""")
def file_descriptions(spark, sf_dir):
    k = F.col("p_partkey")
    end = F.when(k % 3 == 0, "_v2").when(k % 3 == 1, F.concat(F.lit("_"), k)).otherwise("")
    name = F.concat(F.col("p_size").cast("string"), F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("-")), end, F.lit(".PNG"))
    return table(spark, sf_dir, "part").select("p_partkey", T.file_description(name).alias("description"))


@query(r"""WITH c AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'a ' || p_name || ' with a ' || p_type WHEN 1 THEN p_name || '; ' || p_brand ELSE upper(p_name) || '.' END AS t FROM part),
 n AS (SELECT p_partkey, CASE WHEN regexp_matches(t, '^an? ([a-z ]+?) with') THEN regexp_extract(t, '^an? ([a-z ]+?) with', 1) ELSE trim(regexp_extract(t, '^([^.,;]*)', 1)) END AS n FROM c)
 SELECT p_partkey, CASE WHEN regexp_matches(n, '(?i)gizmo$') THEN NULL WHEN n = lower(n) THEN array_to_string(list_transform(string_split(n, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') ELSE n END AS name FROM n""")
def caption_names(spark, sf_dir):
    k = F.col("p_partkey")
    caption = F.when(k % 3 == 0, F.concat(F.lit("a "), F.col("p_name"), F.lit(" with a "), F.col("p_type"))).when(k % 3 == 1, F.concat("p_name", F.lit("; "), F.col("p_brand"))).otherwise(F.concat(F.upper("p_name"), F.lit(".")))
    return table(spark, sf_dir, "part").select("p_partkey", T.name_from_caption(caption, [], r"^an? ([a-z ]+?) with\b", ["(?i:gizmo)$"]).alias("name"))


# ---- functions of names, specs and numbers ---------------------------------------------------------------------------


@query("SELECT p_partkey, CASE WHEN contains(n, 'bolt') THEN 'fastener' WHEN contains(n, 'red') THEN 'paint' WHEN contains(n, 'large') THEN 'bulk' END AS kind FROM (SELECT p_partkey, lower(p_name) AS n FROM part)")
def first_keywords(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.first_keyword(F.upper("p_name"), [("bolt", "fastener"), ("red", "paint"), ("large", "bulk")]).alias("kind"))


@query(r"""SELECT p_partkey, title, '"' || replace(replace(q, '\', '\\'), '"', '\"') || '"' AS quoted, '[' || array_to_string(string_split(p_name, ' '), ', ') || ']' AS tags
 FROM (SELECT p_partkey, p_name, p_name || ' "' || p_size || '" \ ' || p_brand AS q, array_to_string(list_transform(string_split(p_name || ' ' || p_brand, ' '), lambda w: CASE WHEN w = upper(w) AND w <> lower(w) THEN w ELSE upper(left(w, 1)) || lower(substr(w, 2)) END), ' ') AS title FROM part)""")
def titles_and_scalars(spark, sf_dir):
    text = F.concat("p_name", F.lit(' "'), F.col("p_size").cast("string"), F.lit('" \\ '), F.col("p_brand"))
    title = T.title_words(F.concat_ws(" ", "p_name", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", title.alias("title"), T.quoted(text).alias("quoted"), T.quoted_list(F.split("p_name", " ")).alias("tags"))


_SPEC_SIZES, _SPEC_MATERIALS = ("small", "medium", "large"), ("brass", "stone")


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 3 <> 2 THEN p_size END AS x, CASE WHEN p_partkey % 3 <> 2 THEN -p_size END AS y, CASE WHEN p_partkey % 3 = 0 THEN 64 END AS size,
 CASE WHEN p_partkey % 4 < 3 THEN p_name END AS name, CASE WHEN p_partkey % 4 < 3 THEN split_part(p_name, ' ', 1) END AS anchor, CASE p_partkey % 4 WHEN 0 THEN 'medium' WHEN 1 THEN 'large' WHEN 2 THEN 'small' END AS label, CASE WHEN p_partkey % 4 = 2 THEN 'brass' END AS material,
 CASE WHEN p_partkey % 3 = 0 THEN p_size END AS deck, CASE WHEN p_partkey % 3 = 0 THEN 'ramp' END AS role, CASE WHEN p_partkey % 3 = 0 THEN 'north' END AS side FROM (SELECT * REPLACE (p_size::INT AS p_size) FROM part)""")
def spec_parts(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    place = F.when(k % 3 == 2, F.col("p_name")).otherwise(F.concat("p_name", F.lit(":"), size, F.lit(",-"), size, F.when(k % 3 == 0, ",64").otherwise("")))
    anchor = F.concat(F.col("p_name"), F.lit(":"), F.substring_index("p_name", " ", 1), F.when(k % 4 == 1, ", large").when(k % 4 == 2, ",small,brass").when(k % 4 == 3, ",huge").otherwise(""))
    side = F.concat(F.lit("deck"), size, F.when(k % 3 == 0, "= ramp:north ").when(k % 3 == 1, "=stairs:north").otherwise("=ramp"))
    parsed = table(spark, sf_dir, "part").select("p_partkey", T.place_spec(place).alias("p"), T.anchor_spec(anchor, _SPEC_SIZES, _SPEC_MATERIALS).alias("a"), T.side_spec(side, ("ramp", "windscreen"), ("north", "south")).alias("s"))
    return parsed.select("p_partkey", "p.x", "p.y", "p.size", "a.name", "a.anchor", F.col("a.size").alias("label"), "a.material", "s.deck", "s.role", "s.side")


@query("""SELECT vec_id, (vec_id * 37) % 256 AS r, (vec_id * 11) % 256 AS g, vec_id % 256 AS b, CASE WHEN vec_id % 7 = 6 THEN 255 ELSE (vec_id % 7) * 51 END AS a FROM embeddings""")
def overlay_colours(spark, sf_dir):
    v = F.col("vec_id")
    color = F.concat(F.lit("#"), *[F.lpad(F.hex(x % 256), 2, "0") for x in (v * 37, v * 11, v)])
    return _few(spark, sf_dir).select("vec_id", T.rgba(color, (v % 7) / 5.0).alias("c")).select("vec_id", *[F.col(f"c.{x}").cast("long").alias(x) for x in "rgba"])


@query("""SELECT vec_id, bit_count(xor(vec_id * 2654435761, (vec_id // 8) * 8 * 2654435761)) <= 5 AS near FROM embeddings""")
def near_hashes(spark, sf_dir):
    hashed = lambda v: v * F.lit(2654435761)
    v = F.col("vec_id")
    return _few(spark, sf_dir).select("vec_id", H.near_hash(hashed(v), hashed(F.floor(v / 8) * 8)).alias("near"))


@query("""WITH s AS (SELECT vec_id, embedding[1:5]::DOUBLE[] AS s FROM embeddings), e AS (SELECT vec_id, list_transform(s, lambda x: exp((x - list_max(s)) * 100)) AS e FROM s)
 SELECT vec_id, round(list_max(e) / list_sum(e), 6) AS best, round(list_sum(e), 6) AS total FROM e""")
def label_shares(spark, sf_dir):
    s = F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double"))
    share = F.array_max(V.softmax(F.col("s")))
    return _few(spark, sf_dir).select("vec_id", s.alias("s")).select("vec_id", F.round(share, 6).alias("best"), F.round(1.0 / share, 6).alias("total"))


@query("""SELECT o_orderkey, greatest(abs(x - 120), abs(y - 90), abs(z - 60)) AS far, greatest(abs(x - 120), abs(y - 90), abs(z - 60)) <= 40 AS inside FROM (SELECT o_orderkey, o_orderkey % 256 AS x, (o_orderkey * 7) % 256 AS y, o_custkey % 256 AS z FROM orders)""")
def colour_distances(spark, sf_dir):
    a = [F.col("o_orderkey") % 256, F.col("o_orderkey") * 7 % 256, F.col("o_custkey") % 256]
    b = [F.lit(120), F.lit(90), F.lit(60)]
    return table(spark, sf_dir, "orders").select("o_orderkey", G.chebyshev(a, b).alias("far"), G.within(a, b, 40).alias("inside"))


@query("""SELECT p_partkey, CASE WHEN p_size < 40 THEN 40 ELSE p_size // 8 * 8 END AS side, (CASE WHEN p_size < 40 THEN greatest(40, round_even(p_size * 2 * (40.0::DOUBLE / p_size), 0)::INT) ELSE p_size * 2 END) // 8 * 8 AS longer, p_size * 60 >= 1500 AND (p_size * 60) / 10000.0::DOUBLE >= 0.15 AS solid,
 round((p_size - 3.5::DOUBLE) * 12, 2) AS pixel, p_name IN ('red widget') OR regexp_matches(p_name, '^old ') AS garbage, contains(lower(p_name || ' ' || p_brand), 'gizmo') OR contains(lower(p_name || ' ' || p_brand), 'brand#1') AS wanted,
 CASE WHEN p_size % 4 = 3 THEN 'rotation' WHEN p_partkey % 2 = 0 AND p_partkey % 3 <> 0 THEN 'mirror' END AS breach FROM part""")
def gates_and_sizes(spark, sf_dir):
    size, k = F.col("p_size"), F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        G.latent_size(size, size * 2, 40)["width"].alias("side"),
        G.latent_size(size, size * 2, 40)["height"].alias("longer"),
        verdicts.component_gate(size * 60, F.lit(10000.0), 1500, 0.15).alias("solid"),
        G.to_pixels(size.cast("double"), F.lit(3.5), F.lit(12)).alias("pixel"),
        verdicts.garbage_name(F.col("p_name"), ["red widget"], _NAME_RULES[:1]).alias("garbage"),
        verdicts.terms_match(F.split("p_name", " "), F.col("p_brand"), ["Gizmo", "Brand#1"]).alias("wanted"),
        verdicts.policy_breach(size % 4, k % 2 == 0, F.array(*map(F.lit, (0, 1, 2))), k % 3 == 0).alias("breach"),
    )


@query("""SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN trim(text) WHEN 1 THEN 'turn ' || turn END AS told FROM (SELECT conv_id, turn, text FROM conversations)""")
def payload_texts(spark, sf_dir):
    t = F.col("turn")
    payload = F.when(t % 3 == 0, F.to_json(F.struct(F.col("text").alias("caption"), t.alias("n")))).when(t % 3 == 1, F.to_json(F.array(F.concat(F.lit("turn "), t)))).otherwise(F.lit("{broken"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.payload_text(payload).alias("told"))


@query(r"""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size % 2 = 0 THEN 'bow=' || p_name END, CASE WHEN p_size % 3 = 0 THEN 'stern=' || left(p_brand, 60) END], lambda x: x IS NOT NULL), ' | ') AS summary,
 trim(p_name || '. ', '. ') AS clause, trim(', ' || p_type || ' ,', ', ') AS caption FROM part""")
def zone_summaries(spark, sf_dir):
    size = F.col("p_size")
    zones = F.map_from_arrays(F.array(F.lit("bow"), F.lit("stern")), F.array(F.when(size % 2 == 0, F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \n ")))), F.when(size % 3 == 0, F.col("p_brand"))))
    rows = table(spark, sf_dir, "part")
    return rows.select("p_partkey", T.zone_summary(zones, ["bow", "stern", "keel"]).alias("summary"), T.trimmed_clause(F.concat("p_name", F.lit(". "))).alias("clause"), T.trimmed_caption(F.concat(F.lit(", "), "p_type", F.lit(" ,"))).alias("caption"))
