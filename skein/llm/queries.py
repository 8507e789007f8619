"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, common, jaccard, language, mixing, neighbours, periodic, pii, piece_bpe, quality_model, quality_rules, sharding, token_count


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved_shards(common.table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(common.table(spark, sf_dir, "labels"))
    rows = quality_rules.judged(common.table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    return rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality_model.scored(docs, quality_model.learned(docs, common.table(spark, sf_dir, "labels")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(common.table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return language.labelled(docs, language.learned(docs))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.reported(common.table(spark, sf_dir, "documents"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_decode(common.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(common.table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(common.table(spark, sf_dir, "documents"), planted=True)


_ALL = (
    op1_token_counts, op2_cross_polytope, op3_interleaved_shards, op4_block_mixing, op5_quality_rules, op6_quality_model, op7_byte_bpe, op8_jaccard_join,
    op9_language, op10_pii, op11_piece_bpe, op12_centroids, op13_periodic_runs,
)
QUERIES = {f.__name__: f for f in _ALL}


def _centroid_rounds(rounds: int) -> str:
    """Tables c1, c2, ... of centroids after each round, and the last assignment as `z`, from v(r, vec_id, x) and c0(c, x)."""
    near = "(SELECT r, arg_min(c, {{'d': d, 'c': c}}) AS c, min(d) AS d FROM (SELECT v.r, c.c, (list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::BIGINT AS d FROM v, c{i} c) GROUP BY r)"
    each = """
 c{j} AS (SELECT c, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (SELECT c, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS x FROM (SELECT a.c, i, sum(e)::BIGINT AS s, count(*) AS n FROM """ + near + """ a JOIN (SELECT r, unnest(x) AS e, unnest(range(1, 65)) AS i FROM v) USING (r) GROUP BY a.c, i) GROUP BY c) m USING (c)),"""
    return "".join(each.format(i=i, j=i + 1) for i in range(rounds)) + " z AS " + near.format(i=rounds)


#: The checksum's table from its rule: eight halvings of each byte with the reversed polynomial 0xEDB88320.
_CRC_TABLE = "SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i)) AS t"

ORACLES: dict[str, str] = {
    "op3_interleaved_shards": """
WITH k AS (""" + _CRC_TABLE + """),
 b AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
 c AS (SELECT doc_id, source, size, xor(list_reduce(list_transform(range(0, size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]), 4294967295), 4294967295) AS crc FROM b, k),
 u AS (SELECT *, ('0x' || left(md5('7:' || doc_id || ':' || crc), 12))::BIGINT::DOUBLE / 281474976710656 AS u, dense_rank() OVER (ORDER BY source NULLS LAST) AS sid FROM c),
 f AS (SELECT *, (row_number() OVER (PARTITION BY sid ORDER BY u, doc_id, size, crc) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY sid) AS f FROM u),
 p AS (SELECT *, row_number() OVER (ORDER BY f, sid, doc_id, size, crc) - 1 AS place, count(*) OVER () AS n FROM f)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (place * 8 // n)::INTEGER AS shard, (place - (n * (place * 8 // n) + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM p
""",
    "op8_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r(node, reach) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(reach) AS least FROM r GROUP BY node) c ON c.node = d.doc_id
""",
    "op12_centroids": f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
 c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v QUALIFY c < 16),{_centroid_rounds(3)}
SELECT vec_id, z.c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY z.c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c3.x::BIGINT[], ',')) AS centroid_sha256 FROM z JOIN v USING (r) JOIN c3 ON c3.c = z.c
""",
    "op13_periodic_runs": rf"""
WITH k AS ({_CRC_TABLE}), d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0, hex(encode(doc_id::VARCHAR)) AS b FROM documents),
 h AS (SELECT doc_id, w0, len(w0) AS n, xor(list_reduce(list_transform(range(0, len(b) // 2), lambda i: ('0x' || substr(b, 2 * i + 1, 2))::BIGINT), lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1]), 4294967295), 4294967295) AS h FROM d, k),
 a AS (SELECT *, h // 10 % n AS a, 1 + (n - h // 10 % n) // (3 + h // 10 % 8) AS p FROM h WHERE n > 0),
 w AS MATERIALIZED (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(0, n), lambda i: w0[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w0 END AS w FROM a),
 e AS MATERIALIZED (SELECT doc_id, n, unnest(w) AS x, unnest(range(0, n)) AS i FROM w),
 g AS (SELECT doc_id, n, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS x FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
 m AS (SELECT s.doc_id, s.i, t.i - s.i AS q FROM g s JOIN g t ON s.doc_id = t.doc_id AND s.x = t.x AND t.i > s.i AND 4 * (t.i - s.i) <= s.n),
 u AS (SELECT doc_id, q, min(i) AS s, max(i) + 5 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS o FROM m) GROUP BY doc_id, q, o),
 r AS MATERIALIZED (SELECT doc_id, s, e, min(q) AS q FROM u WHERE e - s >= greatest(6, 4 * q) GROUP BY doc_id, s, e),
 b AS (SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'n': e - s, 'q': q}}, {{'x': -(e - s)::DOUBLE / q, 's': s, 'q': q}}) AS b, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM r GROUP BY doc_id),
 c AS (SELECT e.doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM e ANTI JOIN (SELECT DISTINCT r.doc_id, unnest(range(s + q, e)) AS i FROM r) g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.b.s AS start, b.b.n AS length, b.b.q AS period, 1000 * b.b.n // b.b.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM d LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)
""",
}
