"""Registered queries of the text operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelake.llm import digest_runs, line_chunks, mtree, packing, personal, pieces, ppm, prefix_trie, quality, secrets, simhash, term_scan, toxicity
from swipelake.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"), with_ids=False)


def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find(table(spark, sf, "documents"))


def op3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode(table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_mtree(spark: SparkSession, sf: str) -> DataFrame:
    return mtree.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op6_personal(spark: SparkSession, sf: str) -> DataFrame:
    return personal.find(table(spark, sf, "documents"))


def op7_ppm(spark: SparkSession, sf: str) -> DataFrame:
    return ppm.score(table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op9_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return line_chunks.dedup(table(spark, sf, "documents").select("doc_id", "text"), runs=True)


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


def op11_term_scan(spark: SparkSession, sf: str) -> DataFrame:
    return term_scan.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_digest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return digest_runs.find(table(spark, sf, "documents"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.nodes(table(spark, sf, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_packing, op2_secrets, op3_pieces, op4_mtree, op5_simhash, op6_personal, op7_ppm, op8_toxicity, op9_line_chunks, op10_quality,
        op11_term_scan, op12_digest_runs, op13_prefix_trie,
    )
    return {f.__name__: f for f in every}


# Every query vector against every row; floor gives whole numbers, and doubles hold the products exactly.
MTREE_SQL = """
  WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w FROM embeddings
             WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
       s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
             FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
       r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
  SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5"""


# All scores of all documents; only terms of some item are counted one by one.
TERMS_SQL = r"""
  WITH lowered AS (SELECT doc_id, row_number() OVER () AS place, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
       held AS (SELECT place, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM lowered),
       d AS (SELECT place, doc_id, len(terms) AS n, terms FROM held WHERE len(terms) > 0),
       whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
       i AS (SELECT row_number() OVER () AS item, item_id,
                    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
       q AS (SELECT item, item_id, term, count(*) AS times FROM i GROUP BY ALL),
       tf AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
       w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
             FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
       m AS (SELECT place, doc_id, 75 + (25 * n * n_docs) // n_terms AS m FROM d, whole),
       s AS (SELECT item, item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
             FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (place) GROUP BY item, item_id, place, doc_id),
       r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
  SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 20"""

COPIES_SQL = r"""
  WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
       r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS place,
                    first_value(doc_id) OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM t)
  SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM r"""


# crc32 bit by bit; a node is named by the digests of its turns one after the other.
TRIE_SQL = """
  WITH RECURSIVE c AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
       crc(conv_id, i, r) AS (
         SELECT conv_id, 0, CAST(4294967295 AS BIGINT) FROM c
         UNION ALL
         SELECT conv_id, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, CAST(3988292384 AS BIGINT)) ELSE x // 2 END
         FROM (SELECT conv_id, i, CASE WHEN i % 8 = 0 THEN xor(r, CAST(ascii(substr(CAST(conv_id AS VARCHAR), i // 8 + 1, 1)) AS BIGINT)) ELSE r END AS x
               FROM crc WHERE i < 8 * length(CAST(conv_id AS VARCHAR)))),
       h AS (SELECT conv_id, xor(r, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = 8 * length(CAST(conv_id AS VARCHAR))),
       s AS (SELECT conv_id, turn, text, to_base64(unhex(substr(sha256(length(role) || ':' || role || text), 1, 30))) AS token
             FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
       t AS (SELECT conv_id, text, token, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) - 1 AS place FROM s),
       heads AS (SELECT h.conv_id, place, text, token FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 5 AND place < h),
       taken AS (SELECT h.conv_id, h.h, count(heads.place) AS n FROM h LEFT JOIN heads USING (conv_id) GROUP BY h.conv_id, h.h),
       r AS (SELECT * FROM heads UNION ALL SELECT conv_id, n + place - h, text, token FROM t JOIN taken USING (conv_id) WHERE place >= h),
       p AS (SELECT conv_id, CAST(0 AS BIGINT) AS depth, 0 AS size, '' AS node, CAST(NULL AS VARCHAR) AS parent FROM c
             UNION ALL
             SELECT conv_id, place + 1, octet_length(encode(text)), node, substr(node, 1, length(node) - 20)
             FROM (SELECT *, string_agg(token, '') OVER (PARTITION BY conv_id ORDER BY place) AS node FROM r)),
       ends AS (SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
                FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node),
       v AS (SELECT node, parent, depth, size, min(conv_id) AS conv_id, count(*) AS n FROM p GROUP BY node, parent, depth, size),
       k AS (SELECT parent AS node, count(*) AS n_children FROM v WHERE parent IS NOT NULL GROUP BY parent),
       below AS (SELECT DISTINCT a.node, b.node AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
       sums AS (SELECT below.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, CAST(sum((v.n - 1) * v.size) AS BIGINT) AS saved_tokens
                FROM below JOIN v ON v.node = below.under LEFT JOIN k ON k.node = below.under GROUP BY below.node)
  SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
         sha256(coalesce(ids, '')) AS ends_sha256
  FROM v JOIN sums USING (node) LEFT JOIN v u ON u.node = v.parent LEFT JOIN k ON k.node = v.node LEFT JOIN ends ON ends.node = v.node"""


def oracle_sql() -> dict[str, str]:
    return {"op4_mtree": MTREE_SQL, "op11_term_scan": TERMS_SQL, "op12_digest_runs": COPIES_SQL, "op13_prefix_trie": TRIE_SQL}
