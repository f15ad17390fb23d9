"""The registered queries of the subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamcharts.llm import (alignment, cover_tree, exact_dedup, hard_negatives, katz, language, mixing, near_dedup, pii, secrets, segmentation, sharding,
                              toxicity)
from streamcharts.llm.common import table

SHARDS = 24


def op1_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op2_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_cover_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"))


def op4_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's samples, the identifiers as a digest, with digest and length of the text that they decode to."""
    return segmentation.encode(table(spark, sf_dir, "documents"), spelled=True).withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")


def op5_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_stateful_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


def op11_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op12_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's labels: those of every seventh identifier stand one further."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label)


def op13_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups as their digest, as the operator gives it on demand."""
    return alignment.align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_katz_scoring, op2_pivotal_mixing, op3_cover_tree_search, op4_gumbel_segmentation, op5_guess_cost_secrets, op6_weak_supervision_pii, op7_chosen_path_near_dedup, op8_jump_sharding,
                                   op9_noisy_channel_toxicity, op10_stateful_dedup, op11_byte_cnn_language, op12_four_russians_negatives,
                                   op13_shared_cut_alignment)}

# Number 8: checksums bit by bit and the 64-bit generator in 128 bits, as DuckDB has neither.
ORACLE = {
    "op3_cover_tree_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                     CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score FROM s
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
    "op7_chosen_path_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM d),
        c AS (SELECT g, list_sort(g) AS k, min(doc_id) AS id FROM (SELECT doc_id, list_sort(g) AS g FROM s WHERE len(g) > 0) GROUP BY g),
        x AS (SELECT id, len(g) AS n, unnest(g) AS t FROM c),
        p AS (SELECT a.id AS a, b.id AS b, count(*) AS m FROM x a JOIN x b ON a.t = b.t AND a.id < b.id
              AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY a.id, b.id),
        l AS (SELECT p.a, p.b FROM p JOIN c ca ON ca.id = p.a JOIN c cb ON cb.id = p.b
              WHERE 100 * m >= 75 * (len(ca.g) + len(cb.g) - m)),
        r(id, to_id) AS (SELECT id, id FROM c UNION SELECT r.id, q.v FROM r JOIN
              (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l) q ON q.u = r.to_id),
        o AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY id)
        SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(o.component_id, s.doc_id) AS component_id,
               s.doc_id = coalesce(o.component_id, s.doc_id) AS kept
        FROM s LEFT JOIN c ON c.g = list_sort(s.g) LEFT JOIN o ON o.id = c.id
    """,
    "op8_jump_sharding": """
        WITH chunks AS (SELECT CAST(greatest(1, ceil(count(*) / (16384 * 24))) AS BIGINT) AS n FROM documents),
        crc_table AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
        d AS (
            SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        s AS (
            SELECT doc_id, octet_length(b) + 8 AS size,
                   xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                       list_transform(regexp_extract_all(hex(b), '..'), lambda x: CAST('0x' || x AS BIGINT))),
                       lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS text_crc32,
                   CASE WHEN doc_id < 0 THEN CAST(doc_id AS HUGEINT) + 18446744073709551616 ELSE CAST(doc_id AS HUGEINT) END AS key
            FROM d, crc_table),
        j AS (
            SELECT *, list_reduce(list_prepend({'k': key, 'j': CAST(0 AS BIGINT), 's0': CAST(0 AS BIGINT), 's1': CAST(0 AS BIGINT)},
                list_transform(range(25), lambda i: {'k': CAST(0 AS HUGEINT), 'j': CAST(0 AS BIGINT), 's0': CAST(0 AS BIGINT), 's1': CAST(0 AS BIGINT)})),
                lambda a, i: CASE WHEN a.j >= 25 THEN a ELSE {
                    'k': (a.k * 2862933555777941757 + 1) % 18446744073709551616,
                    'j': CAST(floor((a.j + 1) * (CAST(2147483648 AS DOUBLE) /
                              CAST(((a.k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT),
                    's0': CASE WHEN a.j < 24 THEN a.j ELSE a.s0 END, 's1': a.j} END) AS e
            FROM s)
        SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(e.s0 AS INTEGER) AS shard,
               CAST(row_number() OVER (PARTITION BY e.s0 ORDER BY chunk, doc_id, text_crc32, size) - 1 AS BIGINT) AS slot,
               CAST(e.s1 AS INTEGER) AS grown_shard
        FROM (SELECT *, ((doc_id % n + n) % n + text_crc32) % n AS chunk FROM j, chunks)
    """,
    "op10_stateful_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM d
    """,
    "op12_four_russians_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
                     CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
              FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
              AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
}
