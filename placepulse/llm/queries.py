"""The operators applied to the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placepulse.llm import alignment, conversations, conversations_sql, exact_dedup, mixing, near_dedup, packing, quality, scoring, sharding, suffixes, topk, warc, wrappers
from placepulse.llm.common import table
from placepulse.session import scratch_path


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC archives and back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "segments", "complete"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(table(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.drop("text_hash")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damaged(turns), turns)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))[0]


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_texts(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_best_fit_packing,
        op3_near_dedup,
        op4_suffix_dedup,
        op5_topk,
        op6_sharding,
        op7_html_text,
        op8_mixing,
        op9_exact_dedup,
        op10_quality,
        op11_conversation_repair,
        op12_tokenizer_alignment,
        op13_lm_scoring,
    )
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SQL = {
    "op1_warc": f"""WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT *, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p)
    SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
        1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31), 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, url,
    CAST(CASE WHEN page_id <> first THEN 1 ELSE greatest(1, ceil(framed / {warc.SEGMENT_BYTES}.0)) END AS INTEGER) AS segments,
    true AS complete FROM (SELECT *, octet_length(b) + 85 + 5
        + (octet_length(b) // {warc.CHUNK_BYTES}) * (4 + length(printf('%x', {warc.CHUNK_BYTES})))
        + CASE WHEN octet_length(b) % {warc.CHUNK_BYTES} > 0 THEN 4 + length(printf('%x', octet_length(b) % {warc.CHUNK_BYTES})) ELSE 0 END
        AS framed FROM d)""",
    "op3_near_dedup": r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' '))) END AS ss FROM w),
    e AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS sh FROM s),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.sh = y.sh AND x.doc_id <> y.doc_id
        GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
    SELECT s.doc_id, CAST(len(ss) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
    FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = s.doc_id""",
    "op4_suffix_dedup": """WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    h AS (SELECT doc_id, octet_length(b) AS n, hex(b) AS x FROM t),
    w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS m FROM (SELECT doc_id, x, unnest(range(n - 399)) AS i FROM h WHERE n >= 400)),
    r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
    s AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS first FROM r),
    g AS (SELECT doc_id, i, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM s),
    u AS (SELECT doc_id, k, min(i) AS a, max(i) + 400 AS z FROM g GROUP BY ALL),
    v AS (SELECT *, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM u),
    c AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
        string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS kept FROM v JOIN h USING (doc_id) GROUP BY doc_id)
    SELECT h.doc_id, CAST(h.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) AS kept_sha256 FROM h LEFT JOIN c USING (doc_id)""",
    "op5_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_exact_dedup": r"""WITH t AS (SELECT doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
    g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op11_conversation_repair": conversations_sql.SQL,
}
