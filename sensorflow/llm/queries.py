"""One query per operator over its whole intended table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .common import in_bucket, table, written
from .conversation_trie import conversation_trie
from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .html_text import extract_text
from .language import identify_language
from .near_dedup import NearParams, near_duplicates
from .secrets import listed, scan_secrets
from .token_counts import count_tokens
from .toxicity import learn, score_toxicity
from .url_filter import judge_urls
from .warc import read_warc, resolved, warc_folder, write_warc
from .whitening import whiten


def held_out() -> Column:
    """Rows that no training sees: crc32(doc_id as text) mod 4 is 2."""
    return in_bucket("doc_id", 4, 2)


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearParams(words=4, percent=80))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_warc(table(spark, sf_dir, "pages"), warc_folder(spark))
    found = read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return resolved(written(found, "records"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    found = score_toxicity(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (identify_language(docs, ~held_out())
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe_round_trip(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages"), carry=("url",))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_warc": op2_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_filter": op5_url_filter,
    "op6_toxicity": op6_toxicity,
    "op7_language_id": op7_language_id,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_secret_scan": op9_secret_scan,
    "op10_html_extraction": op10_html_extraction,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_token_counts": op13_token_counts,
}

ORACLE: dict[str, str] = {
    "op2_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        s AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
                     sha1(h) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM s)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM m""",
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               coalesce(doc_id = min(doc_id) OVER (PARTITION BY t), FALSE) AS kept,
               sha256(t) AS text_sha256
        FROM d""",
    "op11_conversation_trie": r"""
        WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
                   FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT conv_id, xor(list_reduce(
                    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
                                                                     lambda s: ascii(s)::UBIGINT)),
                    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)::UBIGINT[]),
                        lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 4 AS h
                FROM (SELECT DISTINCT conv_id FROM c)),
        turns AS (SELECT i.conv_id, c.p, c.role, c.text FROM ids i
                  JOIN c ON c.conv_id = i.conv_id - i.conv_id % 20 AND c.p <= i.h
                  UNION ALL
                  SELECT i.conv_id, c.p, c.role, c.text FROM ids i JOIN c ON c.conv_id = i.conv_id AND c.p > i.h),
        prefixes AS (SELECT conv_id, row_number() OVER w AS depth,
                            string_agg(md5(strlen(role)::VARCHAR || ':' || role || text), '') OVER w AS k,
                            len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
                     FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
        members AS (SELECT conv_id, depth, k, words FROM prefixes
                    UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
        nodes AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own
                  FROM members GROUP BY depth, k),
        ended AS (SELECT depth, k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
                  FROM (SELECT conv_id, max(depth) AS depth, max_by(k, depth) AS k FROM members GROUP BY conv_id)
                  GROUP BY depth, k),
        degrees AS (SELECT left(k, 32 * (depth - 1)) AS k, depth - 1 AS depth, count(*) AS n_children
                    FROM nodes WHERE depth > 0 GROUP BY ALL),
        full_nodes AS (SELECT n.*, coalesce(g.n_children, 0) AS n_children
                       FROM nodes n LEFT JOIN degrees g ON g.k = n.k AND g.depth = n.depth),
        subtrees AS (SELECT a AS depth, left(k, 32 * a) AS k, sum(own) AS saved,
                            count(*) FILTER (WHERE n_children = 0) AS n_leaves
                     FROM (SELECT *, unnest(range(depth + 1)) AS a FROM full_nodes) GROUP BY ALL)
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
               n.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
               coalesce(e.ends, sha256('')) AS ends_sha256
        FROM full_nodes n JOIN subtrees s ON s.k = n.k AND s.depth = n.depth
        LEFT JOIN nodes p ON p.k = left(n.k, 32 * (n.depth - 1)) AND p.depth = n.depth - 1
        LEFT JOIN ended e ON e.k = n.k AND e.depth = n.depth""",
}
