"""One query for each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.conversations import conversation_key, damaged, digests, repair_conversations
from tidemark.llm.decontaminate import benchmark_hits
from tidemark.llm.language_id import identify_language, train_language_model
from tidemark.llm.language_model import score_texts
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.pii import BASE_KINDS, find_personal_data
from tidemark.llm.pivot_search import top_inner_products
from tidemark.llm.quality import MEASURES, quality_cascade
from tidemark.llm.resampling import resample
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.token_counts import token_counts
from tidemark.llm.warc import archive_round_trip

MOST_TOKENS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(folds: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; true without an id, which is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == remainder, F.lit(True))


def language_model(docs: DataFrame):
    return train_language_model(docs.where(~in_fold(3, 1)))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality_cascade(table(spark, sf_dir, "documents"), measures=MEASURES)
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return checked.select("doc_id", *MEASURES, base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, language_model(docs))
    return found.select("doc_id", in_fold(3, 1).alias("held_out"), "lang_pred", "score", "rejected")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MOST_TOKENS).alias("over_limit"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, docs.where(~in_fold(7, 2)))
    return scored.select("doc_id", in_fold(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.col("hit_items").cast("array<string>"), ",")
    return hits.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), contaminated().alias("contaminated"))


def contaminated() -> Column:
    """A twentieth of the words or more lie in windows of the benchmark."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), F.array_join("licenses", ",").alias("licenses"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, lines = repair_conversations(damaged(rows))
    every = rows.select("conv_id").distinct().withColumn("conv", conversation_key("conv_id"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    found = every.join(report, "conv", "left").join(digests(lines), "conv", "left")
    numbers = [number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_token_counts": op4_token_counts,
    "op5_language_model": op5_language_model,
    "op6_decontamination": op6_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_top_k": op11_top_k,
    "op12_conversations": op12_conversations,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
        ), cut AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                   regexp_extract_all(t, '[^\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+') AS shown
            FROM docs
        ), windows AS (
            SELECT rid, i, list_slice(w, i, i + 4) AS win FROM cut, unnest(range(1, len(w) - 3)) r(i)
        ), often AS (
            SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM windows) WHERE c > 1
        ), repeats AS (
            SELECT rid, count(DISTINCT i + k) AS n FROM often, range(0, 5) s(k) GROUP BY rid
        ), measured AS (
            SELECT rid, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                   (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                   len(lines) AS n_lines, len(regexp_extract_all(t, '[A-ZÀ-ÖØ-Þ]')) AS upper_, len(regexp_extract_all(t, '[a-zà-öø-ÿ]')) AS lower_,
                   len(list_filter(shown, lambda x: regexp_matches(x, '[\p{L}\p{Nl}\p{No}]'))) AS lettered
            FROM cut LEFT JOIN repeats USING (rid)
        ), judged AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines
               AND 2 * n_words <= word_chars AND word_chars <= 20 * n_words AND upper_ <= lower_ AND 2 * lettered >= n_words AS kept
        FROM judged
    """,
    "op6_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(list_slice(w, i, i + 12), ' ') AS win
            FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) r(i) WHERE len(w) > 0
        ), places AS (
            SELECT rid, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
            FROM docs, (SELECT DISTINCT size FROM windows), unnest(range(1, len(w) - size + 2)) r(i) WHERE len(w) >= size
        ), found AS (
            SELECT rid, i, size, item_id FROM places JOIN windows USING (size, win)
        ), hit AS (
            SELECT rid, count(DISTINCT place) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + size)) AS place FROM found) GROUP BY rid
        ), named AS (
            SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY rid
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
    """,
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages
        ), marked AS (
            SELECT *, strlen(payload) >= 100 AND page_id <> first_id AS again FROM payloads
        )
        SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to
        FROM marked
    """,
    "op11_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
