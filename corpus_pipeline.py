"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_encode
from tidemark.llm.decontaminate import benchmark_hits
from tidemark.llm.language_id import identify_language
from tidemark.llm.pii import find_personal_data
from tidemark.llm.queries import contaminated, language_model, table
from tidemark.llm.simhash import near_duplicates
from tidemark.shared import new_folder

ROW = "_row"


def _as_row(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one, so that their names can't clash."""
    return docs.select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias(ROW))


def _columns(docs: DataFrame, **fresh: Column) -> list[Column]:
    """The columns of ``docs`` out of such rows, some of them anew."""
    return [fresh[c].alias(c) if c in fresh else F.col("text" if c == "text" else f"{ROW}.`{c}`").alias(c) for c in docs.columns]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure enough; rows without a letter go. Learns from the labelled documents it gets, outside the
    held-out fold. Repeated rows and null ids are judged like others; without labelled rows or without rows nothing stays.
    """
    found = identify_language(_as_row(docs), language_model(docs), keep=["text", ROW])
    return found.where(~F.col("rejected")).select(*_columns(docs))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that with the smallest id, rows without an id last.

    What is compared and kept is a row's id with its text, so an id that repeats with another text is another document. Of
    rows alike in both the one whose other columns have the smallest hash stays. Null and empty texts are one group; an empty table stays empty.
    """
    rows = _as_row(docs)
    doc_id = F.col(f"{ROW}.doc_id")
    key = F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0).cast(docs.schema["doc_id"].dataType)).alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha"))
    keyed = rows.withColumn("key", key)
    stays = near_duplicates(keyed.select("key", "text"), id_column="key").where("key = component_id").select("key").distinct()
    kept = keyed.join(stays, "key", "left_semi").groupBy("key")
    one = kept.agg(F.min_by(F.struct("text", ROW), F.struct(F.sha2(F.to_json(ROW), 256), F.col("text").isNull())).alias("kept"))
    return one.select("kept.*").select(*_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows. Null and empty texts, repeated rows
    and null ids stay; an empty benchmark takes nothing, an empty table stays empty.
    """
    hits = benchmark_hits(_as_row(docs), table(spark, sf_dir, "benchmark"), keep=["text", ROW])
    return hits.where(~contaminated()).select(*_columns(docs))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in the text replaced by its kind; ``n_chars`` is that of the new text. A null text stays
    null, repeated rows and null ids stay, an empty table stays empty.
    """
    found = find_personal_data(_as_row(docs), keep=[ROW])
    return found.select(*_columns(docs, text=F.col("redacted"), n_chars=F.char_length("redacted").cast("long")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids, comma-joined), ``ids``. A null
    text has no ids, repeated rows and null ids stay, an empty table stays empty.
    """
    coded = bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "ids")


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", remove_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", remove_personal_data),
    ("bpe", encode),
]

#: SQL has no counterpart of the trained and the tokenising stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
