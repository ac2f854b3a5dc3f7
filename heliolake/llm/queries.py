"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm import (
    decision_list,
    lexical_search,
    licenses,
    line_dedup,
    minhash,
    mixing,
    packing,
    piece_encoder,
    stream_dedup,
    token_alignment,
    toxicity,
    unit_dedup,
    url_rules,
)
from heliolake.llm.shared import table

TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Fixed values of the URL query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, PATTERN, 1024, 0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_dedup.dedup_units(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic")
    scores = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         "max_distance", "n_windows")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.dedup_stream(spark, f"{sf_dir}/documents.parquet").drop("locator")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"),
                                  url_rules.rules_frame(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decision_list.judge_quality(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "rule")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_encoder.encode_pieces(table(spark, sf_dir, "documents"), PIECES)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search_documents(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "benchmark"), 50)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align_documents(table(spark, sf_dir, "documents"), TOKENIZER,
                                              PATTERN, PIECES)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return token_alignment.link_counts(
        aligned.withColumn("groups_sha256", digest).drop("groups"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_packing, op2_line_dedup, op3_substring_dedup, op4_toxicity, op5_exact_dedup,
    op6_url_filters, op7_mixing, op8_license_scans, op9_quality_rules, op10_minhash,
    op11_sentencepiece, op12_lexical_search, op13_token_alignment)}
