"""Corpus preparation: quality rules, line and near deduplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's result to the shared folder and reads
it again as the next stage's docs, so a lost executor costs no earlier stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.llm import decision_list, line_dedup, minhash, mixing, packing
from heliolake.llm.queries import PATTERN, TOKENIZER
from heliolake.llm.shared import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return decision_list.quality_filter(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier one, n_chars brought up to date;
    documents of which no line is left go."""
    lines = line_dedup.dedup_lines(docs)
    left = lines.filter("n_lines = 0 OR n_exact + n_near < n_lines")
    return left.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c)
                         for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each component of near duplicates. Rows
    that share this doc_id are one document and all stay, as do rows without a doc_id."""
    judged = minhash.near_duplicates(docs)
    gone = judged.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as its source's target weight asks for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 1024."""
    return packing.pack_documents(docs, TOKENIZER, PATTERN, 1024, 0)


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines),
          ("minhash_near_dedup", near_duplicates), ("mixing", mix), ("packing", pack)]

#: Learning and packing are not expressible in SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
