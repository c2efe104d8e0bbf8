"""Corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but
the last return the columns of ``documents``, only with the rows (and, for repeated
passages, texts) that the stage keeps. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelterlens.llm import mixing, ngram_join, packing, quality_rules, substring_dedup
from shelterlens.llm.common import table
from shelterlens.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (``quality_rules.keep_good``). Null and empty texts fail; equal
    rows share their fate; the columns of documents come back, extra ones are left out, whatever their names."""
    return quality_rules.keep_good(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the smallest doc_id (``ngram_join.keep_one``). Texts without
    words and rows without a doc_id stay; rows that repeat a kept doc_id stay; an empty table gives none."""
    return ngram_join.keep_one(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has (``substring_dedup.without_repeats``). The first
    occurrence by (doc_id, place) stays; a text that was nothing else goes; null texts and ids stay as they are."""
    return substring_dedup.without_repeats(docs).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics (``mixing.keep_mixed``). Null
    levels are one level, equal doc_ids share their fate, texts without tokens take their cell's chance."""
    return mixing.keep_mixed(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' token pieces in sequences (``packing.pack``). Null and empty texts are one
    piece; equal rows take places of their own; an empty table gives no rows."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", repeated_passages), ("mixing to target weights", mix), ("best-fit packing", pack)]

# Tokenizers, content-defined chunks and raking are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else materialize(out)
    return docs
