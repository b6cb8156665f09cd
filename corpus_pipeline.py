"""Cleaning and packing of ``documents`` in stages.

Each stage takes the documents that its predecessor kept, as a table that was
written and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.llm import decontaminate, line_dedup, packing, quality, simhash
from corpusqa.llm.common import stored, table
from corpusqa.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is too low go. The classifier
    learns from the labelled ones among ``docs``."""
    return quality.select(docs, table(spark, sf_dir, "labels")).filter("keep").select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for their first occurrence, and with them
    documents that hold nothing else. n_chars follows the text."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    cut = line_dedup.dedup_lines(rows).filter(~((F.col("n_dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")))
    text = F.col("text")
    size = F.when(F.col("n_dropped") > 0, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": text, "n_chars": size.cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by ``benchmark`` go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in their sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# Fingerprints, tokenizers and trained models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
