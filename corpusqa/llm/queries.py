"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.llm import chat_format, decontaminate, exact_topk, language_id, line_dedup, lm, mixing, packing, quality, secrets, simhash, spelling, vector_codes
from corpusqa.llm.common import table
from corpusqa.llm.oracle import ORACLE  # noqa: F401


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file; each machine has its own copy of the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], turns.schema)
    return chat_format.read_back(chat_format.expand(turns.union(probe)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality.select(docs, table(spark, sf_dir, "labels"))
    return rated.select("row.doc_id", "expected_grade", "p_top", "keep")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    items = F.col("items")
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "row.doc_id",
        *[count(k) for k in secrets.KINDS],
        F.sha2(secrets.joined(F.col("spans"), secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), weights=(5, 2, 1))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    sha = F.lit("")
    for dim, own in books.items():
        sha = F.when(F.col("dim") == dim, vector_codes.digest(own)).otherwise(sha)
    out = vector_codes.with_label_error(coded.withColumn("sha", sha))
    return out.select("vec_id", "code", "error", "label_error", F.col("sha").alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_chat_format,
        op3_language_id,
        op4_best_fit_packing,
        op5_quality,
        op6_decontaminate,
        op7_secrets,
        op8_exact_topk,
        op9_simhash,
        op10_lm_scoring,
        op11_mixing,
        op12_spelling,
        op13_vector_codes,
    )
}
