"""Logical tables derived from the driver's parquet tables (FIXTURES.md §2).

Each function reads the whole table; the derivation rules are plain column
expressions so that the same rows can be produced in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.session import spread

# Fixed values of the fixture rules.
TRAIN_ANSWER_MULT = 37
SENTENCE = r"[^.]*\.|[^.]+"
UNFINDABLE_EVERY = 50
UNFINDABLE_SUFFIX = "@@"
CONVERSATION_ID_MULT = 1000
DEV_FILE, TRAIN_FILE = "dev.csv", "train.csv"
ACCURACY_SCALE = 500.0


# Tables whose rows carry text that every query processes row by row.
TEXT_TABLES = {"documents", "benchmark", "conversations", "pages"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def passages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """passages(ordinal, docid, passage) from ``documents``, in the table's order. Texts that are
    looked up or dealt elsewhere need no more ``partitions`` than run at once."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("ordinal", F.monotonically_increasing_id())
    return spread(d.select("ordinal", F.col("doc_id").alias("docid"), F.col("text").alias("passage")), partitions)


def test_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """test(id, question) from ``benchmark``."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("question"))


def conversation_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second question set: user turns of ``conversations``."""
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select(
        (F.col("conv_id") * CONVERSATION_ID_MULT + F.col("turn")).alias("id"), F.col("text").alias("question")
    )


def train_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """train_raw(id, docid, question, answer): one row per document. The question
    is its first sentence, the answer the sentence at a place derived from the id;
    every 50th id gets a suffix that makes the answer unfindable. A text without
    sentences has neither."""
    d = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.sparkContext.defaultParallelism)
    d = d.select("doc_id", F.regexp_extract_all("text", F.lit(SENTENCE), 0).alias("s"))
    d = d.withColumn("s", F.when(F.size("s") > 0, F.col("s")))
    ans = F.get("s", ((F.col("doc_id") * TRAIN_ANSWER_MULT) % F.size("s")).cast("int"))
    ans = F.when((F.col("doc_id") % UNFINDABLE_EVERY) == 0, F.concat(ans, F.lit(UNFINDABLE_SUFFIX))).otherwise(ans)
    return d.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("docid"), F.get("s", F.lit(0)).alias("question"), ans.alias("answer")
    )


def loss_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """loss_log(step, loss) from ``events``."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss"))


def eval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """eval_log(run, file, global_step, loss, eval_accuracy) from ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("run"),
        F.when(F.col("event_id") % 2 == 0, F.lit(DEV_FILE)).otherwise(F.lit(TRAIN_FILE)).alias("file"),
        F.col("event_id").alias("global_step"),
        F.col("value").alias("loss"),
        (F.col("value") / F.lit(ACCURACY_SCALE)).alias("eval_accuracy"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")
