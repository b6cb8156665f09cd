"""Structured Streaming variants.

* ``stream_predictions``: a stream of questions answered against a stored
  index and passage table (stream-static), one micro-batch at a time in
  ``foreachBatch``. Each batch writes its own output folder with overwrite,
  so a batch replayed after a failure replaces its earlier partial output
  (idempotent sink); progress lives in the checkpoint location.
* ``stream_clean_chunks``: cleaning, sentence split and packing of a passage
  stream. These are stateless row functions, so they run unchanged on
  ``readStream`` and need no watermark or state store.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.operators import clean, retrieval
from corpusqa.operators.chunk import explode_chunks, pack_chunks
from corpusqa.plans import pipeline
from corpusqa.schemas import PASSAGES, TEST


def question_stream(spark: SparkSession, path: str, schema=TEST, fmt: str = "parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def answer_batch(batch: DataFrame, index: retrieval.Index, passages: DataFrame, scorer, k: int = retrieval.DEFAULT_K,
                 delimiter: str = "。") -> DataFrame:
    """Answers for one batch of raw questions (id, question)."""
    return pipeline.predict(index, batch, passages, scorer, k, delimiter=delimiter)


def stream_predictions(questions: DataFrame, index: retrieval.Index, passages: DataFrame, out_path: str,
                       checkpoint: str, scorer, k: int = retrieval.DEFAULT_K, delimiter: str = "。",
                       trigger: dict | None = None):
    """Start the streaming query; returns the ``StreamingQuery``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = answer_batch(batch, index, passages, scorer, k, delimiter)
        out.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))

    w = questions.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_clean_chunks(spark: SparkSession, path: str, out_path: str, checkpoint: str, capacity: int,
                        delimiter: str = "。", overlap: int = 100, fmt: str = "parquet",
                        trigger: dict | None = None):
    """Clean and chunk a passage stream (docid, passage) into chunk rows."""
    src = spark.readStream.schema(PASSAGES).format(fmt).load(path)
    p = clean.clean_passages(src).withColumn("capacity", F.lit(capacity))
    rows = explode_chunks(
        pack_chunks(p, "capacity", overlap, delimiter, keep=("docid",)).drop("passage"),
        keep=["docid", "capacity"],
    )
    w = (
        rows.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
    )
    return w.start()
