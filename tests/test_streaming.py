"""Streaming variants give the same rows as the batch plans."""

import os

from pyspark.sql import functions as F

from corpusqa.operators import clean, retrieval
from corpusqa.operators.chunk import explode_chunks, pack_chunks
from corpusqa.plans.stand_in import pseudo_logits
from corpusqa.session import scratch_path
from corpusqa.sources import driver_tables as dt
from corpusqa.streaming.questions import answer_batch, question_stream, stream_clean_chunks, stream_predictions

SF = "/root/testdata/sf0.001"


def test_stream_predictions_equal_batch(spark):
    raw = dt.passages(spark, SF).drop("ordinal")
    passages = clean.clean_passages(raw)
    index_path = scratch_path(spark, "stream-index")
    retrieval.write_index(retrieval.build_index(raw), index_path)
    index = retrieval.read_index(spark, index_path)
    src = scratch_path(spark, "questions")
    qs = dt.test_questions(spark, SF).select(F.col("id").cast("string").alias("id"), "question")
    for part in range(2):          # two files -> two micro-batches
        qs.filter(F.col("id").cast("long") % 2 == part).write.parquet(os.path.join(src, f"part{part}"))
    scorer = lambda f: pseudo_logits(f.withColumn("example_id", F.col("example_id").cast("long")))
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    stream = question_stream(spark, os.path.join(src, "*"), max_files_per_trigger=1)
    q = stream_predictions(stream, index, passages, out, ckpt, scorer, delimiter=".")
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("id", "docid", "answer").collect())
    batch = answer_batch(qs, index, passages, scorer, delimiter=".")
    assert got == sorted(tuple(r) for r in batch.select("id", "docid", "answer").collect())
    assert len(got) > 0


def test_stream_clean_chunks_equal_batch(spark):
    src = scratch_path(spark, "passages-src")
    dt.passages(spark, SF).select(F.col("docid").cast("string").alias("docid"), "passage").write.parquet(src)
    out, ckpt = scratch_path(spark, "chunks-out"), scratch_path(spark, "chunks-ckpt")
    stream_clean_chunks(spark, src, out, ckpt, capacity=413, delimiter=".").awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("docid", "chunk_idx", "doc_start", "doc_end").collect())
    p = clean.clean_passages(spark.read.parquet(src)).withColumn("capacity", F.lit(413))
    exp = explode_chunks(pack_chunks(p, "capacity", 100, ".").drop("passage"), keep=["docid", "capacity"])
    assert got == sorted(tuple(r) for r in exp.select("docid", "chunk_idx", "doc_start", "doc_end").collect())
